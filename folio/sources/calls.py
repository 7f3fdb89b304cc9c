"""Calls to services as rows: a failure is a value of its row and never ends the job.

``called`` asks a service from the tasks of a partitioned table, with a pause between calls and longer ones after refusals.
``replayed`` gives the outcome of the same rules over recorded attempts, by DataFrame functions alone, waiting times included.

Rules: before each attempt the throttle. A 429 is tried again after the delay, or what the service asks for if that is
longer, 6 times at most; a 400 that says -32700 and a lost network are tried again twice. The delay doubles after a
429 and a lost network, up to the longest one. Any other status ends the call with an error; a network lost for good is the
error ``network``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds and numbers of attempts.
THROTTLE, DELAY, LONGEST = 1.3, 2.0, 40.0
REFUSALS, TRANSIENTS = 6, 2
RESULT = "ok boolean, value string, error string, attempts int, waited double"


@dataclass
class Answer:
    """status 200 and a body, or another status with what the service said; 0 is a lost network."""

    status: int
    body: str = ""
    retry_after: float | None = None


def called(requests: DataFrame, ask: Callable[[str, str], Answer], id_col: str = "id", tool_col: str = "tool", args_col: str = "args", throttle: float = THROTTLE, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(id, ok, value, error, attempts, waited). ask(tool, args) answers or raises; what it raises is a lost network if it is an
    OSError, else an error of the row. One call at a time in each partition."""

    def one(tool: str, args: str) -> tuple:
        delay, waited, attempt = DELAY, 0.0, 0
        while True:
            attempt += 1
            sleep(throttle)
            waited += throttle
            try:
                answer = ask(tool, args)
            except OSError as lost:
                answer = Answer(0, str(lost))
            except Exception as error:  # noqa: BLE001 - the row's error
                return False, None, repr(error)[:200], attempt, waited
            if answer.status == 200:
                return True, answer.body, None, attempt, waited
            refused, lost = answer.status == 429, answer.status == 0
            transient = lost or (answer.status == 400 and "-32700" in answer.body)
            if not (refused and attempt <= REFUSALS or transient and attempt <= TRANSIENTS):
                return False, None, "network" if lost else f"HTTP {answer.status}", attempt, waited
            pause = max(answer.retry_after or 0.0, delay) if refused else delay
            sleep(pause)
            waited += pause
            delay = min(2 * delay, LONGEST) if refused or lost else delay

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*r) for r in zip(batch.column("tool").to_pylist(), batch.column("args").to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.bool_(), pa.string(), pa.string(), pa.int32(), pa.float64()]
            yield pa.record_batch([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["id", *(c.split()[0] for c in RESULT.split(", "))])

    kind = requests.schema[id_col].dataType.simpleString()
    return requests.select(F.col(id_col).alias("id"), F.col(tool_col).alias("tool"), F.col(args_col).alias("args")).mapInArrow(answered, f"id {kind}, {RESULT}")


def replayed(attempts: DataFrame, id_col: str = "id", order: str = "attempt") -> DataFrame:
    """(id, ok, value, error, attempts, waited) from recorded attempts (id, attempt, status, body, retry_after).

    A record that ends before its call does is a lost network. Attempts after the end are not looked at.
    """
    rows = attempts.groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "status", F.coalesce("body", F.lit("")).alias("body"), F.col("retry_after").cast("double").alias("retry_after")))).alias("a"))
    zero = F.struct(F.lit(False).alias("over"), F.lit(False).alias("ok"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("n"), F.lit(0.0).alias("waited"), F.lit(DELAY).alias("delay"))

    def step(s: Column, a: Column) -> Column:
        n = s["n"] + 1
        refused, lost = a["status"] == 429, a["status"] == 0
        transient = lost | ((a["status"] == 400) & a["body"].contains("-32700"))
        good = a["status"] == 200
        again = (refused & (n <= REFUSALS)) | (transient & (n <= TRANSIENTS))
        pause = F.when(~again, 0.0).when(refused, F.greatest(F.coalesce(a["retry_after"], F.lit(0.0)), s["delay"])).otherwise(s["delay"])
        error = F.when(good | again, F.lit(None)).when(lost, "network").otherwise(F.concat(F.lit("HTTP "), a["status"].cast("string")))
        delay = F.when(again & (refused | lost), F.least(s["delay"] * 2, F.lit(LONGEST))).otherwise(s["delay"])
        new = F.struct((~again).alias("over"), good.alias("ok"), F.when(good, a["body"]).alias("value"), error.cast("string").alias("error"), n.alias("n"), (s["waited"] + THROTTLE + pause).alias("waited"), delay.alias("delay"))
        return F.when(s["over"], s).otherwise(new)

    done = rows.select("id", F.aggregate("a", zero, step).alias("s"))
    return done.select("id", "s.ok", "s.value", F.when(~F.col("s.over"), "network").otherwise(F.col("s.error")).alias("error"), F.col("s.n").alias("attempts"), "s.waited")
