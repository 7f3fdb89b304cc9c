"""Streamed answers of a model put together per conversation: tool calls by round and index, text, and what came late.

State is kept per conversation. The pieces of a round wait until its end mark has been seen; the round is then given out at
the end of that batch, each call with its last name and all its arguments in order. So a stream gives the same calls wherever
its batches are cut, as long as a round's end mark comes in no earlier batch than its pieces.

Defined results: pieces of a round that is closed are given out as ``late`` and change nothing. Rounds from ``MAX_ROUNDS`` on
call no tools: their text only is kept. A conversation that is silent for longer than the time-out, as the times of the
pieces have it, gives out its open rounds as ``open`` and is forgotten; what comes after begins anew. Pieces that are older
than the newest one by more than the time-out are dropped. Null names, arguments and texts are empty; equal
piece numbers keep one piece, the largest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MAX_ROUNDS = 16
PIECES = "conv long, round int, index int, seq long, name string, arguments string, content string, ended boolean, at timestamp"
CALLS = "conv long, round int, index int, state string, name string, arguments string"
#: The index of a round's text.
TEXT = -1


def pieces(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines of server-sent events (conv, round, seq, at, line) as pieces; a line that can't be read is none."""
    data = F.when(F.col(line).startswith("data:"), F.trim(F.substring(line, 6, 1 << 30)))
    call = "struct<index:int,function:struct<name:string,arguments:string>>"
    read = F.from_json(data, f"struct<choices:array<struct<delta:struct<content:string,tool_calls:array<{call}>>>>>")
    delta = F.get(read.getField("choices"), F.lit(0)).getField("delta")
    kind = "array<struct<index:int,name:string,arguments:string,content:string,ended:boolean>>"
    calls = F.transform(delta.getField("tool_calls"), lambda c: F.struct(F.coalesce(c["index"], F.lit(0)).alias("index"), c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments"), F.lit(None).cast("string").alias("content"), F.lit(False).alias("ended")))
    none = F.lit(None).cast("string")
    one = lambda content, ended: F.array(F.struct(F.lit(TEXT).alias("index"), none.alias("name"), none.alias("arguments"), content.alias("content"), F.lit(ended).alias("ended")))
    empty = F.expr(f"cast(array() as {kind})")
    said = delta.getField("content")
    found = F.when(data == "[DONE]", one(none, True)).otherwise(F.concat(F.when(F.coalesce(said, F.lit("")) != "", one(said, False)).otherwise(empty), F.coalesce(calls, empty)))
    rows = lines.withColumn("_d", data).where("_d is not null").select("conv", "round", "seq", "at", F.explode(found.cast(kind)).alias("x"))
    return rows.select("conv", "round", "x.index", "seq", "x.name", "x.arguments", "x.content", "x.ended", "at")


def _given(conv: int, number: int, slots: dict[str, dict[str, list]], state: str) -> list[tuple]:
    out = []
    for index in sorted(map(int, slots)):
        own = sorted((int(seq), *piece) for seq, piece in slots[str(index)].items())
        names = [name for _, name, _ in own if name]
        if index == TEXT or number < MAX_ROUNDS:
            out.append((conv, number, index, state, names[-1] if names else None, "".join(text for *_, text in own)))
    return out


def _relayed(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState, silence_ms: int) -> Iterator[pd.DataFrame]:
    conv = key[0]
    held = json.loads(group.get[0]) if group.exists else {"closed": [], "open": {}}
    out = []
    if group.hasTimedOut:
        for number, slots in sorted(held["open"].items(), key=lambda x: int(x[0])):
            out += _given(conv, int(number), slots, "open")
        group.remove()
    else:
        ended, last = set(), held.get("last", 0)
        for batch in batches:
            last = max([last, *(int(t.timestamp() * 1000) for t in batch["at"].dropna())])
            for number, index, seq, name, arguments, content, end in zip(*(batch[c] for c in ("round", "index", "seq", "name", "arguments", "content", "ended")), strict=True):
                number, index = int(number), int(index)
                if end is True or end == 1:
                    ended.add(number)
                    continue
                piece = [name or "", (content if index == TEXT else arguments) or ""]
                if number in held["closed"]:
                    out.append((conv, number, index, "late", piece[0] or None, piece[1]))
                    continue
                slot = held["open"].setdefault(str(number), {}).setdefault(str(index), {})
                slot[str(seq)] = max(slot.get(str(seq), piece), piece)
        for number in sorted(ended - set(held["closed"])):
            out += _given(conv, number, held["open"].pop(str(number), {}), "call")
            held["closed"].append(number)
        group.update((json.dumps(held | {"last": last}),))
        group.setTimeoutTimestamp(max(last, group.getCurrentWatermarkMs()) + silence_ms)
    yield pd.DataFrame(out, columns=[c.split()[0] for c in CALLS.split(", ")]).astype({"round": "int32", "index": "int32"})


def relay(stream: DataFrame, silence_ms: int = 600_000) -> DataFrame:
    """CALLS as rounds end; text is the call with index -1, its content in ``arguments``."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        yield from _relayed(key, batches, group, silence_ms)

    rows = stream.select(*(c.split()[0] for c in PIECES.split(", "))).withWatermark("at", f"{silence_ms} milliseconds")
    return rows.groupBy("conv").applyInPandasWithState(step, CALLS, "held string", "append", GroupStateTimeout.EventTimeTimeout)


def assembled(rows: DataFrame) -> DataFrame:
    """The same of a table of pieces, as one batch."""
    text: Column = F.when(F.col("index") == TEXT, F.col("content")).otherwise(F.col("arguments"))
    distinct = rows.where("not ended").groupBy("conv", "round", "index", "seq").agg(F.max(F.struct(F.coalesce("name", F.lit("")).alias("name"), F.coalesce(text, F.lit("")).alias("text"))).alias("p"))
    closed = rows.where("ended").select("conv", "round").distinct()
    named = F.max_by("p.name", F.when(F.col("p.name") != "", F.col("seq"))).alias("name")
    out = distinct.join(closed, ["conv", "round"]).where((F.col("index") == TEXT) | (F.col("round") < MAX_ROUNDS)).groupBy("conv", "round", "index").agg(named, F.array_sort(F.collect_list(F.struct("seq", "p.text"))).alias("all"))
    return out.select("conv", "round", "index", F.lit("call").alias("state"), "name", F.array_join(F.transform("all", lambda x: x["text"]), "").alias("arguments"))
