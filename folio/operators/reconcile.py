"""Correcting recognised text word by word against a second reading of the same pages."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.records import LOOKALIKES

from .align import similarity

#: Runs of digits, Latin and Cyrillic letters are words; underscores and other marks part them.
WORD = re.compile("[0-9A-Za-z\u0400-\u04ff]+")
ROMAN = re.compile("[IVXLCDM]+", re.I)
AS_LATIN = str.maketrans(*LOOKALIKES)
FIXES = "array<struct<kind:string,was:string,now:string>>"


def pieces(text: str) -> list[tuple[str, bool]]:
    """The text in order as (piece, is a word); the pieces joined are the text."""
    out, at = [], 0
    for m in WORD.finditer(text):
        if m.start() > at:
            out.append((text[at : m.start()], False))
        out.append((m[0], True))
        at = m.end()
    return [*out, (text[at:], False)] if at < len(text) else out


def composed(word: str) -> str:
    """Composed letters, without marks that stand alone."""
    return "".join(c for c in unicodedata.normalize("NFC", word) if not unicodedata.combining(c))


def script(word: str) -> str:
    """latin, cyrillic, mixed, or empty without letters of either."""
    kinds = {"latin" for c in word if "a" <= c.lower() <= "z"} | {"cyrillic" for c in word if "\u0400" <= c <= "\u052f"}
    return kinds.pop() if len(kinds) == 1 else "mixed" if kinds else ""


def safe_fix(word: str, other: str, floor: float = 0.55) -> bool:
    """Whether ``other`` may replace ``word``.

    Never for equal words, for single characters or another case only. Words that look alike are the same word in
    two scripts: a mixed one is always wrong, a whole Cyrillic one yields to Latin, a Latin one to Cyrillic unless it
    is a Roman numeral. Else the other reading must not merely have lost characters, neither may be a number or a
    long code, lengths differ by two at most, and the words, or their look-alikes, are similar.
    """
    if word.lower() == other.lower() or min(len(word), len(other)) < 2:
        return False
    alike = word.translate(AS_LATIN), other.translate(AS_LATIN)
    if alike[0] == alike[1]:
        pair = script(word), script(other)
        return pair[0] == "mixed" or pair == ("cyrillic", "latin") or pair == ("latin", "cyrillic") and not ROMAN.fullmatch(word)
    if len(alike[1]) < len(alike[0]) and alike[1] in alike[0]:
        return False
    digits, letters = (sum(map(kind, word + other)) for kind in (str.isdigit, str.isalpha))
    if digits and (digits >= letters or max(len(word), len(other)) >= 12):
        return False
    return abs(len(word) - len(other)) <= 2 and max(similarity(word, other), similarity(*alike)) >= floor


def reconciled(text: str, reference: str, most: int = 4, most_new: int = 0, floor: float = 0.55, fits: Callable[[str, str, float], bool] = safe_fix) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with safe fixes, and what was done or left: (kind, was, now).

    Only runs of as many words, ``most`` at most, are compared word by word in place, so spacing and markup stay.
    Words that only the reference has come in where ``most_new`` allows, not at the ends and not numbers alone;
    words that only the text has always stay.
    """
    parts = pieces(text)
    own = [k for k, (_, is_word) in enumerate(parts) if is_word]
    words, other = [parts[k][0] for k in own], [composed(w) for w in WORD.findall(reference)]
    said, done = [p for p, _ in parts], []
    for kind, a, b, c, d in difflib.SequenceMatcher(None, words, other, autojunk=False).get_opcodes():
        old, new = words[a:b], other[c:d]
        if kind == "replace" and len(old) == len(new) <= most:
            for k, w, o in zip(own[a:b], old, new, strict=True):
                fix = fits(w, o, floor)
                done.append(("replace" if fix else "skip-word", w, o))
                said[k] = o if fix else w
        elif kind == "insert" and 0 < a < len(words) and len(new) <= most_new and not all(map(str.isdigit, new)):
            said[own[a]] = " ".join([*new, said[own[a]]])
            done.append(("insert", "", " ".join(new)))
        elif kind != "equal":
            done.append(({"replace": "skip-replace", "insert": "skip-insert", "delete": "keep-delete"}[kind], " ".join(old), " ".join(new)))
    return "".join(said), done


def reconcile(text: Column, reference: Column, most: int = 4, most_new: int = 0, floor: float = 0.55) -> Column:
    """A struct column: the text after safe fixes, and the list of fixes."""

    @F.pandas_udf(f"text string, fixes {FIXES}")
    def run(texts: pd.Series, references: pd.Series) -> pd.DataFrame:
        out = [reconciled(t or "", r or "", most, most_new, floor) for t, r in zip(texts, references, strict=True)]
        return pd.DataFrame({"text": [t for t, _ in out], "fixes": [[dict(zip(("kind", "was", "now"), f, strict=True)) for f in fixes] for _, fixes in out]})

    return run(text, reference)


@F.pandas_udf(T.BooleanType())
def safe_to_fix(words: pd.Series, others: pd.Series) -> pd.Series:
    return pd.Series([safe_fix(w or "", o or "") for w, o in zip(words, others, strict=True)], dtype="bool")


def apply_accepted(lines: DataFrame, accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, skipped). lines: doc, line, text; accepted: doc, old, new, plain (a body paragraph without marks).

    An accepted text replaces the one line that equals its old text when trimmed. What isn't plain or stands on
    no or several lines is skipped: doc, old, why.
    """
    hits = lines.select("doc", "line", F.trim("text").alias("old"))
    counted = accepted.join(hits.groupBy("doc", "old").agg(F.count("*").alias("k"), F.min("line").alias("line")), ["doc", "old"], "left")
    counted = counted.withColumn("k", F.coalesce("k", F.lit(0).cast("long")))
    why = F.when(~F.col("plain"), "not a plain body paragraph").when(F.col("k") != 1, F.concat(F.col("k").cast("string"), F.lit(" matching lines")))
    judged = counted.withColumn("why", why)
    changes = judged.where("why is null").groupBy("doc", "line").agg(F.max("new").alias("new"))
    out = lines.join(changes, ["doc", "line"], "left").select("doc", "line", F.coalesce("new", "text").alias("text"))
    return out, judged.where("why is not null").select("doc", "old", "why")
