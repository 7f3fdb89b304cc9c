"""Language identification by compression.

For each language a dictionary of raw text is held by zstandard; a text, reduced to lower-case words, is
cut into pieces of ``PIECE_BYTES`` and every piece compressed with each language's dictionary. The language
with the fewest bytes over the whole text wins. Where the margin to the second language is narrow, all pieces are
measured once more with a finer compressor; a margin that stays narrow rejects the text.

The dictionaries come from a bounded sample: of each language the rows with the smallest hash in each of
``SLOTS`` slots, and of a row ``SLICES`` places spread over the text, up to ``DICT_BYTES`` a language. Everything else sees every row and whole texts.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected. Ties go to
the language that sorts first (score 0, rejected). Repeated rows repeat their result. An empty table, or
one without a labelled row, learns nothing: every text is ``und``. Columns of results are prefixed only in
``identify_languages``'s own output (id and results), so extra columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_bucket, text_of

SLOTS, DICT_BYTES, SAMPLE_CHARS, SLICES = 96, 110_000, 4_000, 8
PIECE_BYTES, LEVEL = 512, 6
NO_LETTERS = re.compile(r"[\W\d_]+")
#: Rejected when the best language saves less than this share of the second best's bytes.
MARGIN = 0.01
MAX_LANGUAGES = 1_000
FIELDS = "lang_pred string, score double, margin double, rejected boolean"


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionaries by language. Collected: at most SLOTS samples of SAMPLE_CHARS a language."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"), text_of(text_col).alias("t")).where("l is not null and t != ''")
    rows = rows.withColumn("h", F.xxhash64(F.col("i"))).withColumn("s", F.pmod("h", F.lit(SLOTS)))
    first = rows.groupBy("l", "s").agg(F.min("h").alias("h"))
    langs = first.groupBy("l").count().limit(MAX_LANGUAGES + 1).count()
    if langs > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    picked = rows.join(F.broadcast(first), ["l", "s", "h"], "left_semi")  # at most MAX_LANGUAGES * SLOTS keys of 24 bytes
    # SLICES places spread over the text, or all of a shorter one
    size = SAMPLE_CHARS // SLICES
    step = F.greatest(F.floor((F.length("t") - size) / (SLICES - 1)), F.lit(size))
    sample = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda k: F.substring(F.col("t"), (k * step + 1).cast("int"), F.lit(size))), "")
    texts = picked.select("l", "s", "i", sample.alias("t")).groupBy("l", "s").agg(F.min(F.struct("i", "t")).alias("x")).select("l", "s", "x.t").collect()
    out: dict[str, bytes] = {}
    for lang, _, text in sorted(texts):
        out[lang] = (out.get(lang, b"") + reduced(text).encode("utf-8", "replace") + b" ")[:DICT_BYTES]
    return out


def reduced(text: str) -> str:
    """Lower-case words, a blank between them."""
    return NO_LETTERS.sub(" ", text.lower()).strip()


#: Before a piece: zstandard stores what it cannot shrink by some bytes as it is, with any dictionary; after bytes that
#: do shrink, the few that a dictionary saves count.
CARRIER = bytes(64)


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.langs = sorted(dictionaries)
        plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        fine = zstandard.ZstdCompressionParameters(window_log=18, chain_log=18, hash_log=17, search_log=8, min_match=3, target_length=999, strategy=zstandard.STRATEGY_BTULTRA2, **plain)
        self.by, self.fine = [], []
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **plain).compress)
            again = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.fine.append(zstandard.ZstdCompressor(compression_params=fine, dict_data=again).compress)

    def ranked(self, raw: bytes) -> list[tuple[int, str]]:
        pieces = [raw[k : k + PIECE_BYTES] for k in range(0, len(raw), PIECE_BYTES)]
        out = sorted(zip([sum([len(c(p)) for p in pieces]) for c in self.by], self.langs, strict=True))
        if len(out) > 1 and out[1][0] - out[0][0] < MARGIN * out[1][0]:
            pieces = [CARRIER + b" " + p + b" " for p in pieces]
            out = sorted(zip([sum([len(c(p)) for p in pieces]) for c in self.fine], self.langs, strict=True))
        return out

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0, True
        ranked = self.ranked(reduced(text).encode("utf-8", "replace"))
        best, lang = ranked[0]
        second = ranked[1][0] if len(ranked) > 1 else best * 2
        margin = (second - best) / max(second, 1)
        return lang, min(1.0, margin / (margin + MARGIN)) if margin else 0.0, margin, margin < MARGIN


def language_column(text: Column, dictionaries: dict[str, bytes]) -> Column:
    """A struct column with FIELDS."""

    @F.pandas_udf(FIELDS)
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = Classifier(dictionaries).predict
        for texts in batches:
            yield pd.DataFrame([predict(t) for t in texts], columns=[c.split()[0] for c in FIELDS.split(", ")])

    return identified(text)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", holdout: int = 5) -> DataFrame:
    """id, held_out and FIELDS. Rows with crc32(id) mod ``holdout`` = 0 are never learned from."""
    held = crc32_bucket(id_col, holdout) == 0
    dictionaries = learn(docs.where(~held), id_col, text_col, lang_col)
    return docs.select(F.col(id_col), held.alias("held_out"), language_column(F.col(text_col), dictionaries).alias("_lang")).select(id_col, "held_out", "_lang.*")
