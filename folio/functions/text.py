"""Text functions as column expressions (no Python on the executors, but for ``fold_exact``)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Accented letters of Latin and Cyrillic text and what remains without the marks, derived from Unicode's decompositions.
_FOLDED = {
    c: base
    for c in map(chr, [*range(0xC0, 0x250), *range(0x400, 0x460), *range(0x1E00, 0x1F00)])
    if len(base := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()) == 1 and base != c
}
_FROM, _TO = "".join(_FOLDED), "".join(_FOLDED.values())
#: Ligatures and digraphs, and the letters that they stand for, by the same rule.
_SEVERAL = {
    c: base
    for c in map(chr, [*range(0x132, 0x134), 0x149, *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4), *range(0xFB00, 0xFB07)])
    if len(base := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()) > 1
}
#: Combining marks.
MARKS = r"\p{M}+"
#: Arabic vowel marks alone, and with tatweel and Quranic signs.
VOWELS = "[\u064b-\u065f\u0670]"
HARAKAT = "[\u0640\u064b-\u065f\u0670\u06d6-\u06ed]"
LETTER_RUN, WORD_CHARS, INDEX_CHARS = r"\p{L}+", "[a-zа-я0-9]+", r"[\p{L}\p{N}]+"


def fold(text: Column) -> Column:
    """Lower case without diacritics, ligatures as their letters; null gives ''."""
    text = F.coalesce(text, F.lit(""))
    plain = F.regexp_replace(text, MARKS, "")
    for c, letters in _SEVERAL.items():
        plain = F.replace(plain, F.lit(c), F.lit(letters))
    plain = F.when(text.rlike(r"[\p{M}" + "".join(_SEVERAL) + "]"), plain).otherwise(text)  # few texts hold any: one look is enough
    # characters of one byte each need no folding, and looking each of them up costs more than the rest
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.lower(F.translate(plain, _FROM, _TO)))


def folded(text: str) -> str:
    """``fold`` of a text of the driver, a question for instance."""
    return "".join(_SEVERAL.get(c) or _FOLDED.get(c, c) for c in text if not unicodedata.category(c).startswith("M")).lower()


@F.pandas_udf(T.StringType())
def fold_exact(texts: pd.Series) -> pd.Series:
    """The same for all of Unicode, compatibility characters included."""
    return texts.fillna("").map(lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower())


def words(text: Column) -> Column:
    """Folded Latin, Cyrillic and digit words, in order."""
    return F.regexp_extract_all(fold(text), F.lit(WORD_CHARS), F.lit(0))


def index_words(text: Column) -> Column:
    """Folded runs of letters and digits of any script, in order."""
    return F.regexp_extract_all(fold(text), F.lit(INDEX_CHARS), F.lit(0))


def letter_words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LETTER_RUN), F.lit(0))


def word_set(text: Column, shortest: int = 1) -> Column:
    return F.array_distinct(F.filter(words(text), lambda w: F.length(w) >= shortest))


def shingles(tokens: Column, k: int) -> Column:
    """64-bit hashes of the runs of k tokens, in order; empty if there are fewer tokens."""
    n = F.size(tokens) - (k - 1)
    one = lambda i: F.xxhash64(F.array_join(F.slice(tokens, i, F.lit(k)), " "))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one)).otherwise(F.expr("array()").cast("array<bigint>"))


def jaccard(a: Column, b: Column) -> Column:
    """0 if either set is empty; a and b don't repeat what they hold."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)))


def clean_spaces(text: Column) -> Column:
    """No carriage returns, runs of blanks as one, lines trimmed, at most one empty line, ends trimmed."""
    text = F.regexp_replace(F.replace(text, F.lit("\r"), F.lit("")), "[ \\t\u00a0]+", " ")
    text = F.regexp_replace(text, " ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def portable_path(path: Column, roots: dict[str, str]) -> Column:
    """The path relative to the first root it lies under, with the root's name; else unchanged."""
    out = path
    for root, name in reversed(roots.items()):
        out = F.when(F.startswith(path, F.lit(root + "/")), F.concat(F.lit(name + ":"), F.substring(path, F.lit(len(root) + 2), F.length(path)))).otherwise(out)
    return out


def mixed_share(text: Column) -> Column:
    """The share of words of three letters or more that mix Latin and Cyrillic."""
    long = F.filter(F.regexp_extract_all(text, F.lit("[A-Za-zА-Яа-яЁё]{3,}"), F.lit(0)), lambda w: F.lit(True))
    mixed = F.filter(long, lambda w: w.rlike("[A-Za-z]") & w.rlike("[А-Яа-яЁё]"))
    return F.size(mixed) / F.greatest(F.size(long), F.lit(1))


def cut(text: Column, n: int) -> Column:
    """At most n characters, and an ellipsis if some are left out."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("…"))).otherwise(text)


def excerpt(text: Column, at: Column, span: int = 46) -> Column:
    """The text around a place counted from 0."""
    start = F.greatest(at - span, F.lit(0))
    return F.concat(F.lit("…"), F.trim(F.substring(text, start + 1, at + span - start)), F.lit("…"))


def for_model(text: Column, kind: str) -> Column:
    """The text as models with two kinds of input take it: kind is query or passage."""
    return F.concat(F.lit(f"{kind}: "), text)


def same_text(left: Column, right: Column) -> Column:
    """Equal but for white space and the places of vowel marks: the same letters in order, and each mark as often. Null is empty."""
    bare = lambda t: F.regexp_replace(F.regexp_replace(F.coalesce(t, F.lit("")), VOWELS, ""), r"[\s\u00ad\u200e]+", "")
    marks = lambda t: F.array_sort(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(VOWELS), F.lit(0)))
    return (bare(left) == bare(right)) & (marks(left) == marks(right))
