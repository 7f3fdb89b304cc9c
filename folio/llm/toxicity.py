"""Toxicity of texts behind a noisy channel.

Writers hide words by leetspeak ("1d10t"), spacing ("i d i o t") and repetition ("idioooot"). Tokens are decoded: a
lattice of what each character may stand for is searched (Viterbi) under a character trigram model, with a cost for every
substitution, dropped separator and dropped repetition. Spans that look hidden are read as one word; every token that is no
plain word (a word with a doubled letter is none) is also read whole, once with separators as possible bounds of words,
scored by the model, and once without. A text is scored by the words of all these readings.

The trigram model counts the words of all documents. The word weights (lower bounds of the log-odds of presence, of
words whose association with the label is beyond chance) are learned from at most ``TRAIN_ROWS`` labelled rows,
those with the smallest id hash; rows with crc32(id) mod ``holdout`` = 1 are never learned from.

Defined results: null and empty text get the score of a text without any weighted word. Long texts are
restored and scored whole. Repeated rows repeat their result; a labelled id that repeats counts as often.
With no labelled row every score is 0.5 at most and nothing is predicted. Only the id and the results come
back from ``score_documents``, so extra columns cannot clash.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_bucket, held_by_worker, text_of, written

TRAIN_ROWS = 40_000
#: A word weighs if its z value in the labelled rows is at least this, and at least so many toxic rows hold it.
MIN_Z, MIN_ROWS = 5.0, 5
THRESHOLD = 0.7
#: Log-odds of the label, given a word, from which on it weighs: 9 of 10 rows that hold it. Copies of a few rows make many
#: common words look telling; these are not.
MIN_PURE = math.log(9)
#: The weight of a word that clean rows hold too is at most this, so that one such word does not decide; a word counts
#: at most so many times.
MOST_MIXED, MOST_TIMES = 2.5, 3

#: What a character may stand for in leetspeak.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "*": "aeiou",
}
SEPARATORS = " .-_*"
#: Log costs of the channel.
SUBSTITUTED, ANY_VOWEL, DROPPED_SEPARATOR, DROPPED_REPEAT, DROPPED_DOUBLE, DROPPED_MARK, DROPPED_LEET, KEPT_ODD = -1.0, -3.0, -0.1, -0.4, -8.0, -1.5, -5.0, -6.0
#: That of a dropped double letter in a reading beside the plain one.
OPEN_DOUBLE = -2.0

#: Suspect within a word: spaced-out single letters, leet characters before or between letters, a letter three times.
SPACED = r"(?<![^\W_])[^\W\d_](?:[.\-_*]{1,2}[^\W_]){2,}(?![^\W_])"
LEET = r"[^\W\d_][0-9@$!|+(*]+[^\W_][\w@$!|+(*]*|[0-9@$|+(]+[^\W\d_][\w@$!|+(*]*"
REPEATED = r"([^\W\d_])\1\1"
SUSPECT = re.compile(f"{SPACED}|[^\\W\\d_]*(?:{LEET}|{REPEATED}[^\\W\\d_]*)")
#: Tokens whose weighted words a task remembers, and as many spans; longer ones are read each time.
MAX_TOKENS, MAX_TOKEN_CHARS = 150_000, 64
#: Sets of letters whose possible words are remembered; equal lists of words are one.
MAX_SETS = 30_000
PUNCTUATION, TRIPLE = ".,;:!?\"'()", re.compile(r"(.)\1\1")
#: Marks that stand for no letter, at the ends of a plain word; the ends and doubles at which a word is no plain one.
PLAIN_ENDS, ODD_END, DOUBLE = ".,;:?\"')", re.compile(r"[^\W\d_][0-9@$|+*]+[.,;:!?\"')]*$"), re.compile(r"([^\W\d_])\1")
#: In a run of single letters, parts of so many letters may be words.
LEAST_PART, MOST_PART = 4, 24
GAPS = re.compile(r"\s+")
WORDS = re.compile(r"[^\W\d_]+")
LETTERS = {c: k for k, c in enumerate("abcdefghijklmnopqrstuvwxyz", 1)}
EDGE, N = 0, 27


def letter(c: str) -> int:
    """Its place in the model's alphabet: accents dropped, 0 for what is no Latin letter."""
    return LETTERS.get(c) or LETTERS.get(unicodedata.normalize("NFKD", c)[:1], EDGE)


#: Code points to the alphabet; what lies beyond is no letter.
CODES = np.array([letter(chr(c).lower()) for c in range(0x250)], np.int32)


def count_trigrams(text: str, counts: np.ndarray) -> None:
    """Adds the text's trigrams to counts; words begin after two edges."""
    points = np.frombuffer(f"  {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    k = np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], EDGE)
    counts += np.bincount(k[:-2] * (N * N) + k[1:-1] * N + k[2:], minlength=N**3).reshape(N, N, N)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated with shorter contexts."""
    counts = counts.copy()
    counts[EDGE, EDGE] = counts[:, EDGE].sum(axis=0)
    counts[EDGE, EDGE, EDGE] = 0
    tri = counts / np.maximum(counts.sum(axis=2, keepdims=True), 1)
    pair = counts.sum(axis=0) + 0.1
    bi = pair / pair.sum(axis=1, keepdims=True)
    one = pair.sum(axis=0)
    return np.log(0.7 * tri + 0.25 * bi[None] + 0.05 * one / one.sum())


def spread(t: str) -> bool:
    """Whether a token is a run of single letters."""
    if t[1:2] not in SEPARATORS and t[2:3] not in SEPARATORS or len(t) < 5:
        return False
    single = [len(x.rstrip(".,;:!?")) for x in re.split("[- ._*]", t)]
    return max(single) == 1 and sum(single) > 2


def parts(word: str) -> Iterator[str]:
    """The word, and its parts of at least LEAST_PART letters."""
    yield word
    for at in range(len(word)):
        for n in range(LEAST_PART, min(MOST_PART, len(word) - at) + 1):
            yield word[at : at + n]


@lru_cache(4096)
def may_say(c: str) -> int:
    """The letters that a reading may have for a character, as bits of the alphabet."""
    return reduce(or_, (1 << letter(x) for x in STANDS_FOR.get(c, "") + (c if c.isalpha() else "")), 0)


def hidden(word: str) -> re.Pattern:
    """Finds tokens in which the word's letters stand in order, as themselves or hidden: every reading is such a part."""
    kinds = ["".join(map(re.escape, [x, *(c for c, said in STANDS_FOR.items() if x in said)])) for x in word]
    return re.compile("".join(f"[^{k}]*[{k}]" for k in kinds), re.DOTALL)


@dataclass
class Model:
    lm: np.ndarray = field(default_factory=lambda: log_model(np.zeros((N, N, N))))
    weights: dict[str, float] = field(default_factory=dict)
    prior: float = 0.0

    def __post_init__(self):
        self.rows = self.lm.tolist()
        self.decoded: dict[tuple[str, bool], str] = {}
        self.letters = [(reduce(or_, map(may_say, w), 0), hidden(w).match) for w in self.weights]
        self.by_letters: dict[int, tuple[Callable, ...]] = {}
        self.alike: dict[tuple[Callable, ...], tuple[Callable, ...]] = {}
        self.known: dict[str, tuple[str, ...]] = {}

    def decode(self, span: str, open_: bool = False) -> str:
        """``_decode``, remembered for spans of usual length."""
        key = span, open_
        said = self.decoded.get(key)
        if said is None:
            said = self._decode(span, open_)
            if len(self.decoded) >= MAX_TOKENS:
                self.decoded.clear()
            if len(span) <= MAX_TOKEN_CHARS:
                self.decoded[key] = said
        return said

    def _decode(self, span: str, open_: bool = False) -> str:
        """The likeliest word behind a span: the best path of the lattice by (last two letters).

        With ``open_``, a separator may also end a word, blanks always do, and a dropped double letter costs less.
        """
        beams: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}  # what is said is linked backwards: long tokens
        for at, c in enumerate(span):
            new: dict[tuple[int, int], tuple[float, tuple]] = {}
            k = letter(c) if c.isalpha() else EDGE
            reads = [(x, LETTERS[x], ANY_VOWEL if c == "*" else SUBSTITUTED) for x in STANDS_FOR.get(c, "")]
            if k:
                reads.append((c, k, 0.0))
            elif c.isalnum():
                reads.append((c, EDGE, KEPT_ODD))
            for (a, b), (p, said) in beams.items():
                drops = []
                if open_ and c in SEPARATORS:
                    ended = p if a == b == EDGE else p + self.rows[a][b][EDGE]
                    if ended > new.get((EDGE, EDGE), (-math.inf,))[0]:
                        new[EDGE, EDGE] = (ended, (said, " "))
                    if c == " ":
                        continue
                if c in SEPARATORS:
                    drops.append(DROPPED_SEPARATOR)
                elif not c.isalnum():
                    drops.append(DROPPED_LEET if c in STANDS_FOR else DROPPED_MARK)
                elif k and k == b:
                    long = span[at - 2 : at] == c + c or span[at - 1 : at + 2] == c + c + c
                    drops.append(DROPPED_REPEAT if long else OPEN_DOUBLE if open_ else DROPPED_DOUBLE)
                for cost in drops:
                    if (q := p + cost) > new.get((a, b), (-math.inf,))[0]:
                        new[a, b] = (q, said)
                row = self.rows[a][b]
                for x, kx, cost in reads:
                    if (q := p + cost + row[kx]) > new.get((b, kx), (-math.inf,))[0]:
                        new[b, kx] = (q, (said, x))
            beams = new or beams
        said = max(((p + self.rows[a][b][EDGE], said) for (a, b), (p, said) in beams.items()), key=lambda x: x[0])[1]
        out = []
        while said:
            said, x = said
            out.append(x)
        return "".join(reversed(out))

    def spans(self, t: str) -> str:
        """A token, its suspect spans decoded as one word each."""
        if t.strip(PUNCTUATION).isalpha() and not TRIPLE.search(t):
            return t
        return SUSPECT.sub(lambda m: self.decode(m[0]), t)

    def token(self, t: str) -> str:
        """A token's likeliest reading: suspect spans decoded; where there is none, all of a token that is no plain word."""
        if " " in t:
            return self.decode(t, True)
        out = self.spans(t)
        if out != t or t.strip(PLAIN_ENDS).isalpha() or not (t[0] == "!" or ODD_END.search(t)):
            return out
        return self.decode(t, True)

    def readings(self, t: str) -> list[str]:
        """The words of a token: those of its spans, and those that all of it may be read as, separators as bounds or not."""
        out = WORDS.findall(self.spans(t))
        core = t.strip(PLAIN_ENDS)
        if core and (not core.isalpha() or DOUBLE.search(core)):
            reads = [self.decode(core, True)]
            if not core.isalpha() and (DOUBLE.search(core) or any(c in SEPARATORS for c in core)):
                reads.append(self.decode(core))
            more = [w for read in reads for w in WORDS.findall(read)]
            out += [w for w in dict.fromkeys(more) if w not in out]
        return out

    def tokens(self, text: str | None) -> list[str]:
        """The tokens of the text in lower case, not yet restored; runs of three or more single letters are joined by "-", by " " where the gap is wider."""
        text = (text or "").lower()
        out = text.split()
        singles = [k for k, t in enumerate(out) if len(t) < 3 and len(t.rstrip(".,;:!?")) == 1]
        if len(singles) < 3:
            return out
        gaps = [len(g) for g in GAPS.findall(text.strip())]
        joined, k = [], 0
        while k < len(singles):
            n = 1
            while k + n < len(singles) and singles[k + n] == singles[k] + n:
                n += 1
            if n >= 3:
                joined.append((singles[k], n))
            k += n
        for at, n in reversed(joined):
            own = gaps[at : at + n - 1]
            least = min(own)
            run = out[at] + "".join((" " if g > least else "-") + t for g, t in zip(own, out[at + 1 : at + n], strict=True))
            out[at : at + n] = [run]
        return out

    def restore(self, text: str | None) -> str:
        """The text in lower case, a blank between tokens, suspect spans decoded."""
        return " ".join(map(self.token, self.tokens(text)))

    def words(self, text: str | None) -> set[str]:
        """The distinct words of the restored text."""
        return {w for t in set(self.tokens(text)) for w in self.readings(t)}

    def hides(self, t: str) -> bool:
        """Whether any reading of the token may hold a word that weighs. Rules out most tokens before they are decoded."""
        bits = reduce(or_, map(may_say, t), 0)
        found = self.by_letters.get(bits)
        if found is None:
            found = tuple(match for own, match in self.letters if own & ~bits == 0)
            if len(self.by_letters) >= MAX_SETS:
                self.by_letters.clear()
                self.alike.clear()
            found = self.by_letters[bits] = self.alike.setdefault(found, found)
        for match in found:
            if match(t):
                return True
        return False

    def told(self, t: str) -> tuple[str, ...]:
        """The words of a token's readings that weigh."""
        if t.isalpha() and not DOUBLE.search(t):
            return (t,) if t in self.weights else ()
        if not self.hides(t):
            return ()
        read = self.readings(t)
        if spread(t):  # bounds of words are not told: any part may be one
            read = [w for word in read for w in parts(word)]
        return tuple(w for w in dict.fromkeys(read) if w in self.weights)

    def weighted(self, text: str | None) -> Counter:
        """The words of the restored text that weigh, and how often they stand in it."""
        tokens = self.tokens(text)
        counts, known = Counter(tokens), self.known
        out: Counter = Counter()
        for t, n in counts.items():
            found = known.get(t)
            if found is None:
                found = self.told(t)
                if len(known) >= MAX_TOKENS:
                    known.clear()
                if len(t) <= MAX_TOKEN_CHARS:
                    known[t] = found
            for w in found:
                out[w] += n
        return out

    def score(self, text: str | None) -> float:
        z = self.prior + sum(sorted(self.weights[w] * min(n, MOST_TIMES) for w, n in self.weighted(text).items()))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts over all documents; at most 27^3 rows are collected."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((N, N, N), np.int64)
        for batch in batches:
            for t in batch["t"]:
                count_trigrams(t, counts)
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"k": at, "n": counts.ravel()[at]})

    got = docs.select(text_of(text_col).alias("t")).mapInPandas(counted, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(N * N * N)
    for k, n in got:
        counts[k] = n
    return log_model(counts.reshape(N, N, N))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", holdout: int = 3, train_rows: int = TRAIN_ROWS) -> Model:
    """The character model of all documents, word weights of a bounded sample of labelled rows."""
    lm = character_model(docs, text_col)
    marked = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).where(F.col("i").isNotNull() & F.col("y").isin(0, 1) & (crc32_bucket(id_col, holdout) != 1))
    marked = marked.orderBy(F.xxhash64("i"), "i", "y").limit(train_rows)  # so at most train_rows rows of 12 bytes are broadcast
    rows = docs.select(F.col(id_col).alias("i"), text_of(text_col).alias("t")).join(F.broadcast(marked), "i").select("t", "y")

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = (Counter(), Counter())
        n = [0, 0]
        base = Model(lm)
        for batch in batches:
            for t, y in zip(batch["t"], batch["y"], strict=True):
                by[y].update(base.words(t))
                n[y] += 1
            if sum(map(len, by)) > 200_000:
                yield out(by)
                by = (Counter(), Counter())
        yield pd.concat([out(by), pd.DataFrame({"w": [None], "c": [n[0]], "x": [n[1]]})])

    def out(by: tuple[Counter, Counter]) -> pd.DataFrame:
        words = [*by[0].keys() | by[1].keys()]
        return pd.DataFrame({"w": words, "c": [by[0][w] for w in words], "x": [by[1][w] for w in words]}, columns=["w", "c", "x"])

    counts = rows.mapInPandas(held, "w string, c long, x long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("x").alias("x"))
    counts = written(counts.where(F.col("w").isNull() | (F.col("x") >= MIN_ROWS)), "words")
    total = counts.where("w is null").first()
    if not total or not total.c or not total.x:
        return Model(lm)
    rows_of = float(total.c + total.x)
    p, q, both = F.col("x") / total.x, F.col("c") / total.c, (F.col("x") + F.col("c")) / rows_of
    z = (p - q) / F.sqrt(both * (1 - both) * (1 / total.c + 1 / total.x) + 1e-12)
    odds = F.log((F.col("x") + 0.5) / (total.x + 1)) - F.log((F.col("c") + 0.5) / (total.c + 1))
    sure = odds - 2 * F.sqrt(1 / (F.col("x") + 0.5) + 1 / (F.col("c") + 0.5))
    telling = counts.where(F.col("w").isNotNull()).select("w", "c", sure.alias("sure"), z.alias("z"), odds.alias("odds"))
    # every word stands in MIN_ROWS or more of at most TRAIN_ROWS rows, and in 9 toxic ones for a clean one
    found = telling.where((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_PURE - math.log(total.x / total.c)) & (F.col("sure") > 0)).collect()
    return Model(lm, {r.w: min(r.sure, MOST_MIXED) if r.c else r.sure for r in found}, math.log(total.x / total.c))


def score_column(text: Column, model: Model) -> Column:
    lm, weights, prior, key = model.lm, model.weights, model.prior, ("toxicity", uuid.uuid4().hex)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = held_by_worker(key, lambda: Model(lm, weights, prior)).score
        for texts in batches:
            yield pd.Series([score(t) for t in texts], dtype="float64")

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", holdout: int = 3, threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score and predicted (1 from ``threshold`` on)."""
    model = learn(docs, labels, id_col, text_col, label_col, holdout)
    scored = docs.select(F.col(id_col), (crc32_bucket(id_col, holdout) == 1).alias("held_out"), score_column(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
