"""SentencePiece encoding and decoding through a table of distinct chunks.

In a model whose pieces hold the white-space marker only as leading runs, no merge crosses the place
where a marker follows another character. So a marked text splits into chunks, one run of markers and
the characters up to the next run, whose segmentations are independent. Every distinct chunk is
segmented once per task and its ids are put back by position. Vocabularies of 100 TB do not fit a
broadcast, and joining ids back by a shuffle would move every position of the corpus, so the table lives
in the task, in two generations: when the younger reaches ``MAX_CHUNKS`` entries it becomes the older one,
from which chunks still in use are taken over. That costs time, never results.

Defined results: null and empty text have no ids and decode to "". Long texts are whole. Repeated rows
repeat their result; an empty table gives an empty table. Only the id column and the results come back,
so extra columns cannot clash. A model with pieces across markers is refused (ValueError).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker

MARK = "▁"
#: Entries of one generation of a task's chunk table: about 100 MB.
MAX_CHUNKS = 300_000
#: Longer chunks are segmented without being kept.
MAX_CHUNK_CHARS = 64

ENCODED = "ids array<int>, n_tokens long, ids_sha256 string, decoded string, decoded_sha256 string"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class ChunkTable:
    """Distinct marked words of a task: each one's ids (little-endian 32-bit), ids as text, and decoded text."""

    def __init__(self, model_path: str, max_chunks: int = MAX_CHUNKS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.max_chunks = max_chunks
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if crossing := [p for p in pieces if MARK in p.lstrip(MARK)]:
            raise ValueError(f"pieces cross white-space markers: {crossing[:5]}")
        self.marked = np.array([p.startswith(MARK) for p in pieces])
        self.lone = self.model.piece_to_id(MARK)
        self.known: dict[str, tuple[bytes, str, str]] = {}
        self.older: dict[str, tuple[bytes, str, str]] = {}

    def _record(self, ids: list[int] | np.ndarray, decoded: str) -> tuple[bytes, str, str]:
        return np.asarray(ids, "<i4").tobytes(), ",".join(map(str, ids)), decoded

    def _segment(self, chunks: list[str]) -> dict[str, tuple[bytes, str, str]]:
        """Chunks stand here without their first marker. One call takes all that hold no further marker: the
        model marks each word of the joined text, so its ids and its decoded text part at the markers."""
        found = {}
        plain = [c for c in chunks if c and " " not in c]
        if plain:
            ids = np.array(self.model.encode(" ".join(plain), num_threads=1), np.int64)
            starts = np.flatnonzero(self.marked[ids])
            words = self.model.decode(ids.tolist()).split(" ")
            if len(starts) == len(words) == len(plain):
                raw, said = ids.astype("<i4").tobytes(), list(map(str, ids.tolist()))
                bounds = [*starts.tolist(), len(ids)]
                for c, w, lo, hi in zip(plain, words, bounds, bounds[1:], strict=False):
                    found[c] = raw[4 * lo : 4 * hi], ",".join(said[lo:hi]), " " + w
        for c in chunks:
            if c not in found:
                ids = self.model.encode(c, num_threads=1) if c else [self.lone]
                found[c] = self._record(ids, self.model.decode([self.lone, *ids]))
        return found

    def records(self, texts: list[str]) -> list[list[tuple[bytes, str, str]]]:
        """For each text the records of its chunks, in order."""
        split = []
        for t in texts:
            parts = t.replace(MARK, " ").split(" ") if t else []
            split.append(list(_runs(parts)) if "" in parts else parts)
        seen = set(chain.from_iterable(split))
        table = self.known
        missing = [p for p in seen if p not in table]
        long = {}
        if missing:
            if len(table) + len(missing) > self.max_chunks:
                self.older, self.known = table, {}
                table, missing = self.known, list(seen)
            older = self.older
            table.update((p, older[p]) for p in missing if p in older)
            found = self._segment([p for p in missing if p not in older])
            for p, r in found.items():
                (table if len(p) <= MAX_CHUNK_CHARS else long)[p] = r
        if long:
            return [[long[p] if p in long else table[p] for p in parts] for parts in split]
        return [[table[p] for p in parts] for parts in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(r[0] for r in self.records([text])[0]), "<i4").tolist()

    def decode(self, text: str) -> str:
        """What the ids of the text decode to: the first marker is the model's own and falls away."""
        return "".join(r[2] for r in self.records([text])[0])[1:]


def _runs(parts: list[str]) -> Iterator[str]:
    """Chunks without their first marker: empty parts are further markers of the run before the next word."""
    spaces = 0
    for k, p in enumerate(parts):
        if p:
            yield " " * spaces + p
            spaces = 0
        elif k < len(parts) - 1:
            spaces += 1
        else:  # the text ends in a run of markers, a chunk of its own
            yield " " * spaces


def portions(texts: list[str], most: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in order, about ``most`` characters at a time."""
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t)
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


def _table(model_path: str) -> ChunkTable:
    return held_by_worker(("sentencepiece", model_path), lambda: ChunkTable(model_path))


def codec(text: Column, model_path: str, digests_only: bool = False) -> Column:
    """A struct column: ids, their number and digest, the decoded text and its digest."""

    @F.pandas_udf(DIGESTS if digests_only else ENCODED)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _table(model_path)
        for texts in batches:
            rows = []
            for part in portions([t or "" for t in texts]):
                for records in table.records(part):
                    n = sum([len(r[0]) for r in records]) // 4
                    said = hashlib.sha256(",".join([r[1] for r in records]).encode()).hexdigest()
                    back = "".join([r[2] for r in records])[1:]
                    digest = hashlib.sha256(back.encode("utf-8")).hexdigest()
                    rows.append((n, said, digest) if digests_only else (np.frombuffer(b"".join([r[0] for r in records]), "<i4"), n, said, back, digest))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in (DIGESTS if digests_only else ENCODED).split(", ")])

    return coded(text)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digests_only: bool = False) -> DataFrame:
    """One row per document: the id and the fields of ``codec``."""
    return docs.select(F.col(id_col), codec(F.col(text_col), model_path, digests_only).alias("_coded")).select(id_col, "_coded.*")
