"""Packing documents into windows of tokens: bounded-space online best-fit.

Every partition packs its documents in order with at most ``OPEN`` open windows. Whole windows are cut
from a document's front; the rest goes to the open window that it fits best. When none fits, the fullest
window is topped up with the rest's first ids and emitted, so emitted windows are always full. What is
open at a partition's end is merged: windows of ``MERGED`` neighbouring partitions are joined end to end
and cut again, and the last part is split into sequences whose lengths are powers of two, which need no
padding. No sequence is padded then.

Ids are those of the tokenizers library. As its normaliser and splitter never look across ASCII white
space, a task encodes each distinct run of other characters once.

Defined results: a null or empty text is one piece, the end id. Long texts are cut, never shortened. Rows
that repeat are packed as often. An empty table gives an empty table. Only the results come back, so
extra columns cannot clash.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker, portions_of, text_of, written

WINDOW, OPEN, MERGED = 2048, 16, 16
END_ID = 1
#: Entries of a task's table (about 80 MB), and the longest run that enters it.
MAX_RUNS, MAX_RUN_CHARS = 400_000, 64
#: Words are encoded so many together, and so many of these or of other runs in a call: results of the library are large.
WORDS_A_CALL, AT_ONCE = 200, 100
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: A word of letters whose lower case and composition need no context, and marks that split off it as one token.
SIMPLE = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?]*)$"


class RunTable:
    """Ids of the distinct runs without ASCII white space of a task.

    Texts are split and their runs dictionary-encoded by Arrow, so Python sees each distinct run of a portion
    once. Most runs are a word and the marks after it; words are looked up in lower case. Words that are new
    are encoded many together and parted at the ids that end a word, all other runs one by one.
    A full table starts anew; that costs time, never results.
    """

    def __init__(self, tokenizer_path: str, max_runs: int = MAX_RUNS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.max_runs = max_runs
        self.known: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        for k in range(0, len(texts), AT_ONCE):
            for e in self.tokenizer.encode_batch_fast(texts[k : k + AT_ONCE], add_special_tokens=False):
                yield np.array(e.ids, "<u4")

    def _one_by_one(self, runs: list[str]) -> dict[str, bytes]:
        return {r: ids.tobytes() for r, ids in zip(runs, self._encoded(runs), strict=True)}

    def _words(self, words: list[str]) -> dict[str, bytes]:
        blocks = [words[k : k + WORDS_A_CALL] for k in range(0, len(words), WORDS_A_CALL)]
        out: dict[str, bytes] = {}
        for block, ids in zip(blocks, self._encoded([" ".join(b) for b in blocks]), strict=True):
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(block):
                out |= self._one_by_one(block)
                continue
            raw, bounds = ids.tobytes(), [0, *(4 * stops).tolist()]
            out.update(zip(block, map(raw.__getitem__, map(slice, bounds, bounds[1:])), strict=True))
        return out

    def _ids(self, keys: list[str], simple: bool) -> list[bytes]:
        """The ids of distinct keys: words in lower case, or other runs."""
        known = self.known
        new = [k for k in keys if k not in known]
        if new:
            found = self._words(new) if simple else self._one_by_one(new)
            if len(known) + len(found) > self.max_runs:  # the table starts anew with what these texts hold
                found |= {k: known[k] for k in keys if k in known}
                known.clear()
            room = self.max_runs - len(known)
            if len(found) > room or max(map(len, new)) > MAX_RUN_CHARS:
                known.update(list((k, v) for k, v in found.items() if len(k) <= MAX_RUN_CHARS)[:room])
                return [found[k] if k in found else known[k] for k in keys]
            known.update(found)
        return [known[k] for k in keys]

    def _distinct(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct runs: all their ids, and by run the place of its first id and their number."""
        parts = pc.extract_regex(runs, SIMPLE)
        simple = pc.is_valid(parts)
        words = pc.dictionary_encode(pc.utf8_lower(pc.struct_field(pc.filter(parts, simple), "word")))
        marks = pc.dictionary_encode(pc.struct_field(pc.filter(parts, simple), "marks"))
        of_marks = self._one_by_one(marks.dictionary.to_pylist())
        others = pc.filter(runs, pc.invert(simple)).to_pylist()
        word_ids = self._ids(words.dictionary.to_pylist(), True)
        mark_ids = [of_marks[m] for m in marks.dictionary.to_pylist()]
        at = np.zeros(len(runs), np.int64)
        size = np.zeros(len(runs), np.int64)
        chosen = simple.to_numpy(zero_copy_only=False)
        w, m = words.indices.to_numpy(zero_copy_only=False), marks.indices.to_numpy(zero_copy_only=False)
        both = list(map(bytes.__add__, map(word_ids.__getitem__, w.tolist()), map(mark_ids.__getitem__, m.tolist())))
        rest = self._ids(others, False)
        raw = both + rest
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        starts = np.cumsum(lengths) - lengths
        at[chosen], size[chosen] = starts[: len(both)], lengths[: len(both)]
        at[~chosen], size[~chosen] = starts[len(both) :], lengths[len(both) :]
        return np.frombuffer(b"".join(raw), "<u4"), at, size

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text, as little-endian 32-bit bytes; null counts as empty."""
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        runs = pc.dictionary_encode(split.flatten())
        ids, at, size = self._distinct(runs.dictionary)
        index = runs.indices.to_numpy(zero_copy_only=False)
        sizes = size[index]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(at[index] - (ends - sizes), sizes)
        places += np.arange(total)
        raw = ids[places].tobytes()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        bounds = np.concatenate([[0], ends])[bounds] * 4
        return [raw[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]


class Packer:
    """The open windows of one partition. Closed pieces carry no ids, those still open do."""

    def __init__(self, window: int, most_open: int):
        self.window, self.most_open = window, most_open
        self.open: list[tuple[int, list[tuple]]] = []  # (free, pieces)
        self.closed: list[tuple] = []
        self.sequences = 0

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.closed.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.sequences, at))
            at += len(ids) // 4
        self.sequences += 1

    def add(self, doc: int, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            self._close([(doc, start, ids[4 * start : 4 * (start + self.window)], total)])
            start += self.window
        need = total - start
        if not need:
            return
        fits = [(free, k) for k, (free, _) in enumerate(self.open) if free >= need]
        if fits:
            free, k = min(fits)
            pieces = self.open[k][1]
            pieces.append((doc, start, ids[4 * start :], total))
            if free == need:
                self._close(pieces)
                del self.open[k]
            else:
                self.open[k] = (free - need, pieces)
            return
        if len(self.open) == self.most_open:
            free, k = min((free, k) for k, (free, _) in enumerate(self.open))
            pieces = self.open.pop(k)[1]
            pieces.append((doc, start, ids[4 * start : 4 * (start + free)], total))
            self._close(pieces)
            start += free
        self.open.append((self.window - (total - start), [(doc, start, ids[4 * start :], total)]))


def powers(n: int) -> list[int]:
    """n as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def merge(pieces: list[tuple], window: int) -> list[tuple]:
    """(doc, start, ids, total) joined end to end: (doc, start, length, crc, total, sequence, offset)."""
    n = sum(len(ids) // 4 for _, _, ids, _ in pieces)
    cuts = [window] * (n // window) + powers(n % window)
    out, sequence, at = [], 0, 0
    for doc, start, ids, total in pieces:
        while ids:
            take = min(cuts[sequence] - at, len(ids) // 4)
            out.append((doc, start, take, zlib.crc32(ids[: 4 * take]), total, sequence, at))
            ids, start, at = ids[4 * take :], start + take, at + take
            if at == cuts[sequence]:
                sequence, at = sequence + 1, 0
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, most_open: int = OPEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with the columns of PIECES. window must be a power of two."""
    end = np.array([end_id], "<u4").tobytes()
    names = [c.split()[0] for c in PIECES.split(", ")]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = held_by_worker(("packing", tokenizer_path), lambda: RunTable(tokenizer_path)).encode
        packer = Packer(window, most_open)
        for batch in batches:
            left = iter(batch.column("i").to_pylist())
            for texts in portions_of(batch.column("t")):
                for ids in encode(texts):
                    packer.add(next(left), ids + end)
                yield closed(packer, part)
        yield table([(d, s, len(ids) // 4, zlib.crc32(ids), total, k, 0, part, ids) for k, (_, pieces) in enumerate(packer.open) for d, s, ids, total in pieces])

    def closed(packer: Packer, part: int) -> pa.RecordBatch:
        rows = [(d, s, n, crc, total, (part << 33) + q, at, part, None) for d, s, n, crc, total, q, at in packer.closed]
        packer.closed.clear()
        return table(rows)

    kinds = [pa.int64()] * len(names) + [pa.int32(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*names, "part", "ids"])

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("sequence_id", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        got = merge(list(zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True)), window)
        first = (1 << 61) + (key[0].as_py() << 33)
        columns = [list(c) for c in zip(*got, strict=True)] if got else [[] for _ in names]
        columns[names.index("sequence_id")] = [first + k for k in columns[names.index("sequence_id")]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("i"), text_of(text_col).alias("t"))
    first = written(rows.mapInArrow(packed, PIECES + ", part int, ids binary"), "packed")
    again = first.where("ids is not null").groupBy((F.col("part") / MERGED).cast("int").alias("g")).applyInArrow(merged, PIECES)
    return first.where("ids is null").select(*names).unionByName(again)
