"""Centroids, repeated passages and the prefix trie against plain restatements."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folio.llm import centroids, prefix_trie, substring_dedup

# 11


def plain_lloyd(rows, k, rounds, dims, scale, seed):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in kept]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    middle = [list(v) for _, v in first]
    for turn in range(rounds + 1):
        owned = []
        for i, v in kept:
            d, j = min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(middle))
            owned.append((i, j, d, v))
        if turn < rounds:
            for j in range(len(middle)):
                mine = [v for _, o, _, v in owned if o == j]
                if mine:
                    middle[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    return sorted((str(i), j, d) for i, j, d, _ in owned) if kept else [], middle


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance string"


@pytest.mark.parametrize("size", [1, 1e5])
def test_clusters_of_vectors(spark, size):
    rng = random.Random(5)
    rows = [(i, [float(size * rng.choice([-1, -0.5, 0, 0.5, 1])) for _ in range(4)]) for i in range(300)]  # many ties and equal vectors
    rows += [(7, rows[7][1]), (None, [0.1] * 4), (None, None), (900, None), (901, [1.0] * 3), (902, [1.0, None, 0.0, 0.0]), (903, [1.0, float("nan"), 0.0, 0.0]), (904, [float("inf")] * 4), (905, [])]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], VECTORS)
    got, middle = centroids.cluster_vectors(df, k=6, rounds=4, dims=4)
    want, plain = plain_lloyd(rows, 6, 4, 4, 256, "2:")
    assert middle == plain
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got.collect()) == want


def test_fewer_vectors_than_clusters_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], 0, "", ""), (2, [0.5, 0.5], 0, "", "")], VECTORS)
    got, middle = centroids.cluster_vectors(df, k=5, dims=2)
    assert {(r.vec_id, r.cluster, r.distance) for r in got.collect()} == {(1, 0, 0), (2, 0, 0)} and len(middle) == 2
    got, middle = centroids.cluster_vectors(df.where("vec_id > 2"), k=5, dims=2)
    assert got.collect() == [] and middle == []


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30, 0.5], 0, "", "")], VECTORS)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(df, k=1, dims=2)


def test_rounds_compare_what_moved():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (400, 5))
    c = rng.integers(-50, 50, (9, 5))
    owner, known = centroids.assign(x, np.full(400, -1), np.zeros(400, np.int64), c, np.ones(9, bool))
    for _ in range(20):
        changed = rng.random(9) < 0.3
        c = c + changed[:, None] * rng.integers(-9, 9, (9, 5))
        owner, known = centroids.assign(x, owner, known, c, changed)
        d = ((x[:, None] - c) ** 2).sum(2)
        assert (owner == d.argmin(1)).all() and (known == d.min(1)).all()


# 12


def plain_removal(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def passages(rng, window, alphabet, docs):
    """Texts that share, repeat, extend and interrupt one another's passages."""
    vocab = [f"w{i}" for i in range(alphabet)]
    shared = [[rng.choice(vocab) for _ in range(rng.randrange(window // 2, 4 * window))] for _ in range(6)]
    out = []
    for _ in range(docs):
        words = []
        for _ in range(rng.randrange(5)):
            part = list(rng.choice(shared)) if rng.random() < 0.7 else [rng.choice(vocab) for _ in range(rng.randrange(2 * window))]
            lo, hi = sorted((rng.randrange(len(part) + 1), rng.randrange(len(part) + 1))) if rng.random() < 0.4 else (0, len(part))
            part = part[lo:hi]
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = rng.choice(vocab)
            words += part * rng.choice([1, 1, 1, 2])
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("window", "alphabet"), [(35, 5000), (35, 3), (6, 40), (3, 4), (2, 30)])
def test_repeated_passages(spark, window, alphabet):
    rng = random.Random(window * 1000 + alphabet)
    texts = passages(rng, window, alphabet, 120) + [None, "", "one two", " \t\n", "la " * 300, "a b " * 80, "é😀 x y " * 30]
    texts += texts[:3]
    rows = [(i % 118, t, "n", 1) for i, t in enumerate(texts)] + [(None, texts[5], "n", 1), (None, None, "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, spans int").repartition(3)
    got = substring_dedup.drop_repeats(df, window).collect()
    want = [(str(i), *r) for (i, *_), r in zip(rows, plain_removal([r[1] for r in rows], window), strict=True)]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got) == sorted(want)
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed for r in got)


def test_most_windows_of_a_path_are_not_counted(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(5000))
    p = substring_dedup.Passages(35)
    w = p.words(long)
    at, h = p.nodes(w, p.sums(w, 0))
    assert np.diff(at).max() <= 35 - p.k + 1 and at[0] <= 35 - p.k
    marks = np.sort(h | np.uint64(1))
    marks[np.isin(marks & ~np.uint64(1), h[[0, -1]])] &= ~np.uint64(1)
    spans, starts, *_ = p.judged(long, marks)
    assert len(spans) == 1 and len(starts) <= 2 + 2 * 35


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert substring_dedup.drop_repeats(df).collect() == []
    one = spark.createDataFrame([("a", "x y z"), ("b", "x y z")], "doc_id string, text string")
    assert {(r.doc_id, r.n_removed) for r in substring_dedup.drop_repeats(one).collect()} == {("a", 0), ("b", 0)}


# 13


def plain_trie(turns, family, most):
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most if family else 0
        base = c - int(math.fmod(c, family)) if family else c
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[v[:d]].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    out = []
    for k, m in nodes.items():
        sub = [x for x in nodes if x[: len(k)] == k]
        saved = sum((len(nodes[x]) - 1) * len(x[-1][1].encode().split()) for x in sub if x)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(k)))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], sum(not kids[x] for x in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, depth string, n int"


@pytest.mark.parametrize("family", [20, 0])
def test_trie(spark, family):
    rng = random.Random(family)
    turns = []
    for c in [*rng.sample(range(-60, 200), 110), 2**40, 2**40 + 1]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 40])):
            turns.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", None, ""]), rng.choice(["a b", "a b", "", None, "c d e"])))
    turns += [(None, 1, "user", "lost"), (300, None, None, None), (300, None, None, None), *((400 + i, j, "user", f"x {j}") for i in range(9) for j in range(30 - i))]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], TURNS).repartition(5)
    got = prefix_trie.conversation_trie(df, family)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_trie(turns, family, 4)


def test_empty_trie(spark):
    df = spark.createDataFrame([], TURNS)
    assert prefix_trie.conversation_trie(df, 20).collect() == []
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", "", 1)], TURNS), 20).collect() == []


def test_end_lists_are_bounded(spark):
    ids = list(range(-5, 70_000, 7))
    rows = spark.createDataFrame([(c, 1, 5, 6, True) for c in ids], "conv long, depth long, k1 long, k2 long, ends boolean")
    assert {len(r.ids) for r in prefix_trie.end_lists(rows).collect()} <= set(range(1 << 16))
    assert prefix_trie.end_lists(rows).count() == 3
    assert prefix_trie.end_digests(rows).head().ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# 7: the whole rule, patterns included


def plain_line_dedup(docs, min_docs=6, agree=0.8, lead=4):
    """docs: (id, text) with distinct ids; the texts without recurring lines."""
    import re

    mask = lambda line: re.sub(r"[^ 0-9]*[0-9][^ ]*", "<*>", re.sub(r"\s+", " ", line).strip(" "))
    lines = [(i, n, mask(x)) for i, t in docs for n, x in enumerate(t.split("\n")) if x.strip()]
    docs_of, keep = defaultdict(set), {}
    for i, n, m in lines:
        docs_of[m].add(i)
        keep[m] = min(keep.get(m, (i, n)), (i, n))
    leaves = defaultdict(list)
    for m in docs_of:
        leaves[m.count(" "), tuple(m.split(" ")[:lead])].append(m)
    family = defaultdict(list)  # template -> (rank, -docs, first, family)
    for leaf, kinds in leaves.items():
        for m in kinds:
            if len(docs_of[m]) >= min_docs:
                family[m].append((2, -len(docs_of[m]), (), m))
        if len(kinds) < 2 or sum(len(docs_of[m]) for m in kinds) < min_docs:
            continue
        held = Counter()
        for m in kinds:
            for at, token in enumerate(m.split(" ")):
                held[at, token] += len(docs_of[m])
        constant = {}
        for at in range(leaf[0] + 1):
            d, token = max((d, token) for (a, token), d in held.items() if a == at)
            constant[at] = token if 2 * d >= sum(d for (a, _), d in held.items() if a == at) else "<*>"
        alike = [m for m in kinds if sum(t == constant[a] for a, t in enumerate(m.split(" "))) / (leaf[0] + 1) >= agree]
        if len(set().union(*(docs_of[m] for m in alike))) >= min_docs:
            for m in alike:
                family[m].append((0, 0, (), leaf))
        patterns = defaultdict(list)
        for m in kinds:
            words = m.split(" ")
            rare = [a >= lead and w != "<*>" and held[a, w] < min_docs for a, w in enumerate(words)]
            free = math.floor(0.2 * len(words) + 1e-9) - sum(rare)
            plain = ["<*>" if r else w for w, r in zip(words, rare, strict=True)]
            blanks = [a for a in range(lead, len(words)) if plain[a] != "<*>"] if free > 0 else []
            if free >= 0:
                for b in [None, *blanks]:
                    patterns[tuple("<*>" if a == b else w for a, w in enumerate(plain))].append(m)
        for p, ms in patterns.items():
            each = [len(docs_of[m]) for m in ms]
            if len(ms) > 1 and sum(each) >= min_docs:
                n = sum(each) if max(each) >= min_docs else len(set().union(*(docs_of[m] for m in ms)))
                if n >= min_docs:
                    for m in ms:
                        family[m].append((1, -n, min(keep[x] for x in ms), p))
    chosen = {m: min(f, key=lambda x: (x[0], x[1], x[2], str(x[3]))) for m, f in family.items()}
    first = {}
    for m, (rank, _, _, name) in chosen.items():
        first[rank, name] = min(first.get((rank, name), keep[m]), keep[m])
    gone = {(i, n) for i, n, m in lines if m in chosen and first[chosen[m][0], chosen[m][3]] != (i, n)}
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in docs}


CLASH = "doc_id long, text string, _h string, _t long, _gi int, _gone string, row int, i string, h string, gone int, n_lines string"


@pytest.mark.parametrize("seed", range(3))
def test_line_families_as_the_plain_rule(spark, seed):
    from folio.llm import line_dedup

    rng = random.Random(seed)
    names, towns = [f"n{chr(97 + i)}" for i in range(20)], ["rome", "oslo", "bern"]
    docs = []
    for i in range(90):
        text = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.35:
                text.append(f"the user of today {rng.choice(names)} signed in from {rng.choice(towns)} at noon again")
            elif kind < 0.6:
                text.append(f"the user of today was {rng.choice(['sent', 'lost', 'kept'])} {rng.randrange(99)} times for {rng.choice(towns)} by mail")
            elif kind < 0.75:
                text.append(rng.choice(["all rights reserved by us", "read more", "", "  ", "read\tmore "]))
            else:
                text.append(" ".join(rng.choice(names) for _ in range(rng.randrange(1, 12))))
        docs.append((i, "\n".join(text)))
    df = spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, "z", "u", 4, "v") for i, t in docs], CLASH)
    got = line_dedup.drop_lines(df).collect()
    want = plain_line_dedup(docs)
    assert {r.doc_id: r.text for r in got} == want and any(want[i] != t for i, t in docs)
    assert {(r._h, r._t, r._gi, r._gone, r.row, r.i, r.h, r.gone) for r in got} == {("x", 1, 2, "y", 3, "z", "u", 4)}


def test_many_lines_in_one_document(spark):
    import time

    from folio.llm import line_dedup

    df = spark.createDataFrame([(i, "same old line\n" * n + "own" + "abcdefg"[i]) for i, n in enumerate([60_000, *[1] * 6])], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_lines(df).collect()}
    assert got[0] == (60_001, 59_999, "same old line\nowna") and got[3] == (2, 1, "ownd") and time.time() - began < 60


def test_clashing_names_in_other_operators(spark):
    from folio.llm import pipeline, url_rules

    df = spark.createDataFrame([("http://a.org/x", 1, 2, 3)], "url string, _best int, row int, key int")
    r = url_rules.judge_urls(df, [("block", "org", "/")]).head()
    assert (r._best, r.row, r.key, r.verdict, r.rule) == (1, 2, 3, "block", "org/")
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, 7, 8), (2, text, 9, 10), (None, text, 11, 12), (3, "other words", 13, 14)], "doc_id long, text string, _id int, i int")
    assert sorted(map(tuple, pipeline.one_of_each_group(spark, docs, "").collect())) == [(1, text, 7, 8), (3, "other words", 13, 14)]
