"""The training-data operators on small fixtures, against plain restatements."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folio.llm import exact_dedup, langid, license_scan, line_dedup, media, minhash, packing, sp_codec, toxicity, url_rules
from folio.llm.queries import URL_RULES, vocabulary

SP, BPE = vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")
LONG = "lorem ipsum dolor sit amet " * 4000
SCHEMA = "doc_id long, text string, lang string, score string, text_sha256 string"
#: nulls, empty and very long texts, repeated rows, columns whose names clash with results
ODD = [(1, None, "en", "x", "y"), (2, "", "en", "x", "y"), (3, LONG, "en", "x", "y"), (4, "Hello, world", None, None, None), (4, "Hello, world", None, None, None), (None, "no id", "de", "x", "y"), (6, "  a\tb\n\nc  ", "de", "x", "y"), (7, "é▁😀 <s>", "fr", "x", "y")]
DOCS = "/root/testdata/sf0.001/documents.parquet"
needs_data = pytest.mark.skipif(not os.path.exists(DOCS), reason="no test data")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


# 1


def test_chunks_encode_as_the_library():
    table, rng = sp_codec.ChunkTable(SP, max_chunks=50), random.Random(3)
    for alphabet in (" ▁ab1 é\n\t 世😀x<s></s>.", "ab ", " "):
        for _ in range(1500):
            t = "".join(rng.choices(alphabet, k=rng.randrange(15)))
            ids = table.model.encode(t)
            assert table.encode(t) == ids and table.decode(t) == table.model.decode(ids), repr(t)


def test_codec_on_odd_rows(odd, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=SP)
    got = sp_codec.encode_documents(odd, SP).collect()
    assert len(got) == len(ODD)
    for r in got:
        t = next(t or "" for i, t, *_ in ODD if i == r.doc_id)
        ids = model.encode(t)
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == model.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert sp_codec.encode_documents(empty, SP).count() == 0


# 2


def brute_url(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:k])
    path = rest[k:].split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


def test_urls(spark):
    urls = [None, "", "x", "http://", "http://org", "http://ORG/a", "http://example.org/es/1?q=/en/1", "https://a.b.example.org/en/12#x", "http://notexample.org/es/", "http://example.com/de/", "http://example.com/fr/9", "ftp://example.org?x/es/", "http://.org/", "http://example.org/es", "a://b://c.org/x", "http://Ä.org/"] + ["http://hot.org/en/1"] * 30
    df = spark.createDataFrame([(k, u, "clash", "clash") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, URL_RULES).collect()}
    assert got == {k: brute_url(u) for k, u in enumerate(urls)}
    assert url_rules.judge_urls(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(df, [], default="block").collect()} == {"block"}


def test_sweep_keeps_the_longest_open_rule():
    rng = random.Random(5)
    rules = sorted({"".join(rng.choices("ab", k=rng.randrange(1, 6))) for _ in range(25)})
    keys = sorted("".join(rng.choices("ab", k=rng.randrange(1, 9))) for _ in range(300))
    want = [max((len(r), k) for k, r in enumerate(rules) if key.startswith(r))[1] if any(key.startswith(r) for r in rules) else -1 for key in keys]
    walk, got = url_rules.Sweep(), []
    for key, _, n in sorted([(r, 0, k) for k, r in enumerate(rules)] + [(k, 1, n) for n, k in enumerate(keys)]):
        if _ == 0:
            walk.open((key, n))
        else:
            got.append((walk.at(key) or (None, -1))[1])
    assert got == want


@pytest.mark.parametrize("a_range", [1_000, 7])
def test_many_rules_in_ranges(spark, monkeypatch, a_range):
    monkeypatch.setattr(url_rules, "RULES_A_RANGE", a_range)
    rng = random.Random(9)
    hosts = [".".join(rng.choices(["a", "b", "ab", "com"], k=rng.randrange(1, 4))) for _ in range(40)]
    paths = ["", "/", "/a", "/a/", "/a/b", "/é"]
    rules = [(rng.choice(("allow", "block")), rng.choice(hosts), rng.choice(paths)) for _ in range(120)]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'b', '/c'])}" for _ in range(400)]
    first = {}
    for verdict, host, path in rules:
        first.setdefault((host, path), verdict)

    def judged(url):
        host, path = brute_url(url)[:2]
        fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in first.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits else (None, "allow")

    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    for given in (rules, spark.createDataFrame([(v, h, p) for (h, p), v in first.items()], "verdict string, host string, path string")):
        got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge_urls(df, given).collect()}
        assert got == {k: judged(u) for k, u in enumerate(urls)}


# 3


def toxic_model():
    counts = np.zeros((toxicity.N,) * 3)
    toxicity.count_trigrams("the idiot and the moron said stupid trash like a clown " * 50, counts)
    return toxicity.Model(toxicity.log_model(counts), {"idiot": 5.0, "moron": 5.0, "stupid": 5.0, "trash": 5.0}, -2.0)


@pytest.mark.parametrize("said", ["idiot", "1d10t", "i d i o t", "i-d-i-o-t", "idiooooot", "5tupid", "stuuuupid", "tr4sh", "m o r o n"])
def test_hidden_words_are_restored(said):
    m = toxic_model()
    assert m.score(f"You {said}!") > 0.9
    assert m.score("You are kind.") < 0.2 and m.score(None) == m.score("")


@pytest.mark.parametrize("said", ["idio7", "idio+", "tra5h", "m0r0n5", "!diot", "stuupid", "idiiot", "a m o r o n", "t h e i d i o t", "t h e   i d i o t", "moron.idiot", "i-d-i-o-t-m-o-r-o-n", "y o u i d i o t", "z z m o r o n"])
def test_more_hidden_words_are_restored(said):
    m = toxic_model()
    m.weights["morons"] = 5.0
    counts = np.zeros((toxicity.N,) * 3)
    toxicity.count_trigrams("the idiot and a moron said stupid trash like a clown you morons " * 50, counts)
    m = toxicity.Model(toxicity.log_model(counts), m.weights, m.prior)
    assert m.score(f"You {said}") > 0.9
    assert m.score("A good book, 100 pages (all) for 20$ a week! See you soon.") < 0.2


def test_toxicity_learns_from_its_rows_only(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(["lorem", "ipsum", "dolor", "sit"], k=30)) + (" v1le" if k % 3 == 0 and k % 2 else " vile" if k % 3 == 0 else ""), int(k % 3 == 0)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic")
    got = toxicity.score_documents(df.drop("toxic"), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [(r.predicted, int(r.doc_id % 3 == 0)) for r in got if r.held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    # labels of held-out rows don't matter
    flipped = df.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    again = toxicity.score_documents(df.drop("toxic"), flipped).collect()
    assert sorted((r.doc_id, r.score) for r in got) == sorted((r.doc_id, r.score) for r in again)


def test_toxicity_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score_documents(odd, labels).collect()] == [0] * len(ODD)
    assert toxicity.score_documents(empty, labels).count() == 0


# 4


def test_pictures_round_trip_and_tell_damage():
    rng = random.Random(2)
    for n in (0, 1, 191, 192, 193, 20_000):
        text = "".join(rng.choices("abc é😀", k=n))
        payload, size = media.payload_of(text)
        assert size == len(text.encode()) and len(payload) % 192 == 0 and payload.rstrip(b" ") == text.encode().rstrip(b" ")
        png = media.write_png(payload)
        assert media.read_png(png).tobytes() == payload
        broken = bytearray(png)
        broken[45] ^= 1
        with pytest.raises(ValueError):
            media.read_png(bytes(broken))


def test_all_filters_are_undone():
    rng = np.random.default_rng(0)
    want = rng.integers(0, 256, (20, 12), np.uint8)
    kinds = rng.integers(0, 5, 20).astype(np.uint8)
    rows = np.zeros_like(want)
    for y in range(20):
        for x in range(12):
            a = int(want[y, x - 3]) if x >= 3 else 0
            b = int(want[y - 1, x]) if y else 0
            c = int(want[y - 1, x - 3]) if y and x >= 3 else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            rows[y, x] = (int(want[y, x]) - [0, a, b, (a + b) // 2, paeth][kinds[y]]) % 256
    assert (media.unfilter(kinds, rows, 3) == want).all()


def test_media_on_odd_rows(odd, empty):
    for r in media.read_media(media.store_texts(odd)).collect():
        t = next(t or "" for i, t, *_ in ODD if i == r.doc_id).encode()
        payload = t + b" " * (-len(t) % 192 if t else 192)
        assert (r.n_bytes, r.payload_bytes) == (len(t), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
    assert media.read_media(media.store_texts(empty)).count() == 0


# 5


def brute_base(text):
    words = license_scan.words_of(text)
    places = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    return len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_scan_finds_every_base_place():
    scanner, rng = license_scan.Scanner(), random.Random(4)
    words = "under the mit license apache version 2 cc by nc x this work is licensed".split()
    for _ in range(1500):
        t = " ".join(rng.choices(words, k=50))
        assert scanner.scan(t)[:5] == brute_base(t)


def test_scan_chains_templates(odd, empty):
    s = license_scan.Scanner()
    text = "Intro. " + next(t for label, t in license_scan.TEMPLATES if label == "bsd").replace("binary", "object") + " End."
    assert s.scan(text)[5] == "bsd" and s.scan(text)[7][0][:3] == ("bsd", 1, 21)
    got = license_scan.scan_documents(odd).collect()
    assert len(got) == len(ODD) and all(r.n_base == 0 and r.first_word is None for r in got)
    assert license_scan.scan_documents(empty).count() == 0


# 6


def test_directory_splits_overfull_buckets():
    rng = random.Random(6)
    counts = Counter(rng.choices(range(256), weights=[1 / (k + 1) for k in range(256)], k=5000))
    d = exact_dedup.Directory(counts, capacity=200, max_depth=8)
    held = defaultdict(int)
    for k, n in counts.items():
        held[d.slots[k >> (8 - d.depth)]] += n
    assert all(n <= 200 or depth == 8 for (depth, _), n in held.items())
    assert list(d.numbers) == sorted(d.numbers)  # buckets are ranges of keys


def test_exact_dedup(spark, odd, empty):
    rows = ODD + [(8, "", "en", "x", "y"), (9, "Hello, world", "en", "x", "y"), (10, "hello, world", "en", "x", "y")]
    got = exact_dedup.deduplicate(spark.createDataFrame(rows, SCHEMA), capacity=1).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    for r in got:
        own = groups[r.text_sha256]
        assert r.group_size == len(own) and r.keep_id == max((i for i in own if i is not None), default=None) and r.kept == (r.doc_id == r.keep_id)
    assert exact_dedup.deduplicate(empty).count() == 0


# 7


def test_line_dedup(spark, odd, empty):
    rows = [(k, f"own line {'abcdefgh'[k]} of this text\nPage {k} of 99\nUser {'xyzuvwpq'[k]} has signed in from the office today\n\nlast {'abcdefgh'[k] * 3}", k, 0) for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, other int")
    got = {r.doc_id: r for r in line_dedup.drop_lines(df, min_docs=6).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0 and got[0].n_lines == 5
    assert got[5].text == "own line f of this text\nUser w has signed in from the office today\n\nlast fff" and got[5].n_dropped == 1
    lead = [(k, f"the user called {'xyzuvwpq'[k]} has signed in from our office in the old town today") for k in range(8)]
    lead = [(k, t.replace("the user called ", "the user named now ")) for k, t in lead]
    alike = line_dedup.drop_lines(spark.createDataFrame(lead, "doc_id long, text string"), min_docs=6).collect()
    assert sorted((r.doc_id, r.text == "") for r in alike) == [(k, k > 0) for k in range(8)]  # one variable place
    same = {(r.doc_id, r.text) for r in line_dedup.drop_lines(odd).collect()}
    assert same == {(i, t) for i, t, *_ in ODD}
    assert line_dedup.drop_lines(empty).count() == 0

def test_line_families_in_a_full_leaf(spark):
    word = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:03}")
    said = [f"We would like to thank {word(k)} for the kind help with all this work" for k in range(40)]  # one field, 40 values
    said += ["We would like to thank everyone for the kind help with all this work"] * 8  # a common value of the field
    both = [f"We would like to see {word(k)} and our friend {word(500 + k)} here at home again" for k in range(20)]  # two fields
    hot = ["We would like to close the shop on all days of the coming week"] * 60
    alone = [f"We would like to {' '.join(word(20 * k + j + 100) for j in range(10))}" for k in range(45)]
    lines = hot + alone + said + both
    assert {len(x.split()) for x in lines} == {14}
    got = line_dedup.drop_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), min_docs=6).collect()
    kept = {r.doc_id for r in got if r.text}
    assert kept == {0, *range(60, 105), 105, 153}  # the first of each family, and all lines that stand alone
    twice = [(k // 4, f"We would like to thank {word(k)} for the kind help with all this work") for k in range(20)]
    docs = [(d, "\n".join(t for x, t in twice if x == d)) for d in range(5)]  # 20 variants in 5 documents do not recur
    got = line_dedup.drop_lines(spark.createDataFrame(docs + [(9 + k, t) for k, t in enumerate(alone)], "doc_id long, text string"), min_docs=6).collect()
    assert all(r.n_dropped == 0 for r in got)



# 8


def brute_near(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = ["".join(c.lower() if c.isascii() else c for c in x) for x in (t or "").encode().decode().replace("\n", " ").replace("\t", " ").split(" ") if x]
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_posterior_bounds():
    rows, bands = minhash.rows_and_bands(0.85)
    assert (1 - 0.85**rows) ** bands <= minhash.MISS
    least = [minhash.least_matches(0.85, n, 1e-6) for n in (32, 64, 352)]
    assert least == sorted(least) and least[0] < 32 * 0.85 and least[2] < 352 * 0.85


def test_chains_and_hot_groups_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows, words = [], list(base)
    for k in range(60):  # each differs a little from the one before: far ends are linked by steps only
        words = list(words)
        words[rng.randrange(120)] = f"n{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(f"u{rng.randrange(10**6)}" for _ in range(100))) for k in range(20)]
    for k in range(80):  # a star: each strays from one text by its own number of words
        words = [f"s{k}" for k in range(150)]
        for j in rng.sample(range(150), k % 14):
            words[j] = f"x{k}.{j}"
        rows.append((400 + k, " ".join(words)))
    rows += [(200 + k, " ".join(base)) for k in range(30)] + [(300, ""), (301, None), (302, "one two"), (303, "one two"), (304, "ONE TWO")]
    want = brute_near(dict(rows), 3, 85)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_on_odd_rows(odd, empty):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and sum(r.doc_id is None and r.component_id is None and r.kept for r in got) == 1
    assert minhash.near_duplicates(empty).count() == 0


# 9


@needs_data
def test_languages_are_told(docs):
    got = {r.doc_id: r for r in langid.identify_languages(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(got[i].lang_pred == lang[i] for i in held) / len(held) > 0.9


def test_languages_of_odd_rows(spark, odd, empty):
    got = langid.identify_languages(odd.unionByName(spark.createDataFrame([(20, "12 !?", "en", "", "")], SCHEMA))).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].lang_pred == by[2].lang_pred == by[20].lang_pred == "und" and by[1].score == 0
    assert langid.identify_languages(empty).count() == 0


# 10


def check_packing(rows, want, window):
    """want: ids by document. Every id in one piece, sequences gapless, lengths full or powers of two."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(ids) == r.length and r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.doc_tokens == len(want[r.doc_id])
    for i, ids in want.items():
        at = 0
        for start, n in sorted(pieces[i]):
            assert start == at
            at += n
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@needs_data
def test_packing(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    got = packing.pack_documents(docs.repartition(5, "doc_id"), BPE).collect()
    assert check_packing(got, want, 2048) == 0


def test_packing_of_odd_rows(spark, odd, empty):
    rows = {1: None, 2: "", 3: LONG, 4: "Hello, world", 7: "é▁😀 <|endoftext|>", 8: "ÉTÉ İstanbul ΣΑΣ don't"}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows.items()}
    got = packing.pack_documents(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), BPE).collect()
    assert check_packing(got, want, 2048) == 0
    assert packing.pack_documents(odd, BPE).count() >= len(ODD) and packing.pack_documents(empty, BPE).count() == 0


# the pipeline


@needs_data
def test_stages_keep_the_columns(spark, docs):
    import corpus_pipeline as p

    sf_dir = os.path.dirname(DOCS)
    now = docs.limit(60).unionByName(spark.createDataFrame([(1000, None, None, None, None), (1001, "", "en", "s", 0)], docs.schema))
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, now, sf_dir)
        assert after.columns == docs.columns, name
        now = spark.createDataFrame(after.collect(), docs.schema)
    assert p.STAGES[-1][1](spark, now, sf_dir).count() >= now.count()


# ids beside nulls, and groups that lie below the threshold

BIG = [(None, "alpha beta gamma delta"), ((1 << 60) + 1, "alpha beta gamma delta"), ((1 << 60) + 3, "alpha beta gamma delta"), (5, None), (None, "epsilon")]


@pytest.fixture(scope="module")
def big(spark):
    return spark.createDataFrame(BIG, "doc_id long, text string").coalesce(1)


def test_large_ids_beside_null_ids(big):
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.deduplicate(big).collect()}
    top = (1 << 60) + 3
    assert got == {(None, top, False), (top - 2, top, False), (top, top, True), (5, 5, True), (None, None, True)}
    near = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(big).collect()}
    assert {x for x in near if x[0]} == {(top - 2, top - 2, True), (top, top - 2, False), (5, 5, True)}
    assert sorted(x.doc_id or 0 for x in packing.pack_documents(big, BPE).collect()) == sorted(i or 0 for i, _ in BIG)


def brute_components(texts, width, percent):
    words = {i: t.lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} for i, w in words.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in texts}


@pytest.mark.parametrize("edits", [(1, 2, 3), (4, 5), (2, 4, 6, 8)])
def test_groups_mostly_below_the_threshold(spark, edits):
    rng = random.Random(sum(edits))
    base = [f"w{k}" for k in range(150)]
    texts = {}
    for i in range(120):
        own = list(base)
        for at in rng.sample(range(150), edits[i % len(edits)]):
            own[at] = f"x{i}_{at}"
        texts[i] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, width=3, percent=85).collect()}
    assert got == brute_components(texts, 3, 85)


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for n in (3, 40, 400, 4000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 10], rng.integers(0, 1 << 63, n // 12).astype(np.uint64)])
        bits = lambda s: np.unpackbits(np.frombuffer(minhash.sketch(s), np.uint8))
        assert (bits(a) != bits(b)).sum() <= len(np.setxor1d(a, b))


# host rules


def test_rules_without_a_path(spark):
    urls = ["http://bad.com", "http://bad.com/x", "http://a.bad.com?q", "http://notbad.com/", "http://x.computer/z", "http://bad.community/y", "http://ok.org", "ftp://a.b.ok.org/p/q"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    got = url_rules.judge_urls(df, [("block", "bad.com", ""), ("block", "com", "/x"), ("block", "org", ""), ("allow", "ok.org", "/p")]).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == [("bad.com", "block")] * 3 + [(None, "allow")] * 3 + [("org", "block"), ("ok.org/p", "allow")]


# the choice of a language


def test_the_smallest_encoding_wins():
    import zstandard

    dictionaries = {"x": b"lorem ipsum dolor sit amet " * 40, "y": b"quick brown fox jumps over " * 40, "z": b"zwei drei vier " * 40}
    model = langid.Classifier(dictionaries)
    assert [model.predict(t)[0] for t in ("ipsum dolor", "brown fox " * 200, "Drei vier.", "12 34", None, "")] == ["x", "y", "z", "und", "und", "und"]
    for text in ("lorem fox", "vier brown sit", "dolor " * 300 + "fox"):
        raw = langid.reduced(text).encode()
        pieces = [raw[k : k + langid.PIECE_BYTES] for k in range(0, len(raw), langid.PIECE_BYTES)]
        size = {}
        for lang, data in dictionaries.items():
            own = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            size[lang] = sum(len(own.compress(p)) for p in pieces)
        best, second = sorted(size.values())[:2]
        if second - best >= langid.MARGIN * second:
            assert model.predict(text)[0] == min(size, key=size.get)


# toxicity: the lattice against enumerating it, and tokens that are never decoded


def test_the_best_path_is_the_best_of_all():
    counts = np.zeros((27, 27, 27), np.int64)
    toxicity.count_trigrams("idiot lost toil slot still idol dolt silt list oil lot sit", counts)
    model = toxicity.Model(toxicity.log_model(counts))

    def readings(span):
        """(log probability, word) of every path."""
        paths = [(0.0, (0, 0), "")]
        for at, c in enumerate(span):
            new = []
            k = toxicity.letter(c) if c.isalpha() else 0
            for p, (a, b), said in paths:
                row = model.rows[a][b]
                options = [(x, toxicity.LETTERS[x], toxicity.ANY_VOWEL if c == "*" else toxicity.SUBSTITUTED) for x in toxicity.STANDS_FOR.get(c, "")]
                options += [(c, k, 0.0)] if k else [(c, 0, toxicity.KEPT_ODD)] if c.isalnum() else []
                new += [(p + cost + row[kx], (b, kx), said + x) for x, kx, cost in options]
                if c in toxicity.SEPARATORS:
                    new.append((p + toxicity.DROPPED_SEPARATOR, (a, b), said))
                elif not c.isalnum():
                    new.append((p + (toxicity.DROPPED_LEET if c in toxicity.STANDS_FOR else toxicity.DROPPED_MARK), (a, b), said))
                elif k and k == b:
                    long = span[at - 2 : at] == c + c or span[at - 1 : at + 2] == c + c + c
                    new.append((p + (toxicity.DROPPED_REPEAT if long else toxicity.DROPPED_DOUBLE), (a, b), said))
            paths = new or paths
        return [(p + model.rows[a][b][0], said) for p, (a, b), said in paths]

    rng = random.Random(6)
    for _ in range(150):
        span = "".join(rng.choices("idiotls10!*.-$", k=rng.randrange(1, 8)))
        found, best = readings(span), model._decode(span)
        assert abs(max(found)[0] - max(p for p, said in found if said == best)) < 1e-9, span


def test_only_tokens_that_hide_no_word_are_skipped():
    counts = np.zeros((27, 27, 27), np.int64)
    toxicity.count_trigrams("idiot moron stupid trash plain words stand here as well", counts)
    model = toxicity.Model(toxicity.log_model(counts), {w: 1.0 for w in ("idiot", "moron", "stupid", "trash", "été")})
    rng, hits = random.Random(8), 0
    for _ in range(4000):
        word = rng.choice(["idiot", "moron", "stupid", "trash", "plain", "été", "stand"])
        token = "".join(rng.choice([k for k, v in toxicity.STANDS_FOR.items() if c in v] or [c]) if rng.random() < 0.3 else c * rng.choice((1, 1, 1, 2, 3)) + rng.choice(("", "", ".", "-", "*")) for c in word) + rng.choice(("", "!", "7", "s"))
        read = model.readings(token)
        if toxicity.spread(token):
            read = [w for x in read for w in toxicity.parts(x)]
        want = tuple(w for w in dict.fromkeys(read) if w in model.weights)
        hits += bool(want)
        assert model.told(token) == want, token
    assert hits > 500


def test_whole_licence_texts_and_own_templates(spark):
    s = license_scan.Scanner()
    for label, text in license_scan.TEMPLATES:
        got = s.scan(f"Preface here. {text.upper()} And more.")
        assert label in got[5].split(",") and any(x[0] == label and x[3] == 1.0 for x in got[7]), label
    own = [("acme", "you owe acme corporation one good turn for every copy that you make of it")]
    df = spark.createDataFrame([(1, "Now: you owe ACME Corporation one good turn, for every copy you make of it."), (2, "nothing owed")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.n_base) for r in license_scan.scan_documents(df, phrases={"good turn": "turn"}, templates=own).collect()}
    assert got == {1: ("acme,turn", 1), 2: ("", 0)}


def test_places_in_templates_against_search():
    rng = random.Random(3)
    sequences = [rng.choices("ab", k=12) for _ in range(4)]
    automaton = license_scan.Automaton(sequences)
    for at, state, length in automaton.statistics(words := rng.choices("ab", k=60)):
        run = words[at - length + 1 : at + 1]
        first = {n: min(k for k in range(len(q)) if q[max(0, k - length + 1) : k + 1] == run) for n, q in enumerate(sequences) if any(q[max(0, k - length + 1) : k + 1] == run for k in range(len(q)))}
        assert dict(automaton.ends[state]) == first
