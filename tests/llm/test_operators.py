"""The training-data operators against brute force, on small tables with nulls, empty and odd texts, ties and repeats."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import bpe_fst, chat_windows, graph, html_extract, iblt, kk_packing, lsm_dedup, minhash_join, pfor_store, pitman_yor, quality_fm, queries, textvec
from trailmark.llm.chunk_encoder import ByteLevelEncoder, WordEndEncoder

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ODD = ["a", "B", " ", "  ", "\n", "\t", "é", "漢", "🙂", "'s", ".", "<|endoftext|>", "<|", "\\", "|", "12", " ", "́"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice(["the ", "cat ", "Sat, ", "on. ", "a\n", "mat ", f"w{rng.randint(0, 400)} "]) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    texts = base + [b.upper() for b in base[:10]] + [b + " tail" for b in base[10:30]] + base[:5] + odd_texts(40) + [None, "", "one", "ONE", "x" * 5000, "word " * 3000]
    rows = [(i * 3, t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string"), [(i, t or "") for i, t, _ in rows]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, key string")


@pytest.fixture(scope="module")
def hard(spark):
    """Null and repeated identifiers, and repeated rows."""
    return spark.createDataFrame([(None, "a b c d e f"), (None, None), (1, "x"), (1, "x"), (1, "y z"), (2, None), (3, "")], "doc_id long, text string")


def test_word_hashes_cut_as_the_pattern(monkeypatch):
    monkeypatch.setattr(textvec, "CHUNK", 64)
    import pyarrow as pa

    texts = odd_texts(200) + ["q" * 300 + " r", "", "a\x0bb\x0cc"]
    h, first = textvec.word_hashes(*textvec.utf8(pa.array(texts)))
    seen = {}
    for t, a, b in zip(texts, first[:-1], first[1:], strict=True):
        words = WORD.findall(t.encode().lower())
        assert len(words) == b - a
        for w, x in zip(words, h[a:b].tolist(), strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_exact(spark, docs, empty, hard):
    df, rows = docs
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t.encode().lower()].append(i)
    for keep, pick in (("largest", max), ("smallest", min)):
        want = sorted((i, pick(groups[t.encode().lower()]), len(groups[t.encode().lower()]), i == pick(groups[t.encode().lower()]), hashlib.sha256(t.encode().lower()).hexdigest()) for i, t in rows)
        for options in ({}, {"memtable_entries": 5, "range_rows": 7}, {"digest_bytes": 1}):
            assert sorted(map(tuple, lsm_dedup.exact_duplicates(df, keep=keep, **options).collect())) == want
    assert lsm_dedup.exact_duplicates(empty).count() == 0
    got = lsm_dedup.exact_duplicates(hard, keep="largest").collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 4


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(t.encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[b]:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def test_near(spark, docs, empty, hard, monkeypatch):
    df, rows = docs
    assert sorted(map(tuple, minhash_join.near_duplicates(df).collect())) == brute_near(rows)
    assert minhash_join.near_duplicates(empty).count() == 0
    got = sorted(map(str, map(tuple, minhash_join.near_duplicates(hard).collect())))
    assert got == sorted(map(str, [(None, 2, None, True), (None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True)]))


def test_near_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "BLOCK", 8)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"v{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash_join.near_duplicates(df).collect())) == brute_near(rows)


def test_near_in_a_large_cluster(spark, monkeypatch):
    """Thousands of near copies around several centres, in blocks: the groups of brute force."""
    rng = random.Random(11)
    rows = []
    for centre in range(3):
        base = [f"c{centre}w{k}" for k in range(40)]
        for _ in range(250):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                words[rng.randrange(40)] = f"v{rng.randint(0, 50)}"
            rows.append(" ".join(words))
    # A chain: each links to the next alone, and all share many shingles.
    chain = [f"x{k}" for k in range(140)]
    rows += [" ".join(chain[k : k + 60]) for k in range(0, 80, 4)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    monkeypatch.setattr(minhash_join, "BLOCK", 64)
    monkeypatch.setattr(graph, "SMALL", 50)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, minhash_join.near_duplicates(df).collect()))
    assert got == brute_near(rows)


def test_signatures_find_links_near_the_limit():
    """Pairs of sets whose similarity is 0.75 to 0.80 stay within the threshold: at most one in ten thousand is missed."""
    rng = np.random.default_rng(4)
    missed = 0
    for k in range(4000):
        n = int(rng.integers(20, 200))
        shared = int(np.ceil(2 * n * (0.75 + 0.05 * rng.random()) / (1 + 0.8)))
        while 100 * shared < 75 * (2 * n - shared):
            shared += 1
        words = textvec.mix(rng.integers(0, 1 << 62, 2 * n - shared).astype(np.uint64))
        a, b = words[:n], np.concatenate([words[:shared], words[n:]])
        assert minhash_join.similar(np.sort(a), np.sort(b))
        missed += int((minhash_join.signature(a) != minhash_join.signature(b)).sum() > minhash_join.THRESHOLD)
    assert missed <= 1


def test_signatures_guarantee():
    """Any two signatures within the threshold share a key."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 65536, minhash_join.POSITIONS).astype(np.uint16)
        b = a.copy()
        at = rng.choice(minhash_join.POSITIONS, minhash_join.THRESHOLD, replace=False)
        b[at] ^= 1
        batch = pa.record_batch([pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()], pa.binary())], names=["rep", "sig"])
        keys = next(minhash_join._keys([batch]))
        k = keys.column(0).to_numpy().reshape(2, -1)
        assert np.intersect1d(k[0], k[1]).size


def test_codec(spark, docs, empty):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = bpe_fst.read_ranks(path)
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df, rows = docs
    got = {r.doc_id: r for r in bpe_fst.round_trip(df, path, P.PATTERN).collect()}
    for i, text in rows:
        ids = t.encode_ordinary(text)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe_fst.round_trip(empty, path, P.PATTERN).count() == 0
    ids = bpe_fst.encoded(df, path, P.PATTERN)
    back = {r.doc_id: r.text for r in bpe_fst.decoded(ids, path, P.PATTERN).collect()}
    assert back == dict(rows)
    odd = spark.createDataFrame([(None, "a b"), (None, None), (1, "x"), (1, "x")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in bpe_fst.decoded(bpe_fst.encoded(odd, path, P.PATTERN), path, P.PATTERN).collect()) == [(0, ""), (0, "a b"), (1, "x"), (1, "x")]


def test_transducer_in_small_parts(monkeypatch):
    """Long matches are emitted in parts, and tables that are full are built anew: the same ids as the tiktoken library's."""
    import tiktoken

    monkeypatch.setattr(bpe_fst, "FLUSH", 16)
    monkeypatch.setattr(bpe_fst, "MAX_STEPS", 50)
    monkeypatch.setattr(bpe_fst, "MAX_PAIRS", 50)
    enc = bpe_fst.FstEncoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=enc.fst.ranks, special_tokens={})
    rng = random.Random(6)
    texts = odd_texts(500, 3) + ["".join(rng.choice(["ing", "the", "tion", "aa", "é", "x"]) for _ in range(300)) for _ in range(50)] + ["a" * 30_000]
    assert [x.tolist() for x in enc.encode(texts)] == [t.encode_ordinary(x) for x in texts]


def test_utf8_machine():
    rng = random.Random(5)
    for _ in range(3000):
        raw = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE6, 0xBC, 0xA2, 0xF0, 0x9F, 0x99, 0x82, 0x80, 0xFF, 0xED, 0xE0, 0xF4, 0xC0]) for _ in range(rng.randint(0, 14)))
        machine, out, at = bpe_fst.Utf8Machine(), "", 0
        while at < len(raw):
            n = rng.randint(1, 5)
            out, at = out + machine.feed(raw[at : at + n]), at + n
        assert out + machine.end() == raw.decode("utf-8", "replace")


def test_chunk_encoders_equal_the_library():
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = odd_texts(3000, 9) + ["Don't stop. It's fine, no?  Yes\n\n x"] * 2
    texts += ["".join(rng.choice(["a", "Bc", ". ", ", ", " , ", " .", "..", "\0", "\0,", "İ", "é", "1", " ", "\n"]) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    texts += [a + chr(i) + b for i in range(256) for a in ("a", "1 ", " ", ".") for b in ("b", " b", "", "\n")]
    for kind, name in ((ByteLevelEncoder, "byte_bpe_50k.json"), (WordEndEncoder, "word_bpe_49k.json")):
        t = Tokenizer.from_file(P.path(name))
        t.encode_special_tokens = True
        assert [x.tolist() for x in kind(P.path(name)).encode(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_chat(spark, empty):
    rng = random.Random(3)
    part = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "a", "\n", "é🙂", "<\\|"]

    def text():
        return "".join(rng.choice(part) for _ in range(rng.randint(0, 12)))

    rows = [(c, t, rng.choice(["user", "assistant", "system", text(), None]), rng.choice([text(), None])) for c in range(80) for t in range(rng.randint(1, 9))]
    want = {}
    for c, _, role, x in rows:
        o = want.setdefault(c, [0, "", ""])
        o[0] += 1
        o[1] += f"{role or ''}\n{x or ''}\n"
        o[2] += (x or "") if role == "assistant" else ""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {c: (n, sha(a), len(b), sha(b)) for c, (n, a, b) in want.items()}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for budget, history in ((1, 0), (30, 10), (100, 20)):
        windows = chat_windows.chat_windows(df, budget=budget, history=history)
        assert {r[0]: tuple(r)[1:5] for r in chat_windows.read_back(windows).collect()} == want
        for w in windows.collect():
            assert w.tokens <= budget or len(chat_windows.parse(w.formatted)) <= 1 + w.has_system
    assert chat_windows.chat_windows(df.limit(0)).count() == 0


def test_packing(spark, docs, empty, hard):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    df, rows = docs
    pieces = kk_packing.packed(df, P.path("byte_bpe_50k.json")).collect()
    own, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for i, text in rows:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(own[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert kk_packing.packed(empty, P.path("byte_bpe_50k.json")).count() == 0
    assert all(len(own[i]) == 1 for i, text in rows if len(text) < 20)
    got = collections.Counter((p.doc_id, p.doc_tokens) for p in kk_packing.packed(hard, P.path("byte_bpe_50k.json")).collect())
    assert got == {(None, 7): 1, (None, 1): 1, (1, 2): 2, (1, 3): 1, (2, 1): 1, (3, 1): 1}
    rng = random.Random(1)
    for _ in range(80):
        sizes = [rng.randint(1, rng.choice([20, 256])) for _ in range(rng.randint(1, 300))]
        windows = kk_packing.pack(sizes, 256)
        assert all(sum(n for _, _, n in w) <= 256 for w in windows) and len(windows) <= -(-sum(sizes) // 256) * (1 + 1 / kk_packing.RISE) + 1
        units = sorted((i, b + k) for w in windows for i, b, n in w for k in range(n))
        assert units == [(i, k) for i, n in enumerate(sizes) for k in range(n)]
        equal = kk_packing.differencing(sizes, 4)
        assert sorted(i for w in equal for i in w) == list(range(len(sizes)))


def test_token_files(spark, docs, empty, hard, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    df, rows = docs
    pfor_store.write_ids(df, str(tmp_path / "a"), P.path("word_bpe_49k.json"))
    at = 0
    for r, (i, text) in zip(sorted(pfor_store.read_ids(spark, str(tmp_path / "a")).collect()), rows, strict=True):
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        at += len(ids)
    shards = list((tmp_path / "a" / "shards").iterdir())
    assert sum(len(d[2]) for f in shards for d in pfor_store.read_shard(f.read_bytes())) == at
    (tmp_path / "a" / "shards" / "000000-000000-left-by-a-lost-attempt.pfr").write_bytes(shards[0].read_bytes()[:50])
    assert pfor_store.read_ids(spark, str(tmp_path / "a")).count() == len(rows)
    for name, table, n in (("b", empty, 0), ("c", hard, 7)):
        pfor_store.write_ids(table, str(tmp_path / name), P.path("word_bpe_49k.json"))
        got = sorted(((r.doc_id is not None, r.doc_id, r.start, r.n_tokens) for r in pfor_store.read_ids(spark, str(tmp_path / name)).collect()), key=lambda x: x[2])
        assert len(got) == n and [x[2] for x in got] == [sum(y[3] for y in got[:k]) for k in range(n)] and sorted(got, key=lambda x: (x[0], x[1] or 0, x[2])) == got
    rng = random.Random(4)
    for _ in range(20):
        many = [np.array([rng.choice([rng.randrange(50), 2**32 - 1 if rng.random() < 0.02 else 7]) for _ in range(rng.choice([0, 1, 255, 256, 700]))], np.uint32) for _ in range(rng.randint(1, 6))]
        data = pfor_store.write_shard(list(range(len(many))), many)
        for first in range(len(many)):
            (one,) = pfor_store.read_shard(data, first, first + 1)
            assert one[0] == first and (one[2] == many[first]).all()


def test_fingerprints(spark, docs, empty, hard):
    df, rows = docs
    line = re.compile(r"[^\n]{1,%d}\n*|\n+" % iblt.PARAGRAPH)
    down = sorted(rows, reverse=True)
    got = {r.doc_id: r for r in iblt.fingerprints(df).collect()}
    prints = {}
    for k, (i, t) in enumerate(down):
        after = down[(k + 1) % len(down)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]

        def like(x, y):
            x, y = collections.Counter(line.findall(x)), collections.Counter(line.findall(y))
            return sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0

        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(r.near_edited, like(t, edited)) and math.isclose(r.near_next, like(t, after))
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
    assert iblt.fingerprints(empty).count() == 0
    got = sorted(((r.doc_id or 0, r.n_chars, len(r.edited_sha256)) for r in iblt.fingerprints(hard).collect()))
    assert got == [(0, 0, 64), (0, 11, 64), (1, 1, 64), (1, 1, 64), (1, 3, 64), (2, 0, 64), (3, 0, 64)]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("trailmark")]
    (only,) = iblt.fingerprints(hard.where("text = 'y z'")).collect()
    assert only.near_next == 1.0


def test_fingerprint_retries(spark, docs, monkeypatch):
    """Sketches that are far too small are made anew in larger sizes; there is no other way to a result."""
    df, _ = docs
    want = sorted(map(tuple, iblt.fingerprints(df).select("doc_id", "near_edited", "near_next").collect()))
    monkeypatch.setattr(iblt, "OWN", 0.01)
    monkeypatch.setattr(iblt, "DIFFERING", 0.01)
    monkeypatch.setattr(iblt, "ATTEMPTS", ((1, 3), (16, 6), (256, 24)))
    assert sorted(map(tuple, iblt.fingerprints(df).select("doc_id", "near_edited", "near_next").collect())) == want
    monkeypatch.setattr(iblt, "ATTEMPTS", ((1, 3),))
    with pytest.raises(ValueError):
        iblt.fingerprints(df)


def test_fingerprints_recover_paragraphs(spark, docs, monkeypatch):
    df, rows = docs
    down = sorted(rows, reverse=True)
    texts = {}
    for k, (i, t) in enumerate(down):
        after, cut = down[(k + 1) % len(down)][1], len(t) // 3
        texts[i] = (t, t[: len(t) - cut] + after[:cut], after)
    table = spark.createDataFrame([(i, *x) for i, x in texts.items()], "doc_id long, t string, e string, n string")
    digests = {r[0]: [collections.Counter(x) for x in r[1:]] for r in table.select("doc_id", *[iblt.digests(F.col(x)) for x in "ten"]).collect()}

    def more(x, y):
        return sorted((k, x[k] - y[k]) for k in x | y if x[k] != y[k])

    for r in iblt.fingerprints(df).collect():
        t, e, n = digests[r.doc_id]
        assert [tuple(x) for x in r.edited_differs] == more(t, e) and [tuple(x) for x in r.next_differs] == more(t, n)
        for print_, keys in ((r.fingerprint, t), (r.edited_fingerprint, e)):
            m, cells = print_.split(":")
            cells = [[int(y, 16) for y in x.split(".")] for x in cells.split("-") if x]
            assert int(m, 16) >= max(4, iblt.OWN * sum(keys.values())) and sum(x[1] for x in cells) == 3 * sum(keys.values())
            assert sum(x[2] for x in cells) % 2**64 == 3 * sum(k * v for k, v in keys.items()) % 2**64
    # A sketch in a larger size folds to the returned one.
    own = spark.createDataFrame([(0, i, i, [k for k, v in d[0].items() for _ in range(v)]) for i, d in digests.items()], "range int, rn int, doc_id long, a array<int>")
    items = lambda times: own.select("rn", F.expr(f"{times} * {iblt._power(f'{iblt.OWN} * size(a)')}").alias("m"), F.explode("a").alias("key")).withColumn("key", F.col("key").cast("long"))
    small = iblt._sketch(items(1), ["rn", "m"], 0)
    folded = iblt._sketch(items(8), ["rn", "m"], 0).select("rn", F.expr("m div 8 as m"), F.expr("(cell div m) * (m div 8) + pmod(pmod(cell, m), m div 8) as cell"), "c", "k", "q").groupBy("rn", "m", "cell").agg(*[F.sum(x).alias(x) for x in "ckq"])
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, folded.collect()))


def plain_sampler(train, sweeps=40, burn_in=15, seed=3):
    """The same two-level model, customer by customer: p(word, context) averaged over samples."""
    rng = random.Random(seed)
    theta, counts, light, total = pitman_yor.THETA, collections.Counter(), collections.Counter(), collections.Counter()
    for text in train:
        light[text[0]] += 1
        total.update(text)
        counts.update(zip(text, text[1:], strict=False))
    clip = lambda once, twice: min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))
    d = clip(*[sum(c == k for c in counts.values()) for k in (1, 2)])
    tables = {key: [c] for key, c in counts.items()}
    customers, opened, served = collections.Counter(), collections.Counter(), collections.Counter(light)
    for (u, w), c in counts.items():
        customers[u] += c
        opened[u] += 1
        served[w] += 1
    samples = []
    for sweep in range(sweeps):
        d0 = clip(*[sum(c == k for c in served.values()) for k in (1, 2)])
        root = lambda w, d0=d0: (served[w] - d0 if served[w] > 0 else theta + d0 * len(total)) / (theta + sum(served.values()))
        for (u, w), c in counts.items():
            for _ in range(c if c > 1 else 0):
                at = rng.choices(range(len(tables[u, w])), tables[u, w])[0]
                tables[u, w][at] -= 1
                if not tables[u, w][at]:
                    tables[u, w].pop(at)
                    opened[u] -= 1
                    served[w] -= 1
                pull = (theta + d * opened[u]) * root(w)
                at = rng.choices(range(len(tables[u, w]) + 1), [*[n - d for n in tables[u, w]], pull])[0]
                if at == len(tables[u, w]):
                    tables[u, w].append(1)
                    opened[u] += 1
                    served[w] += 1
                else:
                    tables[u, w][at] += 1
        if sweep >= burn_in:
            d0 = clip(*[sum(c == k for c in served.values()) for k in (1, 2)])
            samples.append((dict(served), dict(opened), {k: len(v) for k, v in tables.items()}, d0, sum(served.values())))

    def p(w, u=None):
        out = 0.0
        for served, opened, t, d0, n in samples:
            base = (served[w] - d0 if served.get(w, 0) > 0 else theta + d0 * len(total)) / (theta + n)
            out += base if u is None else (counts[u, w] - d * t.get((u, w), 0) + (theta + d * opened.get(u, 0)) * base) / (theta + customers[u])
        return out / len(samples)

    return p


def test_language_model_against_a_plain_sampler(spark):
    rng = random.Random(9)
    after = {w: [rng.randrange(30) for _ in range(4)] for w in range(30)}
    rows = []
    for i in range(150):
        words = [rng.randrange(30)]
        while len(words) < 30:
            words.append(rng.choice(after[words[-1] % 30]) if rng.random() < 0.8 else rng.randrange(40))
        rows.append((i, " ".join(f"w{x}" for x in words)))
    got = {r.doc_id: r for r in pitman_yor.scored(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 120).collect()}
    tokens = {i: [*t.split(), "<end>"] for i, t in rows}
    p = plain_sampler([tokens[i] for i in range(120)])
    apart = []
    for i, own in tokens.items():
        want = math.log10(p(own[0])) + sum(math.log10(p(w, u)) for u, w in zip(own, own[1:], strict=False))
        apart.append((got[i].score - want) / len(own))
        assert math.isclose(got[i].perplexity, 10 ** (-got[i].score / len(own)))
    assert max(map(abs, apart)) < 0.06 and abs(sum(apart)) < 0.02 * len(apart)
    held = [got[i] for i in range(120, 150)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_seating_is_consistent():
    rng = np.random.default_rng(1)
    counts = rng.integers(2, 50, 300)
    pull = rng.random(300) * 5
    tables, sizes = pitman_yor._seat(counts, pull, 0.6, rng)
    for _ in range(30):
        tables, sizes = pitman_yor._gibbs(counts, tables, sizes, pull, 0.6, rng)
        ends = np.cumsum(tables)
        assert (sizes > 0).all() and ends[-1] == len(sizes) and (np.add.reduceat(sizes, ends - tables) == counts).all()


def test_quality(spark, sf, empty, hard):
    got = queries.op2_quality_fm(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).collect()
    assert all(r[1] >= 0.9 for r in got)
    model = quality_fm.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))
    scores = quality_fm.scored(hard, model).collect()
    assert len(scores) == 7 and len({r.score for r in scores}) == 1 and quality_fm.scored(empty, model).count() == 0
    rng = np.random.default_rng(2)
    m = quality_fm.Model(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, quality_fm.FACTORS)) * 0.1)
    first = np.array([0, 5, 5, 9, 40])
    words = quality_fm.Words(np.concatenate([rng.choice(quality_fm.WORDS, n, replace=False) for n in np.diff(first)]), first)
    k = len(quality_fm.STATISTICS) + len(quality_fm.METADATA)
    bins = quality_fm.WORDS + quality_fm.BINS * np.arange(k) + rng.integers(0, quality_fm.BINS, (4, k))
    for i, got in enumerate(m.logits(words, bins)):
        own = words.at[first[i] : first[i + 1]]
        x = dict.fromkeys(bins[i].tolist(), 1.0) | dict.fromkeys(own.tolist(), 1 / math.sqrt(max(len(own), 1)))
        pairs = sum(x[p] * x[q] * (m.factors[p] @ m.factors[q]) for p in x for q in x if p < q)
        assert math.isclose(got, 0.3 + sum(m.weights[p] * v for p, v in x.items()) + pairs, rel_tol=1e-9)


def test_quality_of_odd_rows(spark):
    """Repeated rows don't add to the sample; long texts, clashing and missing columns, nulls do no harm."""
    good = [(i, f"a calm sentence about topic{i % 7} and the weather.", 40, "k") for i in range(1, 40)]
    bad = [(i, "BUY!!! $$$ ### BUY|||" * 3, 60, "k") for i in range(40, 80)]
    rows = good + bad + good[:1] * 500 + [(90, "word " * 200_000, None, None), (91, None, 5, None), (None, "x", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, __text string").drop("__text").withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(1, 80)] + [(5, None), (None, 1)], "doc_id long, quality int")
    model = quality_fm.fit(df, labels)
    again = quality_fm.fit(df.dropDuplicates(), labels)
    assert (model.weights == again.weights).all()
    kept = quality_fm.accepted(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= set(range(1, 40)) and not {r.doc_id for r in kept.collect()} & set(range(40, 80))
    assert quality_fm.scored(df.drop("n_chars"), model).count() == len(rows)


def test_html():
    show = html_extract.visible_text
    assert show(None) == show("") == ""
    assert show("<p>one<p>two<br>three") == "one\n\ntwo\nthree"
    assert show("<ul><li>a<li>b<ol start=3><li>x</ol></ul>") == "- a\n- b\n  3. x"
    assert show("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>") == "Name       Qty\napple pie  3"
    assert show("<table><tr><td rowspan=2>r<td>1<tr><td>22</table>") == "r  1\n   22"
    assert show("<title>t</title><script>var a='</p>'</script><p hidden>no</p><div style='display: none'>no</div>yes &amp; <b>bold</b>") == "yes & bold"
    assert show("<pre>\n a  b\n  c</pre>") == " a  b\n  c"
    assert show("<blockquote>q</blockquote>x") == "> q\n\nx"
    assert show("a < b <!-- no --> c") == "a < b c"
    assert show("<div>" * 20000 + "deep") == "deep"


MALFORMED = ["<a", "<a '", '<a ">" ', "<", "</p>", "<p>", "<ul><li>x", "<dl><dd>x", "<table><tr><td>a", "<tr><td>a", "<td>a", "<td rowspan=9 colspan=900>a<tr>", "<svg><text>a", "<span></div>", "&#9", "<!-", "<select><option>a"]


def test_html_is_linear():
    """A megabyte of each malformed shape takes seconds (milliseconds a kilobyte), and keeps its text."""
    import time

    pages = [x * (1_000_000 // len(x)) for x in MALFORMED] + ["<div>" * 100_000 + "</b>" * 100_000, "<b><table><td>" + "<div>" * 80_000 + "</b>" * 80_000]
    for page in pages:
        began = time.thread_time()
        text = html_extract.visible_text(page)
        assert time.thread_time() - began < 30, page[:40]
        if page[0:3] in ("<tr", "<td", "<dl", "<ul"):
            letter = "x" if page[0:3] in ("<dl", "<ul") else "a"
            assert text.count(letter) == page.count(f">{letter}")


def test_html_visibility():
    show = html_extract.visible_text
    assert show("a<div style='visibility: hidden'>b<span style='visibility:visible'>c</span>d</div>e") == "a\nc\ne"
    assert show("x <math><mi>y</mi><annotation>no</annotation></math> <svg><title>no</title><desc>no</desc><text>t</text></svg>") == "x y t"
    assert show("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    assert show('<a title="a>b">c</a> <a href="x>d</a><p>e') == "c d\n\ne"


def test_html_against_a_plain_walk():
    """Generated pages: the words and their order are those that the standard library's parser finds outside hidden elements."""
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__()
            self.hidden, self.words = [], []

        def handle_starttag(self, tag, attrs):
            if tag not in ("br", "img", "hr") and (self.hidden or tag in ("script", "style", "template") or "hidden" in dict(attrs)):
                self.hidden.append(tag)

        def handle_endtag(self, tag):
            if self.hidden:
                self.hidden.pop()

        def handle_data(self, data):
            if not self.hidden:
                self.words += data.split()

    rng = random.Random(8)
    serial = iter(range(10**6))

    def page(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["text", "text", "div", "p", "b", "list", "table", "script", "hidden", "br", "entity", "comment"])
            inner = page(depth - 1) if depth and kind in ("div", "b", "hidden") else f" w{next(serial)} "
            out.append({
                "text": f" t{next(serial)} t{next(serial)}\n", "div": f"<div class='x y'>{inner}</div>", "p": f"<div><p>{f'w{next(serial)}'}</p></div>", "b": f"<span>{inner}</span>",
                "list": "<ul>" + "".join(f"<li>w{next(serial)}</li>" for _ in range(3)) + "</ul>", "table": "<table>" + "".join("<tr>" + "".join(f"<td>w{next(serial)}</td>" for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>",
                "script": f"<script>var w{next(serial)} = 1;</script>", "hidden": f"<div hidden>{inner}</div>", "br": "<br>", "entity": f" &lt;w{next(serial)}&amp; ", "comment": f"<!-- w{next(serial)} -->",
            }[kind])
        return "".join(out)

    for _ in range(300):
        source = page(3)
        walk = Walk()
        walk.feed(source)
        walk.close()
        assert [w for w in html_extract.visible_text(source).split() if w != "-"] == walk.words


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", 5), (1, "u", "<p>a", 5), (None, None, None, None)], "page_id long, url string, html string, extra int")
    assert sorted(r.extracted_text for r in html_extract.extracted(df).collect()) == ["", "a", "a"]
    assert html_extract.extracted(df.limit(0)).count() == 0
