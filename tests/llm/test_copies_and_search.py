"""Near-duplicates, repeated passages, exact search and the pipeline against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardmetrics.llm import mixing, simhash, suffixes, topk
from wardmetrics.llm.components import components
from wardmetrics.session import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs], DOCS)


def with_clashes(df):
    return df.withColumns({c: F.lit("clash") for c in ("_key", "_text", "_body", "_row", "_sum", "fp", "root", "spans", "starts", "id", "v", "norm2")})


def groups_by_force(n, near):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


# --- components

def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(300, 300), (5, 4), (5, 4)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 260)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- SimHash

def fingerprint_by_force(text):
    xxhash = pytest.importorskip("xxhash")
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def test_fingerprints_and_groups_equal_brute_force(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["Ab", "éa", "cd", "ÀX", "ef", "gh", "ij", "kl"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 400))) for _ in range(25)]
    own = [None, "", " \n ", "One", "one TWO", "x " * 2000]
    for text in base:
        own += [text, text.upper(), text + " more", " ".join(text.split()[1:]), text.replace(" ", "\n", 3)]
    pairs = [(1000 - i, t) for i, t in enumerate(own)] + [(None, base[0]), (1000, None)]
    got = simhash.near_duplicates(with_clashes(docs_of(spark, pairs))).collect()
    prints = [fingerprint_by_force(t) for _, t in pairs]
    group = groups_by_force(len(pairs), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2)
    least = {}
    for (key, _), g in zip(pairs, group):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    expected = sorted(((str(k), p, least.get(g)) for (k, _), p, g in zip(pairs, prints, group)), key=str)
    assert sorted(((str(r["doc_id"]), r["fp"] % (1 << 64), r["component_id"]) for r in got), key=str) == expected
    assert any(c > 1 for c in Counter(group).values()) and len(set(group)) > 10


@pytest.mark.parametrize("limit", [8192, 3])
def test_links_lose_no_pair(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "PAIR_LIMIT", limit)
    rng = np.random.default_rng(limit)
    fps = set()
    for c in rng.integers(0, 1 << 64, 40, np.uint64).tolist():
        fps.add(c)
        for _ in range(20):
            x = c
            for b in rng.choice(64, rng.integers(0, 5), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    links = simhash.near_links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long"))
    root = {r["node"]: r["root"] for r in components(links).collect()}
    mine = [root.get(int(x), int(x)) for x in fps.view(np.int64)]
    group = groups_by_force(len(fps), lambda i, j: int(np.bitwise_count(fps[i] ^ fps[j])) <= 2)
    assert len(set(mine)) == len(set(group)) == len(set(zip(mine, group)))
    assert links.count() <= 6 * len(fps)


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


# --- repeated passages

def removal_by_force(pairs, length):
    seen = Counter()
    raw = [(k, (t or "").encode()) for k, t in pairs]
    for _, b in raw:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for key, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((key, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    shared, out = [words(30) for _ in range(8)], []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(shared)
            if rng.random() < 0.6:
                a = rng.randint(0, 60)
                p = p[a : a + rng.randint(20, 120)]
            parts.append(p if rng.random() < 0.6 else words(rng.randint(1, 30)))
        out.append((i, " ".join(parts)))
    odd = [(500, None), (501, ""), (502, "ab " * 100), (503, "x" * 300), (None, "x" * 300), (None, shared[0]), (504, out[3][1]), (505, "\0" * 90), (506, "a" + "\0" * 70), (3, out[3][1]), (3, out[3][1])]
    return out + odd


@pytest.mark.parametrize("length,gram,hot", [(50, 8, 10**9), (50, 20, 10**9), (50, 8, 6), (64, 32, 2)])
def test_removal_equals_brute_force(spark, length, gram, hot):
    pairs = passages(length + gram)
    df = with_clashes(docs_of(spark, pairs)).repartition(3)
    got = suffixes.remove_repeats(df, length=length, gram=gram, hot_gram=hot, digests=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == removal_by_force(pairs, length)


def test_long_texts_are_sampled_in_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    block = lambda: suffixes.Block(None, data, np.array([0, len(data)]))
    whole = suffixes.anchors(block())
    monkeypatch.setattr(suffixes, "STRETCH", 700)
    cut = suffixes.anchors(block())
    windows = lambda a: {p: at for at, x, y in zip(a.at, a.first, a.last) for p in range(x, y + 1)}
    assert windows(whole) == windows(cut) and len(windows(whole)) == len(data) - suffixes.LENGTH + 1


def test_multikey_order_and_shared_lengths():
    rng = random.Random(7)
    own = sorted({bytes(rng.choice(b"\0ab") for _ in range(rng.randint(0, 20))) for _ in range(400)}) * 2
    rng.shuffle(own)
    group = np.array([rng.randint(0, 3) for _ in own])
    data = np.frombuffer(b"".join(own), np.uint8)
    length = np.array([len(x) for x in own])
    order, shared = suffixes.multikey_order(suffixes._side(data, np.cumsum(length) - length, length, 24, 1), length, group)
    padded = [(group[i], own[i].ljust(24, b"\0"), len(own[i])) for i in order]
    assert padded == sorted(padded)
    for k in range(1, len(order)):
        a, b = own[order[k - 1]], own[order[k]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == (same if group[order[k]] == group[order[k - 1]] else 0)


def test_the_driver_gets_pages_of_the_filter_and_a_bounded_sample(spark, monkeypatch):
    rows = 60_000
    h = np.random.default_rng(8).integers(-(1 << 63), 1 << 63, rows)
    hashes = written(spark.createDataFrame([(int(x), i) for i, x in enumerate(h)], "h long, lead long").withColumn("n", F.lit(2)).repartition(5), "hashes")
    brought, frame = [], type(hashes)
    for name in ("collect", "toPandas"):
        def counted(self, *args, _own=getattr(frame, name), **kwargs):
            out = _own(self, *args, **kwargs)
            brought.append(len(out))
            return out

        monkeypatch.setattr(frame, name, counted)
    words, bits = suffixes.hash_filter(hashes, rows)
    slots = np.zeros(1 << bits, bool)
    slots[h & (1 << bits) - 1] = True
    assert np.array_equal(np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool), slots)
    assert suffixes.in_filter((words, bits), h.view(np.uint64)).all()
    assert max(brought) <= rows // 500
    cuts = suffixes.splitters(hashes, rows, 10, sample=3000)
    assert len(cuts) == 9 and np.all(np.abs(cuts - rows / 10 * np.arange(1, 10)) < rows / 20)
    assert max(brought) < 3500


def test_only_windows_of_hot_grams_go_one_by_one(spark, monkeypatch):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    shared = [words(10) for _ in range(40)]
    pairs = [(i, words(20) + " " + shared[i % 40] + " " + words(20)) for i in range(160)]
    seen = {}

    def noted(df, name):
        out = written(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(suffixes, "written", noted)
    got = suffixes.remove_repeats(docs_of(spark, pairs), length=50, gram=20, hot_gram=2, digests=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == removal_by_force(pairs, 50)
    windows = Counter()
    for _, t in pairs:
        data = np.frombuffer(t.encode(), np.uint8)
        a = suffixes.anchors(suffixes.Block(None, data, np.array([0, len(data)])), 50, 20)
        for key, first, last in zip(a.hash.tolist(), a.first.tolist(), a.last.tolist()):
            windows[key, "places"] += 1
            windows[key, "all"] += last - first + 1
    assert seen["hot-windows"] == sum(n for (key, kind), n in windows.items() if kind == "all" and windows[key, "places"] > 2) > 0


def test_removal_from_nothing(spark):
    assert suffixes.remove_repeats(docs_of(spark, [])).count() == 0
    kept = suffixes.remove_repeats(docs_of(spark, [(1, "short")])).first()
    assert (bytes(kept["kept"]), kept["n_removed"], kept["n_spans"]) == (b"short", 0, 0)


# --- exact search

def search_by_force(data, k):
    sound = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for place, (q, u) in enumerate(sound):
        if q % 5:
            continue
        scored = sorted((-sum(a * b for a, b in zip(u, v)), i) for other, (i, v) in enumerate(sound) if other != place)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("slices", [(8, 6, 4, 5, 3), (8192, 32768, 4096, 2048, 1024)])
def test_search_equals_brute_force(spark, monkeypatch, slices):
    for name, n in zip(("QUERY_ROWS", "CANDIDATE_ROWS", "SEED_ROWS", "SLICE", "TILE"), slices):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(0, 1, 6) * rng.exponential(1)).tolist()) for i in range(70)]
    data += [(100, [1.0] * 6), (101, [1.0] * 6), (102, [1.0] * 6), (103, [0.0] * 6), (105, None), (110, [None] + [1.0] * 5), (115, [float("nan")] * 6), (120, [float("inf")] * 6), (125, [0.5, 0.25]), (130, []), (None, [1.0] * 6), (7, data[7][1])]
    # Rows of one key: another vector, the same vector twice more.
    data += [(0, [3.0, 0.5, 0.0, 0.0, 0.25, 1.0]), (5, data[5][1]), (5, data[5][1])]
    df = with_clashes(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    got = topk.top_inner_products(df, lambda key: key % 5 == 0)
    assert sorted(tuple(r) for r in got.collect()) == search_by_force(data, 5)


def test_search_stays_exact_beyond_doubles(spark):
    data = [(i, [2.0e9 + i, 1.0, 3.0]) for i in range(4)]
    got = topk.top_inner_products(spark.createDataFrame(data, "vec_id long, embedding array<double>"), lambda key: key == 0, scale=1)
    assert [(r["vec_id"], r["score"]) for r in got.orderBy("rank").collect()] == [(i, 2 * 10**9 * (2 * 10**9 + i) + 10) for i in (3, 2, 1)]
    few = topk.top_inner_products(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"), lambda key: key == 0)
    assert few.count() == 0
    assert topk.top_inner_products(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda key: key == 0).count() == 0


# --- pipeline

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "src0", 0), (7, "twice here", "en", "src0", 10), (7, "twice here", "en", "src0", 10)], docs.schema)
    docs = with_clashes(docs.unionByName(odd)).withColumn("extra", F.lit(1))
    docs.write.parquet(str(tmp_path / "0"))
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        out = stage(spark, docs, FOLDER)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(str(tmp_path / str(k + 1)))
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    # One row of each group of near-duplicates is left.
    after = spark.read.parquet(str(tmp_path / "2"))
    rows = after.collect()
    prints = [fingerprint_by_force(r["text"]) for r in rows]
    assert len(set(groups_by_force(len(rows), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2))) == len(rows)
    # No base secret survives, and texts without one are as they were.
    found = re.compile(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}")
    clean = spark.read.parquet(str(tmp_path / "3")).collect()
    assert not any(found.search(r["text"]) for r in clean if r["text"])
    before = {(r["doc_id"], r["text"]) for r in rows}
    assert all((r["doc_id"], r["text"]) in before for r in clean if "<secret>" not in (r["text"] or ""))
    assert all(r["n_chars"] == len(r["text"]) for r in clean if r["text"] and r["n_chars"] is not None)


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / str(k)))
        docs = stage(spark, spark.read.parquet(str(tmp_path / str(k))), FOLDER)
    assert docs.count() == 0


@pytest.mark.parametrize("stage", ["simhash", "mixing"])
def test_stages_keep_their_rows_when_splits_change_between_jobs(spark, tmp_path, monkeypatch, stage):
    """Places are stored: a scan planned for other splits (an executor more or less) still finds its rows."""
    rng = random.Random(3)
    data = [(i, " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40)), "en", f"s{i % 3}", 79) for i in range(24)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(12).write.parquet(str(tmp_path / "docs"))
    module, name = {"simhash": (simhash, "near_duplicates"), "mixing": (mixing, "mix")}[stage]
    whole = getattr(module, name)
    run = {"simhash": corpus_pipeline.simhash_stage, "mixing": corpus_pipeline.mixing_stage}[stage]
    docs = spark.read.parquet(str(tmp_path / "docs"))
    expected = sorted(tuple(r) for r in run(spark, docs, "").collect())

    def then_other_splits(*args, **kwargs):
        found = written(whole(*args, **kwargs), "found")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        return found

    monkeypatch.setattr(module, name, then_other_splits)
    try:
        got = sorted(tuple(r) for r in run(spark, docs, "").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert expected and got == expected
