"""Conversation tries, archives and spelling variants against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from wardmetrics.llm import prefix_trie, spelling, warc
from wardmetrics.session import scratch_path

TURNS = "conv_id long, turn long, role string, text string"
PAGES = "page_id long, url string, html string"
DOCS = "doc_id long, text string"


def with_clashes(df):
    names = ("conv", "pos", "symbol", "depth", "n1", "up", "_part", "_k", "_p", "_d", "_key", "_text", "word", "n", "value", "key", "last")
    return df.withColumns({c: F.lit("clash") for c in names})


# --- conversation prefix trie

def trie_by_force(rows, rebuild=True):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest(), (r or "", x or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    seqs = own
    if rebuild:
        seqs = {}
        for c in own:
            h = zlib.crc32(str(c).encode()) % 6
            seqs[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members = {}
    for c, q in seqs.items():
        for d in range(len(q) + 1):
            members.setdefault(tuple(q[:d]), []).append(c)
    children, totals = {}, {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(own_members) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own_members), len(node), parent, len(own_members), len(children.get(node, [])), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(df, **options):
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, **options).collect()), key=str)


def forked(rng, keys, lengths, choices=2):
    rows = []
    for c in keys:
        n = rng.choice(lengths)
        cut = rng.randint(0, n)
        rows += [(c, i if i else None, "user" if i % 2 else None, f"turn {i}" if i < cut else f"{i} {rng.randint(0, choices)}") for i in range(n)]
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_brute_force(spark, rebuild):
    rows = forked(random.Random(1), range(80, 240), [1, 2, 3, 5, 8, 9, 63, 64, 65, 130, 300])
    rows += [(100, None, None, None), (None, 1, "user", "lost"), (700, 5, None, ""), (701, 5, "", None), (-30, 1, "a", "é€"), (-30, 1, "a", "é€"), (-30, 1, "b", "x")]
    df = with_clashes(spark.createDataFrame(rows, TURNS).repartition(7))
    assert trie_rows(df, rebuild=rebuild) == trie_by_force(rows, rebuild)


def test_trie_with_one_first_turn_one_hot_conversation_and_copies(spark):
    rows = [(c, 0, "user", "hello") for c in range(1000, 1400)] + [(c, 1, "x", str(c % 3)) for c in range(1000, 1400)]
    rows += [(5, i, "u", "long " * (i % 4)) for i in range(2500)]
    assert trie_rows(spark.createDataFrame(rows, TURNS)) == trie_by_force(rows)


def test_end_lists_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_CHARS", 50)
    rows = [(c, 0, "user", "same") for c in range(0, 3000)]
    assert trie_rows(spark.createDataFrame(rows, TURNS), rebuild=False) == trie_by_force(rows, rebuild=False)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_rows(spark.createDataFrame([], TURNS)) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "a", "b")], TURNS)) == []
    # Conversation 204 takes three turns of 200, which is absent, and drops its own first three.
    key = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 >= 3)
    rows = [(key, 1, "a", "b"), (key, 2, "a", "c")]
    got = trie_rows(spark.createDataFrame(rows, TURNS))
    assert got == trie_by_force(rows) and len(got) == 1


# --- archives

BIG = "é\r\n\r\nWARC/1.1\r\n" * 60_000 + "x" * 1_500_001


def pages_by_force(rows):
    out = []
    kept = {}
    for k, u, h in rows:
        body = (h or "").encode()
        if len(body) >= 1000:
            kept[body] = max(kept.get(body, (False, 0, "")), (k is not None, k or 0, u or ""))
    used = set()
    for k, u, h in rows:
        body = (h or "").encode()
        top = kept.get(body)
        mine = top is None or (top == (k is not None, k or 0, u or "") and body not in used)
        if mine:
            used.add(body)
        out.append((str(k) if k is not None else None, "response" if mine else "revisit", len(body), hashlib.sha1(body).hexdigest(), None if mine or not top[0] else str(top[1])))
    return sorted(out, key=str)


ROWS = [
    (1, "u1", None), (2, "a b\r\nX: y", ""), (3, None, "x" * 999), (4, "u", "x" * 999), (5, "u", "y" * 1000), (6, "u", "y" * 1000), (7, "u", BIG), (8, "v", BIG),
    (None, "q", "y" * 1000), (9, "z", "z\n" * 1000), (9, "z", "z\n" * 1000), (9, "z", "z\n" * 1000), (10, "€", "\r\n\r\n"), (None, None, "n" * 2000), (None, None, "n" * 2000),
    (11, "t", "WARC/1.1\r\nContent-Length: 3\r\n\r\n"),
]


def test_archives_read_back_as_written(spark):
    df = with_clashes(spark.createDataFrame(ROWS, PAGES))
    got = sorted((tuple(r) for r in warc.archived(df).select("key", "record_type", "payload_bytes", "payload_digest", "refers_to").collect()), key=str)
    assert got == pages_by_force(ROWS)
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def test_many_copies_of_one_page(spark):
    rows = [(i, f"u{i}", "same " * 300) for i in range(2000)] + [(i, "v", f"{i} " * 400) for i in range(2000, 2100)]
    got = warc.archived(spark.createDataFrame(rows, PAGES)).groupBy("record_type", "refers_to").count().collect()
    assert {tuple(r) for r in got} == {("response", None, 101), ("revisit", "1999", 1999)}


def test_chunks_hold_all_bytes_and_the_digest_so_far(spark):
    path = scratch_path(spark, "archive")
    warc.write_archives(spark.createDataFrame(ROWS, PAGES), path, chunk=300_000)
    # A record longer than a segment is in the archive in continuations.
    assert spark.read.text(path).filter("value = 'WARC-Type: continuation'").count() == -(-len(BIG.encode()) // 300_000) - 1
    rows = warc.read_chunks(spark, path, chunk=100_000).filter("record_type = 'response'").orderBy("record_id", "chunk_no").collect()
    payloads = {}
    for r in rows:
        so_far = payloads.get(r["record_id"], b"") + r["data"]
        payloads[r["record_id"]] = so_far
        assert len(r["data"]) <= 100_000 and r["payload_bytes"] == len(so_far) and r["payload_digest"] == hashlib.sha1(so_far).hexdigest()
    expected = Counter(len((h or "").encode()) for _, _, h in ROWS)
    assert BIG.encode() in payloads.values()
    assert set(map(len, payloads.values())) <= set(expected)
    last = {r["record_id"]: r["chunk_no"] for r in rows if r["last"]}
    assert set(last) == set(payloads) and max(last.values()) >= len(BIG.encode()) // 100_000


def record(kind, key, body, **fields):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{key}>", *(f"{n.replace('_', '-')}: {v}" for n, v in fields.items()), f"Content-Length: {len(body)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + body


@pytest.mark.parametrize("archive", [
    [record("response", "a", "body", WARC_Payload_Digest="sha1:" + "0" * 40)],
    [record("response", "a", "body", WARC_Segment_Number=1)],
    [record("continuation", "b", "body", WARC_Segment_Number=2, WARC_Segment_Origin_ID="<a>")],
    ["no record"],
    [record("response", "a", "body") + "more"],
])
def test_broken_archives_end_the_job(spark, archive):
    path = scratch_path(spark, "broken")
    spark.createDataFrame([(a,) for a in archive], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    with pytest.raises(PythonException):
        warc.read_chunks(spark, path).collect()


def test_revisit_of_a_record_elsewhere(spark):
    path = scratch_path(spark, "elsewhere")
    text = record("revisit", "a", "", WARC_Payload_Digest="sha1:" + "1" * 40, WARC_Refers_To="<other>")
    spark.createDataFrame([(text,)], "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    row = warc.records(warc.read_chunks(spark, path)).first()
    assert (row["record_type"], row["payload_digest"], row["payload_bytes"], row["refers_to"]) == ("revisit", "1" * 40, None, None)


# --- spelling variants

def variants_by_force(rows, slip=97):
    counts = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            counts[w if h % slip else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: set() for w in words}
    masks = {}
    for w in words:
        for i in range(len(w)):
            masks.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def edited(rng, word, letters):
    i = rng.randint(0, len(word))
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("frequent", [0, 3, 64])
def test_variants_equal_brute_force(spark, frequent, monkeypatch):
    monkeypatch.setattr(spelling.frequent_grams, "__defaults__", (frequent, 1 << 16))
    rng = random.Random(frequent)
    letters = "abcdéÿÀ×"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(60)]
    words += ["aaaaaa", "aaaaaaa", "aaaaa", "ababab", "bababa", "ABabAb"]
    for _ in range(3):
        words += [edited(rng, w, letters) for w in words if rng.random() < 0.6]
    rows = [(i if i % 9 else None, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(7, None), (8, ""), (9, "..,"), (10, "x" * 400), (11, "x" * 400), (12, "x" * 399 + " " + "x" * 400)]
    got = {r["word"]: tuple(r) for r in spelling.variants(with_clashes(spark.createDataFrame(rows, DOCS)), slip=5).collect()}
    assert got == variants_by_force(rows, slip=5)
    assert any(v[2] not in (v[0], v[1]) for v in got.values())


def test_long_texts_are_counted_in_stretches(spark, monkeypatch):
    data = ("wörter Hausé " * 5000 + "z" * 5000 + " ").encode()
    import numpy as np

    pieces = list(spelling.stretches(np.frombuffer(data, np.uint8), 997))
    assert b"".join(pieces) == data and len(pieces) > 50 and max(map(len, pieces)) < 7000
    assert sum(len(re.findall("[A-Za-zÀ-ÿ]+", p.decode())) for p in pieces) == 10_001
    monkeypatch.setattr(spelling, "STRETCH", 1000)
    rows = [(1, "Größe straße " * 20_000), (2, "grösse strasse " * 400 + "q" * 3000)]
    got = {r["word"]: tuple(r) for r in spelling.variants(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == variants_by_force(rows)


def test_no_variants(spark):
    for rows in ([], [(1, None)], [(1, "few words only here")]):
        assert spelling.variants(spark.createDataFrame(rows, DOCS)).count() == 0


def test_affected_grams_bound_every_edit():
    rng = random.Random(8)
    frequent = {"ab", "ba", "aba", "bab", "^a", "^ab", "abab", "cd"}
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 9)))
        other = edited(rng, word, "abcd")
        if other == word:
            continue
        grams = spelling.decomposed(word, frequent)
        shared = sum((Counter(grams) & Counter(spelling.decomposed(other, frequent))).values())
        assert len(grams) - shared <= spelling.affected(grams) < len(grams)
