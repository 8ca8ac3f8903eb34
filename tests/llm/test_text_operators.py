"""Operators on texts against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from wardmetrics.llm import language, mixing, outliers, pieces, quality_net, queries, secret_scan, sharding, texts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["_key", "_text", "_body", "_row", "size", "score", "spans", "fp", "slot", "kept", "_slot", "_body2", "n_words"]


def docs_of(spark, texts_, source="s", lang="en"):
    data = [(i, t, lang, source, len(t) if t is not None else None) for i, t in enumerate(texts_)]
    return spark.createDataFrame(data, DOCS)


def with_clashes(df):
    return df.withColumns({c: F.lit("clash") for c in EXTRA})


EDGE_TEXTS = [None, "", "   \n\t ", "a", "é", "日本語 テキスト", "word " * 3000, "x" * 300_000, "same text here", "same text here"]


@pytest.fixture(scope="module")
def edge(spark):
    base = docs_of(spark, EDGE_TEXTS)
    odd = spark.createDataFrame([(None, "no key", None, None, None), (8, "same text here", "en", "s", 14)], DOCS)
    return with_clashes(base.unionByName(odd))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- blocks of texts

def test_blocks_hold_whole_rows_and_respect_slices():
    import pyarrow as pa

    column = pa.array(["ab", None, "", "cde", "é" * 5])
    batch = pa.RecordBatch.from_arrays([column, pa.array(range(5))], names=["text", "i"]).slice(1)
    got = [b.text(i).decode() for b in texts.blocks([batch], "text", 4) for i in range(len(b))]
    assert got == ["", "", "cde", "é" * 5]


def test_word_spans_equal_the_pattern():
    import pyarrow as pa

    rng = random.Random(1)
    own = ["".join(rng.choice("ab \n\t\x0b\x1c é") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for block in texts.blocks([pa.RecordBatch.from_arrays([pa.array(own)], names=["text"])], "text", 64):
        starts, ends, first = texts.word_spans(block)
        for i in range(len(block)):
            mine = [block.data[a:b].tobytes().decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
            assert mine == re.findall(r"[^\x20\x09-\x0D]+", block.text(i).decode())


# --- secrets

PATTERNS = {
    "assign": (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 1, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def base_by_force(text):
    found = [(m.start(), i, m.end(), k) for i, (k, (p, g, n)) in enumerate(PATTERNS.items()) for m in p.finditer(text or "") if len(m.group(g)) >= n]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def secret_texts():
    rng = random.Random(5)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abcdef", "x1+/_.=-", "AKIA", "AKIA" + "Z9" * 8, "0123456789abcdef" * 2, "é", "日", "\n", "ab", "🙂"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]


def test_base_secrets_equal_brute_force(spark):
    own = [*secret_texts(), *EDGE_TEXTS, "secret=token:abcdef", "AKIAAKIA" + "B" * 15, "token = 'abc' token=abcdefg"]
    df = docs_of(spark, own)
    got = secret_scan.scan_secrets(df, secret_scan.fit_secrets(df)).select("doc_id", secret_scan.joined(F.col("base")).alias("b"), "n_assign", "n_access", "n_hex").collect()
    for r in got:
        expected = base_by_force(own[r["doc_id"]])
        assert r["b"] == expected
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [expected.count(k + ":") for k in PATTERNS]


def test_markov_adds_random_strings_and_spares_identifiers(spark):
    rng = random.Random(2)
    words = ["configuration", "international", "management", "responsibility", "considerations", "developments", "understanding"]
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(150)]
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24)) for _ in range(150)]
    train = [" ".join(rng.choices(words, k=40)) + f" token={h} password={k}" for h, k in zip(hexes, keys)]
    model = secret_scan.fit_secrets(docs_of(spark, train))
    planted = "q7Zp2KxV9mTb4LwR8sYd"
    own = docs_of(spark, [f"the {planted} there", "configurationmanagement and internationalunderstanding", "token=q7Zp2KxV9mTb4LwR8sYd", "-" * 40 + " " + "=" * 40])
    got = rows(secret_scan.scan_secrets(own, model).select("doc_id", secret_scan.joined(F.col("spans")).alias("s"), secret_scan.redacted(F.col("text"), F.col("spans")).alias("t")))
    assert got == [
        (0, "markov:4:24", "the <secret> there"),
        (1, "", "configurationmanagement and internationalunderstanding"),
        (2, "assign:0:26", "<secret>"),
        (3, "", "-" * 40 + " " + "=" * 40),
    ]


def test_secret_sample_is_of_keys_not_rows(spark):
    """A key of many rows that hashes low takes one place of the sample, not all."""
    words = ["configuration", "international", "management", "responsibility"]
    rng = random.Random(6)
    own = [" ".join(rng.choices(words, k=10)) + " token=" + "".join(rng.choices("abcdef0123456789", k=30)) for _ in range(40)]
    single = docs_of(spark, own)
    first = texts.smallest_ids(single, 1).first()
    expected = secret_scan.fit_secrets(single, sample_rows=10)
    repeated = single.unionByName(spark.createDataFrame([tuple(first)] * 60, DOCS))
    assert secret_scan.fit_secrets(repeated, sample_rows=10) == expected


def test_secret_scan_is_native(spark):
    df = docs_of(spark, ["token=abcdefgh"])
    plan = secret_scan.scan_secrets(df, secret_scan.SecretModel([0.0] * 67 * 67))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secret_scan_edges(spark, edge, empty):
    model = secret_scan.fit_secrets(empty)
    got = secret_scan.scan_secrets(edge, model)
    assert got.count() == 12 and got.filter("size(spans) > 0").count() == 0
    assert got.select("_body", "_key").distinct().collect() == [("clash", "clash")]
    assert secret_scan.scan_secrets(empty, model).count() == 0


# --- pieces

@pytest.fixture(scope="module")
def model():
    pytest.importorskip("public_tokenizers")
    return pieces.model_bytes(queries.piece_model_path())


def piece_texts():
    rng = random.Random(4)
    return ["".join(rng.choice(" ab.\n▁é🙂<s>Ł0 ") for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["", " ", "   a", "▁▁x ▁", "<s> </s> <unk> <0x41>", "a" * 5000, "\u0000x"]


def test_ids_spans_and_decoding_equal_the_library(spark, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    own = piece_texts()
    for r in pieces.encode_texts(docs_of(spark, own), model, ["doc_id"]).collect():
        text = own[r["doc_id"]]
        assert r["ids"] == library.encode(text, add_bos=True, add_eos=True)
        assert r["decoded"] == library.decode(r["ids"])
        body = list(zip(r["begins"], r["ends"]))[1:-1]
        assert not body or (body[0][0] == 0 and body[-1][1] == len(text.encode()))
        assert all(a[1] == b[0] for a, b in zip(body, body[1:]))


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_character_map_equals_the_library(rule):
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as proto

    plain = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False)
    spec = proto.ModelProto()
    spec.ParseFromString(plain.serialized_model_proto())
    own = pieces.CharacterMap(spec.normalizer_spec.precompiled_charsmap)
    for text in ["ﬁ ½ Å ｶﾞ ①  ABC", "㍿ Ⅳ ﷺ", "plain", "", "é́ ǆ"]:
        normal, place = own.apply(text.encode())
        assert normal.decode() == plain.normalize(text)
        assert len(place) == len(normal) + 1 and place[-1] == len(text.encode()) and (np.diff(place) >= 0).all()
    assert own.apply("ﬁx".encode())[1].tolist() == [0, 0, 3, 4]


def test_piece_edges(spark, edge, empty, model):
    got = pieces.encode_texts(edge, model, ["doc_id"], digests=True)
    by_id = {r["doc_id"]: r for r in got.collect()}
    nothing = hashlib.sha256(np.array([1, 2], "<u4").tobytes()).hexdigest()
    assert got.count() == 12 and by_id[0]["ids_sha256"] == by_id[1]["ids_sha256"] == nothing and by_id[0]["n_tokens"] == 2
    assert by_id[8]["ids_sha256"] == by_id[9]["ids_sha256"]
    assert pieces.encode_texts(empty, model, ["doc_id"]).count() == 0


# --- quality and language

def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "runs", "under", "old", "bridges", "and", "people", "walk", "there", "slowly"]) for _ in range(n))


def test_quality_separates_and_answers_to_all(spark, edge, empty):
    rng = random.Random(9)
    own = [prose(rng, rng.randint(20, 200)) if i % 3 else "BUY NOW!!! $$$ " * rng.randint(5, 40) for i in range(600)]
    df = docs_of(spark, own)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    held = texts.remainder(F.col("doc_id"), 5) == 0
    net = quality_net.fit_quality(df, labels.filter(~held))
    got = quality_net.score_quality(df, net, ["doc_id"]).filter(held).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 3 > 0) for r in got]) > 0.95
    assert [r for r in quality_net.score_quality(df, net, ["doc_id"]).orderBy("doc_id").collect()] == quality_net.score_quality(
        df.repartition(5), quality_net.fit_quality(df.repartition(7), labels.filter(~held)), ["doc_id"]).orderBy("doc_id").collect()
    odd = quality_net.score_quality(edge, net, ["doc_id"]).collect()
    assert len(odd) == 12 and all(0 <= r["score"] <= 1 for r in odd)
    assert quality_net.score_quality(empty, net, ["doc_id"]).count() == 0
    none = quality_net.fit_quality(empty, labels.limit(0))
    assert {r["score"] for r in quality_net.score_quality(edge, none, ["doc_id"]).collect()} == {0.5}


def test_language_by_family_then_pair(spark, edge, empty):
    rng = random.Random(3)
    words = {
        "en": "the and with under water people there bridge would which", "de": "der und mit unter wasser leute dort brücke würde welche",
        "fr": "le et avec sous eau gens là pont voudrait lequel", "es": "el y con bajo agua gente allí puente quisiera cual",
    }
    data = [(i, " ".join(rng.choices(words[lang].split(), k=rng.randint(8, 60))), lang, "s", 0) for i, lang in enumerate(list(words) * 80)]
    df = spark.createDataFrame(data, DOCS)
    held = texts.remainder(F.col("doc_id"), 4) == 2
    found = language.fit_languages(df.filter(~held))
    assert found.families == ["germanic", "romance"] and len(found.between) == 1 and all(len(m) == 1 for m in found.within.values())
    got = language.predict_languages(df, found, ["doc_id", "lang"]).filter(held).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    odd = {r["doc_id"]: r for r in language.predict_languages(edge, found, ["doc_id"]).collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and odd[3]["lang_pred"] in words and odd[5]["lang_pred"] in words
    digits = language.predict_languages(docs_of(spark, ["123 _ 456"]), found, ["doc_id"]).first()
    assert (digits["lang_pred"], digits["score"]) == ("und", 0.0)
    assert language.predict_languages(empty, found, ["doc_id"]).count() == 0
    assert language.predict_languages(edge, language.fit_languages(empty), ["doc_id"]).filter("lang_pred <> 'und'").count() == 0


def test_word_vectors_cover_unlabelled_texts(spark):
    import pyarrow as pa

    own = ["plain words here and there"] * 8 + ["zebrawort quaggafern okapimoss"] * 4
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    net = quality_net.fit_quality(docs_of(spark, own), labels)
    batch = pa.RecordBatch.from_arrays([pa.array(["zebrawort quaggafern okapimoss"])], names=["text"])
    buckets = quality_net.token_buckets(next(texts.blocks([batch], "text")))[0]
    assert (np.abs(net.vectors[buckets]).sum(1) > 0).all()


def test_neighbour_sums_by_pieces_equal_brute_force():
    rng = np.random.default_rng(1)
    words, row = rng.integers(0, 50, 203), np.repeat(np.arange(7), 29)
    places, signs = quality_net.index_entries(50, 8)
    expected = np.zeros((50, 8))
    for i in range(len(words)):
        for j in range(max(i - quality_net.WINDOW, 0), min(i + quality_net.WINDOW + 1, len(words))):
            if i != j and row[i] == row[j]:
                np.add.at(expected[words[i]], places[words[j]], signs[words[j]])
    for piece in (1, 2, 3, 64, 1000):
        total = np.zeros(400)
        for at, sign in quality_net.neighbour_sums(words, row, (places, signs), 8, piece):
            np.add.at(total, at, sign)
        assert np.array_equal(total.reshape(50, 8), expected)


# --- quality rules

def counts_by_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force(spark):
    rng = random.Random(8)
    own = [*EDGE_TEXTS, *["".join(rng.choice(["a ", "b ", "cé ", "\n", "a b c d e ", "# ", "\x0b", "|"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]]
    for r in outliers.count_texts(docs_of(spark, own), ["doc_id"]).collect():
        expected = counts_by_force(own[r["doc_id"]])
        assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
        assert r["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])


def test_outliers_go_by_group_and_small_groups_by_their_parents(spark, edge, empty):
    rng = random.Random(6)
    usual = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(rng.randint(80, 140))) for _ in range(160)]
    odd = [" ".join("".join(rng.choice("abcdefgh") for _ in range(40)) + "###" for _ in range(100))]
    df = docs_of(spark, usual + odd).unionByName(spark.createDataFrame([(900, odd[0], "xx", None, 0), (901, usual[0], "xx", None, 0), (902, usual[1], "yy", "alone", 0)], DOCS))
    got = {r["doc_id"]: r for r in outliers.judge_texts(df, ["doc_id"]).collect()}
    assert not got[160]["kept"] and sum(got[i]["kept"] for i in range(160)) >= 158
    assert not got[900]["kept"] and got[901]["kept"] and got[902]["kept"]
    assert all((r["distance"] is None) == r["base_failed"] for r in got.values())
    again = {r["doc_id"]: r for r in outliers.judge_texts(with_clashes(df).repartition(6), ["doc_id"]).collect()}
    assert all(again[k]["distance"] == got[k]["distance"] for k in got)
    assert outliers.judge_texts(edge, ["doc_id"]).count() == 12
    assert outliers.judge_texts(empty, ["doc_id"]).count() == 0


def test_covariance_core_ignores_a_far_cloud(spark):
    rng = np.random.default_rng(1)
    near, far = rng.normal(2, 0.5, (400, 5)), rng.normal(9, 0.1, (80, 5))
    z = np.round(np.concatenate((near, far)) * outliers.GRAIN).astype(int).tolist()
    df = spark.createDataFrame([("g", *r) for r in z], "_g string, _z0 long, _z1 long, _z2 long, _z3 long, _z4 long")
    shape = outliers.group_shapes(df).first()
    assert np.abs(np.array(shape["_mu"]) - 2).max() < 0.1


def shrunk_by_force(sets, shapes):
    """Centre and covariance of a group from those of its levels, finest first."""
    mu, cov = None, np.diag(np.square(outliers.FLOORS))
    for name in reversed(sets):
        n, own, white = shapes[name]
        spread = np.linalg.inv(white)
        mu = own if mu is None else mu
        share = n / (n + outliers.PARENT_ROWS)
        mu, cov = share * own + (1 - share) * mu, share * spread @ spread.T + (1 - share) * cov
    return mu, cov


def test_shapes_are_drawn_to_parents_and_verdicts_follow(spark):
    rng = np.random.default_rng(5)
    rows_, groups = [], {("en", "a"): 300, ("en", "b"): 20, ("de", "a"): 1, ("de", "c"): 120}
    for k, ((lang, source), n) in enumerate(groups.items()):
        rows_ += [(f"{lang}{source}", lang, "all", *z) for z in np.round(rng.normal(2 + k, 0.5 + 0.1 * k, (n, 5)) * outliers.GRAIN).astype(int).tolist()]
    kinds = "_own string, _lang string, _all string, " + ", ".join(f"_z{i} long" for i in range(5))
    df = spark.createDataFrame(rows_, kinds)
    got = {r["_g"]: (np.array(r["_mu"]), np.array(r["_w"]).reshape(5, 5)) for r in outliers.shrunk_shapes(df, ["_own", "_lang", "_all"]).collect()}
    shapes = {}
    for level in ("_own", "_lang", "_all"):
        sizes = dict(rows(df.groupBy(level).count()))
        for r in outliers.group_shapes(df.withColumn("_g", F.col(level))).collect():
            shapes[level, r["_g"]] = (sizes[r["_g"]], np.array(r["_mu"]), np.array(r["_w"]).reshape(5, 5))
    for lang, source in groups:
        mu, cov = shrunk_by_force([("_own", lang + source), ("_lang", lang), ("_all", "all")], shapes)
        assert np.allclose(got[lang + source][0], mu) and np.allclose(np.linalg.inv(got[lang + source][1].T @ got[lang + source][1]), cov)
    # The common path: distances of the query follow from the shapes by the textbook formula.
    point = np.array(rows_[0][3:]) / outliers.GRAIN
    mu, cov = shrunk_by_force([("_own", "ena"), ("_lang", "en"), ("_all", "all")], shapes)
    frame = spark.createDataFrame([(*rows_[0][3:], mu.tolist(), np.linalg.inv(np.linalg.cholesky(cov)).ravel().tolist())], ", ".join(f"_z{i} long" for i in range(5)) + ", _mu array<double>, _w array<double>")
    assert abs(frame.select(outliers._distance().alias("d")).first()["d"] - (point - mu) @ np.linalg.inv(cov) @ (point - mu)) < 1e-6


# --- sharding

def slots_by_force(names, slots):
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    prefer = [[(number(f"{n}|offset") + j * (number(f"{n}|skip") % (slots - 1) + 1)) % slots for j in range(slots)] for n in names]
    taken, turn = {}, 0
    while len(taken) < slots:
        i = turn % len(names)
        taken[next(p for p in prefer[i] if p not in taken)] = i
        turn += 1
    return [taken[s] for s in range(slots)]


def test_table_equals_brute_force_and_is_even():
    names = [f"n{i}" for i in range(7)]
    table = sharding.lookup_table(names, 101)
    assert table == slots_by_force(names, 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 30
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 101)


def test_sharding_edges(spark, edge, empty):
    got = sharding.assign_shards(edge, shards=5, slots=53)
    by_id = got.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).collect()
    assert got.count() == 12 and all(r["n"] == 1 for r in by_id) and got.filter("shard is null").count() == 0
    assert sharding.assign_shards(empty).count() == 0


# --- mixing

def targets_by_force(sizes, weights=(5, 2, 1), most=3):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    w = {n: Fraction(weights[i % len(weights)]) for i, n in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        share = {n: left * w[n] / sum(w[m] for m in open_) for n in open_}
        over = {n for n in open_ if share[n] > most * sizes[n]}
        if not over:
            out.update(share)
            break
        for n in over:
            out[n] = Fraction(most * sizes[n])
            left -= out[n]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_mix_reaches_targets(spark, seed):
    rng = random.Random(seed)
    data = []
    for source, n in [("a", rng.randint(1, 400)), ("b", rng.randint(1, 60)), (None, 50), ("Z", 3), ("empty", 2), ("é", rng.randint(1, 300))]:
        for _ in range(n):
            data.append((len(data), "" if source == "empty" else "w " * rng.randint(0, 80), "en", source, 0))
    df = spark.createDataFrame(data, DOCS)
    got = mixing.mix(df).collect()
    sizes = Counter()
    for _, text, _, source, _ in data:
        sizes[source] += len(text.split())
    expected = targets_by_force(dict(sizes))
    taken = Counter()
    for r in got:
        assert abs(r["target"] - float(expected[r["source"]])) <= 1e-9 * max(1, r["target"]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for source, target in expected.items():
        assert abs(taken[source] - float(target)) <= 3 * 80
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_edges(spark, edge, empty):
    got = mixing.mix(edge)
    assert got.count() == 12 and got.filter("source is null").count() == 1
    assert mixing.mix(empty).count() == 0
    nothing = mixing.mix(docs_of(spark, [None, "", "  "])).collect()
    assert all((r["size"], r["target"], r["copies"]) == (0, 0.0, 0) for r in nothing)


# --- what a task remembers

def test_remembered_segments_are_bounded_by_their_length(model, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(pieces, "REMEMBERED_CHARACTERS", 5_000)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    own, rng, most = pieces.PieceModel(model), random.Random(4), 0
    for _ in range(30):
        texts_ = ["".join(rng.choices("abcdeé漢", k=rng.choice([5, 900]))) + " und dann" for _ in range(4)]
        assert [ids.tolist() for ids in own.ids(texts_)] == library.encode(texts_)
        most = max(most, own.held)
    assert own.held == sum(map(len, own.known)) and most < 5_000 + 4 * 920


# --- secrets of texts full of matches

def test_blocks_of_matches_give_what_one_walk_gives(spark, monkeypatch):
    rng = random.Random(12)
    kinds = ["password=abc123def", "word", "secret: xyz", "AKIA" + "Q7" * 9, "é" * 3, "customer_order_totals", "function_returning_values", "mean_of_all_columns"]
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def noisy():
        parts = []
        for _ in range(rng.randint(0, 120)):
            parts.append(rng.choice([*kinds, f"{rng.getrandbits(128):032x}", f"token='{''.join(rng.choices(signs, k=40))}'", "".join(rng.choices(signs, k=30))]))
        return rng.choice([" ", "", " \n"]).join(parts)

    docs = spark.createDataFrame([(i, noisy()) for i in range(60)] + [(60, None), (61, "")], "doc_id long, text string")
    model = secret_scan.SecretModel([2.0] * (len(secret_scan.ALPHABET) + 1) ** 2)  # every candidate is random enough
    results = []
    for block in (1, 2, 7, 10_000):
        monkeypatch.setattr(secret_scan, "BLOCK", block)
        found = secret_scan.scan_secrets(docs, model)
        clean = found.withColumn("clean", secret_scan.redacted(F.coalesce("text", F.lit("")), F.col("spans")))
        results.append([tuple(r) for r in clean.orderBy("doc_id").select("base", "spans", "clean").collect()])
    assert all(r == results[0] for r in results)
    texts = [r[0] or "" for r in docs.orderBy("doc_id").select("text").collect()]
    some = 0
    for text, (base, spans, clean) in zip(texts, results[0]):
        hexes = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
        assert [(b["s"], b["e"]) for b in base if b["kind"] == "hex"] == hexes
        taken = {(x["s"], x["e"]) for x in base}
        for x in spans:
            if x["kind"] == "markov":
                some += 1
                assert all(x["e"] <= s or e <= x["s"] for s, e in taken)
        expected, at = "", 0
        for x in spans:
            if x["s"] >= at:
                expected += text[at : x["s"]] + secret_scan.PLACEHOLDER
            at = max(at, x["e"])
        assert clean == expected + text[at:]
    assert some > 10


def test_a_text_of_hashes_takes_seconds(spark):
    import time

    rng = random.Random(1)
    text = " ".join(f"{rng.getrandbits(128):032x}" for _ in range(60_000))  # two million characters
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    row = secret_scan.scan_secrets(docs, secret_scan.SecretModel([0.0] * (len(secret_scan.ALPHABET) + 1) ** 2)).select("n_hex", F.size("spans").alias("n")).first()
    assert (row["n_hex"], row["n"]) == (60_000, 60_000) and time.time() - start < 60


def test_long_texts_reach_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.unset(name)  # 64 MB
    try:
        docs = spark.range(1000).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 5000).alias("text"))

        def work(block):
            held = block.rows.column(1).buffers()[2].size
            return {"held": pa.array([held] * len(block), pa.int64())}

        found = texts.per_block(docs, work, "held long", ["doc_id"]).agg(F.max("held"), F.count("*")).first()
        assert found[0] < 10_000_000 and found[1] == 1000
        spark.conf.set(name, "100k")
        texts.in_small_batches(docs)
        assert spark.conf.get(name) == "100k"
    finally:
        spark.conf.set(name, before)
