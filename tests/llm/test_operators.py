"""Each operator against a plain version, and on awkward, repeated and empty input."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from hard_rows import HARD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitfeat.llm import common, langid, licenses, mixing, neardup, packing, pieces, quality, queries, rules, sharding, topk, urls

SF = "/root/testdata/sf0.01"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


# 1 packing

def check_packing(pieces, rows, capacity=4096):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = Counter()
    for d, text in rows:
        ids[d, tuple(t.encode(text or "", add_special_tokens=False).ids) + (2,)] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for (d, x), n in ids.items():
        raw = np.array(x, "<u4").tobytes()
        own = [p for p in by_doc[d] if p["doc_tokens"] == len(x) and p["ids_crc32"] == zlib.crc32(raw[4 * p["start"]:4 * (p["start"] + p["length"])])]
        spans = Counter((p["start"], p["length"]) for p in own)
        assert set(spans.values()) == {n}
        at = 0
        for s, length in sorted(spans):
            assert s == at
            at += length
        assert at == len(x)
    assert len(pieces) == sum(n * len(packing.cuts(len(x), capacity, 1024)) for (_, x), n in ids.items())
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= capacity


def test_packing_hard(hard, empty):
    check_packing(packing.pack(hard).collect(), [(r[0], r[1]) for r in HARD])
    assert packing.pack(empty).count() == 0


def test_packing_documents(docs):
    pieces = packing.pack(docs).collect()
    check_packing(pieces, list(texts(docs).items()))
    total = sum(p["length"] for p in pieces)
    parts = len({p["sequence_id"] >> 40 for p in pieces})
    assert len({p["sequence_id"] for p in pieces}) <= total / 4096 * 1.02 + parts


def test_differencing_balances():
    r = np.random.default_rng(0)
    sizes = r.integers(1, 1025, 900).tolist()
    parts = packing.differencing(sizes, 120)
    assert sorted(i for p in parts for i in p) == list(range(900))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) < 40
    assert packing.differencing([5, 4, 3, 3, 3], 2) and sorted(sum([5, 4, 3, 3, 3][i] for i in p) for p in packing.differencing([5, 4, 3, 3, 3], 2)) == [8, 10]
    tight = packing.windows([3000, 3000, 3000], 4096)  # two windows would do by size alone, none fits
    assert len(tight) == 3 and packing.windows([], 4096) == []


def test_word_cache_starts_anew(monkeypatch):
    e = pieces.LowerWords("word_bpe_49k.json")
    monkeypatch.setattr(pieces, "HELD", 60)
    resets = 0
    for t in ("alpha beta gamma delta", "epsilon " + "z" * 50, "alpha it's 42!?", "", "Ünï GAMMA\n\tß ²", "<|endoftext|> x", "日本 語"):
        for text in (t, t + " " + "many Words here " * 9):
            met = len(e.numbers)
            assert [x.tolist() for x in e([text, text])] == [e.exact(text)] * 2
            resets += len(e.numbers) < met
    assert resets


# 2 quality

def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.score(docs, quality.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in got]
    clean = [r["predicted"] for r in got if r["quality"] == 1]
    assert len(got) > 100 and np.mean(right) > 0.97 and np.mean(clean) > 0.98
    for r in got:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1


def test_quality_hard(spark, hard, empty, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(docs, labels)
    got = quality.score(hard, model).collect()
    assert len(got) == len(HARD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality.score(empty, model).count() == 0
    none = quality.learn(hard, labels.limit(0))
    assert {r["score"] for r in quality.score(hard, none).collect()} == {0.5}
    kept = quality.keep_good(hard, none)
    assert kept.schema == hard.schema and kept.count() == len(HARD)
    assert quality.learn(docs, labels.where("quality = 1")).constant == 1.0
    odd = spark.createDataFrame([(None, 1), (5, None), (5, 0), (5, 1), (6, 7)], "doc_id long, quality int")
    assert quality.learn(hard, odd).constant is not None


def test_quality_same_at_every_run_and_segment(spark, docs, monkeypatch):
    rows = [r["text"] for r in docs.orderBy("doc_id").limit(80).collect()]
    y = np.arange(80) % 2 * 1.0
    a, b = (quality.fit(rows, y, np.ones(80), epochs=2) for _ in range(2))
    assert all((a.p[k] == b.p[k]).all() for k in a.p)
    whole = a.score(rows)
    one = np.array([a.score([t])[0] for t in rows])
    assert np.allclose(whole, one)


def test_quality_gradient():
    """The fit's loss falls to near zero on separable bags: one odd passage decides."""
    good, bad = "plain words stand here " * 30, "*** ### $$$ %%% " * 20
    rows = [good + good, good + bad] * 40
    m = quality.fit(rows, np.array([1.0, 0.0] * 40), np.ones(80), epochs=30)
    p = m.score(rows[:2])
    assert p[0] > 0.95 and p[1] < 0.05


def doubled(df):
    return df.union(df).union(df.limit(1).crossJoin(df.sparkSession.range(3000)).select(*df.columns))


def test_repeated_rows_learn_the_same_models(spark, docs):
    """Samples hold one row per id: neither doubled tables nor one id given 3000 times change a fit."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a, b = quality.learn(docs, labels), quality.learn(doubled(docs), doubled(labels))
    assert all((a.p[k] == b.p[k]).all() for k in a.p) and (a.mean == b.mean).all()
    a, b = langid.learn(docs), langid.learn(doubled(docs))
    assert a.langs == b.langs == ["de", "en", "es", "fr"] and (a.weights == b.weights).all() and (a.transition == b.transition).all()


def test_scoring_limits_inputs_as_the_fit():
    x = np.array([[100.0, -100.0, 0.5]])
    assert quality.standard(x, np.zeros(3), np.ones(3)).tolist() == [[8, -8, 0.5]]


# 3 near duplicates

def test_neardup_documents(docs):
    want = brute.components(texts(docs).items())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.groups(docs, 4).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_neardup_hard(hard, empty):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.groups(hard, 4).collect())
    n = {r[0]: len(brute.shingles(r[1], 4)) for r in HARD}
    comp = {6: 5}
    want = Counter((r[0], n[r[0]], None if r[0] is None else comp.get(r[0], r[0]), r[0] not in comp) for r in HARD)
    assert got == want
    assert neardup.groups(empty, 4).count() == 0
    left = neardup.deduplicate(hard, 4)
    assert left.schema == hard.schema
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(d for d in {r[0] for r in HARD} if d != 6)


def test_neardup_chains_and_crowds(spark):
    """Chains (neighbours link, ends do not), a crowd around a shared passage, and more members than a block."""
    r = np.random.default_rng(4)
    word = lambda: "w%d" % r.integers(10 ** 9)
    rows, chain = [], [word() for _ in range(80)]
    for i in range(30):
        rows.append((1000 - i, " ".join(chain)))
        chain = chain[2:] + [word(), word()]
    passage = [word() for _ in range(60)]
    for i in range(40):  # similarity about 0.6 to 0.8 to each other
        rows.append((2000 + i, " ".join(passage + [word() for _ in range(8 + i % 8)])))
    base = [word() for _ in range(70)]
    for i in range(600):  # near copies of one text
        w = list(base)
        for j in r.integers(0, 70, 2):
            w[j] = word()
        rows.append((3000 + i, " ".join(w)))
    rows += [(9000 + i, " ".join(word() for _ in range(40))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in neardup.groups(df, 4).collect()}
    assert got == brute.components(rows)


def test_neardup_repeated_id(spark):
    """A group's smallest id under two near-duplicate texts keeps one of them; unlike texts of one id both stay."""
    a = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(a)), (1, " ".join([*a[:-1], "z"])), (1, " ".join(a)), (2, " ".join(a)), (4, "one"), (4, "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(r["doc_id"] for r in neardup.deduplicate(df).collect())
    assert want == {1: 1, 4: 2}
    other = spark.createDataFrame([*rows, (1, " ".join(f"v{i}" for i in range(200)))], "doc_id long, text string")
    kept = [r["text"].split()[0] for r in neardup.deduplicate(other).where("doc_id = 1").collect()]
    assert sorted(kept) == ["v0", "w0"]


def test_odd_sketch_estimates():
    h = neardup.Hashes()
    r = np.random.default_rng(1)
    for j in (0.95, 0.9, 0.8):
        errors = []
        for _ in range(30):
            n = 400
            both = int(round(2 * n * j / (1 + j)))
            x = r.integers(0, 2 ** 63, 2 * n - both, dtype=np.uint64)
            a, b = h.sketch(h.samples(x[:n])), h.sketch(h.samples(x[n - both:]))
            z = int(neardup._differing(a[None], b[None])[0, 0])
            errors.append(1 + h.bits / (4 * len(h.a)) * np.log(1 - 2 * z / h.bits) - j)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


# 4 top-k

def brute_top_k(rows, k=5):
    v = {i: [int(np.floor(256 * float(x))) for x in e] for i, e in rows
         if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    out = set()
    for q in v:
        if q % 50 == 0:
            s = sorted(((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q))[:k]
            out |= {(q, r + 1, c, -x) for r, (x, c) in enumerate(s)}
    return out


def test_topk_blocks(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = topk.integer_vectors(e, "vec_id", "embedding")
    got = topk.top_k(rows.where("vec_id % 50 = 0"), rows, 5, block_rows=37, query_rows=3)
    want = brute_top_k([(r["vec_id"], r["embedding"]) for r in e.collect()])
    assert {tuple(r) for r in got.collect()} == want


def test_topk_hard(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (6, [1.0, 0.0]),
            (7, None), (None, [1.0, 1.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, []), (100, []), (12, [0.3]),
            (13, [-0.001, 5.0, 2.0]), (1, [1.0, 0.0]), (150, [1.0e18, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = {tuple(r) for r in topk.search(df).collect()}
    want = {(q, r, c, max(-2 ** 63, min(2 ** 63 - 1, s))) for q, r, c, s in brute_top_k(rows)}
    assert got == want
    assert topk.search(df.limit(0)).count() == 0
    assert topk.search(df.where("vec_id = 0")).count() == 0


# 5 sharding

def check_shards(got, rows):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, brute.crc(t)) for d, t in rows)
    by = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < 40 and r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    keys = defaultdict(set)
    for r in got:
        keys[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(len(s) == 1 for s in keys.values())


def test_sharding(docs, hard, empty, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 4)
    check_shards(sharding.shard_documents(hard).collect(), [(r[0], r[1]) for r in HARD])
    got = sharding.shard_documents(docs).collect()
    check_shards(got, list(texts(docs).items()))
    moved = sum(r["grown_shard"] == 40 for r in got)
    assert 5 <= moved <= 60
    assert sharding.shard_documents(empty).count() == 0


def plain_score(key, shard, weight=1.0):
    text = f"17|{shard}|" + ("\0null" if key is None else str(key))
    u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
    return -weight / math.log(u)


def test_sharding_against_plain_scores(spark, docs, hard):
    for df in (docs, hard):
        for r in sharding.shard_documents(df).collect():
            scores = [plain_score(r["doc_id"], i) for i in range(41)]
            assert r["shard"] == max(range(40), key=lambda i: (scores[i], -i))
            assert r["grown_shard"] == max(range(41), key=lambda i: (scores[i], -i))


def test_sharding_spreads_equal_rows(spark, monkeypatch):
    """Equal rows that hold most of the table are ranked in many groups and written in chunks."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 500)
    monkeypatch.setattr(sharding, "CHUNK", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # show the groups' own tasks
    df = spark.range(30_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("doc_id"), F.lit("").alias("text"))
    got = sharding.shard_documents(df, 4)
    rows = got.collect()
    assert len(rows) == 30_000 and len({(r["shard"], r["slot"]) for r in rows}) == 30_000
    for s in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    counted = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("doc_id").isNull()).alias("n"), F.max("slot")).collect()  # slots keep the groups' shuffle in the plan
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["n"] > 0 for r in counted) >= 4 and max(r["n"] for r in counted) < 15_000


def test_sharding_weights(spark):
    rows = spark.range(20_000).withColumn("s", sharding.rendezvous(F.col("id"), 3, [1, 2, 5]))
    n = {r["s"]: r["count"] for r in rows.groupBy("s").count().collect()}
    assert all(abs(n[i] / 20_000 - w / 8) < 0.015 for i, w in enumerate((1, 2, 5)))
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), 2, [1, 0])


def test_write_shards(spark, hard, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(hard.drop("shard"), path, "doc_id", 4, files=2)
    assert spark.read.parquet(path).count() == len(HARD)


# 6 mixing

def test_mixing(docs, hard, empty):
    for df in (docs, hard):
        rows = df.select("doc_id", "source", "text").collect()
        sizes = defaultdict(int)
        for r in rows:
            sizes[r["source"]] += len(brute.words(r["text"]))
        want = brute.mix_targets(dict(sizes))
        source = {(r["doc_id"], len(brute.words(r["text"]))): r["source"] for r in rows}
        got = mixing.mix_report(df).collect()
        assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], len(brute.words(r["text"]))) for r in rows)
        taken = Counter()
        for r in got:
            s = source[r["doc_id"], r["size"]]
            assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
            assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
            taken[s] += r["taken"]
        if df is docs:
            assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.05)
        again = mixing.mix_report(df.repartition(3)).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, got))
        out = mixing.emit(df)
        assert out.schema == df.schema
        assert sum(len(brute.words(r["text"])) for r in out.collect()) == sum(taken.values())
    assert mixing.mix_report(empty).count() == 0


# 7 rules

def test_rules_base(docs, hard, empty):
    for df in (docs, hard):
        want = Counter((r["doc_id"], *brute.base_statistics(r["text"])) for r in df.select("doc_id", "text").collect())
        got = rules.judge(df).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
            assert not (r["kept"] and r["base_failed"])
    assert rules.judge(empty).count() == 0


def test_rules_repeats(spark):
    r = np.random.default_rng(2)
    rows = [(i, " ".join("abc"[x] for x in r.integers(0, 2 + i % 2, int(r.integers(0, 60))))) for i in range(200)]
    rows += [(300, "a b c d e f g h " * 5), (301, "a " * 8), (302, "a " * 9), (303, "a b c d e f g h i a b c d e f g h")]
    df = spark.createDataFrame([(d, t, "l", "s") for d, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in rules.with_base(df).collect()}
    assert got == {d: brute.base_statistics(t)[4] for d, t in rows}


def test_rules_distance(spark):
    """The estimate against numpy, on one group; planted outliers go, the rest stays."""
    r = np.random.default_rng(8)
    word = lambda: "".join(chr(97 + x) for x in r.integers(0, 26, int(r.integers(2, 9))))
    rows = [(i, " ".join(word() for _ in range(int(r.integers(60, 400)))), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(word() + "***%%%" for _ in range(200)), "en", "s") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x["doc_id"]: x for x in rules.judge(df).collect()}
    base = rules.with_base(df)
    for x, c in zip(rules.X, rules._transformed(), strict=True):
        base = base.withColumn(x, c)
    base = base.orderBy("doc_id").collect()
    want, _ = brute.mcd(np.array([[b[x] for x in rules.X] for b in base]), rules.FLOORS)
    assert np.allclose([got[b["doc_id"]]["distance"] for b in base], want, rtol=1e-6, atol=1e-9)
    assert all(got[d]["kept"] == (d < 1000) for d in got)


def test_rules_least_determinant_of_all_subsets(spark):
    """Small groups: the estimate's determinant against that of every subset of three quarters of the rows."""
    from itertools import combinations
    r = np.random.default_rng(12)
    groups, ridge = {}, np.diag(np.square(rules.FLOORS))
    for k in range(6):
        mix = r.normal(size=(5, 5)) * (0.3 + k)
        x = r.normal(size=(12, 5)) @ mix
        x[:2 if k % 2 else 3] += r.normal(size=5) * 40  # some rows far off, in one direction
        groups[f"g{k}"] = x
    rows = spark.createDataFrame([(g, *map(float, v)) for g, x in groups.items() for v in x], "g string, " + ", ".join(f"{c} double" for c in rules.X))
    got = {x["g"]: x["det"] for x in rules.estimates(rows).collect()}
    exact = {g: min(np.linalg.det(np.cov(x[list(c)].T, bias=True) + ridge) for c in combinations(range(12), 9)) for g, x in groups.items()}
    assert all(got[g] == pytest.approx(brute.mcd(x, rules.FLOORS)[1], rel=1e-6) for g, x in groups.items())
    assert all(got[g] >= exact[g] * (1 - 1e-9) for g in groups)
    assert sum(got[g] <= exact[g] * 1.0001 for g in groups) >= 4 and max(got[g] / exact[g] for g in groups) < 3
    one_step = {x["g"]: x["det"] for x in rules.estimates(rows, steps=1).collect()}
    assert all(got[g] <= one_step[g] * (1 + 1e-9) for g in groups)


def test_rules_repeats_reject_alone(spark):
    """29 percent of repeated words, under the base rule's limit, among texts without any."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(100 + i % 7)), "l", "s") for i in range(1000, 1300)]
    again = [f"w1000x{j}" for j in range(29)]
    half = again[:14]  # 28 of 97 words
    rows.append((1, " ".join(half + [f"w1001x{j}" for j in range(69)] + half), "l", "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in rules.judge(df).collect()}
    assert (got[1]["n_repeat_words"], got[1]["n_words"], got[1]["base_failed"], got[1]["kept"]) == (28, 97, False, False)
    assert all(r["kept"] for d, r in got.items() if d != 1)


def test_rules_labels(spark, docs):
    """Good documents stay, most bad ones go."""
    got = rules.judge(docs).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in got if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.995 and np.mean(bad) < 0.2


# 8 licenses

def test_licenses_base(docs, hard, empty):
    for df in (docs, hard):
        want = Counter((r["doc_id"], *brute.base_licenses(r["text"])) for r in df.select("doc_id", "text").collect())
        got = licenses.scan_licenses(df).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
        for r in got:
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert licenses.scan_licenses(empty).count() == 0


def test_licenses_fuzzy():
    scan = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    r = np.random.default_rng(3)
    filler = "lorem ipsum dolor sit amet consectetur".split()
    for notice, label, k in licenses.NOTICES:
        for edits in range(k):
            t = list(notice)
            for at in sorted(r.choice(len(t) - 2, edits, replace=False) + 1, reverse=True):
                t[at] = "q"
            text = " ".join(filler) + "\n" + "".join(t).upper() + ". " + " ".join(filler)
            found = scan(text)[-1]
            assert any(m["edits"] <= edits for m in found), (notice, edits, found)
            if not edits:
                assert found == [{"label": label, "start": 6, "end": 5 + len(notice.split()), "edits": 0}]
    two = scan("Released under the MIT Licence; released under the MIT License")[-1]
    assert [(m["start"], m["end"], m["edits"]) for m in two] == [(0, 4, 1), (5, 9, 0)]
    assert scan("nothing here")[-3:-1] == ("", 0.0) and scan(None)[0] == 0


def test_licenses_of_other_names_and_versions():
    scan = licenses.Scanner((), licenses.NOTICES)
    for text in ("released under the BSD license", "licensed under CC BY-ND 4.0", "licensed under CC BY 3.0", "licensed under CC BY-NC-ND 4.0",
                 "licensed under the Apache License, Version 1.1", "licensed under the GNU General Public License version 1",
                 "this source code form is subject to the terms of the mozilla public license v. 1.1"):
        assert scan(f"file one {text} see there")[-1] == [], text
    for text, label in (("relaesed under the MIT licence", "mit"), ("licensed under the apache license version 2", "apache-2.0"),
                        ("licenced under CC BY-SA 4.0", "cc-by-sa-4.0"), ("licensed under the GNU Generel Public License, version 3.", "gpl-3.0")):
        assert [m["label"] for m in scan(f"file one {text}")[-1]] == [label], text


def test_license_seeds_miss_nothing():
    """Seeded search finds what a scan of the whole line by the same pattern finds."""
    scan = licenses.Scanner((), licenses.NOTICES[:3])
    r = np.random.default_rng(5)
    for _ in range(60):
        notice, _, k = licenses.NOTICES[int(r.integers(3))]
        t = list(notice)
        for _ in range(int(r.integers(0, k + 1))):
            at, what = int(r.integers(len(t))), int(r.integers(3))
            if what == 0:
                del t[at]
            else:
                t[at:at + (what == 1)] = ["z"]
        line = " a b " + "".join(t) + " c d "
        assert bool(scan.fuzzy(line)) == any(p.search(line) for *_, p in scan.notices)


# 9 URLs

def test_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = urls.judge(pages).collect()
    want = {r["page_id"]: brute.host_path(r["url"]) for r in pages.collect()}
    assert len(got) == pages.count()
    for r in got:
        assert (r["host"], r["path"]) == want[r["page_id"]]
        rule, verdict = brute.url_rule(r["host"], r["path"])
        assert r["rule"] == rule and (rule is None or r["verdict"] == verdict) and r["verdict"] in ("allow", "block")


def test_urls_mined_rules_against_brute_force(spark):
    """Confidence and support of every rule, and verdicts of undecided pages, by counting."""
    r = np.random.default_rng(6)
    rows = []
    for i in range(600):
        top, lang, host = r.choice(["com", "net", "org"]), r.choice(["en", "es", "fr"]), r.choice(["a", "b", "bad"])
        rows.append((i, f"http://{host}.example.{'net' if host == 'bad' and i % 20 else top}/{'es' if host == 'bad' and i % 20 else lang}/{i}?x={i}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    host, path = urls.host_and_path(F.col("url"))
    items = pages.select("page_id", "url", urls.tokens(F.col("url"), host, path).alias("tokens"), urls.list_rule(host, path, urls.RULES, 0).alias("verdict"))
    baskets = [(set(x["tokens"]), x["verdict"]) for x in items.collect()]
    mined = urls.mine(items, 0.01, 0.9).collect()
    assert mined
    for x in mined:
        has = [v for t, v in baskets if t >= set(x["antecedent"])]
        agree = sum(v == x["verdict"] for v in has)
        assert x["confidence"] == pytest.approx(agree / len(has)) and agree / len(has) >= 0.9 and agree >= 0.01 * 600 and x["token"] in x["antecedent"]
    for x, (t, v) in zip(urls.judge(pages, support=0.01).orderBy("page_id").collect(), baskets, strict=True):
        if v is None:
            fit = max(((m["confidence"], m["verdict"] == "allow", m["verdict"]) for m in mined if t >= set(m["antecedent"])), default=(0, 0, "allow"))
            assert x["verdict"] == fit[2]


def test_urls_rules_decide_open_pages(spark):
    """What the judged pages show beyond the list decides open ones, however many they are; the list's own tokens don't."""
    rows = [f"http://a.{'net' if bad else 'com'}/{lang}/{'spam' if bad else 'ham'}/{i}" for i in range(40) for bad, lang in ((True, "es"), (False, "de"))]
    rows += [f"http://a.org/x/{w}/{i}" for i in range(200) for w in ("spam", "ham", "other")] + [f"http://a.net/pt/other/{i}" for i in range(9)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = Counter((r["host"].split(".")[1], r["path"].split("/")[2], r["verdict"], r["confidence"]) for r in urls.judge(df).where("rule is null").collect())
    assert got == {("org", "spam", "block", 1.0): 200, ("org", "ham", "allow", 1.0): 200, ("org", "other", "allow", None): 200, ("net", "other", "allow", None): 9}


def test_urls_deep_segments(spark):
    """URLs told apart by their fifth or seventh path segment only."""
    urls_of = lambda host, i, deep: f"http://{host}/{dict(net='es', com='b', org='q')[host[2:]]}/c/d/e/{deep}/{i}"
    rows = [urls_of(h, i, f"{w}/x" if i % 2 else f"x/y/{w}") for i in range(40) for h, w in (("a.net", "spam"), ("a.com", "ham"))]
    rows += [urls_of("a.org", i, d) for i in range(5) for d in ("spam/y", "x/y/spam", "ham/y", "x/y/ham")]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = urls.judge(df, support=0.1).where("rule is null").collect()
    assert len(got) == 20 and all(r["verdict"] == ("block" if "spam" in r["path"] else "allow") and r["confidence"] == 1 for r in got)


def test_urls_equal_baskets_are_one_item(spark):
    """Pages that share a path of 40 segments cost what short ones do; any member stands for the item."""
    deep = "/".join(f"s{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(40))
    rows = [f"http://h.net/es/{deep}/{i}" for i in range(5)] + [f"http://g.com/p{chr(97 + i % 26)}{chr(97 + i // 26)}/ok" for i in range(200)]
    rows += ["http://k.org/q/w/e/r/sx/y", "http://k.org/q/w/e/r/zz/y"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    host, path = urls.host_and_path(F.col("url"))
    items = df.select("url", urls.tokens(F.col("url"), host, path).alias("tokens"), urls.list_rule(host, path, urls.RULES, 0).alias("verdict"))
    rules = urls.mine(items.where("verdict is not null"), named=urls.named_tokens(urls.RULES)).collect()
    assert 0 < len(rules) < 5000 and max(len(m) for r in rules for m in r["members"]) >= 39
    got = {r["page_id"]: (r["verdict"], r["confidence"]) for r in urls.judge(df).collect()}
    assert got[205] == ("block", 1.0) and got[206] == ("allow", None)


def test_urls_hard(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "://"), (5, "HTTP://WWW.Example.COM/en/x?y#z"), (6, "a://b://c.com/"), (7, "http://com/"),
            (8, "http://com"), (9, "http://x.net/es"), (10, "http://x.net/es/"), (10, "http://x.net/es/"), (11, "http://xnet/es/"),
            (12, "http://h.com\n/en/?q"), (None, "http://é.com/ü?#"), (13, "http://x?://y.com/"), (14, "http://.../"), (15, "x" * 50_000)]
    df = spark.createDataFrame([(i, u, "a") for i, u in rows], "page_id long, url string, verdict string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in urls.judge(df).collect())
    assert got == Counter((i, *brute.host_path(u), brute.url_rule(*brute.host_path(u))[0]) for i, u in rows)
    assert urls.judge(df.limit(0)).count() == 0


# 10 language

def test_langid_held_out(docs):
    got = langid.predict(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in got)


def test_langid_hard(docs, hard, empty):
    model = langid.learn(docs)
    got = langid.predict(hard, model).collect()
    lang = lambda t: any(c.isalpha() for c in t or "")
    assert Counter((r["doc_id"], r["lang_pred"] == "und") for r in got) == Counter((r[0], not lang(r[1])) for r in HARD)
    assert langid.predict(empty, model).count() == 0
    nothing = langid.learn(empty)
    assert {r["lang_pred"] for r in langid.predict(hard, nothing).collect()} == {"und"}
    kept = langid.keep_identified(hard, model)
    assert kept.schema == hard.schema and all(lang(r["text"]) for r in kept.collect())


def test_marginals_against_enumeration():
    r = np.random.default_rng(9)
    from itertools import product
    k, lengths = 3, np.array([1, 5, 4])
    e, t = r.normal(size=(10, k)), r.normal(size=(k, k))
    m, at = langid.marginals(e, lengths, t), 0
    for n in lengths:
        want = np.zeros((n, k))
        for path in product(range(k), repeat=int(n)):
            w = np.exp(t).sum(axis=0)[path[0]] * np.exp(sum(e[at + i, s] for i, s in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
            for i, s in enumerate(path):
                want[i, s] += w
        assert np.allclose(m[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_marginals_blocks(monkeypatch):
    r = np.random.default_rng(10)
    lengths = np.array([1, 31, 32, 33, 200])
    e, t = r.normal(size=(lengths.sum(), 4)), r.normal(size=(4, 4))
    blocks = langid.marginals(e, lengths, t)
    monkeypatch.setattr(langid, "BLOCK", 256)
    assert np.allclose(blocks, langid.marginals(e, lengths, t))


def test_langid_code_switched(docs):
    model = langid.learn(docs)
    by = {x: docs.where(F.col("lang") == x).where("n_chars between 400 and 900").orderBy("doc_id").first()["text"] for x in ("en", "de")}
    first, second = langid.split(by["en"])[:40], langid.split(by["de"])[:40]
    (_, score, spans), = model.label([" ".join(first + second)], spans=True)
    tags = [s["lang"] for s in spans for _ in range(s["first"], s["last"] + 1)]
    assert len(tags) == 80 and np.mean(np.array(tags) == np.array(["en"] * 40 + ["de"] * 40)) > 0.9 and score < 0.7


def test_langid_reads_whole_runs(docs):
    """A long run's every letter is read, and it weighs by its letters."""
    for n in (24, 25, 48, 49, 1000):
        run = "".join(chr(97 + i * i % 26) for i in range(n))
        parts = langid.split(run)
        assert "".join(p.split(langid.AFTER)[-1].split(langid.BEFORE)[0] for p in parts) == run and len(parts) == -(-n // 24)
    sets = [set(langid.word_features(langid.split("a" * 40 + w + "b" * 40), {}).ravel()) for w in ("kdz", "vux")]
    assert sets[0] != sets[1]
    model = langid.learn(docs)
    by = {x: langid.split(docs.where(F.col("lang") == x).where("n_chars between 400 and 900").orderBy("doc_id").first()["text"]) for x in ("en", "de")}
    (lang, score), = model.label([" ".join(by["en"][:10]) + " " + "".join(by["de"] * 3) + " " + " ".join(by["en"][:10])])
    assert lang == "de" and score > 0.5


def test_langid_keeps_known_languages_only(spark, docs):
    """Other languages and scripts and chance letters go; all documents of known ones and mixtures of them stay."""
    r = np.random.default_rng(3)
    chance = lambda letters: " ".join("".join(r.choice(list(letters), int(r.integers(2, 9)))) for _ in range(80))
    foreign = [chance("abcdefghijklmnopqrstuvwxyz"), chance("абвгдежзиклмн"), "所有的孩子每天都去上学因为他们想学习" * 3,
               "kaikki lapset käyvät koulussa joka päivä koska he haluavat oppia ja kehittää kiinnostuksen kohteitaan eri aloilla",
               "wszystkie dzieci chodzą codziennie do szkoły ponieważ chcą się uczyć i rozwijać swoje zainteresowania", "123 ---", "", None]
    known = [x["text"] for x in docs.where("lang is not null and n_chars > 300").orderBy("doc_id").limit(40).collect()]
    mixed = [" ".join(a.split()[:40] + b.split()[:40]) for a, b in zip(known[:20], known[20:])]
    rows = list(enumerate(foreign + known + mixed))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {x["doc_id"] for x in langid.keep_identified(frame, langid.learn(docs)).collect()}
    assert kept == set(range(len(foreign), len(rows)))


# registered queries

def test_queries_cover_every_row(spark):
    for name, table in (("op1_packing", "documents"), ("op8_licenses", "documents"), ("op9_urls", "pages")):
        got = queries.QUERIES[name](spark, SF)
        key = "page_id" if table == "pages" else "doc_id"
        assert got.select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count()


def test_langid_sample_is_the_first_of_each_language(spark):
    rows = [(i % 700, ["en", "de"][i % 700 % 9 == 0]) for i in range(1400)] + [(9999, "fr")]
    known = spark.createDataFrame(rows, "doc_id long, lang string")
    got = {tuple(r) for r in langid.sample(known, 20).collect()}
    ranked = known.distinct().selectExpr("doc_id", "lang", "xxhash64(doc_id, 3) AS h").collect()
    want = {(r["doc_id"], r["lang"]) for lang in ("en", "de", "fr")
            for r in sorted((r for r in ranked if r["lang"] == lang), key=lambda r: (r["h"], r["doc_id"]))[:20]}
    assert got == want and len(got) == 41


def test_worker_tables_hold_one_operator():
    made = []
    def make(x):
        return lambda: made.append(x) or x
    assert [common.worker_tables(k, make(k)) for k in ("a", "a", "b", "a")] == ["a", "a", "b", "a"]
    assert made == ["a", "b", "a"] and list(common._TABLES) == ["a"]
    common._TABLES.clear()
