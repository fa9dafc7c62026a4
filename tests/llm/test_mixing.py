from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trialguard.llm import mixing


def test_apportionment_is_that_of_the_highest_quotients(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for g in range(12):
        n, seats = rng.choice([1, 2, 7, 40]), rng.choice([0, 1, 5, 33, 400])
        weights = {k: rng.choice([0, 1, 3, 10, rng.randint(1, 1000), rng.random()]) for k in range(n)}
        want[g] = brute.sainte_lague(weights, seats)
        rows += [(g, k, float(w), seats) for k, w in weights.items()]
    df = spark.createDataFrame(rows, "g long, k long, w double, seats long")
    got = mixing.apportion(df, ["g", "k"], "w", "seats", "g").collect()
    assert {(r.g, r.k): r.quota for r in got} == {(g, k): q for g, own in want.items() for k, q in own.items()}
    for g in (2, 5, 7):
        got = mixing.apportion(df.where(F.col("g") == g), ["k"], "w", "seats").collect()
        assert {r.k: r.quota for r in got} == want[g]


def _docs(spark, seed=1):
    rng = random.Random(seed)
    rows = [(None, None, "no source", 1), (1, "a", None, 2), (2, "a", "", 3), (3, "zz", " \n", 4), (4, None, "x", 5)]
    for k in range(5, 160):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", "Z", "zz", None, "tiny"])
        n = rng.randint(0, 4) if source == "tiny" else rng.choice([1, 30, 200, 3000 if k % 50 == 0 else 90])
        rows.append((k, source, " ".join(f"w{rng.randint(0, 9)}" for _ in range(n)), k))
    rows += [rows[20], rows[20]]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size long")


def test_tiny_sources_meet_their_targets(spark):
    sizes = {"big": 40_000, "b": 10, "c": 1, "d": 100, "e": 33, "f": 7, "g": 64}
    rows = [(k, s, " ".join(["w"] * n)) for k, (s, n) in enumerate(sizes.items())]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = brute.targets(sizes)
    got = {rows[r.doc_id][1]: r for r in mixing.mixture(df).collect()}
    for source, r in got.items():
        assert abs(r.taken - want[source]) <= 1 and r.taken <= 3 * r.size, source
    assert got["b"].taken == 30 and got["c"].taken == 3
    mixed = mixing.mix(df).collect()
    for source in sizes:
        assert sum(len(r.text.split()) for r in mixed if r.source == source) == got[source].taken


def test_a_very_long_text_is_mixed_whole(spark):
    rows = [(1, "a", "word " * 300_000), (2, "b", "x y z"), (3, "c", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in mixing.mixture(df).collect()}
    assert got[1].size == 300_000 and abs(got[1].taken - got[1].target) <= 1 and (got[2].taken, got[3].taken) == (9, 0)


@pytest.mark.parametrize("shard_words", [500, 1 << 15])
def test_mixture_meets_its_targets(spark, shard_words):
    df = _docs(spark)
    sizes, own = {}, {}
    for r in df.collect():
        n = len(brute.space_words(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        own.setdefault(r.doc_id, []).append((n, r.source))
    want = brute.targets(sizes)
    got = mixing.mixture(df, shard_words=shard_words).collect()
    assert len(got) == df.count() and got[0].asDict().keys() == {"doc_id", "size", "source_size", "target", "taken"}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        size, source = own[r.doc_id][0]
        assert (r.size, r.source_size) == (size, sizes[source]) and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for source, n in taken.items():
        shards = max(1, -(-sizes[source] // shard_words))
        assert abs(n - want[source]) <= mixing.BLOCK_WORDS * (1 + shards) + 0.02 * want[source], source
    again = mixing.mixture(df.repartition(5), shard_words=shard_words).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_returns_the_taken_words(spark):
    df = _docs(spark, 2).dropDuplicates(["doc_id"]).withColumn("n_chars", F.length("text")).withColumn("cut", F.lit("c"))
    plan = {r.doc_id: r for r in mixing.mixture(df).collect()}
    rows = mixing.mix(df).collect()
    assert list(rows[0].asDict()) == df.columns
    texts = {r.doc_id: r.text for r in df.collect()}
    words = {}
    for r in rows:
        words.setdefault(r.doc_id, []).extend(brute.space_words(r.text))
        assert r.n_chars == len(r.text) and (r.text == texts[r.doc_id] or set(r.text.split()) <= set(texts[r.doc_id].split()))
    assert {k: len(w) for k, w in words.items()} == {k: r.taken for k, r in plan.items() if r.taken}


def test_empty_and_wordless_tables(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixture(df).collect() == [] and mixing.mix(df).collect() == []
    df = spark.createDataFrame([(1, None, None), (2, "a", " ")], df.schema)
    assert sorted((r.doc_id, r.taken, r.target) for r in mixing.mixture(df).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
    assert mixing.mix(df).collect() == []
