from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trialguard.llm import maxent_lm as m


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(9)
    after = {"a": "bcd", "b": "ef", "c": "gh", "d": "ij"}
    out = [(0, None), (1, ""), (2, " \n"), (None, "A b\x0bC"), (3, "word " * 30_000), (4, "É é"), (4, "É é")]
    for i in range(10, 500):
        words = []
        for _ in range(rng.randint(1, 60)):
            first = rng.choice("abcd")
            words += [first, rng.choice(after[first])]
            if rng.random() < 0.1:
                words.append("r" + str(rng.randint(0, 400)))
        out.append((i, " ".join(words).title()))
    return out


def _want(docs):
    counts, rows = Counter(), []
    for i, t in docs:
        out = zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        words = [*brute.space_words(brute.lower_ascii(t or "")), "\n"]
        rows.append((out, words))
        if not out:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return [
        (out, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        for out, w in rows
    ]


@pytest.mark.parametrize("head", [m.HEAD, 60])
def test_base_is_exact_and_the_model_beats_it_on_held_out_text(spark, docs, head):
    df = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double")
    got = sorted(m.score(df, head=head).collect(), key=str)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted(([r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score] for r in got), key=key)
    want = sorted(([i, *w] for (i, _), w in zip(docs, _want(docs), strict=True)), key=key)
    assert [r[:5] for r in got] == [w[:5] for w in want]
    assert [r[5] for r in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    out = [r for r in got if r[1] and r[2] > 3]
    assert sum(r[6] for r in out) > sum(r[5] for r in out) + 0.05 * sum(r[2] for r in out)
    assert all(r[6] <= 0 and math.isfinite(r[6]) for r in got)


def test_scores_do_not_depend_on_how_the_rows_lie(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one = df.coalesce(1)
    many = df.orderBy(F.xxhash64("text", "doc_id")).repartition(13)
    small = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    key = lambda r: (r[0] is None, *(r[0] or 0, *r[1:]))
    first = sorted((tuple(r) for r in m.score(one, cell_tokens=2_000).collect()), key=key)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        second = sorted((tuple(r) for r in m.score(many, cell_tokens=2_000).collect()), key=key)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)
    assert [r[:5] for r in first] == [r[:5] for r in second]
    for at in (5, 6):
        assert [r[at] for r in first] == pytest.approx([r[at] for r in second], rel=1e-6)


def test_equal_rows_are_dealt_to_many_cells_and_each_cell_lies_in_one_partition(spark):
    rows = [(7, [1, 2])] * 400 + [(None, [3])] * 3 + [(k, [k]) for k in range(10)]
    df = spark.createDataFrame(rows, "id long, ids array<int>").withColumn("h", F.xxhash64("id", "ids"))
    single, more = m.repeated(df)
    assert (single.count(), more.count()) == (10, 403)
    got = m.in_cells(single.unionByName(more), 8).withColumn("part", F.spark_partition_id()).collect()
    assert sorted(list(r.ids) for r in got) == sorted(ids for _, ids in rows)
    hot = Counter(r.cell for r in got if list(r.ids) == [1, 2])
    assert len(hot) == 8 and max(hot.values()) < 100
    assert all(len({r.part for r in got if r.cell == cell}) == 1 for cell in range(8))


def test_chunks_do_not_depend_on_batches():
    rng = np.random.default_rng(2)
    lists = [rng.integers(0, 9, rng.integers(1, 40)).astype(np.int32).tolist() for _ in range(300)]
    lists[150] = [1] * (m.CHUNK + 5)
    cells = [k // 90 for k in range(300)]

    def chunks(size):
        batches = (
            pa.RecordBatch.from_arrays(
                [pa.array(cells[k : k + size], pa.int32()), pa.array(lists[k : k + size], pa.list_(pa.int32()))], names=["cell", "ids"]
            )
            for k in range(0, 300, size)
        )
        return [(cell, ids.tolist(), starts.tolist()) for cell, ids, starts in m._chunks(batches)]

    assert chunks(1) == chunks(17) == chunks(300)
    assert [cell for cell, _, _ in chunks(17)] == [0, 1, 1, 2, 3]
    assert sum((ids for _, ids, _ in chunks(17)), []) == sum(lists, [])


def test_probabilities_add_up():
    rng = np.random.default_rng(1)
    words = [m.END, *(f"w{k}".encode() for k in range(900))]
    counts = np.sort(rng.integers(1, 500, len(words)))[::-1].astype(np.int64)
    model = m.layout(words, counts, rng.integers(0, m.TOPIC_BUCKETS, len(words)), 40, 17)
    w1, w2 = m.weights(model)
    w1 += rng.normal(0, 0.5, w1.shape).astype(np.float32)
    w2 += rng.normal(0, 0.5, w2.shape).astype(np.float32)
    every = np.arange(1, len(words) + 2)
    for one, two in ((0, 0), (5, 0), (901, 30)):
        history = [x for x in (two, one) if x]
        values = np.concatenate([[*history, w] for w in every]).astype(np.int32)
        starts = np.arange(0, len(values), len(history) + 1)
        p = m.log_probabilities(values, starts, model, w1, w2)[len(history) :: len(history) + 1]
        assert np.exp(p).sum() == pytest.approx(1, abs=1e-4)  # the last id stands for all rare words, whose shares add up to one


def test_without_training_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    df = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    rows = m.score(df).collect()
    assert len(rows) == len(held) and all(r.held_out and r.train_tokens == 0 and r.score == r.base_score == 0 for r in rows)
    assert m.score(df.where("doc_id < 0")).collect() == []


def test_words_outside_the_near_ones_have_a_class_for_each_of_ten_topics_and_three_bands():
    n = 20 * m.TOPIC_BUCKETS + m.NEAR + 1
    words = [m.END, *(f"w{k}".encode() for k in range(n - 1))]
    buckets = np.arange(n) % m.TOPIC_BUCKETS
    model = m.layout(words, np.full(n, 5, np.int64), buckets, 1, 1)
    far = model["cls"][1:-1][model["pos"][1:-1] < 0]
    assert len(set(far.tolist())) == 30
