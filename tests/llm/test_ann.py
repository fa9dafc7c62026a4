from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialguard.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank string"


def _brute(rows, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in dict((str(r), r) for r in rows).values() if i is not None and v is not None and len(v) == 8 and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in usable:
        if q % 20 == 0:
            near = sorted((-(x * v).sum(), i) for i, v in usable if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def _got(df, k=20, **options):
    out = {}
    for r in sorted(ann.nearest(df, F.col("vec_id") % 20 == 0, k, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def _same(got, want):
    assert got.keys() == want.keys()
    for q, found in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in found], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in found], abs=1e-12)


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), "x") for i in range(90)]
    rows += [(100 + i, rows[5][1], "copy") for i in range(60)]  # ties go to the smaller id
    rows += [(200, None, None), (220, [0.0] * 8, "zero"), (240, [1.0, None] + [0.0] * 6, "null"), (260, [float("nan")] * 8, "nan")]
    rows += [(280, [float("inf")] + [1.0] * 7, "inf"), (300, [1.0, 2.0], "short"), (None, [1.0] * 8, "no id"), rows[3], rows[20]]
    df = spark.createDataFrame(rows, SCHEMA)
    _same(_got(df), _brute(rows, 20))
    few = rows[:5] + [(20, rows[0][1], "q")]
    _same(_got(spark.createDataFrame(few, SCHEMA)), _brute(few, 20))
    assert _got(spark.createDataFrame([], SCHEMA)) == {}
    assert _got(spark.createDataFrame(rows[90 + 60 : 90 + 63], SCHEMA)) == {}


def test_recall_and_split_lists(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 8)) * 0.5
    x[:900] = x[0] + rng.normal(size=(900, 8)) * 1e-3  # a hot neighbourhood
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "CELL_ROWS", 100)
    monkeypatch.setattr(ann, "ASKED_ROWS", 20)
    got, want = _got(spark.createDataFrame(rows, SCHEMA)), _brute(rows, 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in found}) for q, found in want.items()]
    assert sum(hits) / (20 * len(want)) >= 0.95
    scores = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(s == pytest.approx(scores[q, i], abs=1e-12) for q, found in got.items() for i, s in found if (q, i) in scores)


@pytest.mark.parametrize("ratio", [ann.VISIT_RATIO, float("inf")])
def test_far_more_lists_than_are_visited(spark, monkeypatch, ratio):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 8)) * 2
    x = centres[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 8)) * rng.uniform(0.2, 0.6, (3000, 1))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "LIST_ROWS", 4)  # 750 lists
    got, want = _got(spark.createDataFrame(rows, SCHEMA), ratio=ratio), _brute(rows, 20)
    if ratio == float("inf"):
        _same(got, want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in found}) for q, found in want.items()]
    assert sum(hits) / (20 * len(want)) >= 0.9 and all(len(found) == 20 for found in got.values())


def test_graph_search_visits_the_lists_within_the_ratio():
    rng = np.random.default_rng(5)
    c = rng.normal(size=(900, 16))
    c = (c / np.linalg.norm(c, axis=1)[:, None]).astype(np.float32)
    x = rng.normal(size=(40, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    visits, found, due = ann._visits((c, *ann._linked(c, rng)), x, 1.3), 0, 0
    for own, q in zip(visits, x, strict=True):
        away = np.linalg.norm(c - q, axis=1)
        want = set(np.flatnonzero(away <= 1.3 * away.min())) | set(np.argsort(away)[: ann.FIRST])
        assert list(own) == sorted(own, key=lambda k: away[k]) and len(own) < 900
        found, due = found + len(want & set(own.tolist())), due + len(want)
    assert found >= 0.97 * due


def test_queries_whose_first_lists_hold_too_few_visit_all(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 1)
    monkeypatch.setattr(ann, "FIRST", 1)
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(rng.normal(size=(60, 8)))]
    got = _got(spark.createDataFrame(rows, SCHEMA), k=50, ratio=1.0)
    assert {len(v) for v in got.values()} == {50}
