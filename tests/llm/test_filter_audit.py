from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trialguard.llm import filter_audit as fa

ORDERS = ["".join(p) for p in itertools.permutations("ABCDE")]


def test_lehmer_ranks_number_the_orders_in_lexicographic_order():
    assert [fa.order_of(rank, "ABCDE") for rank in range(120)] == ORDERS


def test_intervals_hold_the_ranks_of_each_removal():
    for mask in range(32):
        steps = {}
        for step, first, end in fa.removal_intervals(mask, list(range(5))):
            for rank in range(first, end):
                assert steps.setdefault(rank, step) == step
        want = {
            rank: next(i for i, x in enumerate(order, 1) if mask >> "ABCDE".index(x) & 1)
            for rank, order in enumerate(ORDERS) if mask
        }
        assert steps == want


def _rows():
    rng = random.Random(8)
    common = " ".join(f"word{i}" for i in range(250))
    rows = [(None, "en", common), (None, "en", common), (None, None, None), (5, None, None), (4, None, ""), (6, "", ""),
            (7, "xx", "A" * 40_000 + " | " * 9000), (7, "xx", "other text of an id that is there twice")]
    for i in range(10, 400):
        lang = rng.choice(["en", "en", "de", None, "fr"])
        if rng.random() < 0.33:  # a third of the rows are one text
            rows.append((i, lang, common))
            continue
        n = rng.choice([0, 1, 150, 199, 200, 260])
        words = [f"w{rng.randint(0, rng.choice([40, 9999]))}" for _ in range(n)]
        if rng.random() < 0.3:
            words = [w.upper() + "ÄÖ" for w in words]
        rows.append((i, lang, rng.choice([" ", "\n", "  "]).join(words) + rng.choice(["", "", "$", " #1"])))
    return rows + rows[20:50] + [(3, "de", common), (3, "de", common), (2_000, "en", rows[30][2])]


def _brute(rows, labels):
    def fails(doc_id, text):
        text = text or ""
        words = brute.space_words(text)
        return {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, _, t in rows),
        }

    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    docs = [(lang or "", {x for x, bad in fails(i, t).items() if bad}, i) for i, lang, t in rows]
    out, per_filter = {}, {}
    for part in {p for p, *_ in docs}:
        own = [(f, i) for p, f, i in docs if p == part]
        for order in ORDERS:
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                per_filter[part, x] = per_filter.get((part, x), 0) + len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(x in f for f, _ in own) - len(gone), sum(f == {x} for f, _ in own),
                    sum(i in good for _, i in gone), sum(i in toxic for _, i in gone),
                ]
    return {k: (*v, per_filter[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("parts", [1, 7])
def test_audit_matches_a_simulation_of_all_orders(spark, parts):
    rng, rows = random.Random(1), _rows()
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1])) for i in range(0, 300)]
    labels += [(None, 1, 1), (20, 1, 0), (20, 0, 1), (99_999, 1, 1)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, lang string, text string, quality string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.filter_audit(docs.repartition(parts), marks).collect()
    assert got[0].asDict().keys() == {
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    }
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}
    assert len(found) == len(got) and found == _brute(rows, labels)


def test_conditions_stop_at_their_limits(spark):
    words = [f"v{i}" for i in range(200)]
    cases = [
        (" ".join(words), 0), (" ".join(words[:199]), 1), (" ".join(words[:100] * 2), 0), (" ".join(words[:99] * 2 + ["v0"] * 2), 2),
        ("AAA" + "a" * 97, 1), ("AAAA" + "a" * 96, 5), ("a|", 9), ("<>", 1), ("", 1),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id int, text string")
    got = df.select("id", fa.conditions(F.col("text"), fa.words_of(F.col("text"))).alias("mask")).collect()
    assert {r.id: r.mask for r in got} == {i: m for i, (_, m) in enumerate(cases)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, lang string, text string")
    got = fa.filter_audit(one, labels).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}
    assert all((r.removed, r.shapley) == ((1, 120) if r.filter_order[r.step - 1] == "A" else (0, 0)) for r in got)
