from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm import brute
from trialguard.llm import simhash
from trialguard.llm.components import connected_components


def _texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    out = [None, "", " \t\n", "One", "one", "two words", "TWO\x0bwords", "x" * 5000 + " y z"]
    for _ in range(30):
        own = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        out.append(" ".join(own))
        for _ in range(rng.randint(0, 3)):
            near = list(own)
            near[rng.randrange(len(near))] = rng.choice(words)
            out.append("  ".join(near).title())
        if rng.random() < 0.4:
            out += [" ".join(own)] * 2
    out.append(" ".join(rng.choice(words) for _ in range(40_000)))
    return out


def test_fingerprints_and_components_match_brute_force(spark):
    texts = _texts()
    ids = [*range(100, 100 + len(texts) - 1), None]
    df = spark.createDataFrame(
        [(t, i, "clash", 1) for t, i in zip(texts, ids, strict=True)], "text string, doc_id long, fp string, rid int"
    )
    rows = simhash.near_duplicates(df, cell_rows=4).collect()
    prints = [brute.simhash(t) for t in texts]
    component = brute.near_groups(prints, ids)
    want = sorted((-1 if i is None else i, f"{p:016x}", c) for i, p, c in zip(ids, prints, component, strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in rows) == want


def test_links_of_dense_fingerprints_survive_split_cells(spark):
    rng = random.Random(8)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        bits = rng.sample(range(64), 9)
        for _ in range(60):
            prints.add(centre ^ sum(1 << b for b in rng.sample(bits, rng.randint(0, 5))))
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for cells in (2, 40, 512):
        for limit in (3, 2):
            got = simhash.linked_prints(df, limit, cells).collect()
            assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= limit for r in got if cells < 33)
            edges = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= limit]
            assert brute.groups(prints, [(r.a, r.b) for r in got]) == brute.groups(prints, edges)


def test_keep_one_keeps_one_row_of_each_component(spark):
    texts = _texts()
    rows = [(i % 90, t, "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[3], (None, "one", "s", 3)], "doc_id long, text string, rid string, FP long")
    kept = simhash.keep_one(df).collect()
    assert kept and list(kept[0].asDict()) == df.columns
    all_rows = df.collect()
    prints = [brute.simhash(r.text) for r in all_rows]
    place = list(range(len(all_rows)))
    component = brute.near_groups(prints, place)
    assert len(kept) == len(set(component))
    of = {}
    for r, c in zip(all_rows, component, strict=True):
        of.setdefault(c, []).append(r.doc_id)
    want = sorted(min((i is None, i or 0) for i in ids) for ids in of.values())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []


def test_components_of_paths_stars_and_chance_graphs(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(150)] + [(1000, 1000 + k) for k in range(1, 120)]
    edges += [(rng.randrange(2000, 2150), rng.randrange(2000, 2150)) for _ in range(90)] + [(1, 1), (5, 6), (6, 5)]
    df = spark.createDataFrame([*edges, (None, 4), (9, None)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == brute.groups(nodes, [e for e in edges if e[0] != e[1]])
    assert connected_components(df.where(F.lit(False))).collect() == []
