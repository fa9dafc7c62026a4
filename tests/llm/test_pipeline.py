"""The corpus pipeline stage by stage: each stage's rows against brute force on what the stage before it kept."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline as c
from tests.llm import brute
from trialguard.llm import kneser_ney, mixing
from trialguard.llm.common import staged
from trialguard.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    words = ["the", "of", "cat", "dog", "house", "tree", "sun", "and", "runs", "sees", "blue", "red"]
    items = [(k, " ".join(rng.choice(words) for _ in range(14))) for k in range(5)]
    docs, labels = [], []
    for i in range(260):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(40, 160))).capitalize() + "."
        if i % 9 == 4:
            text = " ".join(w.upper()[::-1] + "%%%" for w in text.split())
        if i % 13 == 5:
            half = text.split()
            half[10:10] = items[i % 5][1].split()
            text = " ".join(half)
        if i and i % 10 == 0:
            text = docs[i - 1][1]
        docs.append((i, text, "en", rng.choice(["s1", "s1", "s1", "s2", "s3", None]), len(text)))
        if i % 4:
            labels.append((i, 0 if "%%%" in text else 1, 0))
    docs += [(900, None, None, None, None), (901, "", "en", "s2", 0), (902, items[0][1], "en", "s2", len(items[0][1]))]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items


def test_every_stage_does_its_work(spark, tables):
    path, items = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, states = docs.columns, [docs.collect()]
    for name, stage in c.STAGES:
        docs = staged(stage(spark, docs, path), name)
        states.append(docs.collect())
        if name != c.STAGES[-1][0]:
            assert docs.columns == columns
    first, judged, single, clean, mixed, written = states

    labels = spark.read.parquet(f"{path}/labels.parquet")
    keep = {r.doc_id for r in kneser_ney.quality(spark.createDataFrame(first), labels).where("keep").collect()}
    assert {r.doc_id for r in judged} == keep
    good = [r.doc_id for r in first if r.doc_id < 260 and r.doc_id % 9 != 4 and r.doc_id % 13 != 5 and (r.doc_id % 10 or r.doc_id == 0)]
    assert len(keep & set(good)) >= 0.97 * len(good)
    assert not keep & {900, 901} and len([i for i in keep if i % 9 == 4 and i % 10]) <= 1

    ids = [r.doc_id for r in judged]
    component = brute.near_groups([brute.simhash(r.text) for r in judged], ids)
    assert sorted(r.doc_id for r in single) == sorted(set(component))

    hits = {r.doc_id: brute.contamination(r.text, items) for r in single}
    assert {r.doc_id for r in clean} == {i for i, (w, h, _) in hits.items() if len(h) <= 0.5 * len(w)}
    for r in clean:
        words, hit, _ = hits[r.doc_id]
        assert brute.item_words(r.text) == [w for k, w in enumerate(words) if k not in hit] and r.n_chars == len(r.text)

    taken = {r.doc_id: r.taken for r in mixing.mixture(spark.createDataFrame(clean, docs_schema(spark, path))).collect()}
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(brute.space_words(r.text))
    assert got == {i: n for i, n in taken.items() if n}

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = sorted(
        (r.doc_id, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        for r in mixed for x in [[*library.encode(r.text or "", add_special_tokens=False).ids, 1]]
    )
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in written) == want
    at = 0
    for r in sorted(written, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def docs_schema(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet").schema


def test_run_is_registered_and_survives_an_empty_table(spark, tables, tmp_path):
    path, _ = tables
    assert __spark_entry__.queries()["pipeline"] is c.run and c.ORACLE_SQL is None and len(c.STAGES) == 5
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert c.run(spark, str(tmp_path)).collect() == []
