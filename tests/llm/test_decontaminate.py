from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm import brute
from trialguard.llm import decontaminate as d


def _data():
    rng = random.Random(2)
    words = ["ab", "Cd", "é", "x9", "of", "THE", "q"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))

    items = [(1, text(25)), (2, text(10)), (3, "short item"), (3, text(14)), (None, text(12)), (5, None), (6, " .,"), (10, "é")]
    docs = [None, "", "...", "é", "the short, ITEM here", "ab " * 3000]
    for _ in range(40):
        parts = [text(rng.randint(0, 20))]
        if rng.random() < 0.6:
            w = (rng.choice(items)[1] or "").split()
            s = rng.randint(0, max(0, len(w) - 1))
            parts += [" ".join(w[s : s + rng.randint(1, 25)]).upper(), text(5)]
        docs.append(". ".join(parts))
    docs.append(docs[-1])
    return docs, items


@pytest.mark.parametrize("shard_words", [30, 10_000])
def test_hits_match_brute_force(spark, shard_words):
    docs, items = _data()
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(docs)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in d.contamination(df, bench, shard_words=shard_words).collect()}
    assert len(got) == len(docs)
    for k, t in enumerate(docs):
        words, hit, names = brute.contamination(t, items)
        r = got[k]
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), len(hit), sorted(names)), t
        assert {p for s in r.spans for p in range(s.start, s.stop)} == hit


def test_report_digest(spark):
    docs, items = _data()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for r in d.report(df, bench).collect():
        _, hit, names = brute.contamination(docs[r.doc_id], items)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert r.n_items == len(names) and r.contaminated == bool(hit)


@pytest.mark.parametrize("shard_words", [5, 10_000])
def test_decontaminate_removes_spans_and_heavily_covered_rows(spark, shard_words):
    item = " ".join(f"w{k}" for k in range(12))
    other = "Clean words, stay as they are!"
    long = " ".join(f"c{k}" for k in range(40))
    rows = [(1, other, 1, "a"), (2, f"{long}; {item.upper()}.\n{other}", 2, None), (3, item, 3, "b"), (4, None, None, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, TEXT2 string")
    bench = spark.createDataFrame([(7, item), (8, "no such run"), (9, "nor this")], "item_id long, text string")
    got = {r.doc_id: r for r in d.decontaminate(df, bench, shard_words=shard_words).collect()}
    assert set(got) == {1, 2, 4} and got[1] == df.where("doc_id = 1").first() and got[4].text is None
    assert got[2].text == f"{long};  .\n{other}" and got[2].n_chars == len(got[2].text)
    assert d.contamination(d.decontaminate(df, bench), bench).where("n_hit > 0").count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.report(docs, bench).collect() == [] and d.decontaminate(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b", 3)], docs.schema)
    assert d.report(one, bench).first().contaminated is False and d.decontaminate(one, bench).count() == 1


def test_a_null_item_id_is_not_the_text_null(spark):
    bench = spark.createDataFrame([(None, "one two three"), ("null", "four five")], "item_id string, text string")
    df = spark.createDataFrame([(1, "One two, three. Four five!"), (2, "four five")], "doc_id long, text string")
    for shard_words in (1, 10_000):
        got = {r.doc_id: r for r in d.contamination(df, bench, shard_words=shard_words).collect()}
        assert got[1]["items"] == ["null", "null"] and got[2]["items"] == ["null"] and got[1].n_hit == 5


def test_an_automaton_is_built_once_for_a_task_and_shard(spark, monkeypatch):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(40)]
    shards = d._shards(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 160)
    built, automaton = [], d.ItemAutomaton
    monkeypatch.setattr(d, "ItemAutomaton", lambda *a: built.append(a) or automaton(*a))
    hits = []
    for files in shards:
        scan = d._scanner(files, 10)
        hits += [scan(text.encode())[2] for _ in range(30) for _, text in items]  # as many batches
    assert len(shards) == len(built) == 5
    assert sorted(i for found in hits for i in found) == sorted(str(k) for k in range(40) for _ in range(30))
