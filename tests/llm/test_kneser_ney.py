from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tests.llm import brute
from trialguard.llm import kneser_ney as k

DOC = "doc_id long, text string, lang string, nll double"
LABELS = "doc_id long, quality int, toxic int"


def _good(rng, words):
    return " ".join(rng.choice(words) for _ in range(rng.randint(30, 80))).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    common = {"en": ["the", "of", "and", "cat", "dog", "house"], "fr": ["le", "la", "les", "chat", "chien"]}
    docs, labels = [], []
    for i in range(300):
        lang = "fr" if i % 4 == 0 else "en"
        bad = i % 7 == 3
        rare = ["".join(rng.choice("aeioustr") for _ in range(6)) for _ in range(3)]
        text = _good(rng, common[lang] * 3 + rare)
        if bad:
            text = " ".join(w.upper()[::-1] + "!!" for w in text.split())
        docs.append((i, text, lang, 0.5))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    docs += [(900, None, "en", 1.0), (901, "", None, 1.0), (902, " \n", "xx", 1.0), (903, "The cat", None, 1.0), (None, "The dog and the cat", "en", 1.0)]
    docs += [docs[5], (904, "the cat and the dog " * 4000, "en", 1.0)]
    return docs, labels


def test_probabilities_match_the_formulas_and_add_up(spark, corpus):
    texts = [t for _, t, lang, _ in corpus[0][:60] if t]
    model = k.fit(spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string"))
    vocab = model["vocab"].value
    plain = [k._ids(k.tokens_of(t), vocab)[2:].tolist() for t in texts]
    size = k.FIRST_WORD + len(vocab)
    want = brute.KneserNey(plain, k.BEGIN, size)
    for t in ["the cat Quux the of 12 !! and", *texts[:3]]:
        ids = k._ids(k.tokens_of(t), vocab)
        got = k.log_probabilities(ids, model)
        for at, p in enumerate(got, 2):
            spread = model["spread"][ids[at]] if ids[at] < k.FIRST_WORD else 0.0
            assert p - spread == pytest.approx(math.log(want.p(ids[at], (ids[at - 2], ids[at - 1]))), abs=2e-4)
    for u, v in ((k.BEGIN, k.BEGIN), (vocab["the"], vocab["cat"]), (k.LOWER, k.UPPER)):
        total = sum(
            math.exp(k.log_probabilities(np.array([u, v, w]), model)[0] - (model["spread"][w] if w < k.FIRST_WORD else 0))
            for w in range(1, size)
        )
        assert total == pytest.approx(1, abs=1e-3)


def test_rejects_junk_and_keeps_clean_documents(spark, corpus):
    docs, labels = corpus
    rows = k.quality(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    clean = [by_id[i].keep for i in range(300) if i % 7 != 3]
    junk = [by_id[i].keep for i in range(300) if i % 7 == 3]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.05
    assert all(not by_id[i].keep and by_id[i].perplexity is None and by_id[i].n_tokens == 0 for i in (900, 901, 902))
    assert by_id[904].n_tokens == 20_001 and by_id[None].n_tokens == 6
    assert all(r.low < r.high for r in rows if r.perplexity is not None)


def test_keep_good_keeps_rows_and_columns(spark, corpus):
    docs, labels = corpus
    df = spark.createDataFrame(docs, DOC)
    kept = k.keep_good(df, spark.createDataFrame(labels, LABELS))
    assert kept.columns == df.columns
    judged = {r.doc_id for r in k.quality(df, spark.createDataFrame(labels, LABELS)).where("keep").collect()}
    assert {r.doc_id for r in kept.collect()} == judged and set(kept.collect()) <= set(df.collect())


def test_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], LABELS)
    docs = spark.createDataFrame([(1, "a b", "en", 0.0), (2, "", None, 0.0)], DOC)
    assert {(r.doc_id, r.keep) for r in k.quality(docs, labels).collect()} == {(1, True), (2, False)}
    assert k.quality(docs.where("doc_id > 5"), labels).collect() == []


def test_all_trusted_documents_that_are_not_fitted_on_set_thresholds(spark):
    rng = random.Random(8)
    words = {"en": ["the", "of", "cat"], "fr": ["le", "la", "chien", "chat", "rue"]}
    docs = [(i, " ".join(rng.choices(words["en" if i < 130 else "fr"], k=10)), "en" if i < 130 else "fr", 0.0) for i in range(530)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(530)], LABELS)
    df = spark.createDataFrame([*docs, (900, "a b c d e f g h i j", "xx", 0.0)], DOC)
    limits = {r.lang: (r.low, r.high) for r in k.thresholds(df, labels, max_trusted=5)[2].collect()}
    assert limits["en"] != limits["xx"]  # 125 and more documents of its own, not the thresholds of all


def test_every_trusted_document_of_its_half_is_fitted_on_however_many_there_are(spark, monkeypatch):
    import trialguard.llm.kneser_ney as module

    seen = []
    monkeypatch.setattr(module, "fit", lambda trusted: seen.append(trusted.count()) or (_ for _ in ()).throw(KeyError()))
    n = 9000  # half of these are more than the 4,000 that once were the bound
    docs = spark.range(n).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "0D AS nll")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    with pytest.raises(KeyError):
        k.thresholds(docs, labels)
    assert seen == [docs.where(k._half("doc_id") == 0).count()] and seen[0] > 4000


def test_tables_that_are_read_shard_by_shard_give_the_same_scores(spark, corpus, monkeypatch):
    docs, labels = (spark.createDataFrame(rows, s) for rows, s in zip(corpus, (DOC, LABELS), strict=True))
    held = sorted(map(str, k.quality(docs, labels).collect()))
    monkeypatch.setattr(k, "HELD_ROWS", 10)
    monkeypatch.setattr(k, "SHARD_ROWS", 100)
    monkeypatch.setattr(k, "CHUNK", 2000)
    assert sorted(map(str, k.quality(docs, labels).collect())) == held


def test_a_fit_leaves_only_its_shards(spark):
    from trialguard import files
    from trialguard.session import checkpoint_dir

    def tables() -> set[str]:
        at = f"{checkpoint_dir(spark)}/tables"
        return {n for n in files.folders(spark, at) if any(f.endswith(".parquet") for f in spark_files(f"{at}/{n}"))}

    def spark_files(path: str) -> list[str]:
        return [r[0] for r in spark.read.format("binaryFile").load(path).select("path").collect()]

    before = tables()
    model = k.fit(spark.createDataFrame([("the cat sat on the mat",), ("the dog sat on the cat",)], "text string"))
    left = tables() - before
    assert {n.rsplit("-", 1)[0] for n in left} == {"bigram-shards", "trigram-shards"} and len(left) == 2
    assert len(model["bigrams"]) == len(model["trigrams"]) == 1


def test_trigrams_meet_bigrams_in_parts(spark, corpus, monkeypatch):
    sizes = []

    def seen(df, name, *more):
        table = staged(df, name, *more)
        sizes.append((name, table.count()))
        return table

    staged = k.staged
    monkeypatch.setattr(k, "staged", seen)
    texts = [t for _, t, _, _ in corpus[0][:100] if t]
    model = k.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    n = dict(sizes)["trigrams"]
    keys = {int(x) for (table, *_) in k._read(model["trigrams"]) for x in table}
    parts = [rows for name, rows in sizes if name == "trigram-p"]
    assert len(keys) == sum(parts) == n and max(parts) < n / 2


def test_texts_are_encoded_at_once_as_by_a_dictionary(monkeypatch):
    texts = ["The cat, the CAT!!", None, "", " \n\x1c", "x_y1²١\U0001d7ce z\x85q __", "\U0001F600 İǅ aB ba ab", "b" * 9000]
    vocab = {w: k.FIRST_WORD + i for i, w in enumerate(["cat", "ab", "!!", "x", "b" * 9000, "z"])}
    want = [k._ids(k.tokens_of(t), vocab).tolist() if k.tokens_of(t) else [] for t in texts]
    monkeypatch.setattr(k, "tokens_of", None)  # no token is taken out and looked up by itself
    for size in (5, 1 << 18):
        monkeypatch.setattr(k, "ENCODED", size)
        encoder = k._Encoder(vocab)
        got = list(encoder.encode(texts))
        assert np.concatenate([ids for ids, _ in got]).tolist() == sum(want, [])
        assert np.concatenate([n for _, n in got]).tolist() == [max(len(w) - 2, 0) for w in want]
    encoder = k._Encoder({"ab": 8})
    encoder.weights[:] = 1  # "ba" has the hash of "ab" now
    encoder.hashes = np.array([ord("a") + ord("b")], np.uint64)
    assert next(encoder.encode(["ba ab"]))[0].tolist() == [k.BEGIN, k.BEGIN, k.LOWER, 8, k.END]
    assert next(k._Encoder({}).encode(["ab 1"]))[0].tolist() == [k.BEGIN, k.BEGIN, k.LOWER, k.NUMBER, k.END]
