from __future__ import annotations

import random

from tests.llm import brute
from trialguard.llm import wordpiece as w
from trialguard.llm.queries import tokenizer_file


def test_automaton_counts_greedy_pieces():
    rng = random.Random(1)
    for _ in range(400):
        vocabulary = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}
        counter = w.PieceCounter(vocabulary)
        for _ in range(15):
            word = "".join(rng.choice("abéz") for _ in range(rng.randint(0, 12)))
            assert counter.count(word) == brute.pieces(word, vocabulary)


def test_counts_of_documents(spark):
    pieces = w.pieces_of(tokenizer_file("piece_bpe_32k.model"))
    texts = [None, "", " \n", "Hello, wörld!", "tokenization\x0bof 中文 \U0001f389", "\u2003em space", "▁mark", "a" * 3000, "Hello, wörld!"]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in w.token_counts(df, pieces).collect()}
    known = set(pieces)
    for k, t in enumerate(texts):
        words = brute.space_words(t)
        assert (got[k].n_words, got[k].n_tokens) == (len(words), sum(brute.pieces("▁" + x, known) for x in words)), t
    assert w.token_counts(df.where("doc_id < 0"), pieces).collect() == []
    assert w.token_counts(df.where("doc_id = 4"), []).first().n_tokens == len("▁tokenization▁of▁中文▁\U0001f389".encode())
