"""Token counts by a linear longest-match automaton.

A word is cut from left to right into the longest pieces of a vocabulary. The trie of the vocabulary gets, for each
node, a failure link and the number of tokens that are popped when matching can't go on there: the greedy pieces of
what was read, of which the linked node keeps the rest. Each character is then read once, and counts need no pieces.
A character that no piece covers counts as its UTF-8 bytes (byte fallback). Documents are read once and not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialguard.llm.common import pieces as in_hand

#: The mark before a word, which begins the pieces that may only stand at the start of a word.
MARK = "▁"
#: Different words that a task remembers at most.
CACHE_WORDS = 500_000


class PieceCounter:
    """Greedy longest-match piece counts of words over ``pieces``."""

    def __init__(self, pieces: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        token = [False]
        order = [(0, 0, "")]  # node, parent, character; parents come first within a piece
        for piece in pieces:
            v = 0
            for c in piece:
                to = self.children[v].get(c)
                if to is None:
                    to = self.children[v][c] = len(self.children)
                    self.children.append({})
                    token.append(False)
                    order.append((to, v, c))
                v = to
            token[v] = token[v] or v > 0
        self.link = [0] * len(self.children)
        self.popped = [0] * len(self.children)
        depth = [0] * len(self.children)
        for v, parent, _ in order[1:]:
            depth[v] = depth[parent] + 1
        for v, parent, c in sorted(order[1:], key=lambda x: depth[x[0]]):
            if token[v]:
                self.popped[v] = 1
            elif parent == 0:
                self.popped[v] = len(c.encode())
            else:
                self.link[v], n = self._step(self.link[parent], c)
                self.popped[v] = self.popped[parent] + n

    def _step(self, v: int, c: str) -> tuple[int, int]:
        """The node after reading ``c`` at ``v``, and how many tokens were popped on the way."""
        n = 0
        while True:
            to = self.children[v].get(c)
            if to is not None:
                return to, n
            if v == 0:
                return 0, n + len(c.encode())
            n += self.popped[v]
            v = self.link[v]

    def count(self, word: str) -> int:
        v = n = 0
        for c in word:
            to = self.children[v].get(c)
            if to is None:
                v, popped = self._step(v, c)
                n += popped
            else:
                v = to
        while v:
            n += self.popped[v]
            v = self.link[v]
        return n


def pieces_of(model_path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model; bytes and control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(k) for k in ids if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))]


def token_counts(docs: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_tokens`` for each row of ``docs``.

    Words are runs without white space (space, U+0009 to U+000D), each with ``MARK`` before it. Null, empty and blank
    texts have neither words nor tokens. Repeated rows give one row each, an empty table none; without pieces every
    word counts as its bytes. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(PieceCounter(pieces)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(())
        vars(counter).update(shared.value)
        known: dict[bytes, int] = {}
        for batch in in_hand(batches):
            n_words, n_tokens = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                counts = list(map(known.get, words))
                if None in counts:
                    if len(known) > CACHE_WORDS:
                        known.clear()
                    for k, n in enumerate(counts):
                        if n is None:
                            counts[k] = known[words[k]] = counter.count(MARK + words[k].decode())
                n_words.append(len(words))
                n_tokens.append(sum(counts))
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_tokens long").withColumnRenamed("id", id_col)
