"""Hashed maximum-entropy language model with a class-factored softmax.

The probability of a word is that of its class, times its own within the class. Both are softmaxes over hashed
features of the words before: the last word (bigram), the last two together (trigram) and the last but one alone
(skip). Frequent words (``NEAR``) have classes of up to ``NEAR_CLASS`` words with features of their own; other words of
the head vocabulary are classed by topic and frequency, and a word takes its share of the class's training count,
which is the maximum-entropy solution without context features. All rarer and unseen words are one class, whose words
take their share of its count with 0.1 added to each and to one unseen word. So probabilities add up to one.

Word counts are Spark aggregates of counts by task. A word's topic is the kind of document that most of its
occurrences are in, where documents are told apart by their own most frequent word. Training goes over the training
documents once, in ``ROUNDS`` parts, each dealt into cells of about ``CELL_TOKENS`` tokens by a hash of id and words:
a cell starts from the current weights, goes through its documents in order of that hash in mini-batches of sparse
gradients, and sends the change of each weight row with the number of times the row was seen; changes are averaged by
these numbers in a shuffle by blocks of rows, in order of the cells. So scores depend on the rows alone, not on how
Spark has dealt them to files, partitions or Arrow batches. The weights, the head vocabulary and its classes have fixed
size bounds. Rare words of documents meet their counts in a join, never in a broadcast.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialguard.llm.common import pieces, staged, worker_cache

#: Words with ids, words with classes of their own, and how many of these make a class.
HEAD, NEAR, NEAR_CLASS = 200_000, 512, 32
#: Buckets of documents by their most frequent word; the largest become topics. Frequency bands of a topic's words.
TOPIC_BUCKETS, TOPICS, BANDS = 64, 10, 3
#: Rows of the hashed weights: bigram, trigram and skip features of classes; bigram and skip features of words.
CLASS_ROWS, WORD_ROWS = (1 << 13, 1 << 14, 1 << 13), (1 << 13, 1 << 13)
#: Different words that a counting task holds before it sends their counts.
HELD = 300_000
ROUNDS, BATCH, RATE, CAUTION = 3, 4096, 0.7, 5.0
#: Training tokens of a cell, and the tokens of a cell's documents that are taken in hand at once.
CELL_TOKENS, CHUNK = 1_000_000, 1 << 16
#: Occurrences of a weight row in a mini-batch that are added place by place.
SHORT_RUN = 12
BLOCK = 512
#: The token that ends every document; no word contains white space.
END = b"\n"
ADDED = 0.1


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # of bytes: A-Z only, white space U+0009-U+000D and space


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words by bucket of their document; they are sent on whenever ``HELD`` different words are held."""
    import zlib

    found: dict[int, Counter[bytes]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for bucket, counts in found.items():
            words, n = list(counts), list(counts.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array([bucket] * len(n), pa.int32()), pa.array(n, pa.int64())],
                names=["word", "bucket", "n"],
            )
        found.clear()

    for batch in pieces(batches):
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            words = words_of(text)
            if words:
                own = Counter(words)
                most = max(own.values())
                key = min(w for w, n in own.items() if n == most)
                found.setdefault(zlib.crc32(key) % TOPIC_BUCKETS, Counter()).update(words)
            found.setdefault(0, Counter())[END] += 1
        if sum(map(len, found.values())) > HELD:
            yield from sent()
    yield from sent()


def word_counts(training: DataFrame) -> DataFrame:
    """``word, n, bucket`` of the training texts: the bucket holds most of the word's occurrences."""
    parts = training.select("text").mapInArrow(_count, "word string, bucket int, n long")
    parts = parts.groupBy("word", "bucket").agg(F.sum("n").alias("n"))
    return parts.groupBy("word").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", -F.col("bucket"))).alias("most")
    ).select("word", "n", (-F.col("most.col2")).alias("bucket"))


def layout(words: list[bytes], counts: np.ndarray, buckets: np.ndarray, tail_count: int, tail_kinds: int) -> dict:
    """Classes of the head words, which come most frequent first; ids are 1 and up, 0 is before a text.

    ``cls`` is the class and ``pos`` the place within it (-1: a share of its count, ``share``) by id, the last id
    being all other words; ``bias`` and ``bias2`` are the logarithms of training shares.
    """
    n = len(words)
    near = np.arange(n) < NEAR
    if END in words:
        near[words.index(END)] = True
    mass = np.bincount(buckets, counts, TOPIC_BUCKETS) if n else np.zeros(TOPIC_BUCKETS)
    topic_of = np.full(TOPIC_BUCKETS, TOPICS - 1)
    largest = np.argsort(-mass, kind="stable")[: TOPICS - 1]
    topic_of[largest] = np.arange(len(largest))
    topic = topic_of[buckets] if n else np.zeros(0, np.int64)
    near_ids = np.flatnonzero(near)
    near_ids = near_ids[np.argsort(topic[near_ids], kind="stable")]
    near_classes = (NEAR + 1 + NEAR_CLASS - 1) // NEAR_CLASS
    classes = near_classes + TOPICS * BANDS + 1
    cls, pos = np.full(n + 2, classes - 1, np.int32), np.full(n + 2, -1, np.int32)
    at = np.arange(len(near_ids))
    cls[near_ids + 1], pos[near_ids + 1] = at // NEAR_CLASS, at % NEAR_CLASS
    for t in range(TOPICS):
        rest = np.flatnonzero(~near & (topic == t))
        if len(rest):
            upto = np.cumsum(counts[rest])
            cls[rest + 1] = near_classes + t * BANDS + np.minimum((upto - 1) * BANDS // upto[-1], BANDS - 1)
    whole = np.zeros(classes)
    np.add.at(whole, cls[1 : n + 1], counts)
    tail = tail_count + ADDED * (tail_kinds + 1)
    whole[-1] = tail
    share = np.zeros(n + 2)
    share[1 : n + 1] = np.log(counts / whole[cls[1 : n + 1]])
    bias2 = np.full((near_classes, NEAR_CLASS), -1e9)
    bias2[cls[near_ids + 1], pos[near_ids + 1]] = share[near_ids + 1]
    with np.errstate(divide="ignore"):
        bias = np.where(whole > 0, np.log(whole / whole.sum()), -1e9)
    return {
        "cls": cls, "pos": pos, "share": share, "bias": bias.astype(np.float32), "bias2": bias2.astype(np.float32),
        "tail": tail,
    }


def weights(model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights that are all zero."""
    return (
        np.zeros((sum(CLASS_ROWS), len(model["bias"])), np.float32),
        np.zeros((sum(WORD_ROWS), NEAR_CLASS), np.float32),
    )


def _mixed(x: np.ndarray, rows: int) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(40)) % np.uint64(rows)).astype(np.int32)


def _history(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word and the one before that, 0 before the start of a text."""
    one, two = np.zeros_like(values), np.zeros_like(values)
    one[1:], two[2:] = values[:-1], values[:-2]
    inside = starts[starts < len(values)]
    one[inside] = 0
    two[inside] = 0
    two[(inside + 1)[inside + 1 < len(values)]] = 0
    return one, two


def _class_rows(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    a, b, c = CLASS_ROWS
    both = one.astype(np.int64) * 1_000_003 + two
    return np.stack([_mixed(one, a), _mixed(both, b) + a, _mixed(two + 7, c) + (a + b)])


def _word_rows(one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> np.ndarray:
    a, b = WORD_ROWS
    return np.stack([_mixed(one.astype(np.int64) * 64 + cls, a), _mixed(two.astype(np.int64) * 64 + cls + 31, b) + a])


def _logits(w: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    z = np.take(w, rows[0], axis=0)
    for r in rows[1:]:
        z += np.take(w, r, axis=0)
    z += bias
    return np.minimum(z, 60, out=z)  # so that no power overflows


def _row_sums(rows: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, the sums of ``z`` over the places where each stands in any feature, and how many these are.

    Short runs of the sorted rows are added place by place, which is far cheaper than a reduction for each run.
    """
    flat = rows.ravel().astype(np.uint16)  # 16 bits sort by radix
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    many = np.diff(np.append(first, len(flat)))
    places = order % rows.shape[1]
    sums = np.take(z, places[first], axis=0)
    for k in range(1, min(int(many.max()), SHORT_RUN)):
        more = np.flatnonzero(many > k)
        sums[more] += np.take(z, places[first[more] + k], axis=0)
    for run in np.flatnonzero(many > SHORT_RUN).tolist():
        at = places[first[run] + SHORT_RUN : first[run] + many[run]]
        sums[run] += np.take(z, at, axis=0).sum(axis=0)
    return ordered[first].astype(np.int64), sums, many


class _Learner:
    """Weights of one softmax with the gradient history of each row."""

    def __init__(self, start: np.ndarray):
        self.start, self.w = start, start.copy()
        self.square = np.full(len(start), CAUTION, np.float32)
        self.seen = np.zeros(len(start), np.int64)
        self.ones = np.ones(start.shape[1], np.float32)

    def step(self, rows: np.ndarray, bias: np.ndarray, y: np.ndarray) -> None:
        """One mini-batch: ``rows`` of each feature, and the outcomes ``y``."""
        z = _logits(self.w, rows, bias)
        np.exp(z, out=z)
        z /= (z @ self.ones)[:, None]
        z[np.arange(len(y)), y] -= 1
        at, g, many = _row_sums(rows, z)
        self.square[at] += np.einsum("ij,ij->i", g, g)
        g *= (RATE / np.sqrt(self.square[at]))[:, None]
        self.w[at] -= g
        self.seen[at] += many


def _train(values: np.ndarray, starts: np.ndarray, model: dict, class_: _Learner, word: _Learner) -> None:
    one, two = _history(values, starts)
    cls, pos = model["cls"][values], model["pos"][values]
    for at in range(0, len(values), BATCH):
        s = slice(at, at + BATCH)
        class_.step(_class_rows(one[s], two[s]), model["bias"], cls[s])
        near = np.flatnonzero(pos[s] >= 0) + at
        if len(near):
            c = cls[near]
            word.step(_word_rows(one[near], two[near], c), model["bias2"][c], pos[near])


def _chosen(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log probability of the outcomes ``y`` under the softmax of ``z``."""
    p = z[np.arange(len(y)), y]
    return p - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], np.float32))


def log_probabilities(values: np.ndarray, starts: np.ndarray, model: dict, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """Natural log probability of each id after its history; for the last id that of its class alone."""
    one, two = _history(values, starts)
    cls, pos = model["cls"][values], model["pos"][values]
    out = model["share"][values].copy()
    for at in range(0, len(values), BATCH):
        s = slice(at, at + BATCH)
        p = _chosen(_logits(w1, _class_rows(one[s], two[s]), model["bias"]), cls[s])
        near = np.flatnonzero(pos[s] >= 0) + at
        if len(near):
            c = cls[near]
            out[near] = _chosen(_logits(w2, _word_rows(one[near], two[near], c), model["bias2"][c]), pos[near])
        out[s] += p
    return out


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column in a row, and where each list starts."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    return values, offsets[:-1] - offsets[0]


def _encoder(head, n_all: int, v_all: int):
    """Texts to ids, the part of the base score that head words have, and the other words with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, counts, name = head.value
        cache = worker_cache("head words")
        if cache.get("name") != name:
            words = blob.split(b" ") if len(counts) else []
            cache.update(name=name, ids={w: k for k, w in enumerate(words, 1)})
        get, tail = cache["ids"].get, len(counts) + 1
        with np.errstate(divide="ignore"):
            base = np.log10((np.concatenate([[0], counts, [0]]) + ADDED) / (n_all + ADDED * (v_all + 1)))
        end = get(END, tail)
        for batch in pieces(batches):
            ids, ends, sums, known, rare, rare_n, rare_at = [], [0], [], [], [], [], [0]
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = words_of(text)
                own = np.fromiter(chain(map(get, words, repeat(tail)), (end,)), np.int32, len(words) + 1)
                far = np.flatnonzero(own[:-1] == tail)
                others = Counter([words[k] for k in far.tolist()])
                if end == tail:
                    others[END] += 1
                rare += others
                rare_n += others.values()
                rare_at.append(len(rare))
                inside = own[own != tail]
                sums.append(float(base[inside].sum()))
                known.append(len(inside))
                ids.append(own)
                ends.append(ends[-1] + len(own))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids or [np.empty(0, np.int32)])))
            others = pa.StructArray.from_arrays(
                [pa.array(rare, pa.binary()).cast(pa.string()), pa.array(rare_n, pa.int32())], names=["word", "n"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), lists, pa.array(np.diff(ends), pa.int64()),
                    pa.array(known, pa.int64()), pa.array(sums, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(rare_at, pa.int32()), others),
                ],
                names=["id", "held_out", "ids", "n_tokens", "known", "base", "rare"],
            )

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``cell, ids, starts`` of documents in a row until they have ``CHUNK`` tokens or their cell ends.

    Where the rows of ``batches`` begin and end makes no difference.
    """
    held: list[np.ndarray] = []
    cell, size = -1, 0

    def taken() -> tuple[int, np.ndarray, np.ndarray]:
        starts = np.cumsum([0, *map(len, held[:-1])])
        out = cell, np.concatenate(held), starts
        held.clear()
        return out

    for batch in pieces(batches):
        values, starts = _lists(batch.column(1))
        for own, at, to in zip(batch.column(0).to_pylist(), starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True):
            if held and (own != cell or size >= CHUNK):
                yield taken()
                size = 0
            cell, size = own, size + to - at
            held.append(values[at:to])
    if held:
        yield taken()


_CHANGES = pa.schema(
    [("kind", pa.int32()), ("block", pa.int32()), ("cell", pa.int32()), ("change", pa.binary()), ("seen", pa.binary())]
)


def _gradients(model, current):
    """One row for each cell and block of weight rows that the cell's documents changed."""

    def changes(cell: int, learners: tuple[_Learner, _Learner]) -> Iterator[pa.RecordBatch]:
        for kind, x in enumerate(learners):
            for at in range(0, len(x.w), BLOCK):
                seen = x.seen[at : at + BLOCK]
                if seen.any():
                    change = (x.w[at : at + BLOCK] - x.start[at : at + BLOCK]).astype(np.float16)
                    row = {"kind": kind, "block": at // BLOCK, "cell": cell, "change": change.tobytes(), "seen": seen.astype("<i8").tobytes()}
                    yield pa.RecordBatch.from_pylist([row], schema=_CHANGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, learners = None, None
        for cell, values, starts in _chunks(batches):
            if cell != at:
                if learners:
                    yield from changes(at, learners)
                at, learners = cell, tuple(map(_Learner, current.value))
            _train(values, starts, model.value, *learners)
        if learners:
            yield from changes(at, learners)

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean change of each weight row, by how often cells saw it; rows come sorted by block and cell."""

    def mean(key: tuple[int, int], change: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        change = (change / np.maximum(seen, 1)[:, None]).astype(np.float32)
        return pa.RecordBatch.from_pylist(
            [{"kind": key[0], "block": key[1], "change": change.tobytes()}],
            schema=pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("change", pa.binary())]),
        )

    at, sums = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            (r,) = batch.slice(k, 1).to_pylist()
            seen = np.frombuffer(r["seen"], "<i8").astype(np.float64)
            change = np.frombuffer(r["change"], np.float16).astype(np.float64).reshape(len(seen), -1) * seen[:, None]
            if at == (r["kind"], r["block"]):
                sums[0].__iadd__(change)
                sums[1].__iadd__(seen)
            else:
                if sums:
                    yield mean(at, *sums)
                at, sums = (r["kind"], r["block"]), (change, seen)
    if sums:
        yield mean(at, *sums)


def repeated(hashed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``hashed(id, ids, h)`` whose hash no other row has, and the other rows, each with ``copy``.

    Equal rows are counted and then numbered, so that many of them fill no single cell.
    """
    twice = staged(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated")
    single = hashed.join(twice, "h", "left_anti").withColumn("copy", F.lit(1).cast("long"))
    more = hashed.join(twice, "h", "left_semi").groupBy("h", "id", "ids").agg(F.count(F.lit(1)).alias("n"))
    more = more.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    return single, staged(more, "copies")


def in_cells(numbered: DataFrame, cells: int) -> DataFrame:
    """``cell, ids`` of ``numbered(id, ids, h, copy)``: cells by hash, each whole in one partition and in one order."""
    rows = numbered.withColumn("cell", F.pmod(F.xxhash64("h", "copy"), F.lit(cells)).cast("int"))
    return rows.repartition(cells, "cell").sortWithinPartitions("cell", "h", "id", "ids").select("cell", "ids")


def train(
    encoded: DataFrame, model: dict, n_tokens: int, rounds: int = ROUNDS, cell_tokens: int = CELL_TOKENS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights from one pass over ``encoded(id, ids, h)``, which holds ``n_tokens`` ids, in ``rounds`` parts."""
    sc = encoded.sparkSession.sparkContext
    shared = sc.broadcast(model)
    w = weights(model)
    single, more = repeated(encoded)
    numbered = single.unionByName(more)
    cells = -(-n_tokens // (rounds * cell_tokens)) or 1
    for k in range(rounds):
        current = sc.broadcast(w)
        part = in_cells(numbered.where(F.pmod("h", F.lit(rounds)) == k), cells)
        changes = part.mapInArrow(_gradients(shared, current), "kind int, block int, cell int, change binary, seen binary")
        blocks = changes.repartition("kind", "block").sortWithinPartitions("kind", "block", "cell")
        blocks = blocks.mapInArrow(_averaged, "kind int, block int, change binary")
        w = tuple(x.copy() for x in w)
        for r in blocks.toLocalIterator():  # the weights, whose size is fixed
            rows = w[r.kind][r.block * BLOCK : (r.block + 1) * BLOCK]
            rows += np.frombuffer(r.change, np.float32).reshape(rows.shape)
        current.unpersist()
    return w


def _scorer(model, current):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w1, w2 = current.value
        for batch in pieces(batches):
            values, starts = _lists(batch.column(1))
            p = log_probabilities(values, starts, model.value, w1, w2)
            sums = np.add.reduceat(p, starts) if len(starts) else np.empty(0)  # each text has its end
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums / np.log(10))], names=["rid", "head_score"])

    return run


def held_out(id_col: Column) -> Column:
    """One in ten by the checksum of the id as text (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, cell_tokens: int = CELL_TOKENS
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    The model learns from the rows that are not held out and scores all; the order and partitions of the rows make no
    difference. A null text is empty: its only token is the
    end. Repeated rows count each. Without training rows every token has probability one. An empty table gives no
    rows. Other columns are not read.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        held_out(F.col(id_col)).alias("held_out"),
    )
    counts = staged(word_counts(rows.where(~F.col("held_out")).select("text")), "word-counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(head).toArrow()  # bounded by head
    words = top.column("word").cast(pa.binary()).to_pylist()
    head_counts = top.column("n").to_numpy().astype(np.int64)
    rare_n, rare_v = n_all - int(head_counts.sum()), v_all - len(words)
    model = layout(words, head_counts, top.column("bucket").to_numpy().astype(np.int64), rare_n, rare_v)
    shared = sc.broadcast((b" ".join(words), head_counts, uuid.uuid4().hex))

    kind = rows.schema["id"].dataType.simpleString()
    encoded = rows.select("id", "text", "held_out").mapInArrow(
        _encoder(shared, n_all, v_all),
        f"id {kind}, held_out boolean, ids array<int>, n_tokens long, known long, base double, "
        "rare array<struct<word: string, n: int>>",
    )
    encoded = encoded.withColumns({"rid": F.monotonically_increasing_id(), "h": F.xxhash64("id", "ids")})
    encoded = staged(encoded, "encoded")
    w = train(encoded.where(~F.col("held_out")).select("id", "ids", "h"), model, n_all, cell_tokens=cell_tokens)
    scored = encoded.select("rid", "ids").mapInArrow(
        _scorer(sc.broadcast(model), sc.broadcast(w)), "rid long, head_score double"
    )
    c = F.coalesce("c", F.lit(0))
    rare = encoded.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", F.col("r.n").alias("k"))
    rare = rare.join(counts.select("word", F.col("n").alias("c")), "word", "left").groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("k") * F.log10((c + ADDED) / F.lit(n_all + ADDED * (v_all + 1)))).alias("rare_base"),
        F.sum(F.col("k") * F.log10((c + ADDED) / F.lit(float(model["tail"])))).alias("rare_score"),
    )
    zero = F.lit(0)
    return (
        encoded.select("rid", "id", "held_out", "n_tokens", "known", "base").join(scored, "rid").join(rare, "rid", "left")
        .select(
            F.col("id").alias(id_col), "held_out", "n_tokens",
            (F.col("known") + F.coalesce("rare_known", zero)).alias("n_known"),
            F.lit(n_all).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
            (F.col("head_score") + F.coalesce("rare_score", zero)).alias("score"),
        )
    )
