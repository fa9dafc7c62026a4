"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Training counts trigrams of the trusted documents, then how many different words precede each bigram and word. Each
order gets its three discounts from its counts of counts. Probabilities come from these count tables: windows over
contexts and joins with the next lower order, all over integer keys. Words outside the vocabulary fall into classes
by their shape; a class's probability is spread evenly over the kinds of words that it stood for in training.

The model is fitted on every trusted document of one half by hash, so the finished tables grow with the trusted text.
They are written in the shared folder as shards by key range, and the n-grams of every document are joined with one
shard after the other in sorted arrays: documents are never shuffled for it, and the tables don't pass through the
driver. Tables of up to ``HELD_ROWS`` rows stay in a worker; of larger ones it holds a single shard at a time and takes
``CHUNK`` bytes of text through them at once. Thresholds are quantiles of perplexity by language, and by length,
over all trusted documents of the other half.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard.llm.common import dropped, filesystem, fresh, pieces, staged, worker_cache

MAX_WORDS = 1 << 18
#: Parts, by hash of their last two words, in which trigrams are joined with bigrams, so that only one lies in shuffle
#: files at a time; compression of the stored tables.
PARTS, CODEC = 4, "zstd"
SHARD_ROWS = 1 << 20
#: Rows of both tables together that a worker keeps in memory; bytes of text that go through the shards of larger ones at once.
HELD_ROWS, CHUNK = 12 * SHARD_ROWS, 1 << 23
#: Share of trusted documents that lies between the thresholds, and how much further out, as a share of the distance
#: from the median, a document has to be to be rejected.
QUANTILE, MARGIN = 0.995, 0.4
#: A language and length with fewer trusted documents takes the thresholds of its language, or else of all.
LEAST_TRUSTED = 100
#: Steps in which thresholds are set: so many to a unit of mean negative log probability.
BINS = 200
BITS = 21
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Ids below ``FIRST_WORD``: begin, end and the shape classes.
BEGIN, END, LOWER, TITLE, UPPER, MIXED, NUMBER, SIGN = range(8)
FIRST_WORD = 8


def shape(token: str) -> int:
    """The class of a token outside the vocabulary."""
    if token[0].isalpha():
        if token.islower():
            return LOWER
        if token.isupper() and len(token) > 1:
            return UPPER
        return TITLE if token[0].isupper() and (len(token) == 1 or token[1:].islower()) else MIXED
    return NUMBER if token[0].isdigit() else SIGN


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text or "")


def _ids(tokens: list[str], vocab: dict[str, int]) -> np.ndarray:
    """Ids of tokens between two begins and an end."""
    get = vocab.get
    ids = [BEGIN, BEGIN, *(get(t) or shape(t) for t in tokens), END]
    return np.array(ids, np.int64)


#: Kinds of characters that tokens are runs of (see ``TOKEN``); white space is kind 0.
KINDS = (r"[^\W\d_]+", r"\d+", r"[^\w\s]+", r"_+")
#: Characters that are encoded at once; different weights of places in a token's hash (a power of 2).
ENCODED, PLACES = 1 << 18, 1 << 12


def _kinds() -> np.ndarray:
    """The kind of each code point, worked out once in a worker process."""
    cache = worker_cache("kinds of characters")
    if "kinds" not in cache:
        every = "".join(map(chr, range(sys.maxunicode + 1)))
        kinds = np.zeros(len(every), np.uint8)
        for kind, run in enumerate(KINDS, 1):
            for found in re.finditer(run, every):
                kinds[found.start() : found.end()] = kind
        cache["kinds"] = kinds
    return cache["kinds"]


class _Encoder:
    """``_ids`` of many texts at once in arrays.

    Tokens are runs of one kind of characters. A token is found in the vocabulary by a hash and then compared with the
    word it found, character by character, so ids are those of a dictionary.
    """

    def __init__(self, vocab: dict[str, int]):
        self.kinds = _kinds()
        words = list(vocab)
        ids = np.fromiter(vocab.values(), np.int64, len(words))
        code, starts, sizes, _ = self._runs("\n".join(words))
        for seed in count(1):
            self.weights = np.random.default_rng(seed).integers(1, 1 << 63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)
            hashes = self._hashes(code, starts, sizes)[0]
            order = np.argsort(hashes)
            self.hashes = hashes[order]
            if (self.hashes[1:] != self.hashes[:-1]).all():
                break
        self.code, self.at, self.sizes, self.word_ids = code, starts[order], sizes[order], ids[order]

    def _runs(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points in tokens, where among them each token starts, its length, and where it starts in ``text``."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kinds[code]
        first = kind != 0
        inside = np.flatnonzero(first)
        first[1:] &= kind[1:] != kind[:-1]
        starts = np.flatnonzero(first[inside])
        return code[inside], starts, np.diff(starts, append=len(inside)), inside[starts]

    def _hashes(self, code: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each token, and each character's place in its token."""
        place = np.arange(len(code)) - np.repeat(starts, sizes)
        if not len(code):
            return np.empty(0, np.uint64), place
        return np.add.reduceat(code * self.weights[place & (PLACES - 1)], starts), place

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(texts)
        code, starts, sizes, where = self._runs(text)
        hashes, place = self._hashes(code, starts, sizes)
        ids = np.zeros(len(starts), np.int64)
        if len(self.hashes):
            order = np.argsort(hashes)  # in order each is found close to the one before
            at = np.empty(len(hashes), np.int64)
            at[order] = np.searchsorted(self.hashes, hashes[order])
            at = np.minimum(at, len(self.hashes) - 1)
            like = (self.hashes[at] == hashes) & (self.sizes[at] == sizes)
            own = np.repeat(like, sizes)
            differs = self.code[(np.repeat(self.at[at], sizes) + place)[own]] != code[own]
            if differs.any():
                like[np.repeat(np.arange(len(starts)), sizes)[own][differs]] = False
            ids[like] = self.word_ids[at[like]]
        rest = np.flatnonzero(ids == 0)
        begin, end = where[rest], where[rest] + sizes[rest]
        ids[rest] = [shape(text[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        n = np.diff(np.searchsorted(where, bounds))
        full = n > 0
        out = np.full(len(ids) + 3 * int(full.sum()), BEGIN, np.int64)
        rank = np.cumsum(full) - 1
        out[np.arange(len(ids)) + np.repeat(3 * rank + 2, n)] = ids
        out[np.cumsum(n[full] + 3) - 1] = END
        return out, n + full

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``_ids`` of ``texts`` one after the other, without texts that have no token, and how many ids each text has
        after its begins; about ``ENCODED`` characters at a time."""
        some: list[str] = []
        size = 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > ENCODED:
                yield self._encoded(some)
                some, size = [], 0
        if some:
            yield self._encoded(some)


def _vocabulary(trusted: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Ids of the most frequent words seen twice or more, and how many kinds of words each class stands for."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                seen.update(tokens_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
        )

    counts = staged(
        trusted.select("text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    order = [F.col("n").desc(), F.col("word")]
    words = [r.word for r in counts.where("n > 1").orderBy(*order).limit(MAX_WORDS).toLocalIterator()]
    vocab = {w: FIRST_WORD + k for k, w in enumerate(words)}

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [0] * FIRST_WORD
        for batch in batches:
            for word in batch.column(0).to_pylist():
                found[shape(word)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(FIRST_WORD)), pa.array(found)], names=["kind", "n"])

    rare = counts.where("n = 1").select("word").mapInArrow(classes, "kind long, n long")
    kinds = np.ones(FIRST_WORD)
    for r in rare.groupBy("kind").agg(F.sum("n").alias("n")).collect():  # a row a class
        kinds[r.kind] = max(1, r.n) if r.kind >= LOWER else 1
    dropped(counts)
    return vocab, kinds


def _discounts(n1: float, n2: float, n3: float, n4: float) -> list[float]:
    """The discounts of counts of 1, 2 and 3 or more, from the counts of counts."""
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0]
    return [min(max(d, 0.05), k) for k, d in zip((0.95, 1.95, 2.95), found, strict=True)]


def _discounts_of(counts: DataFrame) -> list[float]:
    of = counts.agg(*(F.sum((F.col("n") == k).cast("double")) for k in range(1, 5))).first()
    return _discounts(*(x or 0.0 for x in of))


def _discount(n: Column, d: list[float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _with_context(counts: DataFrame) -> DataFrame:
    """``counts(key, n)`` of trigrams and, of each one's context, ``total``, how many of its trigrams were counted once
    (``once``), twice and more often (``twice``, ``more``), and a mark on one of them (``lead``).

    A context has a row for each word that follows it, at most as many as there are words.
    """
    whole = Window.partitionBy(F.shiftright("key", BITS))
    n = F.col("n")
    of = {"total": F.sum(n), "once": F.count(F.when(n == 1, 1)), "twice": F.count(F.when(n == 2, 1)), "more": F.count(F.when(n > 2, 1))}
    return counts.select(
        "key", "n", *(c.over(whole).alias(name) for name, c in of.items()), (F.min("key").over(whole) == F.col("key")).alias("lead")
    )


def _rest(d: list[float]) -> Column:
    """The share of a context's total count that its discounts set free."""
    return (F.col("once") * d[0] + F.col("twice") * d[1] + F.col("more") * d[2]) / F.col("total")


def fit(trusted: DataFrame) -> dict:
    """The model of ``trusted(text)``: vocabulary, and arrays of log probabilities and backoff weights by n-gram.

    Bigrams and trigrams are sorted by key; a key packs the ids in ``BITS`` bits each. Tables in between are deleted
    as soon as nothing reads them any more.
    """
    spark = trusted.sparkSession
    trusted = staged(trusted.select("text"), "trusted")
    vocab, kinds = _vocabulary(trusted)
    shared = spark.sparkContext.broadcast(vocab)

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared.value)
        for batch in pieces(batches):
            keys = [np.empty(0, np.int64)]
            for x, _ in encoder.encode(batch.column(0).to_pylist()):
                packed = (x[:-2] << (2 * BITS)) | (x[1:-1] << BITS) | x[2:]
                keys.append(packed[x[2:] != BEGIN])  # none reaches into the next text
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys))], names=["key"])

    mask = F.lit((1 << (2 * BITS)) - 1)
    word = F.lit((1 << BITS) - 1)
    c3 = trusted.select("text").mapInArrow(trigrams, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    c3 = staged(_with_context(c3), "trigrams", CODEC)
    dropped(trusted)
    low = F.col("key").bitwiseAND(mask)
    c2 = staged(c3.groupBy(low.alias("key")).agg(F.count(F.lit(1)).alias("n")), "bigrams", CODEC)
    c1 = c2.groupBy(F.col("key").bitwiseAND(word).alias("key")).agg(F.count(F.lit(1)).alias("n")).toPandas()

    # words: bounded by the vocabulary
    size = FIRST_WORD + len(vocab)
    n = np.zeros(size)
    n[c1["key"].to_numpy(np.int64)] = c1["n"].to_numpy()
    d1 = _discounts(*(float((n == k).sum()) for k in range(1, 5)))
    total = max(n.sum(), 1.0)
    cut = np.where(n == 0, 0.0, np.where(n == 1, d1[0], np.where(n == 2, d1[1], d1[2])))
    rest = cut.sum() / total if n.any() else 1.0
    p1 = (n - cut) / total + rest / (size - 1)  # every id but the begin
    p1[BEGIN] = 0.0
    unigrams = spark.createDataFrame(list(enumerate(p1.tolist())), "last long, p1 double")

    d2, d3 = _discounts_of(c2), _discounts_of(c3)
    first2 = F.shiftright("key", BITS)
    c = F.col("n")
    x2 = staged(
        c2.groupBy(first2.alias("context")).agg(F.sum(c).alias("total"), F.sum(_discount(c, d2)).alias("freed"))
        .select("context", "total", (F.col("freed") / F.col("total")).alias("rest")),
        "contexts",
    )
    p2 = c2.withColumn("context", first2).join(x2, "context").withColumn("last", F.col("key").bitwiseAND(word))
    p2 = p2.join(unigrams, "last").select(
        "key",
        ((F.col("n") - _discount(F.col("n"), d2)) / F.col("total") + F.col("rest") * F.col("p1")).alias("p"),
    )
    p2 = staged(p2, "bigram-p", CODEC)
    backoff1 = np.zeros(size, np.float32)
    got = x2.toPandas()
    backoff1[got["context"].to_numpy(np.int64)] = np.log(got["rest"].to_numpy())
    dropped(c2, x2)
    # a trigram's row knows its context's counts, so it only meets its last two words' probability, a part at a time
    p3 = []
    for k in range(PARTS):
        own = c3.where(_part(low) == k).select(
            "key", ((c - _discount(c, d3)) / F.col("total")).alias("own"), _rest(d3).alias("rest")
        )
        of = p2.where(_part(F.col("key")) == k).select(F.col("key").alias("low"), F.col("p").alias("p2"))
        part = own.join(of, low == F.col("low")).select(
            "key", F.log(F.col("own") + F.col("rest") * F.col("p2")).cast("float").alias("p")
        )
        p3.append(staged(part, "trigram-p", CODEC))
    x3 = staged(c3.where("lead").select(F.shiftright("key", BITS).alias("key"), _rest(d3).alias("rest")), "contexts", CODEC)
    dropped(c3)
    trigram_shards = _shards("trigram-shards", *p3)
    bigrams = p2.join(x3, "key", "full").select(
        "key", F.log("p").cast("float").alias("p"), F.coalesce(F.log("rest"), F.lit(0.0)).cast("float").alias("back")
    )
    bigrams = staged(bigrams, "bigram-p", CODEC)
    dropped(p2, x3)
    with np.errstate(divide="ignore"):
        log1 = np.log(p1).astype(np.float32)
    log1[BEGIN] = 0.0
    tables = {"bigrams": _shards("bigram-shards", bigrams), "trigrams": trigram_shards}
    return {
        "held": sum(rows for _, rows in tables.values()) <= HELD_ROWS,
        "vocab": shared, "spread": -np.log(kinds).astype(np.float32), "p1": log1, "back1": backoff1,
        **{k: shards for k, (shards, _) in tables.items()},
    }


def _part(key: Column) -> Column:
    """Which of ``PARTS`` a bigram belongs to."""
    return F.pmod(F.xxhash64(key), F.lit(PARTS))


def _shards(name: str, *tables: DataFrame) -> tuple[list[str], int]:
    """Write stored ``tables`` as files of about ``SHARD_ROWS`` rows, each a range of keys in order; the files and all rows.

    The tables are deleted after it.
    """
    rows = reduce(DataFrame.unionByName, tables)
    n = rows.count()
    parts = max(1, -(-n // SHARD_ROWS))
    found = staged(rows.repartitionByRange(parts, "key").sortWithinPartitions("key"), name, CODEC).inputFiles()
    dropped(*tables)
    return found, n


def _read(paths: list[str]) -> Iterator[list[np.ndarray]]:
    """The columns of each shard that holds rows, one shard after the other."""
    for file in paths:
        fs, path = filesystem(file)
        table = pq.read_table(path, filesystem=fs)
        if table.num_rows:
            yield [c.to_numpy().copy() for c in table.columns]
        del table
        pa.default_memory_pool().release_unused()


def _loaded(paths: list[str], kind: str, held: bool) -> Iterable[list[np.ndarray]]:
    """The columns of each shard that holds rows; a worker process reads them once if they are ``held``."""
    if not held:
        return _read(paths)
    cache = worker_cache(f"n-gram shards {kind}")
    if cache.get("files") != paths:
        cache.update(files=paths, shards=list(_read(paths)))
    return cache["shards"]


def _look_up(keys: np.ndarray, shards: Iterable[list[np.ndarray]], width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Whether each key is in the sharded table, and the values of those that are (0 for the others).

    Keys are put in order first: those of a shard then lie together, and each is found close to the one before.
    """
    found = np.zeros(len(keys), bool)
    values = [np.zeros(len(keys), np.float32) for _ in range(width)]
    order = np.argsort(keys)
    keys = keys[order]
    for table, *columns in shards:
        begin, end = np.searchsorted(keys, table[0]), np.searchsorted(keys, table[-1], "right")
        k = keys[begin:end]
        at = np.searchsorted(table, k)
        hit = table[at] == k
        rows = order[begin:end][hit]
        found[rows] = True
        for v, c in zip(values, columns, strict=True):
            v[rows] = c[at[hit]]
    return found, values


def log_probabilities(ids: np.ndarray, model: dict) -> np.ndarray:
    """Natural log probability of each id after the first two; ``ids`` may hold several texts one after the other."""
    u, v, w = ids[:-2], ids[1:-1], ids[2:]
    pairs = (ids[:-1] << BITS) | ids[1:]
    known, (p2, back2) = _look_up(pairs, _loaded(model["bigrams"], "2", model["held"]), 2)
    low = np.where(known[1:] & ~np.isnan(p2[1:]), p2[1:], model["back1"][v] + model["p1"][w])
    out = back2[:-1] + low  # an unknown context has weight 1
    ask = np.flatnonzero(known[:-1] & known[1:])
    triples = (u[ask] << (2 * BITS)) | (v[ask] << BITS) | w[ask]
    hit, (p3,) = _look_up(triples, _loaded(model["trigrams"], "3", model["held"]), 1)
    out[ask[hit]] = p3[hit]
    special = w < FIRST_WORD
    out[special] += model["spread"][w[special]]
    return out


def _score_texts(texts: list[str | None], model: dict, encoder: _Encoder) -> list[tuple[int, float | None]]:
    """Tokens (with the end) and mean negative log probability of each text; None without tokens."""
    out: list[tuple[int, float | None]] = []
    held: list[np.ndarray] = []
    sizes: list[int] = []

    def flush() -> None:
        ids = np.concatenate(held)
        p = log_probabilities(ids, model) if len(ids) else ids
        at = 0
        for n in sizes:
            if n:
                out.append((n, -float(p[at : at + n].sum(dtype=np.float64)) / n))
                at += n + 2
            else:
                out.append((0, None))
        held.clear()
        sizes.clear()

    pending = 0
    for ids, n in encoder.encode(texts):
        held.append(ids)
        sizes.extend(n.tolist())
        pending += len(ids)
        if model["held"] and pending > 100_000:
            flush()
            pending = 0
    if held:
        flush()
    return out


def with_perplexity(
    docs: DataFrame, model: dict, text_col: str, tokens_name: str, nll_name: str, keep_text: bool = True
) -> DataFrame:
    """All columns of ``docs`` (the text if asked) with the tokens and the mean negative log probability of its text."""
    at = docs.columns.index(text_col)
    out = [k for k in range(len(docs.columns)) if keep_text or k != at]

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces as they come or, if the shards have to be read for each, put together to ``CHUNK`` bytes of text."""
        some: list[pa.RecordBatch] = []
        size = 0
        for batch in pieces(batches):
            some.append(batch)
            size += batch.column(at).nbytes
            if model["held"] or size > CHUNK:
                yield pa.concat_batches(some)
                some, size = [], 0
        if some:
            yield pa.concat_batches(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(model["vocab"].value)
        for batch in taken(batches):
            n, nll = zip(*_score_texts(batch.column(at).to_pylist(), model, encoder), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in out), pa.array(n, pa.int64()), pa.array(nll, pa.float64())],
                names=[*(batch.schema.names[k] for k in out), tokens_name, nll_name],
            )

    fields = [T.StructField(tokens_name, T.LongType()), T.StructField(nll_name, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*(docs.schema.fields[k] for k in out), *fields]))


def _half(id_col: str) -> Column:
    """0 for ids that the model may be fitted on."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(2))


def _band(tokens: Column) -> Column:
    """Length classes: each four times as long as the one before; beyond 4096 tokens one."""
    return F.least(F.floor(F.log2(F.greatest(tokens, F.lit(1))) / 2), F.lit(6)).cast("int")


def _limits(calibration: DataFrame, keys: list[str], quantile: float, margin: float) -> DataFrame:
    """``low, high, n`` of ``nll`` for each group of ``keys``, from counts of values rounded to ``BINS`` a unit.

    The counts of a group are a few thousand rows at most, however many documents it has.
    """
    step = calibration.where("nll is not null").groupBy(*keys, F.round(F.col("nll") * BINS).cast("long").alias("bin"))
    counts = step.agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    seen = counts.withColumn("seen", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(whole))

    def at(q: float) -> Column:
        return F.min(F.when(F.col("seen") >= F.col("n") * q, F.col("bin"))) / BINS

    found = seen.groupBy(*keys).agg(
        F.first("n").alias("n"), at(1 - quantile).alias("q0"), at(0.5).alias("q5"), at(quantile).alias("q1")
    )
    return found.select(
        *keys, "n", (F.col("q0") - margin * (F.col("q5") - F.col("q0"))).alias("low"),
        (F.col("q1") + margin * (F.col("q1") - F.col("q5"))).alias("high"),
    )


def thresholds(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    max_trusted: int | None = None, quantile: float = QUANTILE, margin: float = MARGIN,
) -> tuple[dict, DataFrame, DataFrame]:
    """The model, ``id, lang, tokens, nll`` of all rows of ``docs``, and ``lang, band, low, high``.

    Trusted are documents with a label of quality 1 and toxic 0. Every second one by hash is fitted on (a caller
    may set ``max_trusted``); all others set the thresholds. A null language is a language of its own.
    """
    good = labels.where("quality = 1 and toxic = 0").select(F.col("doc_id").alias("good_id")).distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    read = rows.where(_half("id") == 0)
    fitted = good.where(_half("good_id") == 0)
    if max_trusted is not None:
        # those that are fitted on are chosen by id alone, then their texts are fetched
        there = fitted.join(read.select(F.col("id").alias("good_id")).distinct(), "good_id")
        fitted = staged(there.orderBy(F.xxhash64("good_id", F.lit(1)), "good_id").limit(max_trusted), "fitted")
    trusted = read.join(fitted, read["id"] == fitted["good_id"], "left_semi").select("text")
    model = fit(trusted)

    scored = staged(with_perplexity(rows, model, "text", "tokens", "nll", keep_text=False), "scored")
    banded = scored.select("id", "lang", _band(F.col("tokens")).alias("band"), "nll")
    calibration = banded.join(good, banded["id"] == good["good_id"], "left_semi")
    calibration = calibration.join(fitted, calibration["id"] == fitted["good_id"], "left_anti")
    calibration = staged(calibration, "calibration")
    overall = _limits(calibration.withColumn("all", F.lit(0)), ["all"], quantile, margin).first()  # one row, or none
    limits = banded.select("lang", "band").distinct()
    for p, on in (("l", ["lang"]), ("b", ["lang", "band"])):
        found = _limits(calibration, on, quantile, margin).where(F.col("n") >= LEAST_TRUSTED)
        found = found.select(*(F.col(c).alias(f"{c}_{p}") for c in [*on, "low", "high"]))
        match = [limits[k].eqNullSafe(found[f"{k}_{p}"]) for k in on]
        limits = limits.join(found, match, "left")
    limits = limits.select(
        "lang", "band",
        *(
            F.coalesce(f"{c}_b", f"{c}_l", F.lit(overall[c] if overall else None).cast("double")).alias(c)
            for c in ("low", "high")
        ),
    )
    return model, scored, staged(limits, "limits")


def _judged(rows: DataFrame, limits: DataFrame, lang: str, tokens: str, nll: str, names: dict[str, str]) -> DataFrame:
    """``rows`` with their thresholds and ``keep``, all under ``names``."""
    limits = limits.select(*(F.col(c).alias(names[c]) for c in ("lang", "band", "low", "high")))
    match = F.col(lang).eqNullSafe(F.col(names["lang"])) & (_band(F.col(tokens)) == F.col(names["band"]))
    value = F.col(nll)
    inside = F.coalesce((value >= F.col(names["low"])) & (value <= F.col(names["high"])), F.lit(True))
    return rows.join(limits, match, "left").withColumn(names["keep"], value.isNotNull() & inside)


LIMIT_NAMES = ("lang", "band", "low", "high", "keep")


def quality(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_tokens, perplexity, low, high, keep`` for each document.

    ``keep`` is true between the thresholds, and for all texts with tokens if there are no thresholds at all (no
    trusted documents); a text without tokens (null, empty, blank) has no perplexity and is not kept. Repeated rows
    are judged alike, each kept or not. An empty table gives no rows; other columns are not read.
    """
    _, scored, limits = thresholds(docs, labels, **parameters)
    names = {n: f"limit_{n}" for n in LIMIT_NAMES}
    judged = _judged(scored, limits, "lang", "tokens", "nll", names)
    return judged.select(
        F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"), F.exp("nll").alias("perplexity"),
        F.exp("limit_low").alias("low"), F.exp("limit_high").alias("high"), F.col("limit_keep").alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", lang_col: str = "lang", **parameters) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their columns.

    Texts are scored once for the thresholds and once more on their way out, so that they are not stored in between.
    """
    model, _, limits = thresholds(docs, labels, text_col=text_col, lang_col=lang_col, **parameters)
    names = {n: fresh(docs, f"limit_{n}") for n in LIMIT_NAMES}
    tokens, nll = fresh(docs, "tokens"), fresh(docs, "nll")
    judged = _judged(with_perplexity(docs, model, text_col, tokens, nll), limits, lang_col, tokens, nll, names)
    return judged.where(F.col(names["keep"])).select(*docs.columns)
