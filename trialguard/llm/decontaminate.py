"""Benchmark decontamination with a generalised suffix automaton.

The automaton accepts every run of words of every benchmark item. Streaming a document's words through it gives, at
each word, the longest run ending there that some item contains. A run of at least ``window`` words (or a whole item,
if the item is shorter) marks its words as hit and names the items. Documents are read once and never shuffled.

Spark deals the items to shards of about ``SHARD_WORDS`` words, a file each in the shared folder, so one automaton has
a size bound however large the benchmark is and none passes through the driver. A task reads one shard and builds its
automaton once. With several shards the documents are read once for each, and the hits of a document are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard.llm.common import filesystem, fresh, pieces, shared_path, staged

WINDOW = 10
MAX_COVERAGE = 0.5
SHARD_WORDS = 500_000
#: A-Z to lower case; ASCII that is neither letter nor digit to space. All bytes of other characters belong to words.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


class ItemAutomaton:
    """Generalised suffix automaton over the words of items ``(item_id, text)``; ids are strings or null."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        runs = []
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            if ids:
                runs.append((item, ids))
                last = 0
                for t in ids:
                    last = self._extend(last, t)
        self._name_windows(runs)

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, v: int, t: int) -> int:
        """The state of the longest run of ``v`` followed by ``t``, made by cloning if it shares one with longer runs."""
        q = self.next[v][t]
        if self.length[q] == self.length[v] + 1:
            return q
        clone = self._state(self.length[v] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while v >= 0 and self.next[v].get(t) == q:
            self.next[v][t] = clone
            v = self.link[v]
        return clone

    def _extend(self, last: int, t: int) -> int:
        if t in self.next[last]:
            return self._split(last, t)
        new = self._state(self.length[last] + 1, 0, {})
        v = last
        while v >= 0 and t not in self.next[v]:
            self.next[v][t] = new
            v = self.link[v]
        if v >= 0:
            self.link[new] = self._split(v, t)
        return new

    def _name_windows(self, runs: list[tuple[str | None, list[int]]]) -> None:
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        #: for states of runs of at least a window: the ancestor state that holds the window itself
        self.top = [0] * len(self.link)
        for v in order:
            if self.length[v] >= self.window:
                self.top[v] = self.top[self.link[v]] if self.length[self.link[v]] >= self.window else v
        self.items: dict[int, set[str | None]] = {}
        short: set[int] = set()
        for item, ids in runs:
            v = 0
            for k, t in enumerate(ids, 1):
                v = self.next[v][t]
                if k >= self.window:
                    self.items.setdefault(self.top[v], set()).add(item)
            if len(ids) < self.window:
                short.add(v)
                self.items.setdefault(v, set()).add(item)
        #: nearest state on the way to the root, itself included, that is a whole short item
        self.short_up = [-1] * len(self.link)
        for v in order:
            self.short_up[v] = v if v in short else self.short_up[self.link[v]]
        self.least_run = min([self.window, *(self.length[v] for v in short)])
        self.any_short = bool(short)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Hit runs of words as disjoint ranges in order, and the items whose windows occur."""
        get = self.vocab.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        known = np.concatenate([[False], ids >= 0, [False]])
        ends = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)
        ranges, seen = [], set()
        for s, e in ends[ends[:, 1] - ends[:, 0] >= self.least_run].tolist():
            self._stream(ids[s:e].tolist(), s, ranges, seen)
        found: set[str | None] = set()
        for v in seen:
            found |= self.items[v]
        return _merge(ranges), found

    def _stream(self, ids: list[int], at: int, ranges: list[tuple[int, int]], seen: set[int]) -> None:
        nxt, link, length, window, any_short = self.next, self.link, self.length, self.window, self.any_short
        v = matched = 0
        for k, t in enumerate(ids, at):
            to = nxt[v].get(t)
            while to is None and v:
                v = link[v]
                matched = length[v]
                to = nxt[v].get(t)
            if to is None:
                continue
            v, matched = to, matched + 1
            if matched >= window:
                start = k - matched + 1
                if ranges and start <= ranges[-1][1] and ranges[-1][0] <= start:
                    ranges[-1] = (ranges[-1][0], k + 1)
                else:
                    ranges.append((start, k + 1))
                seen.add(self.top[v])
            if any_short:
                u = v if matched == length[v] else link[v]
                u = self.short_up[u]
                while u > 0:
                    ranges.append((k - length[u] + 1, k + 1))
                    seen.add(u)
                    u = self.short_up[link[u]]


def _shards(items: DataFrame, id_col: str, text_col: str, shard_words: int) -> list[list[str]]:
    """Files of ``item, text`` for each shard of about ``shard_words`` words; a shard has at least one item."""
    words = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(words > 0)
    n = -(-(rows.agg(F.sum(words)).first()[0] or 0) // shard_words)
    if not n:
        return []
    dealt = rows.distinct().withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int"))
    path = shared_path(items.sparkSession, "items")
    dealt.repartition("shard").write.partitionBy("shard").parquet(path)
    shards: dict[str, list[str]] = {}
    for file in sorted(items.sparkSession.read.schema(dealt.schema).parquet(path).inputFiles()):
        shards.setdefault(file.rsplit("/", 2)[1], []).append(file)
    return list(shards.values())


def _scanner(files: list[str], window: int):
    """A function from a text to ``(words, hit ranges, items)``; its automaton is built with the first text."""
    kept: list[ItemAutomaton] = []

    def scan(text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str | None]]:
        words = words_of(text)
        if not files:
            return len(words), [], set()
        if not kept:
            items = []
            for file in files:
                fs, path = filesystem(file)
                with fs.open_input_file(path) as opened:
                    table = pq.ParquetFile(opened).read(["item", "text"])
                items += zip(table.column("item").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(), strict=True)
            kept.append(ItemAutomaton(items, window))
        return len(words), *kept[0].hits(words)

    return scan


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _as_spans(found: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "stop": e} for s, e in ranges] for ranges in found], SPANS)


def _pass(files: list[str], window: int, whole: bool):
    """Rows ``rid, text`` to ``rid, n_words, items, spans`` under one shard; only those with hits unless ``whole``."""
    scan = _scanner(files, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [scan(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([list(i) for _, _, i in found], pa.list_(pa.string())), _as_spans([r for _, r, _ in found]),
                ],
                names=["rid", "n_words", "items", "spans"],
            )
            yield out if whole else out.filter(pa.array([bool(r) for _, r, _ in found], pa.bool_()))

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``rid, n_words, items, spans`` with overlapping spans made one."""
    for batch in pieces(batches):
        spans = [_merge([(s["start"], s["stop"]) for s in row]) for row in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], _as_spans(spans)], names=batch.schema.names)


def _hits(rows: DataFrame, shards: list[list[str]], window: int) -> DataFrame:
    """``rid, n_words, items, spans`` for each row of ``rows(rid, text)``; with several shards ``rid`` has to be a key."""
    kind = rows.schema["rid"].dataType.simpleString()
    schema = f"rid {kind}, n_words long, items array<string>, spans array<struct<start:long,stop:long>>"
    found = rows.mapInArrow(_pass(shards[0] if shards else [], window, True), schema)
    if len(shards) < 2:
        return found
    for files in shards[1:]:
        found = found.unionAll(rows.mapInArrow(_pass(files, window, False), schema))
    found = found.groupBy("rid").agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    return found.mapInArrow(_merged, schema)


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``id_col, n_words, n_hit, items, spans`` for each row of ``docs``.

    ``items`` are the different ids (as strings, sorted) with occurring windows, ``spans`` the hit ranges of word
    numbers. Null texts have no words; null and empty items have no windows. An item with a
    null id is named "null" and is another than one whose id is that text.
    Repeated rows give one row each, an empty table none; without items nothing is hit. Other columns are not read.
    """
    shards = _shards(items, item_col, item_text_col, shard_words)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if len(shards) < 2:
        found = _hits(rows.withColumnRenamed("id", "rid"), shards, window).withColumnRenamed("rid", "id")
    else:
        rows = staged(rows.withColumn("rid", F.monotonically_increasing_id()), "texts")
        found = rows.select("rid", "id").join(_hits(rows.select("rid", "text"), shards, window), "rid")
    names = F.array_sort(F.transform("items", lambda i: F.coalesce(i, F.lit("null"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), names.alias("items"), "spans")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest columns of ``contamination`` for each document."""
    found = contamination(docs, items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def cut(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """``text`` without the words in ``ranges`` and what stands between them; one space for each range."""
    lowered = text.lower()
    places = [m.span() for m in WORD.finditer(lowered)]
    out, at = [], 0
    for s, e in ranges:
        out.append(text[at : places[s][0]])
        at = places[e - 1][1]
    out.append(text[at:])
    return b" ".join(out)


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, max_coverage: float = MAX_COVERAGE, length_col: str = "n_chars",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without hit spans; rows whose hit words are more than ``max_coverage`` of all words go.

    All columns stay; ``length_col``, where there is one, gets the new number of characters of a changed text. Rows
    without hits pass unchanged, null texts too.
    """
    shards = _shards(items, item_col, item_text_col, shard_words)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(length_col) if length_col in docs.columns else None
    several = len(shards) > 1
    rows = docs
    if several:
        rid, spans = fresh(docs, "rid"), fresh(docs, "spans")
        rows = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "texts")
        hits = _hits(rows.select(F.col(rid).alias("rid"), F.col(text_col).alias("text")), shards, window)
        hits = hits.where(F.size("spans") > 0).select(F.col("rid").alias(rid), F.col("spans").alias(spans))
        rows = rows.join(hits, rid, "left").select(*docs.columns, spans)
    scan = _scanner(shards[0] if shards else [], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            columns = list(batch.columns)
            texts = columns[at].cast(pa.binary()).to_pylist()
            if several:
                ranges = [[(s["start"], s["stop"]) for s in row or []] for row in columns.pop().to_pylist()]
            else:
                ranges = [scan(text)[1] for text in texts]
            keep = np.ones(len(texts), bool)
            sizes = columns[size_at].to_pylist() if size_at is not None else None
            for j, own in enumerate(ranges):
                if not own:
                    continue
                if sum(e - s for s, e in own) > max_coverage * len(words_of(texts[j])):
                    keep[j] = False
                else:
                    texts[j] = cut(texts[j], own)
                    if sizes is not None:
                        sizes[j] = len(texts[j].decode())
            if any(ranges):
                columns[at] = pa.array(texts, pa.binary()).cast(columns[at].type)
                if sizes is not None:
                    columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[: len(columns)]).filter(pa.array(keep))

    return rows.mapInArrow(run, T.StructType(docs.schema.fields))


#: DuckDB: item windows and short items joined with all runs of the same length of each document.
SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
ks AS (SELECT DISTINCT k FROM wins),
runs AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS run
  FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM doc_words, ks WHERE len(w) >= k)),
found AS (SELECT r.rid, r.k, r.i, s.item_id FROM runs r JOIN wins s ON r.k = s.k AND r.run = s.run),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(generate_series(i, i + k - 1)) AS p FROM found) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""
