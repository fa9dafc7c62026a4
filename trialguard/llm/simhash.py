"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits; two texts are linked when their fingerprints differ in at most ``max_bits`` bits. The
fingerprint is cut into four segments on a ring. By the pigeonring principle a pair within the limit has a segment i
from which every run of l consecutive segments differs in at most floor(l * max_bits / 4) bits. For the limit of 3 the
budgets are 0, 1, 2 and 3: segment i is equal and segment i+1 differs in at most one bit. That two-segment chain is
an exact key: every fingerprint is filed under (i, segment i, segment i+1), and those whose segment i+1 has even
parity also visit the 16 keys with one bit of it flipped, so that a pair one bit apart meets exactly once. The rest
of the chain is checked before the full Hamming distance.

Skew: copies share one fingerprint and only distinct fingerprints are filed. A key with more than ``cell_rows``
fingerprints is cut into chunks, and each pair of chunks is a cell of its own, in another task; a cell returns a
spanning forest of its links, never all pairs. Components come from ``components.connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard.llm.common import append_column, fresh, staged
from trialguard.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 4
WIDTH = 64 // SEGMENTS
CELL_ROWS = 512
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text as a signed 64-bit integer; 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and exactly the white space U+0009-U+000D and space
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < shingle_words:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(s), 42) for s in zip(*(words[k:] for k in range(shingle_words)), strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        raw = np.frombuffer(b"".join(hashes[at : at + BLOCK]), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` and a column ``name`` with each text's fingerprint (null and empty texts: 0)."""
    return append_column(
        docs, text_col, name, T.LongType(), pa.int64(), lambda texts: [fingerprint(t, shingle_words) for t in texts]
    )


def _segment(column: str, k: int):
    return F.shiftrightunsigned(F.col(column), (k % SEGMENTS) * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _filed(prints: DataFrame) -> DataFrame:
    """``key, fp, home`` rows: each fingerprint under its own key of each segment, or under a key one bit away."""
    one_off = F.array(*(F.lit(x) for x in [0] + [1 << b for b in range(WIDTH)]))

    def keys(k: int):
        first, second = _segment("fp", k), _segment("fp", k + 1)
        base = F.lit(k << (2 * WIDTH)).bitwiseOR(F.shiftleft(first, WIDTH))
        flips = F.when(F.bit_count(second) % 2 == 0, one_off).otherwise(F.array(F.lit(0)))
        return F.transform(
            flips, lambda x: F.struct(base.bitwiseOR(second.bitwiseXOR(x)).alias("key"), (x == 0).alias("home"))
        )

    parts = [keys(k) for k in range(SEGMENTS)]
    rows = prints.select("fp", F.explode(F.concat(*parts)).alias("x"))
    return rows.select("x.key", "fp", "x.home")


def _cells(filed: DataFrame, cell_rows: int) -> DataFrame:
    """Rows with their cell ``key, p, q`` and chunk ``own``; one cell (0, 0) for a key that is not large."""
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any_home"))
    met = sizes.where("n > 1 and any_home")
    cut = filed.join(met.select("key", F.ceil(F.col("n") / cell_rows).cast("int").alias("chunks")), "key")
    own = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return other.select(
        "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fp", "home"
    )


def _links(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether pairs of fingerprints pass the chain of some segment and then the full distance."""
    x = a ^ b
    mask = np.uint64((1 << WIDTH) - 1)
    diff = [np.bitwise_count((x >> np.uint64(k * WIDTH)) & mask).astype(np.int16) for k in range(SEGMENTS)]
    passed = np.zeros(x.shape, bool)
    for k in range(SEGMENTS):
        total, ok = np.zeros(x.shape, np.int16), np.ones(x.shape, bool)
        for length in range(1, SEGMENTS + 1):
            total = total + diff[(k + length - 1) % SEGMENTS]
            ok &= total <= length * max_bits // SEGMENTS
        passed |= ok
    passed[passed] = np.bitwise_count(x[passed]) <= max_bits
    return passed


def _forest(fp: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each row to the first row of its component in the symmetric matrix ``linked``."""
    label = np.arange(len(fp))
    while True:
        least = np.where(linked, label[None, :], len(fp)).min(axis=1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(fp))
    return fp[moved], fp[label[moved]]


def _edges(max_bits: int):
    def search(fp: np.ndarray, home: np.ndarray, own: np.ndarray, start: np.ndarray, stop: np.ndarray):
        """Links of whole cells, which are the row ranges ``start:stop``."""
        size = stop - start
        small = size <= 32
        group_end = np.repeat(stop, size)
        fine = np.repeat(small, size)
        alone = np.repeat(own[start] == own[stop - 1], size) if len(start) else fine
        rows = np.flatnonzero(fine)
        step = 1
        while len(rows):
            rows = rows[rows + step < group_end[rows]]
            other = rows + step
            ok = (home[rows] | home[other]) & (alone[rows] | (own[rows] != own[other]))
            i, j = rows[ok], other[ok]
            hit = _links(fp[i], fp[j], max_bits)
            yield fp[i[hit]], fp[j[hit]]
            step += 1
        for s, e in zip(start[~small], stop[~small], strict=True):
            f, h = fp[s:e], home[s:e]
            linked = _links(f[:, None], f[None, :], max_bits) & (h[:, None] | h[None, :])
            yield _forest(f, linked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def out(table: pa.Table, last: bool):
            key, p, q = (table.column(c).to_numpy() for c in ("key", "p", "q"))
            n = len(key)
            if not n:
                return table, []
            new = np.flatnonzero((key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
            start = np.concatenate([[0], new])
            stop = np.concatenate([new, [n]])
            if not last:
                start, stop = start[:-1], stop[:-1]
            fp = table.column("fp").to_numpy().view(np.uint64)
            home = table.column("home").to_numpy(zero_copy_only=False)
            got = list(search(fp, home, table.column("own").to_numpy(), start, stop))
            rest = table.slice(int(stop[-1]) if len(stop) else 0)
            return rest, [
                pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
                for a, b in got
                if len(a)
            ]

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rest, found = out(pa.concat_tables(held).combine_chunks(), False)
            held = [rest]
            yield from found
        if held:
            yield from out(pa.concat_tables(held).combine_chunks(), True)[1]

    return run


def linked_prints(prints: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``prints(fp)`` that connect all pairs within the limit."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the key of two segments holds for a limit of up to 3 bits")
    cells = _cells(staged(_filed(prints), "filed"), cell_rows)
    ordered = cells.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "own", "fp")
    return ordered.mapInArrow(_edges(max_bits), "a long, b long")


def fingerprint_components(
    docs: DataFrame, id_col: str, fp_col: str, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``fp, component_id``: for each distinct fingerprint the smallest id reachable over links.

    Rows whose id is null take part as links but are never the smallest id; a component of only such rows has a null
    component id.
    """
    prints = staged(
        docs.groupBy(F.col(fp_col).alias("fp")).agg(F.min(F.col(id_col)).alias("least")), "fingerprints"
    )
    links = linked_prints(prints.select("fp"), max_bits, cell_rows)
    groups = connected_components(links).select(F.col("node").alias("fp"), F.col("component"))
    labelled = staged(
        prints.join(groups, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")),
        "labelled",
    )
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return labelled.join(least, "component").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``id_col, fingerprint, component_id`` for each row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits. Null, empty and blank texts have fingerprint zero and are linked like
    any other. Repeated rows and ids give one row each; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = with_fingerprint(rows, "text", "fp").select("id", "fp")
    marked = staged(marked, "marked")
    found = fingerprint_components(marked, "id", "fp", **limits)
    return marked.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id (null ids last; of rows with
    that id any one).

    Only ids, fingerprints and hashes of texts are stored; the kept rows are then picked from ``docs`` by id and hash.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("tie")
    )
    marked = staged(with_fingerprint(rows, "text", "fp").select("id", "tie", "fp"), "marked")
    own = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("tie"))
    prints = staged(marked.groupBy("fp").agg(F.min(own).alias("least")), "fingerprints")
    groups = connected_components(linked_prints(prints.select("fp"), **limits))
    groups = groups.select(F.col("node").alias("fp"), F.col("component"))
    labelled = prints.join(groups, "fp", "left").select("least", F.coalesce("component", "fp").alias("component"))
    kept = labelled.groupBy("component").agg(F.min("least").alias("least")).select("least.*")
    # two components may have the same id and, by rows that are the same, never the same text
    tie, kept_id, kept_tie = fresh(docs, "tie"), fresh(docs, "kept_id"), fresh(docs, "kept_tie")
    kept = kept.select(F.col("id").alias(kept_id), F.col("tie").alias(kept_tie)).distinct()
    match = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(tie) == F.col(kept_tie))
    found = docs.withColumn(tie, F.xxhash64(F.col(text_col))).join(kept, match, "left_semi")
    return found.dropDuplicates([id_col, tie]).select(*docs.columns)
