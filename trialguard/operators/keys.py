"""Per-group numbering and "first row of a group" that stay balanced when one group is huge.

``grain_of`` cuts the rows of a subject into small grains: the order columns
themselves, and a coarse part of the input order, so that even all rows of one
subject on one date are many grains. Row counts (and whatever else is needed,
such as the first eligible row) are aggregated by grain, partially before any
shuffle. Windows then run over that small table only, and one join by grain
brings their results back to the rows, where rows are numbered within their
grain. Everything is a function of the data, so a recomputed task gives the
same numbers.

Where rows are read from a stored table they are counted first: a subject, or a
subject's test, of up to ``CROWDED`` rows is then one grain (``cells_of``), and
only larger ones are cut. The table of grains is much smaller that way.

Rows that are not stored can be counted by subject before they are dealt out:
``apart`` splits off the crowded subjects, and all others need no grains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Column of the coarse input order; rows that share it number at most about a thousand for readers' RECNO.
PART = "_part"
#: Rows that one task may sort as one grain.
CROWDED = 100_000
_MARK = "_crowded"


def coarse_order(df: DataFrame, recno: str = "RECNO") -> Column:
    """A value that never falls as ``recno`` rises, shared by about a thousand neighbouring rows.

    Numbers are cut by 1024. Text as the readers make it (a path, ``#`` and 20 digits) loses its last three
    digits; any other text has one value for all rows.
    """
    kind = dict(df.dtypes)[recno]
    if kind in ("int", "bigint", "smallint", "tinyint"):
        return F.shiftright(F.col(recno).cast("long"), 10)
    return F.regexp_extract(F.col(recno).cast("string"), r"(?s)^(.*#\d{17})\d{3}$", 1)


def grain_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with the coarse input order, and the columns of its grain; ``order`` columns must not be NULL."""
    return df.withColumn(PART, coarse_order(df)), [*keys, *order, PART]


def crowded(df: DataFrame, cell: Sequence[str]) -> DataFrame:
    """The values of ``cell`` that more than ``CROWDED`` rows share: at most one in so many rows."""
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > CROWDED).select(*cell)


def cells_of(df: DataFrame, keys: Sequence[str], order: Sequence[str], many: DataFrame) -> tuple[DataFrame, list[str]]:
    """``grain_of`` for the cells ``many`` (see ``crowded``); every other cell is one grain.

    A cell is ``keys`` and, perhaps, the first of ``order``. The rows of other cells have constants in place of what
    cuts grains, so each grain still lies in one piece of the order.
    """
    cell = many.columns
    df, _ = grain_of(df, keys, order)
    df = df.join(F.broadcast(many.withColumn(_MARK, F.lit(True))), cell, "left")  # bounded: rows / CROWDED
    kinds = dict(df.dtypes)
    cut = {
        c: F.when(F.col(_MARK), F.col(c)).otherwise(F.lit("1970-01-01" if kinds[c] == "date" else "0").cast(kinds[c]))
        for c in (*order, PART) if c not in cell
    }
    df = df.withColumns({f"{PART}_{c}": value for c, value in cut.items()}).drop(_MARK, PART)
    return df, [f"{PART}_{c}" if c in cut else c for c in (*keys, *order, PART)]


def apart(df: DataFrame, key: Column, many: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` is not among the values ``many`` (one column, as few as ``crowded`` gives), and those whose is.

    ``key`` must not be NULL. Rows stay where they are.
    """
    listed = F.broadcast(many.toDF(_MARK))  # bounded: rows / CROWDED
    return tuple(df.join(listed, key == F.col(_MARK), kind) for kind in ("left_anti", "left_semi"))


def rows_before(keys: Sequence[str], grain: Sequence[str], n: str) -> Column:
    """Rows of earlier grains of the same ``keys`` group, over a table with one row per grain."""
    order = [c for c in grain if c not in keys]
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


def place_in_grain(grain: Sequence[str], order: Sequence[str]) -> Column:
    """1, 2, ... within a grain, by those columns of ``order`` that are not its own and then input order."""
    return F.row_number().over(Window.partitionBy(*grain).orderBy(*[c for c in order if c not in grain], "RECNO"))


def added(grain: Sequence[str]) -> list[str]:
    """The columns of a grain that are not the rows' own."""
    return [c for c in grain if c.startswith(PART)]


def sequence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, many: DataFrame | None = None
) -> DataFrame:
    """Add ``name`` = 1, 2, ... within ``keys``, by ``order`` and then input order; ``many`` as in ``cells_of``."""
    df, grain = grain_of(df, keys, order) if many is None else cells_of(df, keys, order, many)
    counts = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_before", rows_before(keys, grain, "_n")).drop("_n")
    out = df.join(offsets, grain)
    number = (F.col("_before") + place_in_grain(grain, order)).cast("int")
    return out.withColumn(name, number).drop("_before", *added(grain))


def group_first_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: dict[str, Column],
    where: Column | None = None,
) -> DataFrame:
    """Add columns ``values`` taken from the first row (by ``order``) of each ``keys`` group among
    rows satisfying ``where``; NULL for groups without such a row."""
    cand = df if where is None else df.filter(where)
    winner = F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[v.alias(k) for k, v in values.items()]))
    firsts = cand.groupBy(*keys).agg(winner.alias("_w")).select(*keys, *[F.col(f"_w.{k}").alias(k) for k in values])
    return df.join(firsts, list(keys), "left")
