"""Filter interaction audit by Lehmer-rank difference arrays.

Which of five filters a document fails is its mask. Applied in some order, the first filter of the order that is in the
mask removes it. Orders are numbered by Lehmer rank, their lexicographic place among all 120; orders that start alike
are neighbours, so the ranks at which a mask is removed at a given step are a few intervals. Documents are counted by
(part, mask); each count is added where an interval starts and taken off where it ends, and a running sum over the ranks
gives what every step of every order removes. Everything else follows from these sums and the counts by mask.

Documents are read once: conditions and a hash of the text are staged. The smallest id of each text and the labels
come by aggregates and joins on hash and id; a text that a third of the rows share is first counted by (hash, id), which
spreads it, and then by (hash, part, conditions), which leaves a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialguard.llm.common import SPACE, staged, words_of

FILTERS = "ABCDE"
#: The limits of filters A, B and C, and the characters of D.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 3, "[#$%&*|]"
#: The filter of repeated texts is decided after the others.
REPEATED = FILTERS.index("E")


def factorials(n: int) -> list[int]:
    return list(accumulate(range(1, n + 1), lambda a, b: a * b, initial=1))


def order_of(rank: int, items: str) -> str:
    """The order with this Lehmer rank: digits in the factorial base say which of the items left comes next."""
    left, order = list(items), []
    for size in reversed(factorials(len(items) - 1)):
        order.append(left.pop(rank // size))
        rank %= size
    return "".join(order)


def removal_intervals(mask: int, left: list[int], step: int = 1, at: int = 0) -> Iterator[tuple[int, int, int]]:
    """``step, first, end`` of the ranks at which a mask is removed at a step, over orders of ``left`` from ``at`` on."""
    size = factorials(len(left))[max(len(left) - 1, 0)]
    for digit, item in enumerate(left):
        first = at + digit * size
        if mask >> item & 1:
            yield step, first, first + size
        else:
            yield from removal_intervals(mask, [x for x in left if x != item], step + 1, first)


def changes(n: int) -> list[tuple[int, int, int, int]]:
    """``mask, step, rank, change``: where a mask's count is added (1) and taken off (-1); ends beyond all ranks are left out."""
    found: dict[tuple[int, int, int], int] = {}
    for mask in range(1 << n):
        for step, first, end in removal_intervals(mask, list(range(n))):
            for rank, change in ((first, 1), (end, -1)):
                found[mask, step, rank] = found.get((mask, step, rank), 0) + change
    last = factorials(n)[n]
    return [(*key, change) for key, change in sorted(found.items()) if change and key[2] < last]


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every step of every order of ``filters`` does, from ``counts(part, mask, n, good, toxic)``.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``: one row for each
    part, order and step. Bit k of a mask is filter k. No counts give no rows.
    """
    spark, n = counts.sparkSession, len(filters)
    last = factorials(n)[n]
    edges = spark.createDataFrame(changes(n), "mask int, step int, rank int, change int")
    moved = counts.join(edges, "mask").groupBy("part", "step", "rank").agg(
        *(F.sum(F.col(c) * F.col("change")).alias(c) for c in ("n", "good", "toxic"))
    )
    bit = [F.col("mask").bitwiseAND(1 << k) > 0 for k in range(n)]

    def sums(condition) -> Column:
        return F.array(*(F.coalesce(F.sum(F.when(condition(k), F.col("n"))), F.lit(0)) for k in range(n)))

    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"), sums(lambda k: bit[k]).alias("fails"),
        sums(lambda k: F.col("mask") == 1 << k).alias("alone"),
    )
    orders = F.array(*(F.lit(order_of(rank, filters)) for rank in range(last)))
    grid = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(last - 1))).alias("rank")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")
    )
    running = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    steps = grid.join(moved, ["part", "step", "rank"], "left").select(
        "part", "total", "fails", "alone", "rank", "step", F.element_at(orders, F.col("rank") + 1).alias("filter_order"),
        *(F.sum(F.coalesce(c, F.lit(0))).over(running).alias(name)
          for c, name in (("n", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))),
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    place = F.instr(F.lit(filters), letter)
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed",
        (F.element_at("fails", place) - F.col("removed")).alias("redundant"),
        F.element_at("alone", place).alias("unique_fails"), "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", letter)).alias("shapley"),
    )


def conditions(text: Column, words: Column) -> Column:
    """Mask of the filters that look at one text only; ``words`` are its words."""
    n = F.size(words)
    failed = [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text),
        text.rlike(SIGNS),
    ]
    return reduce(add, (F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed)))


def mask_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, those with quality 1 and those with toxic 1, by part and mask.

    Every row of ``docs`` counts. A text is repeated if the table has it with a smaller id, so rows that share the
    smallest id are not repeats of each other. A null text is empty; a null part is the part ``''``; a row with a null
    id is no repeat, makes none, and has no label. Of several labels of an id any 1 counts.
    """
    text = F.col("text")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).select("*", words_of(text).alias("words"))
    seen = rows.select("id", "part", conditions(text, F.col("words")).alias("mask"), F.unhex(F.sha2(text, 256)).alias("hash"))
    seen = staged(seen, "conditions").groupBy("hash", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col(id_col).alias("id")).agg(
        *(F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(name)
          for c, name in (("quality", "good"), ("toxic", "toxic")))
    ).where("good + toxic > 0")
    no_id = F.col("id").isNull()
    # rows without an id have no label: not joined, as one key would hold them all
    labelled = seen.where(~no_id).join(known, "id", "left").unionByName(seen.where(no_id), allowMissingColumns=True)
    groups = labelled.groupBy(
        "hash", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    ).agg(
        F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("n_first"),
        F.coalesce(F.sum(F.when(no_id, F.col("n"))), F.lit(0)).alias("n_no_id"),
    )
    smallest = F.min("first").over(Window.partitionBy("hash"))
    fresh_rows = F.col("n_no_id") + F.when(F.col("first") == smallest, F.col("n_first")).otherwise(0)
    split = groups.withColumn("fresh", fresh_rows).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
            F.struct((F.col("mask") + (1 << REPEATED)).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")),
        )).alias("of"),
    )
    return split.where("of.n > 0").groupBy("part", "of.mask").agg(
        F.sum("of.n").alias("n"), F.sum(F.col("of.n") * F.col("good")).alias("good"),
        F.sum(F.col("of.n") * F.col("toxic")).alias("toxic"),
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``audit`` of the five filters over ``docs``; see ``mask_counts`` for nulls, ties and repeated rows.

    Parts are the values of ``part_col``, each with all 120 orders of five steps, zeros included. An empty table has no
    parts and gives no rows; other columns are not read.
    """
    return audit(staged(mask_counts(docs, labels, id_col, text_col, part_col), "masks"))


SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
known AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN docs.doc_id > min(docs.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM docs LEFT JOIN known ON docs.doc_id = known.doc_id),
masks AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (
  SELECT part, filter_order, step::INT AS step, substr(filter_order, step, 1) AS letter, fails, n, good, toxic,
    -- the step that removes the documents of this mask; beyond the last if none does
    coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda i: contains(fails, substr(filter_order, i, 1)))), 9) AS gone
  FROM masks, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
totals AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (gone > step), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (gone = step), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (contains(fails, letter) AND gone < step), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (gone = step), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (gone = step), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM totals
"""
