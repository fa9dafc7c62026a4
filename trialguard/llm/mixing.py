"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets share the words of all documents by weight; a target stops at ``max_repeats`` times its source and the excess
is shared again. Blocks of up to ``block_words`` words, all of one length that also counts the smallest target well,
are then allocated to sources by highest quotients ``weight / (2 * seats + 1)``. A source is cut into shards by a seeded hash of its documents, and the source's blocks
are apportioned to its shards in the same way, so each shard has an integer quota. In a shard, documents stand in
seeded order, and the words are cut into equal blocks; whole passes take all blocks, and what is left of the quota
takes a run of consecutive blocks from a seeded start. The documents on a block's border are taken in part.

Everything is DataFrame work. A source's shards number at most ``MAX_SHARDS`` and hold a share of its words each, so
neither the apportionment of one source nor the running sum of one shard is ever a whole source in one task; sources
are ranked in two steps (range partitions, then offsets). Which block a document lies in is arithmetic, so blocks are
never rows. Sums are over integers, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialguard.llm.common import SPACE, fresh, staged, words_of

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Words to a block, and the least number of blocks that the smallest target has to be worth (down to blocks of a word).
BLOCK_WORDS, LEAST_BLOCKS = 32, 64
SHARD_WORDS = 1 << 15
MAX_SHARDS = 1 << 16
SEED = 7


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with its row number (from 1) in ``order``: numbered in range partitions, then shifted by their offsets."""
    parts = staged(
        df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return parts.withColumn(name, own).join(offsets, "part").withColumn(name, F.col(name) + F.col("offset")).drop(
        "part", "offset"
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources(source_key, source_size)`` with ``target``: weights repeat in the order of the keys.

    A level is the words that one unit of weight gets. It rises while sources above ``max_repeats`` times their size
    are held there, until none is above; each step is one aggregate over the sources.
    """
    pattern = F.array(*(F.lit(w) for w in weights))
    weighed = staged(
        ranked(sources, "rank", F.col("source_key")).withColumn(
            "weight", F.element_at(pattern, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
        ),
        "weighed",
    )
    most = F.col("source_size") * max_repeats
    level, held = 0.0, -1
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    while True:
        above = (F.col("weight") * F.lit(level) > most) if held >= 0 else F.lit(False)
        n, kept, left = weighed.agg(
            F.coalesce(F.sum(above.cast("int")), F.lit(0)),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if n == held or not left:
            break
        held, level = n, (total - kept) / left
    return weighed.withColumn("target", F.least(F.col("weight") * F.lit(level), most.cast("double")))


def apportion(parties: DataFrame, key: list[str], weight: str, seats: str, group: str | None = None) -> DataFrame:
    """``parties`` with ``quota``: Sainte-Laguë seats by ``weight``, for each ``group`` or all together.

    ``seats`` is a column with the seats of the party's group. Rounding each exact share is the highest-quotient
    result for some number of seats; the seats that are missing (or too many) are then dealt by the quotients next in
    line. A party of share x among n can gain or lose at most ceil(x * n / (2 * seats)) + 1 of them, so the candidates
    are a few for each party. Ties go to the smaller key. Weights that are zero get no seat.
    """
    def totals(df: DataFrame, **sums: Column) -> DataFrame:
        by = df.groupBy(group) if group else df.groupBy()
        return by.agg(*(c.alias(k) for k, c in sums.items()))

    def with_totals(df: DataFrame, sums: DataFrame) -> DataFrame:
        if group:
            return df.join(sums, group)
        return df.withColumns({k: F.lit(v) for k, v in sums.first().asDict().items()})  # a row of totals

    w, s = F.col(weight).cast("double"), F.col(seats)
    rows = with_totals(parties, totals(parties, whole=F.sum(w), n=F.sum((w > 0).cast("long"))))
    share = F.when(w > 0, w * s / F.col("whole")).otherwise(0.0)
    rows = rows.withColumn("share", share).withColumn("base", F.floor(F.col("share") + 0.5))
    rows = staged(rows, "shares")
    rows = with_totals(rows, totals(rows, given=F.sum("base")))
    short = F.when(F.col("whole") > 0, s - F.col("given")).otherwise(0)
    reach = F.least(F.ceil(F.col("share") * F.col("n") / (2 * s)) + 1, F.abs(short))
    steps = rows.withColumn("short", short).where((F.col("short") != 0) & (w > 0)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), reach.cast("int")))
    )
    gain = F.col("short") > 0
    quotient = F.when(gain, w / (2 * (F.col("base") + F.col("step")) - 1)).otherwise(
        -w / (2 * (F.col("base") - F.col("step")) + 1)
    )
    steps = steps.where(gain | (F.col("step") <= F.col("base"))).withColumn("quotient", quotient)
    order = [F.col("quotient").desc(), *(F.col(k) for k in key), F.col("step")]
    steps = steps.select(*key, "short", "step", "quotient")
    if group:
        steps = steps.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    else:
        steps = ranked(steps, "place", *order)
    more = steps.where(F.col("place") <= F.abs("short")).groupBy(*key).agg(F.sum(F.signum("short")).alias("more"))
    done = rows.join(more, key, "left").withColumn("quota", F.col("base") + F.coalesce("more", F.lit(0)).cast("long"))
    return done.select(*parties.columns, "quota")


def _plan(
    sized: DataFrame, weights: tuple[int, ...], max_repeats: int, block_words: int, shard_words: int, seed: int
) -> DataFrame:
    """``rid, size, source_size, target, passes`` and the chosen word ranges ``from_1:to_1``, ``from_2:to_2`` of rows.

    ``sized`` holds ``rid, source_key, size, order_key``.
    """
    sources = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    aimed = targets(sources, weights, max_repeats)
    words, least = aimed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.min(F.when(F.col("target") > 0, F.col("target")))
    ).first()
    block_words = max(1, min(block_words, int((least or 0) // LEAST_BLOCKS)))
    aimed = aimed.withColumn("blocks", F.lit(round(words / block_words)))
    quotas = apportion(aimed, ["source_key"], "target", "blocks")
    shards_of = F.greatest(F.lit(1), F.least(F.ceil(F.col("source_size") / shard_words), F.lit(MAX_SHARDS)))
    quotas = staged(
        quotas.select(
            "source_key", "source_size", "target", F.col("quota").alias("source_quota"), shards_of.alias("shards")
        ),
        "quotas",
    )
    dealt = sized.join(quotas.select("source_key", "shards"), "source_key").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed), "order_key"), F.col("shards"))
    )
    shards = dealt.groupBy("source_key", "shard").agg(F.sum("size").alias("shard_size")).join(quotas, "source_key")
    shards = apportion(
        staged(shards.drop("shards"), "shards"), ["source_key", "shard"], "shard_size", "source_quota", "source_key"
    )
    n = F.greatest(F.lit(1), F.round(F.col("shard_size") / block_words).cast("long"))
    quota = F.least(F.col("quota"), max_repeats * F.col("n"))
    start = F.pmod(F.xxhash64(F.lit(seed), "source_key", "shard"), F.col("n"))
    stop = F.col("start") + F.pmod("quota", F.col("n"))

    def at(block: Column) -> Column:  # the first word of a block
        return F.floor(block * F.col("shard_size") / F.col("n"))

    cut = shards.withColumn("n", n).withColumn("quota", quota).withColumn("start", start).select(
        "source_key", "shard", "source_size", "target", F.floor(F.col("quota") / F.col("n")).alias("passes"),
        at(F.col("start")).alias("first_1"), at(F.least(stop, F.col("n"))).alias("last_1"),
        at(F.greatest(stop - F.col("n"), F.lit(0))).alias("last_2"),
    )
    placed = dealt.withColumn(
        "stop",
        F.sum("size").over(
            Window.partitionBy("source_key", "shard").orderBy("order_key", "rid")
            .rowsBetween(Window.unboundedPreceding, 0)
        ),
    ).withColumn("start", F.col("stop") - F.col("size"))
    rows = placed.join(cut, ["source_key", "shard"])

    def inside(bound: Column) -> Column:  # as a word number of the document
        return F.greatest(F.lit(0), F.least(bound - F.col("start"), F.col("size")))

    return rows.select(
        "rid", "size", "source_size", "target", "passes",
        inside(F.col("first_1")).alias("from_1"), inside(F.col("last_1")).alias("to_1"),
        F.lit(0).cast("long").alias("from_2"), inside(F.col("last_2")).alias("to_2"),
    )


def _sized(rows: DataFrame, rid: str, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    """What the plan needs of each row; the order key is a seeded hash of id and text."""
    source = F.col(source_col)
    return rows.select(
        F.col(rid).alias("rid"),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string"))).alias("source_key"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(text_col), F.col(id_col)).alias("order_key"),
    )


def _taken() -> Column:
    return (
        F.col("passes") * F.col("size") + (F.col("to_1") - F.col("from_1")) + (F.col("to_2") - F.col("from_2"))
    ).cast("long")


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS, seed: int = SEED,
) -> DataFrame:
    """``id_col, size, source_size, target, taken`` for each row of ``docs``.

    ``taken`` counts the words that the mix takes of a document, repeats included: at most ``max_repeats`` times its
    size. A null source is a source of its own, after all others; null, empty and blank texts have no words and
    nothing is taken of them. Repeated rows count each; the order of rows with equal id and text doesn't matter.
    An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    sized = staged(_sized(rows, "id", "id", "source", "text", seed), "sized")
    plan = _plan(sized, weights, max_repeats, block_words, shard_words, seed)
    return plan.select(F.col("rid").alias(id_col), "size", "source_size", "target", _taken().alias("taken"))


def mix(
    docs: DataFrame, text_col: str = "text", source_col: str = "source", length_col: str = "n_chars",
    id_col: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED,
) -> DataFrame:
    """The mixed documents: each row of ``docs`` once for every pass that takes all of it, and once for a part.

    A part keeps the taken words, joined by single spaces. All columns stay; ``length_col``, where there is one, is
    set for a part.
    """
    rid = fresh(docs, "rid")
    held = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "mixed-rows")
    sized = staged(_sized(held, rid, id_col, source_col, text_col, seed), "sized")
    plan = _plan(sized, weights, max_repeats, block_words, shard_words, seed).where(_taken() > 0)
    part = F.col("to_1") - F.col("from_1") + F.col("to_2") - F.col("from_2")
    whole = F.col("passes") + (part == F.col("size")).cast("long")
    ranges = F.array(
        F.struct(F.col("from_2").alias("s"), F.col("to_2").alias("e")),
        F.struct(F.col("from_1").alias("s"), F.col("to_1").alias("e")),
    )
    copies = F.concat(
        F.array_repeat(F.array().cast("array<struct<s:long,e:long>>"), whole.cast("int")),
        F.when((part > 0) & (part < F.col("size")), F.array(ranges)).otherwise(
            F.array().cast("array<array<struct<s:long,e:long>>>")
        ),
    )
    cut = fresh(docs, "cut")
    chosen = plan.select(F.col("rid").alias(rid), F.explode(copies).alias(cut))
    words = words_of(F.col(text_col))
    taken = F.flatten(
        F.transform(F.col(cut), lambda r: F.slice(words, (r.s + 1).cast("int"), (r.e - r.s).cast("int")))
    )
    text = F.when(F.size(cut) == 0, F.col(text_col)).otherwise(F.array_join(taken, " "))
    out = held.join(chosen, rid).withColumn(text_col, text)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.when(F.size(cut) == 0, F.col(length_col)).otherwise(F.length(text_col).cast(kind))
        out = out.withColumn(length_col, length)
    return out.select(*docs.columns)
