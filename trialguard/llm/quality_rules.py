"""Quality rules with risk-controlled thresholds.

Each rule gives a document a level, a whole number that is higher the worse it looks; levels are steps of a fixed grid,
so cutoffs do not depend on the data. Labelled documents that pass the base rules are the holdout. For every stratum,
rule and cutoff the number of good holdout documents at or above the cutoff is tested with the exact binomial
distribution: a cutoff is certified if so few false rejections would come about with probability ``risk`` at most were
the true rate above ``max_false`` divided by the number of rules. The risk is divided by strata times rules
(Bonferroni); along the grid of one rule false rejections only grow towards stricter cutoffs, so testing from the most
lenient one on in a fixed sequence needs no further correction. With probability ``1 - risk``, no stratum loses more
than ``max_false`` of its good documents to the rules. Of the certified cutoffs, which hold all at once, each stratum and
rule takes the one with the largest difference between the shares of bad and of good documents that it rejects, the
more lenient one of equals; where none is certified or none tells bad from good, the rule rejects nothing.

All work is DataFrame expressions over one scan of the texts; what the scan finds is staged, and the cutoffs come from
counts by (stratum, rule, level), which are few however many documents there are.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialguard.llm.common import SPACE, staged, words_of

#: Words in a window, and the share of words in repeated windows (in percent) that fails a document.
WINDOW, MAX_REPEATED = 8, 30
LEAST_WORDS = 20
#: Share of good documents that the rules together may reject in a stratum, and the risk that they reject more.
MAX_FALSE, RISK = 0.05, 0.05
#: Steps of the grid on which shares and mean lengths are cut.
SHARE_STEPS, LENGTH_STEPS, LONGEST = 200, 20, 20


def _share(part: str, whole: str) -> Column:
    """Step of a share; a whole of nothing has share 0."""
    return F.when(F.col(whole) > 0, F.expr(f"{SHARE_STEPS} * {part} div {whole}")).otherwise(0)


def _mean_length() -> Column:
    steps = F.when(F.col("n_words") > 0, F.expr(f"{LENGTH_STEPS} * word_chars div n_words")).otherwise(0)
    return F.least(steps, F.lit(LENGTH_STEPS * LONGEST))


def rules() -> dict[str, Column]:
    """Name and level of each rule, over the columns of ``features``."""
    return {
        "symbols": F.least(_share("n_symbols", "word_chars"), F.lit(SHARE_STEPS)),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "short_words": LENGTH_STEPS * LONGEST - _mean_length(),
        "long_words": _mean_length(),
    }


def features(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the counts of ``rows(keys, text)``: words, their characters, symbols, lines and repeated words."""
    text = F.col("text")
    split = rows.select(
        *keys,
        words_of(text).alias("words"),
        (F.length(text) - F.regexp_count(text, F.lit(f"[{SPACE}]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"),
    )
    n = F.size("words")
    starts = F.when(n > WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1)))
    hashed = split.select(
        *keys, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, lambda at: F.xxhash64(F.slice("words", at, F.lit(WINDOW)))).alias("windows"),
    )
    # only texts with a repeated window are sorted; equal windows are neighbours then
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash = F.sort_array(F.transform("windows", lambda x, at: F.struct(x.alias("hash"), at.alias("at"))))
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    ordered = hashed.select(*keys, *counts, F.when(again, by_hash).alias("ordered"))

    def repeated(w: Column, k: Column) -> Column:
        before = F.get("ordered", k - 1)["hash"]
        after = F.get("ordered", k + 1)["hash"]
        return F.coalesce(before == w["hash"], F.lit(False)) | F.coalesce(after == w["hash"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("ordered", repeated), lambda w: w["at"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("words")),
        lambda acc, at: F.struct(
            at.alias("last"), (acc["words"] + F.least(at - acc["last"], F.lit(WINDOW))).alias("words")
        ),
        lambda acc: acc["words"],
    )
    return ordered.select(*keys, *counts, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for ``x >= 1``: Stirling's series at ``x + 10``, brought back down."""
    y = x + 10
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - F.log(reduce(lambda a, b: a * b, (x + k for k in range(10))))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """Probability of ``k`` or fewer hits in ``n`` trials at ``rate``, for ``k`` up to ``n * rate``.

    Summed downwards from the last term, the largest one there: the terms fall, so nothing overflows.
    """
    odds = (1 - rate) / rate
    last = (
        log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)
        + k * math.log(rate) + (n - k) * math.log(1 - rate)
    )
    below = F.when(k > 0, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    one = F.lit(1.0)
    # a term is the one above it times i / (n - i + 1) times the odds of a miss
    total = F.aggregate(
        below,
        F.struct(one.alias("term"), one.alias("total")),
        lambda acc, i: _next_term(acc, acc["term"] * i * odds / (n - i + 1)),
        lambda acc: acc["total"],
    )
    return F.exp(last) * total


def _next_term(acc: Column, term: Column) -> Column:
    return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))


def cutoffs(levels: DataFrame, max_false: float = MAX_FALSE, risk: float = RISK) -> DataFrame:
    """``stratum, rule, level, good_rejected, bad_rejected, p_value``: the chosen cutoffs.

    ``levels(stratum, rule, level, good, bad)`` counts the good and bad holdout documents of each level. Strata or
    rules without a certified cutoff that tells bad from good have no row.
    """
    levels = staged(levels, "levels")
    sizes = levels.groupBy("rule").agg(F.count_distinct("stratum").alias("strata"))
    found = sizes.agg(F.count(F.lit(1)).alias("rules"), F.max("strata").alias("strata")).first()
    n_rules, tests = max(found["rules"], 1), max(found["rules"] * (found["strata"] or 0), 1)
    rate = max_false / n_rules
    own = Window.partitionBy("stratum", "rule")
    stricter = own.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = levels.select(
        "stratum", "rule", "level",
        F.sum("good").over(stricter).alias("good_rejected"), F.sum("bad").over(stricter).alias("bad_rejected"),
        F.sum("good").over(own).alias("n_good"), F.sum("bad").over(own).alias("n_bad"),
    )
    # at the allowed rate or above it the tail is about a half, far from any risk: not worked out
    p_value = F.when(
        F.col("good_rejected") < F.col("n_good") * rate, binomial_tail(F.col("good_rejected"), F.col("n_good"), rate)
    )
    gain = F.try_divide("bad_rejected", "n_bad") - F.try_divide("good_rejected", "n_good")
    certified = path.withColumns({"p_value": p_value, "gain": gain}).where(
        (F.col("p_value") <= risk / tests) & (F.col("gain") > 0)
    )
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("level"))
    return certified.withColumn("place", F.row_number().over(best)).where("place = 1").select(
        "stratum", "rule", "level", "good_rejected", "bad_rejected", "p_value"
    )


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    max_false: float = MAX_FALSE, risk: float = RISK,
) -> DataFrame:
    """Counts of each document, whether the base rules fail it, and whether it is kept.

    ``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by``, one row for
    each row of ``docs``; ``rejected_by`` names the rules whose cutoff the document reaches, in the order of ``rules``.
    ``labels(id_col, quality, toxic)``: quality 1 and no toxic 1 is good, quality 0 bad; of contradicting labels of an
    id bad counts, other labels count for nothing. A holdout document counts once, however often its row is repeated.
    A null text has no words; a null stratum is a stratum of its own, one without labels has no cutoffs, so only the
    base rules judge it; a null id has no label. Empty tables give no rows or no cutoffs; other columns are not read.
    """
    stratum = F.when(F.col(stratum_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(stratum_col).cast("string")))
    rows = docs.select(
        F.col(id_col).alias("id"), stratum.alias("stratum"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    measured = staged(features(rows, "id", "stratum").withColumn("base_failed", failed), "features")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False))
    good = F.coalesce(F.col("quality") == 1, F.lit(False)) & ~F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.select(F.col(id_col).alias("id"), good.alias("good"), bad.alias("bad")).where("good or bad")
    known = known.groupBy("id").agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
    own = rules()
    holdout = (
        measured.where(~F.col("base_failed")).select("id", "stratum", *(c.alias(r) for r, c in own.items())).distinct()
        .join(known, "id")
        .select(
            "stratum", (F.col("good") & ~F.col("bad")).cast("long").alias("good"), F.col("bad").cast("long").alias("bad"),
            F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).cast("long").alias("level")) for r in own)))
            .alias("at"),
        )
    )
    levels = holdout.groupBy("stratum", "at.rule", "at.level").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    chosen = cutoffs(levels, max_false, risk).groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == r, F.col("level"))).alias(f"cut_{r}") for r in own)
    )
    over = {r: F.coalesce(level >= F.col(f"cut_{r}"), F.lit(False)) for r, level in own.items()}
    return measured.join(chosen, "stratum", "left").select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~(F.col("base_failed") | reduce(or_, over.values()))).alias("kept"),
        F.concat_ws(",", *(F.when(hit, r) for r, hit in over.items())).alias("rejected_by"),
    )


_LEVELS = {
    "symbols": f"CASE WHEN word_chars > 0 THEN least({SHARE_STEPS} * n_symbols // word_chars, {SHARE_STEPS}) ELSE 0 END",
    "duplicate_lines": f"CASE WHEN n_lines > 0 THEN {SHARE_STEPS} * n_dup_lines // n_lines ELSE 0 END",
    "repeated_words": f"CASE WHEN n_words > 0 THEN {SHARE_STEPS} * n_repeat_words // n_words ELSE 0 END",
    "short_words": "400 - mean_length",
    "long_words": "mean_length",
}

SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
parts AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
windows AS (
  SELECT rid, pos, unnest(generate_series(pos, pos + 7)) AS word FROM (
    SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n FROM (
      SELECT rid, pos, array_to_string(words[pos:pos + 7], ' ') AS win FROM (
        SELECT rid, words, unnest(generate_series(1, len(words) - 7)) AS pos FROM parts WHERE len(words) > 8)))
  WHERE n > 1),
repeated AS (SELECT rid, count(DISTINCT word) AS n FROM windows GROUP BY rid),
measured AS (
  SELECT p.rid, doc_id, lang, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM parts p LEFT JOIN repeated r ON p.rid = r.rid),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN least(20 * word_chars // n_words, 400) ELSE 0 END AS mean_length FROM measured),
known AS (
  SELECT doc_id, bool_or(quality = 0) AS bad FROM labels
  WHERE quality = 0 OR quality = 1 AND coalesce(toxic, 0) <> 1 GROUP BY doc_id),
ruled AS (
  {" UNION ALL ".join(f"SELECT *, '{rule}' AS rule, {level} AS level FROM judged" for rule, level in _LEVELS.items())}),
levels AS (
  SELECT lang, rule, level, count(*) FILTER (bad) AS bad, count(*) FILTER (NOT bad) AS good
  FROM (SELECT DISTINCT doc_id, lang, rule, level, bad FROM ruled JOIN known USING (doc_id) WHERE NOT base_failed)
  GROUP BY lang, rule, level),
path AS (
  SELECT lang, rule, level, sum(good) OVER stricter AS k, sum(bad) OVER stricter AS bad_rejected,
    sum(good) OVER own AS n, sum(bad) OVER own AS n_bad
  FROM levels
  WINDOW own AS (PARTITION BY lang, rule), stricter AS (PARTITION BY lang, rule ORDER BY level DESC)),
tested AS (
  SELECT *, (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(0.01) + (n - i) * ln(0.99)))
      FROM (SELECT unnest(generate_series(0, k::BIGINT)) AS i)) AS p,
    bad_rejected / nullif(n_bad, 0) - k / nullif(n, 0) AS gain
  FROM path WHERE k < n * 0.01),
chosen AS (
  SELECT lang, rule, arg_max(level, (gain, level)) AS cut FROM tested
  WHERE gain > 0 AND p <= 0.05 / (5 * (SELECT count(*) FROM (SELECT DISTINCT lang FROM levels))) GROUP BY lang, rule),
hits AS (
  SELECT rid, string_agg(rule, ',' ORDER BY list_position({list(_LEVELS)}, rule)) AS rejected_by
  FROM ruled JOIN chosen USING (rule) WHERE ruled.lang IS NOT DISTINCT FROM chosen.lang AND level >= cut GROUP BY rid)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND h.rid IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM judged j LEFT JOIN hits h ON j.rid = h.rid
"""
