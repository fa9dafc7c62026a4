"""Raw clinical tables derived from the supplied TPC-H-style tables.

The test tables carry no clinical data, so raw DM / AE / LB are derived from
``customer`` (subjects), ``orders`` (adverse events) and ``lineitem`` (lab
results) by fixed arithmetic on real keys. The mapping grows with the scale
factor and has known faults (blank and duplicated subjects, bad ages, unmappable
sex, unplanned arms, bad dates, orphans, non-numeric results, bad ranges).

Every value is text, like a raw file; ``RECNO`` is the input-order column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_DAY0 = "2025-01-06"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _subjects(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    site = _s(F.lit(101) + k % 6)
    return customer.select(
        k.alias("k"),
        site.alias("site"),
        F.concat(site, F.lit("-"), F.lpad(_s(k), 6, "0")).alias("subj"),
        F.date_add(F.lit(_DAY0).cast("date"), (k * 37 % 260).cast("int")).alias("d0"),
        (k % 3).alias("a"),
        F.col("c_nationkey").alias("nk"),
    )


def _case(*pairs, otherwise) -> Column:
    out = None
    for cond, val in pairs:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(otherwise)


def raw_dm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw demographics: one row per customer plus a second copy of every 50th subject."""
    b = _subjects(_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    copies = b.withColumn("copy", F.lit(0)).unionByName(
        b.filter(F.col("k") % 50 == 3).withColumn("copy", F.lit(1))
    )
    k, a, nk, d0 = F.col("k"), F.col("a"), F.col("nk"), F.col("d0")
    lit = F.lit
    return copies.select(
        (k * 2 + F.col("copy")).alias("RECNO"),
        F.when(k % 97 == 1, lit("")).otherwise(F.col("subj")).alias("SUBJID"),
        F.col("site").alias("SITEID"),
        _case((k % 89 == 5, lit("abc")), (k % 166 == 7, lit("99999999999")), (k % 83 == 7, lit("150")), otherwise=_s(16 + k * 7 % 72)).alias("AGE"),
        _case(
            (k % 79 == 11, lit("Q")), (k % 10 == 2, lit("Male")), (k % 10 == 3, lit("female")),
            (k % 2 == 0, lit("M")), otherwise=lit("F"),
        ).alias("SEX"),
        _case(
            (nk % 8 == 0, lit("martian")), (nk % 8 == 1, lit("")), ((nk % 8).isin(2, 3), lit("ASIAN")),
            ((nk % 8).isin(4, 5), lit("White")), otherwise=lit("BLACK OR AFRICAN AMERICAN"),
        ).alias("RACE"),
        _case(
            (k % 67 == 13, lit("XXX")), (a == 0, lit("PBO")), (a == 1, lit("DRGA50")), otherwise=lit("DRGA100")
        ).alias("ARMCD"),
        _case((a == 0, lit("Placebo")), (a == 1, lit("Drug A 50 mg")), otherwise=lit("Drug A 100 mg")).alias("ARM"),
        F.when(k % 71 == 17, lit("01/02/2025")).otherwise(_s(d0)).alias("TRTSDT"),
        _case(
            (k % 61 == 19, lit("")), (k % 59 == 23, lit("2024-01-01")),
            otherwise=_s(F.date_add(d0, (40 + k % 44).cast("int"))),
        ).alias("TRTEDT"),
        _case((k % 13 == 4, lit("ADVERSE EVENT")), (k % 101 == 29, lit("DEATH")), otherwise=lit("")).alias("DCSREAS"),
        F.when(k % 101 == 29, _s(F.date_add(d0, 45))).otherwise(lit("")).alias("DTHDT"),
    )


def raw_ae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw adverse events: one row per order, for the order's customer."""
    b = _subjects(_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    orders = orders.repartition("o_custkey")  # the supplied file is one row group; the join then needs no other shuffle
    o = orders.join(b, orders.o_custkey == b.k)
    n, a, d0, lit = F.col("o_orderkey"), F.col("a"), F.col("d0"), F.lit
    term = F.when((a > 0) & (n % 4 == 0), lit(0)).otherwise(n % 19)
    start = F.date_add(d0, (n % 150 - 15).cast("int"))
    return o.select(
        n.alias("RECNO"),
        F.when(n % 311 == 8, lit("999-9999")).otherwise(F.col("subj")).alias("SUBJID"),
        F.when(n % 2 == 0, lit("")).otherwise(F.concat(lit("verbatim "), _s(n % 19))).alias("AETERM"),
        F.concat(lit("PT"), F.lpad(_s(term), 2, "0")).alias("AEDECOD"),
        F.concat(lit("SOC"), _s(term % 6)).alias("AEBODSYS"),
        F.when(n % 41 == 7, lit("2025-13-45")).otherwise(_s(start)).alias("AESTDT"),
        _case(
            (n % 11 == 0, lit("")), (n % 43 == 1, lit("nope")), (n % 47 == 2, lit("2020-01-01")),
            otherwise=_s(F.date_add(d0, (n % 150 - 15 + n % 20).cast("int"))),
        ).alias("AEENDT"),
        _case((n % 53 == 3, lit("9")), (n % 53 == 4, lit("")), otherwise=F.substring("o_orderpriority", 1, 1)).alias(
            "AETOXGR"
        ),
        _case((n % 7 == 0, lit("Mild")), (n % 61 == 5, lit("TERRIBLE")), otherwise=lit("")).alias("AESEV"),
        _case(
            (n % 59 == 4, lit("maybe")), (F.col("o_orderstatus") == "F", lit("yes")),
            (F.col("o_orderstatus") == "O", lit("0")), otherwise=lit("N"),
        ).alias("AESER"),
        _case(
            (n % 5 == 0, lit("NOT RELATED")), (n % 5 == 1, lit("UNLIKELY RELATED")),
            (n % 5 == 2, lit("POSSIBLY RELATED")), (n % 5 == 3, lit("PROBABLY RELATED")), otherwise=lit("RELATED"),
        ).alias("AEREL"),
        F.when(n % 37 == 9, lit("DRUG WITHDRAWN")).otherwise(lit("DOSE NOT CHANGED")).alias("AEACN"),
        F.when(n % 97 == 6, lit("FATAL")).otherwise(lit("RECOVERED/RESOLVED")).alias("AEOUT"),
    )


def raw_lb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lab results: one row per line item, for the customer of its order."""
    b = _subjects(_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    ).repartition("l_orderkey")  # the supplied file is one row group, which can't be read in parts
    # subjects meet the orders first, so that the many items are shuffled by order alone
    subjects = orders.join(b, orders.o_custkey == b.k).select("o_orderkey", "subj", "d0")
    joined = items.join(subjects, items.l_orderkey == subjects.o_orderkey)
    lo, p, s, v = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("int")
    px = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    t, d0, lit = p % 6, F.col("d0"), F.lit
    raw_v = _case((t == 0, q + 8), (t == 1, q), (t == 2, q % 24 + 1), (t == 3, q + 62), (t == 4, q + 122), otherwise=q % 9)
    return joined.select(
        F.concat(
            F.lpad(_s(lo), 10, "0"), lit("-"), _s(v), lit("-"), F.lpad(_s(p), 10, "0"), lit("-"),
            F.lpad(_s(s), 10, "0"), lit("-"), F.lpad(_s(px), 12, "0"),
        ).alias("RECNO"),
        F.when(p % 307 == 4, lit("999-9999")).otherwise(F.col("subj")).alias("SUBJID"),
        F.when(p % 211 == 9, lit("x")).otherwise(_s(v)).alias("VISITNUM"),
        _case(
            (v == 1, lit("SCREENING")), (v == 2, lit("DAY 1")), otherwise=F.concat(lit("WEEK "), _s(4 * (v - 2)))
        ).alias("VISIT"),
        F.when(p % 199 == 3, lit("bad")).otherwise(_s(F.date_add(d0, ((v - 2) * 28 + p % 5 - 2).cast("int")))).alias(
            "LBDT"
        ),
        _case(
            (t == 0, lit("ALT")), (t == 1, lit("AST")), (t == 2, lit("BILI")), (t == 3, lit("CREAT")),
            (t == 4, lit("HGB")), otherwise=lit("NEUT"),
        ).alias("LBTESTCD"),
        _case(
            (t == 0, lit("Alanine Aminotransferase")), (t == 1, lit("Aspartate Aminotransferase")),
            (t == 2, lit("Bilirubin")), (t == 3, lit("Creatinine")), (t == 4, lit("Hemoglobin")), otherwise=lit(""),
        ).alias("LBTEST"),
        _case(
            (p % 191 == 2, lit("<5")), ((v > 2) & ((p + s) % 29 == 7), _s(raw_v * 6)), otherwise=_s(raw_v)
        ).alias("LBORRES"),
        _case((t.isin(0, 1), lit("U/L")), (t.isin(2, 3), lit("umol/L")), (t == 4, lit("g/L")), otherwise=lit("10^9/L")).alias(
            "LBORRESU"
        ),
        _case(
            (p % 181 == 1, lit("999")), (t == 0, lit("7")), (t == 1, lit("10")), (t == 2, lit("3")),
            (t == 3, lit("60")), (t == 4, lit("120")), otherwise=lit("1.8"),
        ).alias("LBORNRLO"),
        _case(
            (t == 0, lit("56")), (t == 1, lit("40")), (t == 2, lit("21")), (t == 3, lit("110")),
            (t == 4, lit("170")), otherwise=lit("7.5"),
        ).alias("LBORNRHI"),
    )


#: A label of a variable of ``broken_domains`` that is too long.
BROKEN_LABELS = {"XLABEL": "A label that is longer than the forty characters allowed"}


def broken_domains(dm: DataFrame, ae: DataFrame, lb: DataFrame) -> dict[str, DataFrame]:
    """Copies of the SDTM domains with faults, set by arithmetic on the subject number and the sequence number, so
    that every conformance rule has something to find."""
    n = F.substring("USUBJID", -6, 6).try_cast("int")
    lit = F.lit

    def put(df: DataFrame, **faults: tuple[Column, Column]) -> DataFrame:
        kinds = dict(df.dtypes)
        return df.select(
            *(F.when(faults[c][0], faults[c][1].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in faults else c for c in df.columns)
        )

    s = n + F.col("AESEQ")
    x = n + F.col("LBSEQ")
    orphan = lit("SYN-SAFETY-001-999-000000")
    dm = dm.unionByName(dm.where(n % 13 == 2))
    dm = put(
        dm, STUDYID=(n % 11 == 1, lit("")), SEX=(n % 17 == 3, lit("X")), DTHFL=(n % 19 == 4, lit("Y")),
        DTHDTC=(n % 19 == 4, lit("")), RFENDTC=(n % 23 == 5, lit("2025/01/01")),
    ).drop("COUNTRY").withColumns({"LONGVARNAME": lit(""), "XLABEL": lit("")})
    ae = put(
        ae, USUBJID=(s % 29 == 6, orphan), AESEQ=((n % 7 == 0) & (F.col("AESEQ") == 2), lit(1)),
        AESTDTC=(s % 31 == 7, lit("bad")), AESTDY=(s % 37 == 8, lit(0)),
        AESEV=(s % 41 == 9, F.when(s % 2 == 0, "AWFUL").otherwise("MILD")), AESER=(s % 43 == 10, lit("U")),
        AEENDTC=(s % 47 == 11, lit("1999-01-01")), AEOUT=(s % 43 == 10, lit("FATAL")),
        AETOXGR=(s % 41 == 9, lit(4)), DOMAIN=(s % 53 == 12, lit(None)),
    )
    lb = put(
        lb, USUBJID=(x % 61 == 13, orphan), LBSEQ=((n % 5 == 0) & (F.col("LBSEQ") == 3), lit(1)),
        LBBLFL=(n % 6 == 1, lit("")), LBNRIND=(x % 67 == 14, lit("ODD")), LBDY=(x % 71 == 15, lit(0)),
        LBDTC=(x % 73 == 16, lit("2025-13-01")),
    )
    return {"DM": dm, "AE": ae, "LB": lb}


def raw_bundle(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``{"dm", "ae", "lb"}`` raw tables for one scale-factor directory."""
    return {"dm": raw_dm(spark, sf_dir), "ae": raw_ae(spark, sf_dir), "lb": raw_lb(spark, sf_dir)}
