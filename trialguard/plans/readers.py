"""Queries that go through the raw reader: a table written as a file of some kind into the shared folder, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialguard.session import checkpoint_dir
from trialguard.sources import fixtures
from trialguard.sources.raw import read_raw


def _path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/readers/{uuid.uuid4().hex[:12]}/{name}"


def _csv(df: DataFrame, name: str, **options: str) -> str:
    """Write ``df`` as CSV as it is: values keep the spaces around them."""
    path = _path(df.sparkSession, name)
    plain = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**plain, **options).csv(path)
    return path


def read_csv_dm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics as semicolon-separated Latin-1 text, with names in small letters and spaces, separators
    in quoted values, spaces around values and words for missing ones."""
    dm, n = fixtures.raw_dm(spark, sf_dir), F.col("RECNO")
    dm = dm.withColumns(
        {
            "RECNO": n.cast("string"),
            "SITEID": F.concat(F.lit("  "), "SITEID", F.lit("\t ")),
            "RACE": F.when(n % 7 == 0, "nan").when(n % 7 == 1, " None ").when(n % 7 == 2, "NaT").when(n % 7 == 3, "NA").otherwise(F.col("RACE")),
            "COUNTRY": F.when(n % 5 == 0, "Côte d'Ivoire; est").otherwise(""),
        }
    ).withColumnRenamed("RECNO", "ROW")
    path = _csv(dm.toDF(*(f" {c.lower()} " for c in dm.columns)), "dm_raw.csv", sep=";", encoding="ISO-8859-1")
    return read_raw(spark, path, "dm").drop("RECNO")


def read_csv_lb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labs as comma-separated UTF-8 text, with quotes and separators in values and every result's sign kept."""
    lb = fixtures.raw_lb(spark, sf_dir).withColumnRenamed("RECNO", "ROW")
    lb = lb.withColumns(
        {
            "LBTEST": F.concat(F.lit('a "quoted", té'), "LBTESTCD"),
            "LBORRESU": F.when(F.col("LBTESTCD") == "ALT", "<NA>").otherwise('"'),
        }
    )
    return read_raw(spark, _csv(lb, "lb_raw.csv"), "lb").drop("RECNO")


def read_parquet_ae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as Parquet with numbers, dates and flags of their own types; all become text."""
    ae = fixtures.raw_ae(spark, sf_dir).withColumnRenamed("RECNO", "ROW")
    ae = ae.withColumns(
        {
            "AETOXGR": F.col("AETOXGR").try_cast("int"), "AESTDT": F.expr("try_to_date(AESTDT, 'yyyy-MM-dd')"),
            "AESER": F.when(F.col("AESER") == "yes", True).when(F.col("AESER") == "N", False),
        }
    )
    path = _path(spark, "ae_raw.parquet")
    ae.write.parquet(path)
    return read_raw(spark, path, "ae").drop("RECNO")


QUERIES = {"read_csv_dm": read_csv_dm, "read_csv_lb": read_csv_lb, "read_parquet_ae": read_parquet_ae}
