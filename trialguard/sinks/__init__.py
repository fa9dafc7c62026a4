"""Writers: datasets, transport-ready copies, tables, reports, metadata and digests.

Datasets are written by the executors (Parquet / CSV directories, no
``coalesce``); only results whose size does not follow the number of subjects
(tables by arm, findings, the manifest) are written as single files. Quotes in
CSV are doubled. Datasets are in their published order: range partitions in
order, sorted within.
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard import files
from trialguard import terminology as tm
from trialguard.functions import for_transport

log = logging.getLogger(__name__)

#: Published order of the datasets.
ORDER = {
    "DM": ["USUBJID"], "AE": ["USUBJID", "AESTDTC", "AEDECOD", "AESEQ"], "LB": ["USUBJID", "LBTESTCD", "LBDTC", "LBSEQ"],
    "ADSL": ["USUBJID"], "ADAE": ["USUBJID", "ASTDT", "AESEQ"], "ADLB": ["USUBJID", "PARAMCD", "AVISITN", "ADT"],
}


def in_order(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the published order of dataset ``name``, over any number of files."""
    keys = [k for k in ORDER.get(name.upper(), []) if k in df.columns]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df


def write_csv(df: DataFrame, path: str, single: bool = False) -> str:
    """A CSV folder with a header and doubled quotes; ``single`` for results of bounded size: one file."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path



def write_dataset(df: DataFrame, out_dir: str, name: str, formats: tuple[str, ...] = ("parquet", "csv")) -> dict[str, str]:
    """O1: one dataset in each format; a failing format is logged, not fatal."""
    written: dict[str, str] = {}
    for fmt in formats:
        path = f"{out_dir.rstrip('/')}/{name.lower()}.{fmt}"
        try:
            if fmt == "parquet":
                df.write.mode("overwrite").parquet(path)
            elif fmt == "csv":
                write_csv(df, path)
            elif fmt == "xpt":
                write_transport(df, out_dir, name)
                path = f"{out_dir.rstrip('/')}/{name.lower()}.xpt.parquet"
            else:
                raise ValueError(f"unknown format {fmt}")
            written[fmt] = path
        except Exception as exc:  # noqa: BLE001 - one bad format must not lose the others
            log.warning("could not write %s as %s: %s", name, fmt, exc)
    return written


def write_transport(df: DataFrame, out_dir: str, name: str) -> str:
    """O2: the SAS-v5-ready projection (E23) as Parquet; labels and DATE9 formats ride in column metadata.

    The binary XPT encoding itself is a single-file codec and is not built.
    """
    path = f"{out_dir.rstrip('/')}/{name.lower()}.xpt.parquet"
    for_transport(df).write.mode("overwrite").parquet(path)
    return path


#: Tables with a row per subject, which are written in parts like datasets.
SUBJECT_TABLES = ("hys_law",)


def write_table(df: DataFrame, path: str, name: str, names: dict[str, str] | None = None) -> str:
    """A table as CSV without ``_`` columns, under its published names; one file unless it has a row per subject.

    ``names`` gives published names that a plan can't hold beside another (they differ in case only).
    """
    names = names or {}
    shown = [c for c in df.columns if not c.startswith("_")]
    if any(c in names for c in shown):
        # the names clash inside a plan, so rows are written without header below a first line with the names
        order = F.monotonically_increasing_id()
        head = ",".join(names.get(c, c) for c in shown)
        text = df.select(order.alias("_at"), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in shown]), {"escape": '"'}).alias("value"))
        first = df.sparkSession.createDataFrame([(-1, head)], "_at long, value string")
        first.unionByName(text).coalesce(1).sortWithinPartitions("_at").select("value").write.mode("overwrite").text(path)
        return path
    return write_csv(df.select(*[F.col(f"`{c}`") for c in shown]), path, single=name not in SUBJECT_TABLES)


def dataset_metadata(spark: SparkSession, datasets: dict[str, DataFrame], records: dict[str, int] | None = None) -> DataFrame:
    """O3: dataset label, record count and variables (name, label, Num/Char; dates are Num).

    Record counts come from ``records`` when known, else from one union of counts.
    """
    rows = []
    for name, df in datasets.items():
        for pos, f in enumerate(df.schema.fields, start=1):
            num = isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.BooleanType))
            rows.append((name, tm.DATASET_LABELS.get(name, name), pos, f.name, tm.LABELS.get(f.name, ""), "Num" if num else "Char"))
    schema = "dataset string, label string, position int, variable string, variable_label string, type string"
    meta = spark.createDataFrame(rows, schema)
    if records is None:
        counts = None
        for name, df in datasets.items():
            c = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("dataset"), "records")
            counts = c if counts is None else counts.unionByName(c)
    else:
        counts = spark.createDataFrame([(k, int(v)) for k, v in records.items()], "dataset string, records long")
    return meta.join(counts, "dataset", "left").select("dataset", "label", "records", "position", "variable", "variable_label", "type")


def row_text(df: DataFrame) -> Column:
    """A row as text that tells NULL from any value and keeps values in their columns.

    A NULL is ``N``; text is ``V``, its length, a colon and itself; other values are their text and a semicolon.
    Numbers with a fraction are taken to six decimals, as a whole number of millionths, so that other engines can make
    the same text; beyond 10**12 they are taken as they are.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            part = F.concat(F.lit("V"), F.length(c).cast("string"), F.lit(":"), c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            millionths = F.when(F.abs(c) < 1e12, F.floor(c * 1e6 + 0.5).cast("string")).otherwise(c.cast("string"))
            part = F.concat(millionths, F.lit(";"))
        else:
            part = F.concat(c.cast("string"), F.lit(";"))
        parts.append(F.coalesce(part, F.lit("N")))
    return F.concat(*parts)


def row_digest(df: DataFrame) -> Column:
    """The first 60 bits of the SHA-256 of ``row_text``, as a whole number."""
    return F.conv(F.substring(F.sha2(row_text(df), 256), 1, 15), 16, 10).cast("long")


def _digest_of(row: Column) -> list[Column]:
    """O6 aggregates of row digests: ``records`` (row count) and ``digest`` (their sum, as text)."""
    total = F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("records"), F.coalesce(total, F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest")]


def content_digest(df: DataFrame) -> DataFrame:
    """Order-insensitive digest of a dataset: row count and sum of row hashes (``row_digest``).

    Computed by the executors in one aggregation, so any size of output can be
    fingerprinted without a single task reading it whole.
    """
    return df.agg(*_digest_of(row_digest(df)))


def observed_digest(
    df: DataFrame, without: tuple[str, ...] = (), metrics: tuple[Column, ...] = ()
) -> tuple[DataFrame, Observation]:
    """``df`` with the O6 aggregates of its columns, but for ``without``, and ``metrics`` attached as observed metrics.

    The digest is computed by the action that writes ``df`` (partial aggregates
    per task, merged on the driver), so fingerprinting an output costs no
    second scan. ``Observation.get`` returns ``{"records": ..., "digest": ...}``
    once that action has finished.
    """
    obs = Observation(f"digest_{uuid.uuid4().hex}")
    # the row's digest is a column of its own, so that it is generated code and not the metric's interpreted one
    row = "_row_digest"
    marked = df.withColumn(row, row_digest(df.drop(*without)))
    return marked.observe(obs, *_digest_of(F.col(row)), *metrics).drop(row), obs


def write_json(spark: SparkSession, obj, path: str) -> str:
    """A small JSON document (the manifest) as one file, put in place in one act."""
    return files.write_text(spark, path, json.dumps(obj, indent=2, default=str))
