"""Fault-tolerant reading of raw DM / AE / LB files.

Every value is read as text so that type problems become row-level findings.
A file is rejected as a whole (``InputError``) only when it cannot be used at
all: missing, empty, unparseable, a row with more fields than the header,
duplicate or missing required columns, or a demographics file without rows.

The checks are Spark jobs over the files (existence and size from the file
system's metadata, encoding by a distributed UTF-8 validity check, surplus
fields and emptiness by one aggregate of the parsed rows); only the header line
is looked at on the driver, to name the columns.
"""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard import files
from trialguard.terminology import REQUIRED_RAW

# FIXED VALUES: text the raw reader treats as missing, and candidate delimiters.
MISSING_TOKENS = ("nan", "None", "NaT", "<NA>")
DELIMITERS = (",", ";", "\t", "|")
# Python's str.strip() whitespace, as one character class.
_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The text of a row that has not as many fields as the header.
_ODD_ROW = "_odd_row"


class InputError(ValueError):
    """A raw file that cannot be used at all (as opposed to row-level problems)."""


def detect_delimiter(header_line: str) -> str:
    """S3: the most frequent of comma, semicolon, tab and pipe in the header line."""
    counts = {d: header_line.count(d) for d in DELIMITERS}
    best = max(DELIMITERS, key=lambda d: counts[d])
    return best if counts[best] else ","


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 when every line is valid UTF-8 (checked on the executors), else Latin-1."""
    ok = spark.read.text(path).agg(F.bool_and(F.is_valid_utf8("value")).alias("ok")).first()["ok"]
    return "UTF-8" if ok is None or ok else "ISO-8859-1"


def normalize_names(names: list[str]) -> list[str]:
    """Strip and upper-case column names; duplicates after normalising are a file error."""
    out = [str(c).strip().upper() for c in names]
    dup = sorted({c for c in out if out.count(c) > 1})
    if dup:
        raise InputError(f"duplicate column(s) after normalising names: {', '.join(dup)}")
    return out


def strip_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def normalize_values(df: DataFrame) -> DataFrame:
    """Every text value stripped; exactly ``nan``/``None``/``NaT``/``<NA>`` and NULL become ``''``."""
    exprs = {}
    for name, dtype in df.dtypes:
        if name == "RECNO":
            continue
        v = strip_text(F.col(f"`{name}`").cast("string"))
        exprs[name] = F.when(v.isNull() | v.isin(*MISSING_TOKENS), F.lit("")).otherwise(v)
    return df.withColumns(exprs)


def _check_columns(df: DataFrame, name: str, domain: str) -> None:
    missing = [c for c in REQUIRED_RAW[domain] if c not in df.columns]
    if missing:
        raise InputError(f"{name}: missing required column(s) {', '.join(missing)}")


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    row = spark.read.option("encoding", encoding).text(path).head(1) if encoding != "UTF-8" else spark.read.text(path).head(1)
    line = row[0]["value"] if row else ""
    return line.lstrip("\ufeff")


def read_raw(
    spark: SparkSession,
    path: str,
    domain: str,
    *,
    fmt: str | None = None,
    sep: str | None = None,
    encoding: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read one raw table as text with normalised names and values.

    CSV: header row, delimiter and encoding detected unless given; quotes in a
    quoted field are doubled; a row with fewer fields than the header is filled
    with missing values, one with more rejects the file (empty surplus fields
    are passed over, a value in any of them rejects). ``multi_line`` allows line breaks in quoted fields; such a
    file is read by one task, so it is off unless asked for. Parquet: every
    column cast to text.

    ``RECNO`` is the input order as text: the file's path and, for Parquet, the
    row's index in it, for CSV the place of its block and its number within the
    block's partition.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    size = files.size(spark, path)
    if size is None:
        raise InputError(f"{name}: file not found")
    if size == 0:
        raise InputError(f"{name}: file is empty")
    kind = (fmt or ("parquet" if name.lower().endswith(".parquet") else "csv")).lower()
    try:
        if kind == "parquet":
            df = _read_parquet(spark, path)
        else:
            df, rows = _read_csv(spark, path, name, sep, encoding, multi_line)
        df = df.toDF(*normalize_names(df.columns))
        df = normalize_values(df)
        _check_columns(df, name, domain)
        if domain == "dm" and kind == "parquet" and df.isEmpty():
            raise InputError(f"{name}: contains no subjects")
        if domain == "dm" and kind != "parquet" and not rows:
            raise InputError(f"{name}: contains no subjects")
    except InputError:
        raise
    except Exception as exc:  # noqa: BLE001 - any reader failure makes the file unusable
        raise InputError(f"{name}: could not be parsed ({exc.__class__.__name__}: {exc})") from exc
    return df


def _read_parquet(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.parquet(path)
    cols = [F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns]
    recno = F.concat(F.col("_metadata.file_path"), F.lit("#"), F.lpad(F.col("_metadata.row_index").cast("string"), 20, "0"))
    return raw.select(recno.alias("RECNO"), *cols)


def _read_csv(
    spark: SparkSession, path: str, name: str, sep: str | None, encoding: str | None, multi_line: bool
) -> tuple[DataFrame, int]:
    """The rows of a CSV file or folder, and how many there are."""
    encoding = encoding or detect_encoding(spark, path)
    header = _first_line(spark, path, encoding)
    if not header.strip():
        raise InputError(f"{name}: file is empty")
    sep = sep or detect_delimiter(header)
    columns = next(csv.reader(io.StringIO(header), delimiter=sep))
    width = len(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*(f"_c{i}" for i in range(width)), _ODD_ROW)])
    df = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _ODD_ROW)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", True)
        .schema(schema)
        .csv(path)
    )
    # one pass: the number of rows, and whether any has a value beyond the header's fields, however far; all fields are
    # read, because a parser that leaves columns out does not count the fields of a row
    every = F.xxhash64(*[F.col(f"_c{i}") for i in range(width)])
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.when(_has_surplus(sep, width), F.col(_ODD_ROW))).alias("surplus"), F.max(every),
    ).first()
    if seen["surplus"] is not None:
        raise InputError(f"{name}: could not be parsed (row with more fields than the header: {seen['surplus']!r})")
    recno = F.concat(
        F.col("_metadata.file_path"), F.lit("#"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
        F.lit("#"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"),
    )
    data = df.select(recno.alias("_recno"), *[F.col(f"_c{i}") for i in range(width)])
    return data.toDF("RECNO", *columns), seen["rows"]


def _has_surplus(sep: str, width: int) -> Column:
    """Whether a row with another number of fields than ``width`` has a value beyond them (quoted ones count as values)."""
    unquoted = F.regexp_replace(F.col(_ODD_ROW), '"(?:[^"]|"")*+"', "q")
    s = re.escape(sep)
    return unquoted.rlike(rf"(?s)^(?:[^{s}]*+{s}){{{width}}}.*[^\s{s}]")


def discover(spark: SparkSession, raw_dir: str, domain: str) -> str | None:
    """``{d}_raw.csv``, then ``{d}_raw.parquet``, then ``{d}.csv`` under ``raw_dir``; None if absent."""
    for candidate in (f"{domain}_raw.csv", f"{domain}_raw.parquet", f"{domain}.csv"):
        path = f"{raw_dir.rstrip('/')}/{candidate}"
        if files.size(spark, path) is not None:
            return path
    return None
