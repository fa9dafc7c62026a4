"""Helpers shared by the operators: input columns, stage tables and Arrow passes."""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard import files
from trialguard.session import checkpoint_dir

#: The white space that separates words, as a character class body: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder, which the driver and all executors see."""
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's own setting to delete a query's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The shuffle files of the write are deleted after it, as those of an operator's stages would add up. ``codec`` is a
    compression other than the session's.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` wrote and that nothing reads any more."""
    for table in tables:
        for file in table.inputFiles():
            files.delete(table.sparkSession, file)


def clear_stages(spark: SparkSession) -> None:
    """Delete the tables that ``staged`` wrote in this session; results that read them have to be written before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/tables")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that starts with ``base`` and that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


#: Rows that a Python worker takes in hand at once; Spark's own batches hold up to 10,000.
PIECE_ROWS = 512


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` a few at a time, so that a task's Python objects are those of a few texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(at, PIECE_ROWS)


def append_column(
    df: DataFrame, text: str, name: str, kind: T.DataType, arrow: pa.DataType, values: Callable[[list], list]
) -> DataFrame:
    """All columns of ``df`` and one more, which ``values`` computes from a batch of texts (UTF-8 bytes or None)."""
    at = df.columns.index(text)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            new = pa.array(values(texts), arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, name])

    return df.mapInArrow(pass_, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def words_of(text: Column) -> Column:
    """The words of a text as an array: maximal runs without white space; none for a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"([^{SPACE}]+)"), F.lit(1))


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI in the shared folder; ``file:/x`` counts as ``file:///x``."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that its tasks share what they loaded or computed."""
    holder = sys.modules.setdefault("trialguard_worker_cache", types.ModuleType("trialguard_worker_cache"))
    return holder.__dict__.setdefault(name, {})
