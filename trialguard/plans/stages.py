"""Stored sub-plans: a stage is written once under a key of its inputs and read by everything that needs it.

A stage is a Parquet folder and, beside it, a mark with its schema, row count, digest and other observed metrics. The
mark is put in place after the folder is complete, so a stage without a mark was cut off and is written again. Stages
lie under one root, which the caller derives from the fingerprint of the inputs and the version of the library.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from trialguard import files, sinks
from trialguard.session import checkpoint_dir

#: Version of the library; stages of another version are not read.
VERSION = "0.3.1"


class StageStore:
    """The stages under one root; each is built at most once, also by several threads of a driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._marks: dict[str, dict] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def mark(self, name: str) -> dict | None:
        """What is known of a complete stage, None if there is none."""
        if name not in self._marks:
            text = files.read_text(self.spark, f"{self.root}/{name}.stage.json")
            if text is None:
                return None
            self._marks[name] = json.loads(text)
        return self._marks[name]

    def put(self, name: str, df: DataFrame, metrics: tuple[Column, ...] = (), digest: bool = False, **facts) -> DataFrame:
        """Write a stage; ``metrics`` and, if asked for, row count and digest are observed by the write.

        ``facts`` are values for the mark, or functions that give them once the stage is written.
        """
        path, seen = self.path(name), {}
        if digest:
            df, observed = sinks.observed_digest(df, metrics=metrics)
        elif metrics:
            observed = Observation()
            df = df.observe(observed, *metrics)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if digest or metrics:
            seen = dict(observed.get)
        seen |= {k: v() if callable(v) else v for k, v in facts.items()}
        mark = {**seen, "schema": df.schema.jsonValue()}
        files.write_text(self.spark, f"{self.root}/{name}.stage.json", json.dumps(mark))
        self._marks[name] = mark
        return self.frame(name)

    def frame(self, name: str) -> DataFrame:
        """A complete stage as it was stored."""
        schema = T.StructType.fromJson(self._marks[name]["schema"])
        return self.spark.read.schema(schema).parquet(self.path(name))

    def get(self, name: str, build: Callable[[], DataFrame], **how) -> DataFrame:
        """The stage ``name``; what ``build`` composes is stored first if there is none (``how`` as in ``put``)."""
        with self._guard:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            return self.frame(name) if self.mark(name) else self.put(name, build(), **how)


_shared: dict[str, StageStore] = {}


def shared_store(spark: SparkSession, key: str) -> StageStore:
    """The stages of the inputs with fingerprint ``key`` in the session's shared folder."""
    root = f"{checkpoint_dir(spark)}/stages/{VERSION}-{key}"
    if root not in _shared or _shared[root].spark is not spark:
        _shared[root] = StageStore(spark, root)
    return _shared[root]
