"""Helpers shared by the operators of this subpackage.

Words of a text, where an operator does not say otherwise, are the runs
``[^\\x20\\x09-\\x0D]+``; ``bytes.split()`` cuts at exactly these separators.
Intermediate tables are written as Parquet below the shared folder that
``spark.checkpoint.dir`` names, so a lost executor costs no lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.session import ensure_checkpoint_dir, ship_package

#: Most bytes of one batch that Spark hands to a Python function, where the
#: session does not say: a worker holds a batch as Python objects, several times
#: its size, and six workers share a machine with the JVM.
BATCH_BYTES = 4 * 1024 * 1024
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Broadcast a lookup side only up to this many rows (counted first).
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that clash with none of ``df``."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        new = name
        while new.lower() in used:
            new += "_"
        used.add(new.lower())
        out.append(new)
    return out


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder (not yet created)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    root = base.rsplit("/", 1)[0] if "/" in base else base
    return f"{root}/lendlens-llm/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed
    once, and recovered from there when an executor is lost."""
    spark = df.sparkSession
    ship_package(spark)
    path = shared_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by :func:`cut` that no later plan reads."""
    path, spark = getattr(df, "_written_path", None), df.sparkSession
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows (counted by
    a plain aggregate); otherwise as it is, and the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def off_driver(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """A join side of at most ``rows`` rows: beyond ``most`` the join shuffles
    whatever the files' compressed sizes promise, since the driver holds what is
    broadcast several times over."""
    return df if rows <= most else df.hint("merge")


def words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def word_ids(tokens: list) -> np.ndarray:
    """Number of each token's first occurrence class, from 0 by appearance."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(t, len(seen)) for t in tokens), np.int64, len(tokens))


def per_text(fn: Callable, returns: str):
    """An Arrow-batched UDF with struct result from a function of one value
    (``returns``: ``name type, name type``); only that column goes to Python."""
    names = [c.split()[0] for c in returns.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in batches:
            yield pd.DataFrame([fn(v) for v in values], columns=names)

    return F.pandas_udf(run, returns)
