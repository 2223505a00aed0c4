"""Global order-dependent columns without a single-task window.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one
task. The input (already aggregated: lenders, distinct scores) is first
written once as Parquet in the session's shared ``spark.checkpoint.dir``
folder, which computes the upstream plan exactly once and cuts its lineage.
The rows are then range-partitioned on the sort keys; each range partition is
numbered locally and shifted by the row counts (or sums) of all earlier
partitions, a table with one row per partition (a proven broadcast bound).
Small and large inputs take the same path. The partition of each row is
written too, so that a recomputation after an executor loss finds it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.session import materialize

_PID = "_range_pid"


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_partitioned(df: DataFrame, order: Sequence[Column],
                      num_partitions: int | None = None) -> DataFrame:
    """Range-partition a written (stable) input on ``order`` and write it with
    the partition id. The bounds are sampled anew by each execution, so rows
    and offsets must both come from the written ids."""
    n = _partitions(df, num_partitions)
    return materialize(df.repartitionByRange(n, *order).withColumn(_PID, F.spark_partition_id()), "ranges")


def _offsets(parted: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """Per-partition totals, turned into exclusive prefix sums over pid."""
    totals = parted.groupBy(_PID).agg(*[a.alias(k) for k, a in aggs.items()])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the ordered window over it is tiny
    return totals.select(_PID, *[
        F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_off_{k}") for k in aggs])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rank",
                      num_partitions: int | None = None, written: bool = False) -> DataFrame:
    """1-based BIGINT row number in the total order ``order`` (ties broken by the
    caller: pass enough keys for a total order). ``written``: the input is a
    written table, or rows and columns of one, and is not written again."""
    if not written:
        df = materialize(df, "rank-input")
    parted = range_partitioned(df, order, num_partitions)
    offsets = _offsets(parted, {"n": F.count(F.lit(1))})
    local = F.row_number().over(Window.partitionBy(_PID).orderBy(*order))
    return (parted.withColumn("_local", local)
            .join(F.broadcast(offsets), _PID)
            .withColumn(name, F.col("_local") + F.col("_off_n"))
            .drop(_PID, "_local", "_off_n"))


def global_running_sum(df: DataFrame, order: Sequence[Column], cols: Sequence[str],
                       prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in the total order ``order``."""
    df = materialize(df, "cumsum-input")
    parted = range_partitioned(df, order, num_partitions)
    offsets = _offsets(parted, {c: F.sum(c) for c in cols})
    w = (Window.partitionBy(_PID).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = parted
    for c in cols:
        out = out.withColumn(f"_loc_{c}", F.sum(c).over(w))
    out = out.join(F.broadcast(offsets), _PID)
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_loc_{c}") + F.col(f"_off_{c}"))
    return out.drop(_PID, *[f"_loc_{c}" for c in cols], *[f"_off_{c}" for c in cols])
