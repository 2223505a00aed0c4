"""Aggregations (A5–A16, W2): distributions, cross-tabs, controlled means,
geographic summaries and column profiles.

Each is one ``groupBy`` (hash aggregate with map-side partial aggregation),
so a hot key is combined inside every map task before the shuffle. Code and
year domains are generated with ``explode`` (no cross join) and joined to the
aggregated counts, which are bounded by |domain| and broadcast safely.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions import exprs as X
from lendlens.sources.tables import q


def snake(label: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")


def _domain(spark, cols: Mapping[str, Sequence]) -> DataFrame:
    """Full grid of the given value lists, built with explode (no join)."""
    df = spark.range(1)
    for name, values in cols.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df.drop("id")


def distribution(df: DataFrame, col: str, domain: Sequence[int],
                 labels: Mapping[int, str] | None = None,
                 by: str | None = None, by_domain: Sequence[int] | None = None,
                 code_name: str = "action_code", label_name: str = "outcome",
                 digits: int = 2) -> DataFrame:
    """A5 (+W2): count and percent per code, densified over ``domain``
    (and per ``by`` value over ``by_domain``); an empty group gives NULL
    percent."""
    keys = ([by] if by else []) + [col]
    src = df.filter(q(col).isin(list(domain)))
    if by:
        src = src.filter(q(by).isin(list(by_domain)))
    counts = src.groupBy(*[q(k).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    dom_spec = ({by: list(by_domain)} if by else {})
    dom_spec[col] = list(domain)
    grid = _domain(df.sparkSession, dom_spec)
    # counts has at most |by_domain| × |domain| rows: a proven broadcast bound
    out = (grid.join(F.broadcast(counts), keys, "left")
           .withColumn("count", F.coalesce("_n", F.lit(0)).cast("bigint")).drop("_n"))
    total = F.sum("count").over(Window.partitionBy(by)) if by else F.sum("count").over(Window.partitionBy())
    out = out.withColumn("percent", X.percent(F.try_divide(F.col("count").cast("double"), total), digits))
    sel = ([q(by)] if by else []) + [q(col).alias(code_name)]
    if labels:
        sel.append(X.map_codes(q(col), labels).alias(label_name))
    return out.select(*sel, "count", "percent")


def crosstab(df: DataFrame, row: str, col: str, row_domain: Sequence[int],
             col_values: Mapping[int, str]) -> DataFrame:
    """Rows × labelled code columns of counts, zero-filled, all rows of
    ``row_domain`` present. One conditional aggregate (an explicit pivot)."""
    src = df.filter(q(row).isin(list(row_domain)) & q(col).isin(list(col_values)))
    wide = src.groupBy(q(row).alias(row)).agg(*[
        F.count_if(q(col) == k).alias(snake(v)) for k, v in col_values.items()])
    grid = _domain(df.sparkSession, {row: list(row_domain)})
    out = grid.join(F.broadcast(wide), row, "left")
    return out.select(row, *[F.coalesce(snake(v), F.lit(0)).cast("bigint").alias(snake(v))
                             for v in col_values.values()])


def controlled_means(df: DataFrame, bins: Sequence[str], group: str, measure: str,
                     name: str | None = None) -> DataFrame:
    """Mean of ``measure`` per bin(s) × group; empty cells are absent and
    rows with a NULL bin form no cell."""
    cond = F.lit(True)
    for b in list(bins) + [group]:
        cond = cond & q(b).isNotNull()
    return (df.filter(cond).groupBy(*[q(b) for b in bins], q(group))
            .agg(F.avg(q(measure)).alias(name or f"avg_{measure}")))


def county_summary(df: DataFrame, county: str = "county_code", amount: str = "loan_amount",
                   rate: str = "interest_rate") -> DataFrame:
    """Applications, mean amount, mean rate per county."""
    return (df.groupBy(q(county).alias("county_code"))
            .agg(F.count(F.lit(1)).alias("total_loans"),
                 F.avg(q(amount)).alias("avg_loan"),
                 F.avg(q(rate)).alias("avg_rate")))


def postal_counts(df: DataFrame, code: str = "Entity.HeadquartersAddress.PostalCode",
                  count: str = "Company_Count", region: str | None = "Reigon_Clean",
                  region_value: str = "US-NC") -> DataFrame:
    """Company count per cleaned 5-digit postal code."""
    if region and region in df.columns:
        df = df.filter(q(region) == region_value)
    zip5 = X.zfill(F.substring(X.strip(q(code).cast("string")), 1, 5), 5)
    return (df.select(zip5.alias("ZIP5"), q(count).alias("_c"))
            .filter(F.col("ZIP5").rlike(r"^\d{5}$"))
            .groupBy("ZIP5").agg(F.sum("_c").alias("company_count")))


def class_balance(df: DataFrame, label: str, digits: int | None = None) -> DataFrame:
    """Count and share per class."""
    share = F.col("count") / F.sum("count").over(Window.partitionBy())
    out = (df.groupBy(q(label).alias(label)).agg(F.count(F.lit(1)).alias("count"))
           .withColumn("share", share if digits is None else X.round_half_even(share, digits)))
    return out


def table_summary(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Row count, column count and (optionally) the mean of a 0/1 flag
    (the approval rate) in one global aggregate; partial counts and sums are
    combined map-side, so only one row per task reaches the final task."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")]
    if flag is not None:
        aggs.append(F.avg(q(flag).cast("double")).alias(f"{flag}_rate"))
    return df.agg(*aggs)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct value combinations of ``cols`` (NULL is a value, as in
    pandas ``unique``); a hash aggregate with map-side dedup."""
    return df.select(*[q(c).alias(c) for c in cols]).distinct()


def null_profile(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Missing values per column in ONE aggregate, unpivoted; the
    ``top`` columns with most missing values (ties by name)."""
    wide = df.agg(*[F.count_if(q(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot([], [q(c) for c in df.columns], "column", "null_count")
    if top is None:
        return long
    w = Window.orderBy(F.col("null_count").desc(), F.col("column").asc())
    # one row per column of the input: a schema-sized table
    return long.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= top)


#: Distinct (column, value) pairs that a task holds before it emits them.
HELD_VALUES = 100_000


def value_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows per distinct non-NULL value of every column: (``c`` column number,
    ``v`` value as text, ``n``), from ONE scan whatever the number of columns.

    Tasks count the values of their batches column by column and hold the
    combined counts up to ``HELD_VALUES``; only distinct pairs are shuffled, so
    a value that fills a third of the table is one row per task."""
    from lendlens.session import ship_package
    ship_package(df.sparkSession)
    cols, types = list(df.columns if cols is None else cols), dict(df.dtypes)
    as_text = [(F.when(q(c) == 0, F.lit(0.0)).otherwise(q(c)) if types[c] in ("double", "float") else q(c)).cast("string").alias(f"c{i}")
               for i, c in enumerate(cols)]

    def combined(parts: list) -> pa.Table:
        return pa.concat_tables(parts).group_by(["c", "v"]).aggregate([("n", "sum")]).rename_columns(["c", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for i, column in enumerate(batch.columns):
                found = column.drop_null().value_counts()
                values = found.field(0).cast(pa.string())
                parts.append(pa.table([pa.array(np.full(len(found), i), pa.int32()), values, found.field(1).cast(pa.int64())],
                                      names=["c", "v", "n"]))
                held += len(found)
            if held > HELD_VALUES:
                parts = [combined(parts)]
                if parts[0].num_rows > HELD_VALUES // 2:
                    yield from parts[0].to_batches()
                    parts = []
                held = sum(t.num_rows for t in parts)
        if parts:
            yield from combined(parts).to_batches()

    counted = df.select(*as_text).mapInArrow(run, "c int, v string, n bigint")
    return counted.groupBy("c", "v").agg(F.sum("n").alias("n"))


def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A10: exact distinct non-NULL values per column, from one scan."""
    cols = list(df.columns if cols is None else cols)
    wide = value_counts(df, cols).agg(*[F.count_if(F.col("c") == i).alias(c) for i, c in enumerate(cols)])
    return wide.unpivot([], [q(c) for c in cols], "column", "n_distinct")


def column_profile(df: DataFrame, cols: Sequence[str], top_n: int) -> dict[str, tuple[int, list[str]]]:
    """Distinct non-NULL values and the ``top_n`` most frequent ones (ties:
    value ascending) of every column, from one scan and one shuffle of the
    distinct pairs; ``top_n`` values per column and task reach the last step."""
    cols = list(cols)
    if not cols:
        return {}
    out: dict[str, tuple[int, list[str]]] = {c: (0, []) for c in cols}
    for r in sorted(_profile_rows(df, cols, top_n).collect(), key=lambda r: (r["c"], r["r"])):
        c = cols[r["c"]]
        out[c] = (r["d"], out[c][1]) if r["r"] == 0 else (out[c][0], [*out[c][1], r["v"]])
    return out


def _profile_rows(df: DataFrame, cols: Sequence[str], top_n: int) -> DataFrame:
    """Per column a row ``r`` = 0 with the distinct number ``d``, and its top
    values by rank ``r``; both read one exchange of the counts."""
    counts = value_counts(df, cols)
    order = Window.partitionBy("c").orderBy(F.col("n").desc(), F.col("v").asc())
    top = counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top_n).select(
        "c", "r", "v", "n", F.lit(None).cast("bigint").alias("d"))
    # the sum is asked for too, so that both branches read the same aggregate
    sizes = counts.groupBy("c").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n")).select(
        "c", F.lit(0).alias("r"), F.lit(None).cast("string").alias("v"), "n", "d")
    return sizes.union(top)


def high_cardinality(df: DataFrame, cols: Sequence[str], max_distinct: int) -> list[str]:
    """Columns with more than ``max_distinct`` distinct non-NULL values, by
    exact counts of all columns from one scan."""
    if not cols:
        return []
    sizes = distinct_profile(df, cols).collect()
    return [r["column"] for r in sizes if r["n_distinct"] > max_distinct]


def reduce_categories(df: DataFrame, cols: Sequence[str], top_n: int = 10,
                      max_distinct: int = 20, other: str = "OTHER") -> DataFrame:
    """In columns with more than ``max_distinct`` distinct values, keep
    the ``top_n`` most frequent values and replace the rest (and NULL) by
    ``other``. One scan profiles all columns; the second, lazy one maps them
    by a literal list of at most ``top_n`` values per column, without a join.
    """
    out = df
    for c, (distinct, keep) in column_profile(df, cols, top_n).items():
        if distinct > max_distinct:
            text = q(c).cast("string")
            if dict(df.dtypes)[c] in ("double", "float"):  # as counted: -0.0 is 0.0
                text = F.when(q(c) == 0, F.lit(0.0)).otherwise(q(c)).cast("string")
            out = out.withColumn(c, F.when(text.isin(keep), text).otherwise(F.lit(other)))
    return out


#: Digits of a double that one pass of ``column_medians`` settles.
DIGIT_BITS = 16


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact (interpolated) median per numeric column, one row.

    The doubles are read as ordered 64-bit integers, and the two middle ranks
    of all columns at once are narrowed digit by digit: a pass counts per
    column the next 16 bits of the values that share the digits found so far
    (numpy histograms per task), the running sum over at most 65,536 counts
    tells the digit that holds the rank. Four scans whatever the size or the
    number of columns; nothing is exploded, sorted or written. NULLs are
    skipped; a column without values gets NULL; even counts interpolate
    ``a + (b - a) / 2``.
    """
    cols = list(cols)
    spark = df.sparkSession
    from lendlens.session import ship_package
    ship_package(spark)
    numbers = df.select(*[q(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    # per column the prefixes of its middle values (one or two) and the rank inside each
    found: dict[int, list[tuple[int, int]]] = {i: [(0, -1)] for i in range(len(cols))}
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        first = shift == 64 - DIGIT_BITS
        if not found:
            break
        asked = {i: sorted({p for p, _ in own}) for i, own in found.items()}
        counts = numbers.mapInArrow(_digit_counts(asked, shift), "c int, p int, d int, n bigint").groupBy("c", "p", "d").agg(F.sum("n").alias("n"))
        by = Window.partitionBy("c", "p")
        upto = F.sum("n").over(by.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        total = F.sum("n").over(by)
        placed = counts.select("c", "p", "d", "n", upto.alias("upto"), total.alias("total"))
        if first:  # the middle ranks follow from the number of values
            ranks = F.array(F.expr("(total - 1) div 2"), F.expr("total div 2"))
        else:
            inside = []
            for i, own in found.items():
                for k, p in enumerate(asked[i]):
                    inside += [F.lit(2 * i + k), F.array(*[F.lit(r).cast("bigint") for prefix, r in own if prefix == p])]
            ranks = F.element_at(F.create_map(*inside), 2 * F.col("c") + F.col("p"))
        hit = placed.withColumn("rank", F.explode(ranks)).filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        rows = hit.select("c", "p", "d", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("inside")).collect()  # two per column
        found = {}
        for r in rows:
            prefix = asked[r["c"]][r["p"]]
            found.setdefault(r["c"], []).append(((prefix << DIGIT_BITS) + r["d"], r["inside"]))
    values = []
    for i in range(len(cols)):
        own = sorted(_double_of(p) for p, _ in found.get(i, []))
        values.append(own[0] + (own[-1] - own[0]) * 0.5 if own else None)
    return spark.createDataFrame([tuple(values)], ", ".join(f"`{c}` double" for c in cols))


def _digit_counts(asked: dict[int, list[int]], shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(i, k): np.zeros(1 << DIGIT_BITS, np.int64) for i, own in asked.items() for k in range(len(own))}
        for batch in batches:
            for i, own in asked.items():
                v = batch.column(i).drop_null().to_numpy(zero_copy_only=False) + 0.0
                bits = v.view(np.uint64)
                ordered = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))
                rest = ordered >> np.uint64(shift)
                for k, prefix in enumerate(own):
                    here = rest
                    if shift + DIGIT_BITS < 64:
                        here = rest[rest >> np.uint64(DIGIT_BITS) == np.uint64(prefix)]
                    sums[i, k] += np.bincount((here & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64), minlength=1 << DIGIT_BITS)
        for (i, k), n in sums.items():
            d = np.flatnonzero(n)
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), x), pa.int32()) for x in (i, k)] + [
                    pa.array(d, pa.int32()), pa.array(n[d])], names=["c", "p", "d", "n"])

    return run


def _double_of(ordered: int) -> float:
    bits = ordered & ((1 << 63) - 1) if ordered >> 63 else ~ordered & ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])
