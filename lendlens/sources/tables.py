"""Scans, sinks and column maintenance."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.functions import codes


# --------------------------------------------------------------------------
# scans
# --------------------------------------------------------------------------
def csv_headers(spark: SparkSession, files: Sequence[str], threads: int = 32) -> list[tuple[str, ...] | None]:
    """Header names of each CSV file (``None``: an empty file). Only first lines
    are read, by file-system calls side by side (as Spark lists files itself):
    no job, whatever the number and size of the files."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> tuple[str, ...] | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            source = codec.createInputStream(stream) if codec is not None else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
        finally:
            stream.close()
        return tuple(next(csv.reader([line]))) if line else None

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(first_line, files))


def _files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Files of a source as Spark lists them, as URIs, in order of their names."""
    return sorted(spark.read.schema("line string").text(path).inputFiles())


def read_csv_table(spark: SparkSession, path: str | Sequence[str],
                   columns: Sequence[str] | Callable[[str], bool] | None = None,
                   header: Sequence[str] | None = None,
                   normalize: bool = True) -> DataFrame:
    """Bronze CSV scan — every column STRING, no inference pass.

    ``columns`` as a list is strict (absent names raise); as a predicate it
    silently keeps the matching names. Missing-value tokens become NULL (S6)
    unless ``normalize=False``. The projection is applied before any other
    operator, so the CSV reader prunes the remaining columns.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if header is None and len(paths) > 1:  # by name: each source has its own header
        parts = [read_csv_table(spark, p, normalize=False) for p in paths]
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part, allowMissingColumns=True)
    else:
        names = list(header) if header is not None else next(
            (h for f in _files(spark, paths) for h in csv_headers(spark, [f]) if h), ())
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        # files of one source must agree on the header: the reader checks it
        df = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
              .option("enforceSchema", str(header is not None).lower()).schema(schema).csv(paths))
    if columns is not None:
        if callable(columns):
            keep = [c for c in df.columns if columns(c)]
        else:
            missing = [c for c in columns if c not in df.columns]
            if missing:
                raise ValueError(f"columns not in source: {missing}")
            keep = list(columns)
        df = df.select(*[F.col(f"`{c}`") for c in keep])
    return normalize_na(df) if normalize else df


def normalize_na(df: DataFrame, cols: Iterable[str] | None = None,
                 tokens: Sequence[str] = tuple(codes.NA_TOKENS)) -> DataFrame:
    """Exact missing-value tokens in STRING columns → NULL (one select)."""
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in targets:
            c = F.when(~F.coalesce(c.isin(list(tokens)), F.lit(False)), c).alias(f.name)
        out.append(c)
    return df.select(*out)


def load_years(spark: SparkSession, base: str, years: Sequence[int],
               pattern: str = "{base}/year={year}", fmt: str = "csv",
               year_col: str = "year") -> DataFrame:
    """Read one file set per year, any file name pattern, with a literal
    year column; union by column name (a column that a year lacks is NULL).

    CSV files may differ in their headers, inside a year too: there is one read
    per year and distinct header, whatever the number of files. A filter on the
    literal year drops the reads of all other years."""
    parts = []
    for y in years:
        path = pattern.format(base=base, year=y)
        if fmt != "csv":
            reads = [spark.read.format(fmt).load(path)]
        else:
            files = _files(spark, path)
            headers = csv_headers(spark, files)
            sets: dict[tuple, list[str]] = {}
            for file, header in zip(files, headers, strict=True):
                if header:
                    sets.setdefault(header, []).append(file)
            if len(sets) == 1:
                reads = [read_csv_table(spark, path, header=header) for header in sets]
            else:  # explicit files: their names are no patterns
                reads = [read_csv_table(spark, [_exact(f) for f in some], header=header) for header, some in sets.items()]
        parts += [df.withColumn(year_col, F.lit(int(y))) for df in reads]
    if not parts:
        raise ValueError(f"no file with a header for the years {list(years)}")
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def _exact(uri: str) -> str:
    """A listed file as a path that matches this file alone."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(uri))


# --------------------------------------------------------------------------
# sinks
# --------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", options: Mapping[str, str] | None = None) -> None:
    """Write a result. Parquet by default; CSV with header on request;
    ``options`` are the writer's.

    Never ``coalesce(1)``: each task writes its own file, so the write stays
    parallel at any size.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.options(**(options or {})).format(fmt).save(path)


def write_many(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> None:
    """Fan out several results computed from one shared input."""
    for name, df in tables.items():
        write_table(df, f"{base.rstrip('/')}/{name}", fmt=fmt)


# --------------------------------------------------------------------------
# column maintenance
# --------------------------------------------------------------------------
def q(name: str) -> Column:
    """Column by exact name (dots and dashes are not path syntax)."""
    return F.col(f"`{name}`")


def keep_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listed ∩ existing columns, in list order."""
    present = set(df.columns)
    return df.select(*[q(c) for c in cols if c in present])


def drop_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    present = set(df.columns)
    return df.drop(*[c for c in cols if c in present])


def drop_family(df: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Drop columns equal to a name or encoded from it (``name_…``)."""
    prefixes = list(prefixes)
    doomed = [c for c in df.columns
              if any(c == p or c.startswith(p + "_") for p in prefixes)]
    return df.drop(*doomed)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P5: rename by map (absent names ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def clean_columns(df: DataFrame, mode: str = "strip") -> DataFrame:
    """Clean header names — ``strip``, ``lower`` (strip+lower) or
    ``symbols`` (``[<>[]]`` → ``_``). Raises on a name collision."""
    def fix(n: str) -> str:
        if mode == "strip":
            return n.strip()
        if mode == "lower":
            return n.strip().lower()
        if mode == "symbols":
            return re.sub(r"[<>\[\]]", "_", n)
        raise ValueError(mode)
    names = [fix(n) for n in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"cleaned column names collide: {names}")
    return df.toDF(*names)


def require_columns(df: DataFrame, cols: Sequence[str], name: str = "dataset") -> DataFrame:
    """Raise when a required column is absent."""
    for c in cols:
        if c not in df.columns:
            raise ValueError(f"Missing '{c}' in {name}")
    return df


# --------------------------------------------------------------------------
# unions
# --------------------------------------------------------------------------
def union_all_columns(*dfs: DataFrame) -> DataFrame:
    """Union keeping every column; absent columns are NULL.

    Columns whose types disagree between inputs are reconciled to STRING
    first (a mixed column), so the union never fails on a type conflict.
    """
    types: dict[str, set] = {}
    for d in dfs:
        for f in d.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    conflicted = {n for n, ts in types.items() if len(ts) > 1}
    fixed = []
    for d in dfs:
        fixed.append(d.select(*[
            q(c).cast("string").alias(c) if c in conflicted else q(c) for c in d.columns]))
    out = fixed[0]
    for d in fixed[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def labelled_union(positive: DataFrame, negative: DataFrame, label: str = "approved",
                   drop: Sequence[str] = ("action_taken", "activity_year")) -> DataFrame:
    """Positive rows labelled 1, negative 0, leakage columns dropped."""
    out = union_all_columns(positive.withColumn(label, F.lit(1)),
                            negative.withColumn(label, F.lit(0)))
    return drop_existing(out, drop)


def infer_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """S1 type inference over whole columns (as a CSV reader without
    ``low_memory`` does): a STRING column whose every non-NULL value is a
    plain number becomes DOUBLE; anything else stays STRING.

    One aggregate pass computes, per column, the count of non-numeric
    values; the result is one row per input schema (schema-sized).
    """
    from lendlens.functions.exprs import NUMBER_PATTERN, to_number
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
               and (cols is None or f.name in cols)]
    if not strings:
        return df
    bad = df.agg(*[F.count_if(q(c).isNotNull() & ~q(c).rlike(NUMBER_PATTERN)).alias(c)
                   for c in strings]).first().asDict()
    numeric = {c for c in strings if bad[c] == 0}
    return df.select(*[to_number(q(c)).alias(c) if c in numeric else q(c) for c in df.columns])
