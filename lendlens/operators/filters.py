"""Row filters (F1–F12) with the reference's missing-value semantics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions import exprs as X
from lendlens.sources.tables import q


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """keep rows whose value is in the list (NULL dropped)."""
    return df.filter(q(col).isin(list(values)))


def exclude(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """drop rows whose value is in the list; NULL rows are kept."""
    if col not in df.columns:
        return df
    return df.filter(X.not_in_keep_null(q(col), values))


def exclude_ne(df: DataFrame, col: str, value) -> DataFrame:
    """keep ``col != value``; NULL rows are kept."""
    if col not in df.columns:
        return df
    return df.filter(X.ne_keep_null(q(col), value))


def require_non_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """drop rows with a NULL in any listed column that exists."""
    present = [c for c in cols if c in df.columns]
    return df.dropna(subset=present) if present else df


def in_range(c: Column, lo=None, hi=None, lo_closed: bool = False,
             hi_closed: bool = False) -> Column:
    """F5 predicate: open/closed numeric range (missing bound = unbounded)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= lo) if lo_closed else (c > lo))
    if hi is not None:
        cond = cond & ((c <= hi) if hi_closed else (c < hi))
    return cond


def good_key(c: Column) -> Column:
    """F10 predicate: key not NULL, not empty, not the text ``NAN``."""
    return c.isNotNull() & ~c.isin("", "NAN")


def bbox_overlap(minx: float, miny: float, maxx: float, maxy: float,
                 cols: tuple[str, str, str, str] = ("minx", "miny", "maxx", "maxy")) -> Column:
    """F11 predicate: a row's box overlaps the query box (inclusive edges)."""
    a, b, c, d = (F.col(x) for x in cols)
    return (c >= minx) & (a <= maxx) & (d >= miny) & (b <= maxy)


def bbox_filter(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """keep rows whose bounding box overlaps ``[minx,maxx]×[miny,maxy]``."""
    return df.filter(bbox_overlap(minx, miny, maxx, maxy))


def filter_if_column(df: DataFrame, col: str, predicate) -> DataFrame:
    """apply ``predicate(column)`` only when the column exists."""
    return df.filter(predicate(q(col))) if col in df.columns else df
