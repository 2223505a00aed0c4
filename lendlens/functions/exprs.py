"""Scalar column functions (pure ``Column`` → ``Column``; all JVM-side).

Every function returns a native Spark expression, so the plans stay inside
whole-stage codegen; no Python UDF is used anywhere in the package.

Missing-value semantics follow the reference's pandas behaviour, made explicit
for SQL three-valued logic (see SURVEY §1.3, traps T1–T23).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text accepted as a number by a coercing parser: optional sign, digits with
# optional fraction (or a bare fraction), optional exponent, blanks around.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Whitespace set stripped by ``strip`` (space, tab, CR, LF).
WHITESPACE = " \t\r\n"


def strip(c: ColumnOrName) -> Column:
    """Trim surrounding whitespace (not only spaces)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def to_number(c: ColumnOrName) -> Column:
    """Coerce text to DOUBLE; anything that is not a plain number → NULL.

    ``try_cast`` alone would accept forms such as ``12d`` and ANSI ``cast``
    would throw, so the text is guarded by ``NUMBER_PATTERN`` first.
    """
    c = _c(c)
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), strip(text).try_cast("double"))


def to_int(c: ColumnOrName) -> Column:
    """Coerce an integer code; non-integral or non-numeric text → NULL."""
    n = to_number(c)
    return F.when(n == F.floor(n), n.cast("int"))


def strip_commas(c: ColumnOrName) -> Column:
    """C2 helper: remove thousands separators."""
    return F.regexp_replace(_c(c).cast("string"), ",", "")


def to_number_commas(c: ColumnOrName) -> Column:
    """Strip thousands commas, then C1."""
    return to_number(strip_commas(c))


def norm_key(c: ColumnOrName) -> Column:
    """Key normalisation — strip + upper."""
    return F.upper(strip(c))


def null_if_in(c: ColumnOrName, values: Iterable[str]) -> Column:
    """C4: placeholder text (after strip) → NULL, else the stripped text."""
    s = strip(c)
    return F.when(~F.coalesce(s.isin(list(values)), F.lit(False)), s)


def zfill(c: ColumnOrName, width: int) -> Column:
    """Left zero-fill to ``width``; never truncates; keeps a leading sign."""
    s = _c(c).cast("string")
    signed = s.rlike(r"^[+-]")
    body = F.substring(s, 2, 1 << 30)
    filled_signed = F.concat(F.substring(s, 1, 1),
                             F.lpad(body, width - 1, "0"))
    return (F.when(F.length(s) >= width, s)
            .when(signed, filled_signed)
            .otherwise(F.lpad(s, width, "0")))


def first_number(c: ColumnOrName) -> Column:
    """First run of digits as DOUBLE (``<20%`` → 20); none → NULL."""
    s = _c(c).cast("string")
    return F.nullif(F.regexp_extract(s, r"(\d+)", 1), F.lit("")).try_cast("double")


def map_codes(c: ColumnOrName, mapping: Mapping, fallback_to_code: bool = False) -> Column:
    """Code → label by a literal map; a miss gives NULL (or the code)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), _c(c))
    return F.coalesce(looked, _c(c).cast("string")) if fallback_to_code else looked


def flag(c: ColumnOrName, codes: Sequence) -> Column:
    """1 when the value is one of ``codes``, else 0 (NULL → 0)."""
    return F.coalesce(_c(c).isin(list(codes)), F.lit(False)).cast("int")


# DTI bins kept verbatim by the re-binning rule.
DTI_KEEP_BINS = ["<20%", "20%-<30%", "50%-60%", ">60%"]


def bin_dti(c: ColumnOrName, keep_30_36: bool = False) -> Column:
    """C14: re-bin debt-to-income text into six bins (T5).

    Four range labels pass through; plain numbers are binned
    ``<20 / <30 / <40 / <50 / <=60 / >60``; anything else (``30%-<36%``,
    ``Exempt``, NULL, junk) → NULL. ``keep_30_36`` maps ``30%-<36%`` to
    ``30%-<40%`` instead of dropping it (the evident intent).
    """
    s = _c(c).cast("string")
    num = to_number(s)
    out = (F.when(s.isin(DTI_KEEP_BINS), s)
           .when(num < 20, "<20%")
           .when(num < 30, "20%-<30%")
           .when(num < 40, "30%-<40%")
           .when(num < 50, "40%-<50%")
           .when(num <= 60, "50%-60%")
           .when(num > 60, ">60%"))
    if keep_30_36:
        out = F.when(s == "30%-<36%", "30%-<40%").otherwise(out)
    return out


def dti_binnable(c: ColumnOrName, keep_30_36: bool = False) -> Column:
    """Exactly when ``bin_dti`` is non-NULL, as a cheap predicate (no numeric
    comparisons): a kept label or a plain number. Filtering on this instead of
    on the bin keeps the bin expression out of the pushed-down filter."""
    s = _c(c).cast("string")
    keep = DTI_KEEP_BINS + (["30%-<36%"] if keep_30_36 else [])
    return F.coalesce(s.isin(keep) | s.rlike(NUMBER_PATTERN), F.lit(False))


def ordinal(c: ColumnOrName, order: Sequence[str]) -> Column:
    """Position of the value in ``order`` (0-based); absent/NULL → NULL."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), _c(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def cut(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``[lo, hi)`` interval label; outside all intervals → NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs len(edges) == len(labels) + 1")
    c = _c(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c >= F.lit(lo)) & (c < F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def cut_index(c: ColumnOrName, edges: Sequence[float]) -> Column:
    """Bin index (0-based) of ``cut``, for ordering labelled bins."""
    c = _c(c)
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (c >= F.lit(lo)) & (c < F.lit(hi))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def finite(c: ColumnOrName) -> Column:
    """C20: NaN and ±inf → NULL."""
    c = _c(c)
    return F.when(~(F.isnan(c) | c.isin(float("inf"), float("-inf"))), c)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, plus_one: bool = True) -> Column:
    """``num / (den + 1)``; division by zero → NULL (never an error)."""
    d = _c(den) + F.lit(1) if plus_one else _c(den)
    return F.try_divide(_c(num).cast("double"), d.cast("double"))


def round_half_even(c: ColumnOrName, digits: int) -> Column:
    """Round like numpy/pandas ``round`` (scale, round-half-even, unscale).

    numpy rounds the *binary* value ``x * 10**d`` to the nearest even integer
    and divides back; ``rint`` reproduces that bit for bit.
    """
    scale = float(10 ** digits)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def percent(c: ColumnOrName, digits: int = 2) -> Column:
    """Share → percent rounded half-even."""
    return round_half_even(_c(c) * F.lit(100.0), digits)


def decision(p: ColumnOrName, threshold: float) -> Column:
    """Probability → ``APPROVED`` / ``DENIED`` at ``threshold``."""
    return F.when(_c(p) >= F.lit(threshold), "APPROVED").otherwise("DENIED")


def gap_label(gap: ColumnOrName, dead_band: float = 3.0) -> Column:
    """Signed gap (fair − main, points) → agree / main_higher / fair_higher."""
    g = _c(gap)
    return (F.when(F.abs(g) < F.lit(dead_band), "agree")
            .when(g < 0, "main_higher")
            .otherwise("fair_higher"))


def not_in_keep_null(c: ColumnOrName, values: Sequence) -> Column:
    """F2 predicate: value not in ``values``; NULL rows pass."""
    return ~F.coalesce(_c(c).isin(list(values)), F.lit(False))


def ne_keep_null(c: ColumnOrName, value) -> Column:
    """F3 predicate: ``c != value``; NULL rows pass."""
    return ~_c(c).eqNullSafe(F.lit(value))


def content_hash(df, seed: int | None = None, cols: Sequence[str] | None = None) -> Column:
    """Seeded 64-bit hash of a row's content (stable under recomputation).
    Map columns cannot be hashed by Spark and are left out; rows that differ
    only in a map column share a hash (the callers only need a stable key)."""
    from pyspark.sql.types import MapType
    kinds = {f.name: f.dataType for f in df.schema.fields}
    use = [c for c in (cols or df.columns) if not isinstance(kinds.get(c), MapType)]
    args = ([F.lit(seed)] if seed is not None else []) + [F.col(f"`{c}`") for c in use]
    return F.xxhash64(*args)

