"""Quality rules with adaptive thresholds (operator 10).

Every whole text gives a few ratios. One mergeable quantile sketch (KLL) of
each ratio is kept per (language, source); the sketches are merged further to
the language and to the whole corpus. A document is judged against the
thresholds of its own group, or of the language or corpus where the group has
fewer than ``min_group`` documents:

    low  = q25 - reach * spread      high = q75 + reach * spread
    spread = max(q75 - q25, the ratio's least spread)

No cutoff is fixed: the least spread only keeps a constant ratio (most groups
have no repeated line at all) from turning any deviation into an outlier.

Defined results: a null or empty text has no words, all counts 0, and fails
the base rules. Null language and null source are groups of their own.
Repeated rows are judged each by itself and alike. An empty table gives an
empty result. A column of the input that is named like the output keeps its
values: the output column's name then gets an underscore.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import cut, fresh, per_text, small, table, word_ids

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_chars", "n_lines")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: ratio -> (numerator, denominator, side(s) that reject, least spread)
RATIOS = {
    "mean_word_length": ("word_chars", "n_words", "both", 0.5),
    "symbol_share": ("n_symbols", "n_chars", "high", 0.005),
    "upper_share": ("n_upper", "n_chars", "high", 0.02),
    "dup_line_share": ("n_dup_lines", "n_lines", "high", 0.15),
    "repeat_share": ("n_repeat_words", "n_words", "high", 0.1),
}


def repeated_words(tokens: list, n: int = 3) -> int:
    """Words inside an ``n``-word window that the text has twice or more."""
    if len(tokens) <= n:
        return 0
    ids = word_ids(tokens)
    grams = ids[: len(ids) - n + 1]
    for k in range(1, n):  # pairs of class numbers stay below len(ids) ** 2
        _, grams = np.unique(grams * (len(ids) + 1) + ids[k : len(ids) - n + 1 + k], return_inverse=True)
    again = np.bincount(grams)[grams] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(n):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one whole text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    tokens = raw.split()
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    upper = np.frombuffer(raw, np.uint8)
    return (
        len(tokens), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup,
        repeated_words(tokens), int(((upper >= 65) & (upper <= 90)).sum()), len(text), lines,
    )


def _ratio(q: str, name: str) -> Column:
    top, below, _, _ = RATIOS[name]
    return F.when(F.col(f"{q}.{below}") > 0, F.col(f"{q}.{top}") / F.col(f"{q}.{below}"))


def thresholds(counted: DataFrame, q: str, groups: tuple[str, ...], min_group: int, reach: float,
               sketch_k: int) -> DataFrame:
    """One row per group (named g0, g1, ...) with ``low_*`` and ``high_*``.

    Map tasks build partial sketches, so a hot source is merged, not moved;
    the coarser levels merge the group sketches again.
    """
    keys = [f"g{i}" for i in range(len(groups))]
    ratios = counted.select(*[F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)],
                            *[_ratio(q, r).alias(r) for r in RATIOS])
    sketches = cut(ratios.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(r, F.lit(sketch_k)).alias(r) for r in RATIOS]), "sketches")

    def level(by: list[str], depth: int) -> DataFrame:
        merged = sketches if by == keys else sketches.groupBy(*by).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(r).alias(r) for r in RATIOS])
        quartiles = [F.when(F.kll_sketch_get_n_double(r) > 0, F.kll_sketch_get_quantile_double(
            r, F.array(F.lit(0.25), F.lit(0.75)))).alias(f"{r}_{depth}") for r in RATIOS]
        return merged.select(*[F.col(k).alias(f"{k}_{depth}") for k in by], F.col("n").alias(f"n_{depth}"), *quartiles)

    out, depths = level(keys, 0), range(len(keys) + 1)
    for depth in depths[1:]:
        by = keys[: len(keys) - depth]
        if not by:  # the corpus level is one row of quartiles
            whole = level(by, depth).first()
            out = out.withColumns({f"n_{depth}": F.lit(whole[f"n_{depth}"] or 0).cast("long")} | {
                f"{r}_{depth}": F.array(*[F.lit(x).cast("double") for x in whole[f"{r}_{depth}"] or (None, None)]) for r in RATIOS})
            continue
        same = F.lit(True)
        for k in by:
            same &= F.col(f"{k}_0").eqNullSafe(F.col(f"{k}_{depth}"))
        out = out.join(small(level(by, depth)), same)
    chosen = F.lit(depths[-1])
    for depth in reversed(depths[:-1]):
        chosen = F.when(F.col(f"n_{depth}") >= min_group, F.lit(depth)).otherwise(chosen)
    out = out.withColumn("level", chosen)
    for r, (_, _, side, least) in RATIOS.items():
        two = F.element_at(F.array(*[F.col(f"{r}_{d}") for d in depths]), F.col("level") + 1)
        spread = F.greatest(two[1] - two[0], F.lit(least)) * reach
        out = out.withColumn(f"high_{r}", two[1] + spread)
        if side == "both":
            out = out.withColumn(f"low_{r}", two[0] - spread)
    return out.select(*[F.col(f"{k}_0").alias(k) for k in keys], "level",
                      *[c for c in out.columns if c.startswith(("low_", "high_"))])


def quality_rules(df: DataFrame, text_col: str = "text", groups: tuple[str, ...] = ("lang", "source"),
                  out: str = "quality", min_words: int = 50, max_repeat_percent: int = 50, min_group: int = 100,
                  reach: float = 4.0, sketch_k: int = 400, keep_text: bool = True) -> DataFrame:
    """``df`` with a struct column ``out``: the counts, ``base_failed``,
    ``failed`` (names of the adaptive rules that reject) and ``kept``."""
    (q, o) = fresh(df, "counts", out)
    with_counts = df.withColumn(
        q, per_text(text_counts, ", ".join(f"{c} bigint" for c in COUNTS))(F.col(text_col)))
    counted = cut(with_counts if keep_text else with_counts.drop(text_col), "quality")
    limits = cut(thresholds(counted, q, groups, min_group, reach, sketch_k), "limits")
    (lim,) = fresh(counted, "limits")
    limits = small(limits.select(F.struct(*limits.columns).alias(lim)))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"{lim}.g{i}"))
    base = (F.col(f"{q}.n_words") < min_words) | (
        100 * F.col(f"{q}.n_repeat_words") > max_repeat_percent * F.col(f"{q}.n_words"))
    tests = []
    for r, (_, _, side, _) in RATIOS.items():
        bad = _ratio(q, r) > F.col(f"{lim}.high_{r}")
        if side == "both":
            bad |= _ratio(q, r) < F.col(f"{lim}.low_{r}")
        tests.append(F.when(bad, F.lit(r)))
    failed = F.array_compact(F.array(*tests))
    keep = [c for c in df.columns if keep_text or c != text_col]
    return counted.join(limits, same, "left").select(*keep, F.struct(
        *[F.col(f"{q}.{c}").alias(c) for c in COUNTS], base.alias("base_failed"), failed.alias("failed"),
        (~base & (F.size(failed) == 0)).alias("kept")).alias(o))


def op10_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality_rules(docs, keep_text=False)
    return judged.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")],
                         F.array_join("quality.failed", ",").alias("failed_rules"))
