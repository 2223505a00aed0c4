"""Lender tables: approval summary, league tables, fairness gaps and
recommendations (A1–A4, D1, J1–J3, J6, W1, O1–O3, O5).

All per-lender statistics come from ONE ``groupBy(lender)`` with conditional
aggregates (the reference's two pivots, two merges and a totals merge fold
into one hash aggregate with map-side partial aggregation, so a lender holding
a third of all rows costs no more than any other).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions import codes
from lendlens.functions import exprs as X
from lendlens.operators import joins
from lendlens.operators.filters import good_key
from lendlens.operators.window import global_row_number
from lendlens.session import materialize
from lendlens.sources.tables import q


# --------------------------------------------------------------------------
# registry (lender names)
# --------------------------------------------------------------------------
def clean_registry(registry: DataFrame, key: str = "LEI", name: str = "Entity.LegalName",
                   extra: Sequence[str] = ()) -> DataFrame:
    """Normalise registry keys and names: key strip+upper with bad keys
    removed (F10); name stripped with placeholder text → NULL (C4)."""
    return (registry
            .select(X.norm_key(q(key)).alias("lei"),
                    X.null_if_in(q(name), codes.NAME_PLACEHOLDERS).alias("legal_name"),
                    *[q(c) for c in extra])
            .filter(good_key(F.col("lei"))))


def registry_dedup(registry: DataFrame, key: str = "LEI",
                   name: str = "Entity.LegalName") -> DataFrame:
    """One name per lender key, the first non-NULL name in sort order."""
    return joins.dedup_first_name(clean_registry(registry, key, name), "lei", "legal_name")


# --------------------------------------------------------------------------
# approval summary and league tables (A1, O1, O2)
# --------------------------------------------------------------------------
def approval_summary(apps: DataFrame, registry: DataFrame | None = None,
                     key: str = "lei", action: str = "action_taken",
                     approved_code: int = 1, denied_code: int = 3,
                     min_apps: int = codes.MIN_APPS,
                     unknown_name: str | None = codes.UNKNOWN_NAME,
                     strategy: str | None = None) -> DataFrame:
    """A1 (+J1): approvals, denials, totals and rates per lender.

    Lenders with fewer than ``min_apps`` decided applications are dropped
    (HAVING). With a registry, the first name per key is attached (left
    join, ``strategy`` as in ``lookup_join``) and missing names become
    ``unknown_name`` (NULL kept if None); the counts are written once for it.
    """
    act = X.to_int(q(action)) if dict(apps.dtypes)[action] == "string" else q(action)
    facts = (apps
             .select(X.norm_key(q(key)).alias("lei"), act.alias("_act"))
             .filter(good_key(F.col("lei")) & F.col("_act").isin(approved_code, denied_code)))
    summary = (facts.groupBy("lei")
               .agg(F.count_if(F.col("_act") == approved_code).alias("approved_count"),
                    F.count_if(F.col("_act") == denied_code).alias("denied_count"))
               .withColumn("total_apps", F.col("approved_count") + F.col("denied_count"))
               .filter(F.col("total_apps") >= min_apps))
    approval = F.try_divide(F.col("approved_count").cast("double"), F.col("total_apps"))
    denial = F.try_divide(F.col("denied_count").cast("double"), F.col("total_apps"))
    summary = (summary
               .withColumn("approval_rate", approval)
               .withColumn("denial_rate", denial)
               .withColumn("approval_rate_pct", X.percent("approval_rate", 2))
               .withColumn("denial_rate_pct", X.percent("denial_rate", 2)))
    if registry is not None:
        summary = joins.lookup_join(materialize(summary, "lender-counts"), clean_registry(registry), "lei", "lei",
                                    reduce_dim=lambda d: joins.dedup_first_name(d, "lei", "legal_name"),
                                    strategy=strategy)
        if unknown_name is not None:
            summary = summary.withColumn("name_found", F.col("legal_name").isNotNull())
            summary = summary.withColumn("legal_name", F.coalesce("legal_name", F.lit(unknown_name)))
    cols = ["lei"] + (["legal_name"] if registry is not None else []) + [
        "approved_count", "denied_count", "total_apps", "approval_rate",
        "approval_rate_pct", "denial_rate", "denial_rate_pct"]
    if registry is not None and unknown_name is not None:
        cols.append("name_found")
    return summary.select(*cols)


# Sort keys of the four league tables (all descending, then
# lender key ascending as the stable tie-break).
LEAGUE_ORDERS = {
    "approvals": ["approved_count", "approval_rate"],
    "denials": ["denied_count", "denial_rate"],
    "approval_rate": ["approval_rate", "total_apps", "approved_count"],
    "denial_rate": ["denial_rate", "total_apps", "denied_count"],
}


def league_table(summary: DataFrame, by: str, key: str = "lei",
                 named_only: bool = False, name_col: str = "legal_name",
                 unknown_name: str = codes.UNKNOWN_NAME, written: bool = False) -> DataFrame:
    """O1/O2: the summary ranked by one of ``LEAGUE_ORDERS`` (1 = top)."""
    df = summary
    if named_only:
        df = df.filter(q(name_col) != unknown_name)
    order = [F.col(c).desc_nulls_last() for c in LEAGUE_ORDERS[by]] + [F.col(key).asc()]
    ranked = global_row_number(df, order, name="rank", written=written)
    return ranked.withColumn("rank", F.col("rank").cast("int"))  # lenders fit INT


def unmatched_lenders(summary: DataFrame) -> DataFrame:
    """Summary rows whose lender key found no name in the registry."""
    return summary.filter(~F.col("name_found"))


def lender_rankings(apps: DataFrame, registry: DataFrame | None,
                    min_apps: int = codes.MIN_APPS) -> dict[str, DataFrame]:
    """Q6 + S10: the eleven ranking outputs from ONE lender summary.

    The summary (one row per lender) is written once to the shared folder, so
    the other ten tables read that copy instead of aggregating the
    applications again, and a lost executor recomputes nothing upstream.
    """
    summary = materialize(approval_summary(apps, registry, min_apps=min_apps), "lender-summary")
    tables = {"lender_summary": summary,
              "named_summary": summary.filter(q("legal_name") != codes.UNKNOWN_NAME)}
    for by in LEAGUE_ORDERS:
        tables[f"top_by_{by}"] = league_table(summary, by, written=True)
    for by in LEAGUE_ORDERS:
        tables[f"named_top_by_{by}"] = league_table(summary, by, named_only=True, written=True)
    tables["unmatched_lenders"] = unmatched_lenders(summary)
    return tables


# --------------------------------------------------------------------------
# fairness table
# --------------------------------------------------------------------------
FAIRNESS_GROUPS = {  # short name → group value (fixed values)
    "white": "White",
    "black": "Black or African American",
    "asian": "Asian",
    "native": "American Indian or Alaska Native",
}


def fairness_stats(apps: DataFrame, key: str = "lei", group: str = "derived_race",
                   action: str = "action_taken",
                   groups: Mapping[str, str] = FAIRNESS_GROUPS,
                   reference: str = "white", score_group: str = "black",
                   min_counts: Mapping[str, int] | None = None, digits: int = 4) -> DataFrame:
    """A2–A4 + F8: per-lender rates, counts, gaps and fairness score from ONE
    conditional aggregate, then the minimum-count filter (HAVING)."""
    if min_counts is None:
        min_counts = {"white": codes.MIN_WHITE_BLACK, "black": codes.MIN_WHITE_BLACK}
    act = X.to_int(q(action)) if dict(apps.dtypes)[action] == "string" else q(action)
    facts = (apps
             .filter(act.isin(1, 3) & q(group).isin(list(groups.values())))
             .select(X.norm_key(q(key)).alias("lei"), q(group).alias("_g"),
                     (act == 1).cast("int").alias("_ok"))
             # a lender key that is missing forms no group (pandas groupby)
             .filter(F.col("lei").isNotNull()))
    aggs: list[Column] = [F.count(F.lit(1)).alias("total_loans")]
    for short, value in groups.items():
        in_g = F.col("_g") == value
        aggs.append(F.avg(F.when(in_g, F.col("_ok"))).alias(f"{short}_rate"))
        aggs.append(F.nullif(F.count_if(in_g), F.lit(0)).alias(f"{short}_count"))
    lenders = facts.groupBy("lei").agg(*aggs)
    others = [s for s in groups if s != reference]
    for short in others:
        lenders = lenders.withColumn(
            f"{short}_gap", X.round_half_even(F.col(f"{reference}_rate") - F.col(f"{short}_rate"), digits))
    lenders = lenders.withColumn("fairness_score", X.round_half_even(F.col(f"{score_group}_gap"), digits))
    cond = F.lit(True)
    for short, m in min_counts.items():
        cond = cond & (F.col(f"{short}_count") >= m)
    lenders = lenders.filter(cond)
    for short in groups:
        lenders = lenders.withColumn(f"{short}_rate", X.round_half_even(F.col(f"{short}_rate"), digits))
    return lenders


def fairness_table(apps: DataFrame, registry: DataFrame | None = None,
                   key: str = "lei", group: str = "derived_race",
                   action: str = "action_taken",
                   groups: Mapping[str, str] = FAIRNESS_GROUPS,
                   reference: str = "white", score_group: str = "black",
                   min_counts: Mapping[str, int] | None = None,
                   dedup_registry: bool = False, digits: int = 4,
                   strategy: str | None = None) -> DataFrame:
    """A4: per-lender approval rate and count per group, gap of each group
    to the reference group, fairness score, minimum-count filter, names,
    1-based rank by fairness score.

    ``min_counts`` maps short group names to a minimum count (the reference
    uses 100 for White and Black). ``dedup_registry=False`` reproduces the
    reference's join to an un-deduplicated registry (one row per name);
    ``strategy`` as in ``lookup_join``.
    """
    lenders = fairness_stats(apps, key, group, action, groups, reference, score_group,
                             min_counts, digits)
    others = [s for s in groups if s != reference]
    if registry is not None:
        reg = clean_registry(registry, extra=["Entity.LegalAddress.City", "Entity.LegalAddress.Region"])
        reg = reg.select("lei", F.col("legal_name").alias("institution_name"),
                         q("Entity.LegalAddress.City").alias("city"),
                         q("Entity.LegalAddress.Region").alias("state"))
        # one row per key: the first name in sort order (NULL names last),
        # then city and state — a total order, so the pick is deterministic
        first = F.min(F.struct(F.col("institution_name").isNull().alias("_nl"),
                               "institution_name", "city", "state"))

        def one_name(d):
            return d.groupBy("lei").agg(first.alias("_r")).select(
                "lei", "_r.institution_name", "_r.city", "_r.state")
        lenders = joins.lookup_join(materialize(lenders, "lender-rates"), reg, "lei", "lei", strategy=strategy,
                                    reduce_dim=one_name if dedup_registry else None)
    else:
        lenders = (lenders.withColumn("institution_name", F.lit(None).cast("string"))
                   .withColumn("city", F.lit(None).cast("string"))
                   .withColumn("state", F.lit(None).cast("string")))
    order = [F.col("fairness_score").asc_nulls_last(), F.col("lei").asc(),
             F.col("institution_name").asc_nulls_last(), F.col("city").asc_nulls_last(),
             F.col("state").asc_nulls_last()]
    ranked = global_row_number(lenders, order, name="rank").withColumn("rank", F.col("rank").cast("int"))
    cols = (["rank", "lei", "institution_name", "city", "state", "total_loans"]
            + [f"{s}_rate" for s in groups] + [f"{s}_gap" for s in others]
            + ["fairness_score"] + [f"{s}_count" for s in groups])
    return ranked.select(*cols)


def recommend_lenders(fairness: DataFrame, config: Mapping = codes.RECOMMEND_CONFIG,
                      top_n: int = 5, order: str = "signed",
                      reference_rate: str = "white_rate") -> DataFrame:
    """Top-n lenders per applicant group by gap (smallest first).

    All groups in one pass: the fairness table is unpivoted into one row per
    (lender, group) with ``explode`` (no union, no join), filtered by the
    group's minimum count, and ranked per group; ``row_number() <= n`` lets
    Spark keep only the top rows per group in each task before the shuffle.
    ``order='absolute'`` ranks by |gap| instead of the signed gap (T22).
    """
    entries = [F.struct(F.lit(g).alias("applicant_group"), F.col(gap).alias("gap"),
                        F.col(rate).alias("group_rate"), F.col(cnt).alias("group_count"),
                        F.lit(m).alias("min_count"))
               for g, (gap, rate, cnt, m) in config.items()]
    long = (fairness
            .select("rank", "lei", "institution_name", "city", "state", "total_loans",
                    reference_rate, F.explode(F.array(*entries)).alias("_e"))
            .select("*", "_e.*").drop("_e")
            .filter(F.col("gap").isNotNull() & (F.col("group_count") >= F.col("min_count"))))
    key = F.abs(F.col("gap")) if order == "absolute" else F.col("gap")
    w = Window.partitionBy("applicant_group").orderBy(key.asc(), F.col("rank").asc())
    return (long.withColumn("recommendation", F.row_number().over(w))
            .filter(F.col("recommendation") <= top_n)
            .select("applicant_group", "recommendation", "lei", "institution_name", "city",
                    "state", "total_loans", reference_rate, "group_rate", "gap"))
