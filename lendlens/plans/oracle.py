"""DuckDB oracle SQL for the registered queries.

Each oracle is independent ANSI-style SQL over the driver's tables: the
HMDA-shaped inputs are the shared adapter texts (``sources.adapter``) placed
in a CTE prefix, and the query logic is written out again in SQL, so the
Spark DataFrame plans are checked against a second implementation.

DuckDB rounding ``round_even(x * 10^d, 0) / 10^d`` matches numpy's
half-even rounding of the binary value (``rint`` in Spark).
"""

from __future__ import annotations

from lendlens.functions import codes
from lendlens.sources import adapter

NUM = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def with_tables(*names: str) -> str:
    parts = [f"{n} AS ({adapter.duckdb_sql(n)})" for n in names]
    return "WITH " + ",\n".join(parts)


def lit_list(values) -> str:
    out = []
    for v in values:
        if isinstance(v, str):
            out.append("'" + v.replace("'", "''") + "'")
        else:
            out.append(str(v))
    return "(" + ", ".join(out) + ")"


def num(expr: str) -> str:
    """C1 in DuckDB: guarded coercion of text to DOUBLE."""
    return (f"CASE WHEN regexp_full_match(CAST({expr} AS VARCHAR), {NUM}) "
            f"THEN TRY_CAST(trim(CAST({expr} AS VARCHAR), ' \t\r\n') AS DOUBLE) END")


def num_commas(expr: str) -> str:
    return num(f"replace(CAST({expr} AS VARCHAR), ',', '')")


def norm_key(expr: str) -> str:
    return f"upper(trim({expr}, ' \t\r\n'))"


def rnd(expr: str, digits: int) -> str:
    scale = f"{10 ** digits}.0"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def na_norm(col: str) -> str:
    """S6 in DuckDB: missing-value tokens → NULL."""
    return f"CASE WHEN {col} IN {lit_list(codes.NA_TOKENS)} THEN NULL ELSE {col} END"


# Columns of the bronze applications table (adapter output order) and the
# STRING ones among them (NA-token normalisation applies to those).
APP_COLUMNS = [
    "src_orderkey", "src_linenumber", "src_partkey", "lei", "activity_year",
    "action_taken", "loan_amount", "interest_rate", "rate_spread", "total_loan_costs",
    "discount_points", "lender_credits", "income", "property_value",
    "debt_to_income_ratio", "loan_term", "loan_purpose", "loan_type", "occupancy_type",
    "lien_status", "preapproval", "reverse_mortgage", "open-end_line_of_credit",
    "applicant_credit_score_type", "loan_to_value_ratio", "prepayment_penalty_term",
    "intro_rate_period", "manufactured_home_secured_property_type",
    "manufactured_home_land_property_interest", "derived_race", "derived_ethnicity",
    "derived_sex", "applicant_age", "co-applicant_age", "co-applicant_sex",
    "co-applicant_sex_observed", "co-applicant_ethnicity_observed", "county_code",
    "derived_msa-md", "derived_loan_product_type", "derived_dwelling_category",
    "conforming_loan_limit", "hoepa_status", "business_or_commercial_purpose",
    "tract_population", "tract_minority_population_percentage",
    "tract_to_msa_income_percentage", "tract_owner_occupied_units",
    "tract_one_to_four_family_homes", "tract_median_age_of_housing_units",
    "ffiec_msa_md_median_family_income", "denial_reason-1", "denial_reason-2",
    "denial_reason-3", "denial_reason-4",
]
APP_STRING_COLUMNS = [
    "lei", "loan_amount", "interest_rate", "rate_spread", "total_loan_costs",
    "discount_points", "lender_credits", "income", "property_value",
    "debt_to_income_ratio", "loan_term", "loan_to_value_ratio",
    "prepayment_penalty_term", "intro_rate_period", "derived_race", "derived_ethnicity",
    "derived_sex", "applicant_age", "co-applicant_age", "county_code", "derived_msa-md",
    "derived_loan_product_type", "derived_dwelling_category", "conforming_loan_limit",
    "tract_population", "tract_minority_population_percentage",
    "tract_to_msa_income_percentage", "tract_owner_occupied_units",
    "tract_one_to_four_family_homes", "tract_median_age_of_housing_units",
    "ffiec_msa_md_median_family_income",
]


def qi(name: str) -> str:
    return '"' + name + '"'


def napps_cte() -> str:
    """S6 over the bronze applications: NA tokens → NULL in STRING columns."""
    rep = ", ".join(f"{na_norm(qi(c))} AS {qi(c)}" for c in APP_STRING_COLUMNS)
    return f"napps AS (SELECT * REPLACE ({rep}) FROM applications)"


def not_in(col: str, values) -> str:
    return f"NOT coalesce({col} IN {lit_list(values)}, false)"


def bin_dti(col: str) -> str:
    n = num(col)
    return (f"CASE WHEN {col} IN ('<20%', '20%-<30%', '50%-60%', '>60%') THEN {col} "
            f"WHEN {n} < 20 THEN '<20%' WHEN {n} < 30 THEN '20%-<30%' "
            f"WHEN {n} < 40 THEN '30%-<40%' WHEN {n} < 50 THEN '40%-<50%' "
            f"WHEN {n} <= 60 THEN '50%-60%' WHEN {n} > 60 THEN '>60%' END")


def first_number(col: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(CAST({col} AS VARCHAR), '(\\d+)', 1), '') AS DOUBLE)"


def cut(col: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{lab}'"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {parts} END"


def zfill(col: str, width: int) -> str:
    return (f"CASE WHEN length({col}) >= {width} THEN {col} "
            f"WHEN {col} LIKE '+%' OR {col} LIKE '-%' THEN "
            f"substr({col}, 1, 1) || lpad(substr({col}, 2), {width - 1}, '0') "
            f"ELSE lpad({col}, {width}, '0') END")


def map_case(col: str, mapping, fallback: str = "NULL") -> str:
    parts = " ".join(f"WHEN {lit_list([k])[1:-1]} THEN {lit_list([v])[1:-1]}"
                     for k, v in mapping.items())
    return f"CASE {col} {parts} ELSE {fallback} END"


def clean_apps_ctes() -> str:
    """Q1 as CTEs ending in ``clean``."""
    req = " AND ".join(f"{qi(c)} IS NOT NULL" for c in codes.PRICING_REQUIRED)
    return f"""{napps_cte()},
c1 AS (
  SELECT * REPLACE ({num_commas('loan_amount')} AS loan_amount, {num('interest_rate')} AS interest_rate)
  FROM napps
  WHERE {not_in('business_or_commercial_purpose', codes.COMMERCIAL_CODES)}
    AND {not_in('derived_race', codes.RACE_PLACEHOLDERS)}
    AND {not_in('derived_ethnicity', codes.ETHNICITY_PLACEHOLDERS)}
    AND derived_sex IS DISTINCT FROM '{codes.SEX_PLACEHOLDER}'
    AND {not_in('debt_to_income_ratio', codes.DTI_DROP_TOKENS)}
), c2 AS (
  SELECT * REPLACE ({bin_dti('debt_to_income_ratio')} AS debt_to_income_ratio) FROM c1
), clean AS (
  SELECT * FROM c2
  WHERE debt_to_income_ratio IS NOT NULL
    AND conforming_loan_limit IS DISTINCT FROM '{codes.CONFORMING_PLACEHOLDER}'
    AND {req}
)"""


def clean_denials_ctes() -> str:
    """Q2 as CTEs ending in ``denied``."""
    req = " AND ".join(f"{qi(c)} IS NOT NULL" for c in codes.DENIAL_REQUIRED)
    reasons = ", ".join(f"{num(qi(c))} AS {qi(c)}" for c in codes.DENIAL_REASON_COLUMNS)
    labels = ", ".join(
        f"{map_case(qi(c), {float(k): v for k, v in codes.DENIAL_REASON_LABELS.items()})} AS {qi(c + '_label')}"
        for c in codes.DENIAL_REASON_COLUMNS)
    return f"""{napps_cte()},
d1 AS (
  SELECT * REPLACE ({num_commas('loan_amount')} AS loan_amount, {num_commas('income')} AS income,
                    {num_commas('property_value')} AS property_value)
  FROM napps
  WHERE action_taken = 3
    AND NOT coalesce(CAST(business_or_commercial_purpose AS VARCHAR) IN ('1', '1111'), false)
    AND {not_in('derived_race', codes.RACE_PLACEHOLDERS)}
    AND {not_in('derived_ethnicity', codes.ETHNICITY_PLACEHOLDERS)}
    AND derived_sex IS DISTINCT FROM '{codes.SEX_PLACEHOLDER}'
    AND {not_in('debt_to_income_ratio', codes.DTI_DROP_TOKENS)}
), d2 AS (
  SELECT * REPLACE ({bin_dti('debt_to_income_ratio')} AS debt_to_income_ratio, {reasons}) FROM d1
), d3 AS (
  SELECT *, {labels} FROM d2
  WHERE debt_to_income_ratio IS NOT NULL
    AND conforming_loan_limit IS DISTINCT FROM '{codes.CONFORMING_PLACEHOLDER}'
), denied AS (
  SELECT *, '{codes.ACTION_LABELS[3]}' AS action_taken_label FROM d3 WHERE {req}
)"""
