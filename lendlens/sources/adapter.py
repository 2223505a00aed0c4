"""HMDA-shaped bronze tables derived from the driver's star-schema tables.

The engine works on loan-application tables (one row per application, the
columns of a yearly HMDA LAR file). The test and bench data are TPC-H-like
tables, so a deterministic projection of ``lineitem ⋈ orders ⋈ customer``
plays the application file (one application per lineitem row). Supplier plays
the lender registry, customer the lender postal-code file, part the postal area
dimension and nation the county dimension.

Every text here is ONE SQL statement valid in both Spark SQL and DuckDB, so the
same definition feeds the Spark plans and the DuckDB oracle. Bronze columns
mirror what a CSV reader infers on real files: clean integer codes are INT,
mixed columns (commas, ``Exempt``, ranges) are STRING.

Table references are written ``{lineitem}`` etc.; Spark binds them to
DataFrames via ``spark.sql(text, lineitem=df, ...)``, the oracle substitutes
plain view names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --------------------------------------------------------------------------
# applications (bronze) — lineitem ⋈ orders ⋈ customer, lossless
# --------------------------------------------------------------------------
APPLICATIONS_SQL = """
WITH base AS (
  SELECT
    l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, o.o_custkey AS ck,
    l.l_linenumber AS ln, CAST(l.l_quantity AS INT) AS q,
    CAST(floor(l.l_extendedprice) AS BIGINT) * 4 AS amt,
    CAST(round(l.l_discount * 100) AS INT) AS disc,
    CAST(round(l.l_tax * 100) AS INT) AS tax,
    CAST(year(l.l_shipdate) + 24 AS INT) AS yr,
    o.o_orderstatus AS ostatus, o.o_orderpriority AS oprio,
    c.c_nationkey AS nk, CAST(floor(c.c_acctbal / 20) AS BIGINT) AS inc,
    c.c_mktsegment AS seg
  FROM {lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey
), coded AS (
  SELECT *,
    CASE
      WHEN ln = 7 THEN 4 + CAST(pk % 4 AS INT)
      WHEN ln = 4 THEN 2
      WHEN q > 42 THEN 3
      WHEN (pk + ck) % 10 < (CASE seg WHEN 'BUILDING' THEN 4 WHEN 'HOUSEHOLD' THEN 3
                                      WHEN 'FURNITURE' THEN 2 ELSE 1 END) THEN 3
      ELSE 1
    END AS act
  FROM base
)
SELECT
  ok AS src_orderkey,
  ln AS src_linenumber,
  pk AS src_partkey,
  CASE WHEN ok % 101 = 0 THEN NULL
       ELSE concat(' lei', lpad(CAST(sk AS STRING), 17, '0'), ' ') END AS lei,
  yr AS activity_year,
  act AS action_taken,
  CASE WHEN ok % 89 = 0 THEN NULL
       WHEN amt >= 1000 THEN concat(CAST(CAST(floor(amt / 1000) AS BIGINT) AS STRING), ',',
                                    lpad(CAST(amt % 1000 AS STRING), 3, '0'))
       ELSE CAST(amt AS STRING) END AS loan_amount,
  CASE WHEN pk % 11 = 0 THEN 'Exempt'
       WHEN pk % 13 = 0 THEN NULL
       WHEN ck % 23 = 0 THEN '16.0'
       ELSE concat(CAST(2 + disc AS STRING), '.', lpad(CAST((pk % 4) * 25 AS STRING), 2, '0'))
  END AS interest_rate,
  CASE WHEN ok % 7 = 0 THEN NULL WHEN ok % 7 = 1 THEN 'Exempt'
       ELSE concat('0.', CAST(10 + pk % 90 AS STRING)) END AS rate_spread,
  CASE WHEN pk % 19 = 0 THEN NULL ELSE CAST(1000 + pk % 5000 AS STRING) END AS total_loan_costs,
  CASE WHEN (ok + pk) % 9 = 0 THEN NULL ELSE CAST(pk % 900 AS STRING) END AS discount_points,
  CASE WHEN (ok + ln) % 10 = 0 THEN NULL ELSE CAST(pk % 700 AS STRING) END AS lender_credits,
  CASE WHEN ck % 29 = 0 THEN NULL ELSE CAST(inc AS STRING) END AS income,
  CASE WHEN ok % 43 = 0 THEN NULL ELSE CAST(amt + 1000 * (ck % 50) AS STRING) END AS property_value,
  CASE WHEN q <= 5 THEN '<20%'
       WHEN q <= 10 THEN '20%-<30%'
       WHEN q <= 14 THEN '30%-<36%'
       WHEN q <= 28 THEN CAST(q + 21 AS STRING)
       WHEN q <= 36 THEN '50%-60%'
       WHEN q <= 42 THEN '>60%'
       WHEN q <= 46 THEN 'Exempt'
       WHEN q <= 48 THEN 'NA'
       ELSE NULL END AS debt_to_income_ratio,
  CASE WHEN ok % 31 = 0 THEN NULL WHEN ok % 31 = 1 THEN 'Exempt'
       WHEN ln % 3 = 0 THEN '180' WHEN ln % 3 = 1 THEN '360' ELSE '240' END AS loan_term,
  CASE pk % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 31 WHEN 3 THEN 32 WHEN 4 THEN 4 ELSE 5 END
    AS loan_purpose,
  CAST(1 + ck % 4 AS INT) AS loan_type,
  CAST(1 + ok % 3 AS INT) AS occupancy_type,
  CASE WHEN ok % 5 = 0 THEN 2 ELSE 1 END AS lien_status,
  CASE WHEN pk % 7 = 0 THEN 1 ELSE 2 END AS preapproval,
  CASE WHEN pk % 53 = 0 THEN 1 ELSE 2 END AS reverse_mortgage,
  CASE WHEN ck % 19 = 0 THEN 1 ELSE 2 END AS `open-end_line_of_credit`,
  CAST(1 + ok % 9 AS INT) AS applicant_credit_score_type,
  CASE WHEN pk % 37 = 0 THEN 'Exempt'
       ELSE CAST(60 + tax * 4 + ln AS STRING) END AS loan_to_value_ratio,
  CASE WHEN sk % 3 = 0 THEN 'Exempt' WHEN ok % 41 = 0 THEN NULL
       ELSE CAST(12 * (ok % 4) AS STRING) END AS prepayment_penalty_term,
  CASE WHEN sk % 3 = 1 THEN 'Exempt' WHEN ok % 47 = 0 THEN NULL
       ELSE CAST(12 * (pk % 6) AS STRING) END AS intro_rate_period,
  CASE WHEN sk % 4 = 0 THEN 1111 ELSE 3 END AS manufactured_home_secured_property_type,
  CASE WHEN sk % 4 = 0 THEN 1111 ELSE 5 END AS manufactured_home_land_property_interest,
  CASE WHEN ck % 41 = 0 THEN 'Free Form Text Only'
       WHEN ck % 13 = 1 THEN 'Joint'
       WHEN seg = 'AUTOMOBILE' THEN 'White'
       WHEN seg = 'BUILDING' THEN 'Black or African American'
       WHEN seg = 'FURNITURE' THEN 'Asian'
       WHEN seg = 'HOUSEHOLD' THEN 'American Indian or Alaska Native'
       ELSE 'Race Not Available' END AS derived_race,
  CASE WHEN ok % 59 = 0 THEN NULL
       WHEN ok % 53 = 0 THEN 'Free Form Text Only'
       WHEN oprio = '1-URGENT' THEN 'Hispanic or Latino'
       WHEN oprio = '4-NOT SPECIFIED' THEN 'Ethnicity Not Available'
       WHEN oprio = '5-LOW' THEN 'Joint'
       ELSE 'Not Hispanic or Latino' END AS derived_ethnicity,
  CASE WHEN ok % 61 = 0 THEN NULL
       WHEN ck % 11 = 0 THEN 'Sex Not Available'
       WHEN ostatus = 'F' THEN 'Male' WHEN ostatus = 'O' THEN 'Female'
       ELSE 'Joint' END AS derived_sex,
  CASE ck % 8 WHEN 0 THEN '<25' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54'
              WHEN 4 THEN '55-64' WHEN 5 THEN '65-74' WHEN 6 THEN '>74' ELSE '8888' END
    AS applicant_age,
  CASE WHEN ok % 2 = 0 THEN '9999'
       ELSE CASE ok % 7 WHEN 0 THEN '<25' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
                        WHEN 3 THEN '45-54' WHEN 4 THEN '55-64' WHEN 5 THEN '65-74'
                        ELSE '>74' END END AS `co-applicant_age`,
  CASE WHEN ok % 2 = 0 THEN 5 ELSE CAST(1 + ck % 2 AS INT) END AS `co-applicant_sex`,
  CASE WHEN ok % 2 = 0 THEN 3 ELSE 2 END AS `co-applicant_sex_observed`,
  CASE WHEN ok % 2 = 0 THEN 3 ELSE 2 END AS `co-applicant_ethnicity_observed`,
  CASE WHEN ck % 83 = 0 THEN NULL
       WHEN ck % 47 = 0 THEN concat('45', lpad(CAST(2 * nk + 1 AS STRING), 3, '0'))
       ELSE concat('37', lpad(CAST(2 * nk + 1 AS STRING), 3, '0')) END AS county_code,
  CAST(10000 + 20 * (nk % 9) AS STRING) AS `derived_msa-md`,
  CASE WHEN ck % 4 = 0 THEN 'Conventional:First Lien'
       WHEN ck % 4 = 1 THEN 'FHA:First Lien'
       WHEN ck % 4 = 2 THEN 'VA:First Lien'
       ELSE 'FSA/RHS:First Lien' END AS derived_loan_product_type,
  CASE WHEN pk % 23 = 0 THEN 'Multifamily:Site-Built'
       WHEN pk % 10 = 0 THEN 'Single Family (1-4 Units):Manufactured'
       ELSE 'Single Family (1-4 Units):Site-Built' END AS derived_dwelling_category,
  CASE ok % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'NC' WHEN 2 THEN 'NA' ELSE 'U' END
    AS conforming_loan_limit,
  CASE WHEN pk % 29 = 0 THEN 1 ELSE 2 END AS hoepa_status,
  CASE WHEN pk % 9 = 0 THEN 1 WHEN pk % 9 = 1 THEN 1111 WHEN pk % 31 = 5 THEN NULL ELSE 2 END
    AS business_or_commercial_purpose,
  CASE WHEN ck % 71 = 0 THEN NULL ELSE CAST(2000 + (ck % 60) * 100 AS STRING) END
    AS tract_population,
  CAST(5 + ck % 90 AS STRING) AS tract_minority_population_percentage,
  CAST(60 + ck % 90 AS STRING) AS tract_to_msa_income_percentage,
  CAST(500 + ck % 1500 AS STRING) AS tract_owner_occupied_units,
  CAST(700 + ck % 1700 AS STRING) AS tract_one_to_four_family_homes,
  CAST(5 + ck % 60 AS STRING) AS tract_median_age_of_housing_units,
  CAST(60000 + 1000 * (nk % 25) AS STRING) AS ffiec_msa_md_median_family_income,
  CASE WHEN act <> 3 THEN 10 WHEN ok % 37 = 0 THEN NULL ELSE CAST(1 + pk % 9 AS INT) END
    AS `denial_reason-1`,
  CASE WHEN act = 3 AND pk % 3 = 0 THEN CAST(1 + ok % 9 AS INT) END AS `denial_reason-2`,
  CASE WHEN act = 3 AND pk % 5 = 0 THEN CAST(1 + ck % 9 AS INT) END AS `denial_reason-3`,
  CASE WHEN act = 3 AND pk % 7 = 0 THEN CAST(1 + (ok + ck) % 9 AS INT) END AS `denial_reason-4`
FROM coded
"""

# --------------------------------------------------------------------------
# lender registry — one or two rows per supplier; second row is a name-less
# duplicate or an alternate spelling; some keys never match an application
# --------------------------------------------------------------------------
REGISTRY_SQL = """
SELECT
  concat(CASE WHEN s.s_suppkey % 4 = 0 THEN ' ' ELSE '' END,
         CASE WHEN s.s_suppkey % 3 = 0 THEN 'lei' ELSE 'LEI' END,
         lpad(CAST(s.s_suppkey AS STRING), 17, '0'),
         CASE WHEN s.s_suppkey % 11 = 3 THEN 'X' ELSE '' END) AS `LEI`,
  CASE WHEN s.s_suppkey % 7 = 0 THEN NULL
       WHEN s.s_suppkey % 13 = 0 THEN 'nan'
       ELSE concat('Lender ', s.s_name) END AS `Entity.LegalName`,
  concat('City ', n.n_name) AS `Entity.LegalAddress.City`,
  concat('US-R', CAST(n.n_regionkey AS STRING)) AS `Entity.LegalAddress.Region`
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
UNION ALL
SELECT
  concat('LEI', lpad(CAST(s.s_suppkey AS STRING), 17, '0'),
         CASE WHEN s.s_suppkey % 11 = 3 THEN 'X' ELSE '' END) AS `LEI`,
  CASE WHEN s.s_suppkey % 5 = 0 THEN concat('Lender ', lower(s.s_name))
       WHEN s.s_suppkey % 6 = 0 THEN '  '
       ELSE NULL END AS `Entity.LegalName`,
  concat('City ', n.n_name) AS `Entity.LegalAddress.City`,
  concat('US-R', CAST(n.n_regionkey AS STRING)) AS `Entity.LegalAddress.Region`
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""

# --------------------------------------------------------------------------
# lender headquarters postal codes (one row per customer) — raw codes with
# ZIP+4 suffixes, short codes that need zero-fill, and junk
# --------------------------------------------------------------------------
POSTAL_SQL = """
SELECT
  CASE WHEN c_custkey % 17 = 0 THEN 'N/A'
       WHEN c_custkey % 13 = 0 THEN CAST(c_custkey % 900 AS STRING)
       WHEN c_custkey % 5 = 0 THEN concat(' ', CAST(27000 + c_custkey % 1000 AS STRING), '-',
                                          lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))
       ELSE CAST(27000 + c_custkey % 1000 AS STRING) END AS `Entity.HeadquartersAddress.PostalCode`,
  CAST(1 + c_custkey % 3 AS BIGINT) AS `Company_Count`,
  CASE WHEN c_nationkey % 6 = 0 THEN 'US-SC' ELSE 'US-NC' END AS `Reigon_Clean`
FROM {customer}
"""

# --------------------------------------------------------------------------
# postal area dimension (ZIP5 with bounding box), one row per ZIP
# --------------------------------------------------------------------------
AREAS_SQL = """
SELECT
  lpad(CAST(26500 + p_partkey % 1500 AS STRING), 5, '0') AS `ZIP5`,
  min(-85.5 + CAST(p_partkey % 97 AS DOUBLE) * 0.12) AS minx,
  min(33.0 + CAST(p_partkey % 53 AS DOUBLE) * 0.08) AS miny,
  max(-85.5 + CAST(p_partkey % 97 AS DOUBLE) * 0.12 + 0.2) AS maxx,
  max(33.0 + CAST(p_partkey % 53 AS DOUBLE) * 0.08 + 0.15) AS maxy
FROM {part}
GROUP BY lpad(CAST(26500 + p_partkey % 1500 AS STRING), 5, '0')
"""

# --------------------------------------------------------------------------
# county dimension (state + county FIPS), one row per nation
# --------------------------------------------------------------------------
COUNTIES_SQL = """
SELECT
  CASE WHEN n_regionkey = 4 THEN '45' ELSE '37' END AS `STATEFP`,
  lpad(CAST(2 * n_nationkey + 1 AS STRING), 3, '0') AS `COUNTYFP`
FROM {nation}
"""

TABLE_SQL = {
    "applications": (APPLICATIONS_SQL, ("lineitem", "orders", "customer")),
    "registry": (REGISTRY_SQL, ("supplier", "nation")),
    "postal": (POSTAL_SQL, ("customer",)),
    "areas": (AREAS_SQL, ("part",)),
    "counties": (COUNTIES_SQL, ("nation",)),
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One HMDA-shaped bronze table as a lazy DataFrame."""
    text, deps = TABLE_SQL[name]
    frames = {d: read_driver_table(spark, sf_dir, d) for d in deps}
    return spark.sql(text, **frames)


#: Expressions of APPLICATIONS_SQL over the few columns of ``coded``.
LEI_SQL = "CASE WHEN ok % 101 = 0 THEN NULL\n       ELSE concat(' lei', lpad(CAST(sk AS STRING), 17, '0'), ' ') END"
LOAN_AMOUNT_SQL = """CASE WHEN ok % 89 = 0 THEN NULL
       WHEN amt >= 1000 THEN concat(CAST(CAST(floor(amt / 1000) AS BIGINT) AS STRING), ',',
                                    lpad(CAST(amt % 1000 AS STRING), 3, '0'))
       ELSE CAST(amt AS STRING) END"""


def numbered_applications(spark: SparkSession, sf_dir: str, id_column: str) -> DataFrame:
    """``bronze`` of the applications with their id: the id comes from the
    joined source columns, so that rows are moved and sorted while they have
    these only; the columns of the application file are made after it, by the
    tasks that write them, the rows of a year together."""
    text, deps = TABLE_SQL["applications"]
    ctes, columns = text.rsplit("\n)\nSELECT\n", 1)
    frames = {d: read_driver_table(spark, sf_dir, d) for d in deps}
    coded = spark.sql(f"{ctes}\n)\nSELECT * FROM coded", **frames)
    keyed = coded.selectExpr("*", f"{LEI_SQL} AS id_lei", f"{LOAN_AMOUNT_SQL} AS id_amount")
    numbered = keyed.selectExpr("*", "row_number() OVER (PARTITION BY ok, ln, pk, id_lei ORDER BY yr, act, id_amount) AS id_place")
    made = f"concat_ws('-', ok, ln, pk, coalesce({LEI_SQL}, ''), id_place) AS {id_column}"
    return spark.sql(f"SELECT\n  {made},\n" + columns.replace("FROM coded", "FROM {coded}"),
                     coded=numbered.sortWithinPartitions("yr"))


def duckdb_sql(name: str) -> str:
    """The same table text for DuckDB (plain view names, STRING→VARCHAR)."""
    text, deps = TABLE_SQL[name]
    return text.format(**{d: d for d in deps}).replace("`", '"')


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir, "applications")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir, "registry")
