"""The insurance tables as SELECTs over the TPC-H shaped tables.

Customers are customers, orders are policies, line items are payments, nations give the
addresses. Every SELECT is plain SQL that Spark and DuckDB both run; ``{customer}``,
``{orders}`` ... stand for the input tables. The raw ones spoil some rows, chosen by
their keys, so that every data-quality rule has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Region codes and spellings, policy types, terms and titles of the extracts.
_REGION = """CASE {key} % 11 WHEN 0 THEN ' eAsT ' WHEN 1 THEN 'ea' WHEN 2 THEN 'W'
  WHEN 3 THEN 'west' WHEN 4 THEN 'North' WHEN 5 THEN 'no' WHEN 6 THEN 'SOUTH' WHEN 7 THEN 's'
  WHEN 8 THEN 'EAST' WHEN 9 THEN ' Nowhere' ELSE 'NORTH' END"""

_POLICY_TYPE = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Auto' WHEN '2' THEN 'WholeLife'
  WHEN '3' THEN 'Term' WHEN '4' THEN 'Health' ELSE 'Home' END"""


def _region(key: str) -> str:
    return _REGION.replace("{key}", key)


RAW: dict[str, str] = {
    "customers": f"""
SELECT
  CASE WHEN c_custkey % 97 = 5 THEN NULL
       WHEN c_custkey % 89 = 7 THEN 'abc' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 83 = 3 THEN '-' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 53 = 11 THEN CAST(c_custkey - 1 AS STRING)
       WHEN c_custkey % 41 = 9 THEN '0' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 37 = 2 THEN CAST(c_custkey AS STRING) || '.0'
       WHEN c_custkey % 31 = 2 THEN 'NA'
       ELSE CAST(c_custkey AS STRING) END AS Customer_ID,
  CASE c_custkey % 6 WHEN 0 THEN 'Mr.' WHEN 1 THEN ' Mrs.' WHEN 2 THEN 'Ms. ' WHEN 3 THEN 'Dr.'
       WHEN 4 THEN 'Professor' ELSE NULL END AS Customer_Title,
  CASE WHEN c_custkey % 101 = 4 THEN NULL WHEN c_custkey % 3 = 0 THEN '  o''neil'
       WHEN c_custkey % 3 = 1 THEN 'mcDONALD-smith ' ELSE lower(c_mktsegment) END
    AS Customer_First_Name,
  CASE WHEN c_custkey % 103 = 8 THEN 'N/A' WHEN c_custkey % 2 = 0 THEN lower(c_name)
       ELSE upper(c_name) END AS Customer_Last_Name,
  ' ' || c_mktsegment AS Customer_Segment,
  CASE c_custkey % 7 WHEN 0 THEN ' m' WHEN 1 THEN 'Single' WHEN 2 THEN 'DIV'
       WHEN 3 THEN 'widow' WHEN 4 THEN 'wed' WHEN 5 THEN 'Martian' ELSE NULL END AS Marital_Status,
  CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'f ' WHEN 2 THEN 'Female' ELSE 'X' END AS Gender,
  CASE WHEN c_custkey % 59 = 2 THEN 'not a date'
       WHEN c_custkey % 4 = 0 THEN substr(born, 6, 2) || '/' || substr(born, 9, 2) || '/' || substr(born, 1, 4)
       ELSE born END AS DOB,
  CAST(DATE '2000-01-01' + CAST(c_custkey % 3000 AS INT) AS STRING) AS Effective_Start_Dt,
  CASE WHEN c_custkey % 10 = 0 THEN '9999-12-31' ELSE '' END AS Effective_End_Dt,
  CASE WHEN c_custkey % 107 = 1 THEN '' ELSE {_region('c_custkey')} END AS Region,
  c_custkey AS line_no
FROM (SELECT *, CAST(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS STRING) AS born
      FROM {{customer}}) c""",
    "policies": f"""
SELECT
  'PT00' || substr(o_orderpriority, 1, 1) AS Policy_Type_Id,
  {_POLICY_TYPE} AS Policy_Type,
  ' ' || lower(o_orderpriority) || ' ' AS Policy_Type_Desc,
  CASE WHEN o_orderkey % 67 = 2 THEN NULL
       WHEN o_orderkey % 71 = 5 THEN 'P' || CAST(o_orderkey AS STRING)
       WHEN o_orderkey % 47 = 13 THEN CAST(o_orderkey - 1 AS STRING)
       WHEN o_orderkey % 61 = 3 THEN CAST(o_orderkey AS STRING) || '.0'
       ELSE CAST(o_orderkey AS STRING) END AS Policy_Id,
  {_POLICY_TYPE} || ' Policy ' || CAST(o_orderkey AS STRING) AS Policy_Name,
  CASE WHEN o_orderkey % 73 = 1 THEN 'null' ELSE CAST(o_custkey AS STRING) END AS Customer_ID,
  CASE o_orderkey % 43 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN 'x' WHEN 3 THEN '1e3'
       WHEN 4 THEN '1d' WHEN 5 THEN 'NaN' ELSE amount END AS Premium_Amt,
  CASE WHEN o_orderkey % 37 = 1 THEN 'weekly' WHEN o_orderkey % 37 = 2 THEN NULL
       WHEN o_orderstatus = 'F' THEN ' qtr' WHEN o_orderstatus = 'O' THEN 'Monthly'
       ELSE 'YR' END AS Policy_Term,
  CASE WHEN o_orderkey % 29 = 6 THEN 'soon' ELSE CAST(day AS STRING) END AS Policy_Start_Dt,
  CASE WHEN o_orderkey % 31 = 4 THEN CAST(day - 10 AS STRING) WHEN o_orderkey % 31 = 5 THEN NULL
       ELSE CAST(day + 365 AS STRING) END AS Policy_End_Dt,
  CAST(day + 30 AS STRING) AS Next_Premium_Dt,
  CAST(day + 20 AS STRING) AS Actual_Premium_Paid_Dt,
  amount AS Total_Policy_Amt,
  amount AS Premium_Amt_Paid_TillDate,
  {_region('o_custkey')} AS Region,
  o_orderkey AS line_no
FROM (SELECT *, CAST(o_orderdate AS DATE) AS day,
             CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS amount
      FROM {{orders}}) o""",
    "address": f"""
SELECT
  CASE WHEN c_custkey % 79 = 6 THEN NULL WHEN c_custkey % 43 = 12 THEN CAST(c_custkey - 1 AS STRING)
       ELSE CAST(c_custkey AS STRING) END AS Customer_ID,
  CASE WHEN c_custkey % 47 = 8 THEN NULL ELSE ' ' || lower(n_name) END AS Country,
  CASE WHEN c_custkey % 61 = 9 THEN 'NA' ELSE {_region('c_custkey')} END AS Region,
  'new ' || upper(n_name) || '''s' AS State,
  CASE WHEN c_custkey % 29 = 1 THEN NULL ELSE 'saint-' || lower(c_mktsegment) END AS City,
  substr('00000' || CAST(c_custkey % 100000 AS STRING), -5) AS Postal_Code,
  c_custkey AS line_no
FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey""",
    "transactions": f"""
SELECT
  CASE WHEN l_partkey % 67 = 2 THEN NULL WHEN l_partkey % 71 = 5 THEN 'P' || CAST(l_orderkey AS STRING)
       ELSE CAST(l_orderkey AS STRING) END AS Policy_Id,
  CASE WHEN l_partkey % 73 = 6 THEN '' ELSE CAST(o_custkey AS STRING) END AS Customer_ID,
  CASE l_partkey % 83 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN 'x'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) END AS Premium_Amt,
  CASE WHEN l_partkey % 89 = 3 THEN 'n/a'
       ELSE CAST(CAST(l_quantity AS DECIMAL(15,2)) AS STRING) END AS Total_Policy_Amt,
  CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) AS Premium_Amt_Paid_TillDate,
  CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) AS Next_Premium_Dt,
  CASE WHEN l_partkey % 53 = 1 THEN 'NaT' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END
    AS Actual_Premium_Paid_Dt,
  {_region('o_custkey')} AS Region,
  l_orderkey AS line_no
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey""",
}

# The star schema, typed and clean. A third of the customers have a second version; half
# of those changed their marital status with it. One customer in 17 has no address.
STAR: dict[str, str] = {
    "dim_customer": """
SELECT
  CAST(2 * c_custkey + version AS BIGINT) AS Customer_SK,
  c_custkey AS Customer_ID,
  CASE c_custkey % 5 WHEN 0 THEN 'Mr.' WHEN 1 THEN 'Mrs.' WHEN 2 THEN 'Ms.' WHEN 3 THEN 'Dr.'
       ELSE 'Professor' END AS Customer_Title,
  c_mktsegment AS Customer_First_Name,
  c_name AS Customer_Last_Name,
  CASE c_custkey % 5 WHEN 0 THEN 'Mr.' WHEN 1 THEN 'Mrs.' WHEN 2 THEN 'Ms.' WHEN 3 THEN 'Dr.'
       ELSE 'Professor' END || ' ' || c_mktsegment || ' ' || c_name
       || CASE WHEN version = 2 THEN ' II' ELSE '' END AS Customer_Name,
  c_mktsegment AS Customer_Segment,
  CASE WHEN version = 2 AND c_custkey % 6 = 0 THEN 'Divorced' WHEN c_custkey % 4 = 1 THEN NULL
       ELSE 'Married' END AS Marital_Status,
  CASE c_custkey % 2 WHEN 0 THEN 'Male' ELSE 'Female' END AS Gender,
  DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS DOB,
  DATE '2000-01-01' + CAST(c_custkey % 3000 + 400 * (version - 1) AS INT) AS Effective_Start_Dt,
  CASE WHEN version = 1 AND c_custkey % 3 = 0
       THEN DATE '2000-01-01' + CAST(c_custkey % 3000 + 399 AS INT) END AS Effective_End_Dt,
  r_name AS Region
FROM (SELECT *, 1 AS version FROM {customer}
      UNION ALL
      SELECT *, 2 AS version FROM {customer} WHERE c_custkey % 3 = 0) c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "dim_policy": f"""
SELECT
  CAST(o_orderkey + 1 AS BIGINT) AS Policy_SK,
  'PT00' || substr(o_orderpriority, 1, 1) AS Policy_Type_Id,
  {_POLICY_TYPE} AS Policy_Type,
  o_orderpriority AS Policy_Type_Desc,
  o_orderkey AS Policy_Id,
  {_POLICY_TYPE} || ' Policy ' || CAST(o_orderkey AS STRING) AS Policy_Name,
  o_custkey AS Customer_ID,
  CAST(o_totalprice AS DECIMAL(15,2)) AS Premium_Amt,
  CASE o_orderstatus WHEN 'F' THEN 'Quarterly' WHEN 'O' THEN 'Monthly' ELSE 'Annual' END
    AS Policy_Term,
  CAST(o_orderdate AS DATE) AS Policy_Start_Dt,
  CAST(o_orderdate AS DATE) + 365 AS Policy_End_Dt,
  CAST(o_orderdate AS DATE) + 30 AS Next_Premium_Dt,
  CAST(o_orderdate AS DATE) + 20 AS Actual_Premium_Paid_Dt,
  CAST(o_totalprice AS DECIMAL(15,2)) AS Total_Policy_Amt,
  CAST(o_totalprice AS DECIMAL(15,2)) AS Premium_Amt_Paid_TillDate,
  CAST(CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 12 ELSE 1 END AS INT) AS Num_Installments,
  CASE o_custkey % 5 WHEN 0 THEN 'EAST' WHEN 1 THEN 'WEST' WHEN 2 THEN 'NORTH' WHEN 3 THEN 'SOUTH'
       END AS Region
FROM {{orders}} o""",
    "dim_address": """
SELECT
  CAST(c_custkey + 1 AS BIGINT) AS Address_SK,
  CASE WHEN c_custkey % 17 <> 3 THEN c_custkey END AS Customer_ID,
  n_name AS Country,
  r_name AS Region,
  'State ' || CAST(c_custkey % 50 AS STRING) AS State,
  'City ' || CAST(c_custkey % 500 AS STRING) AS City,
  substr('00000' || CAST(c_custkey % 100000 AS STRING), -5) AS Postal_Code
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "payments": """
SELECT
  l_orderkey AS Policy_Id,
  o_custkey AS Customer_ID,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS Premium_Amt,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS Total_Policy_Amt,
  CAST(l_quantity AS DECIMAL(15,2)) AS Premium_Amt_Paid_TillDate,
  CAST(o_orderdate AS DATE) + 30 AS Next_Premium_Dt,
  CAST(l_shipdate AS DATE) AS Actual_Premium_Paid_Dt,
  CASE o_custkey % 5 WHEN 0 THEN 'EAST' WHEN 1 THEN 'WEST' WHEN 2 THEN 'NORTH' WHEN 3 THEN 'SOUTH'
       END AS Region
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    # Line items as versions of their order's policy.
    "policy_versions": """
SELECT
  l_orderkey AS Policy_Id,
  o_custkey AS Customer_ID,
  l_returnflag AS Policy_Type_Id,
  CASE l_returnflag WHEN 'A' THEN 'Auto' WHEN 'N' THEN 'Term' ELSE 'Home' END AS Policy_Type,
  l_returnflag || ' Policy ' || CAST(l_orderkey AS STRING) AS Policy_Name
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    # The next snapshot: annual policies are absent, some others changed or lost their type.
    "next_policies": f"""
SELECT
  o_orderkey AS Policy_Id,
  o_custkey AS Customer_ID,
  CASE WHEN o_orderkey % 35 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'PT009'
       ELSE 'PT00' || substr(o_orderpriority, 1, 1) END AS Policy_Type_Id,
  CASE WHEN o_orderkey % 35 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'Travel'
       ELSE {_POLICY_TYPE} END AS Policy_Type,
  'Renewed ' || CAST(o_orderkey AS STRING) AS Policy_Name
FROM {{orders}} o WHERE o_orderstatus <> 'P'""",
    # Payments with the keys of the customer's first version, the policy and the address.
    # Their own key repeats where a line number does.
    "fact_transactions": """
SELECT
  CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS Transaction_SK,
  l_orderkey AS Policy_Id,
  o_custkey AS Customer_ID,
  CAST(2 * o_custkey + 1 AS BIGINT) AS Customer_SK,
  CAST(l_orderkey + 1 AS BIGINT) AS Policy_SK,
  CAST(CASE WHEN o_custkey % 17 <> 3 THEN o_custkey + 1 END AS BIGINT) AS Address_SK,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS Premium_Amt,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS Total_Policy_Amt,
  CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) + 30 AS Is_Late,
  CAST(l_tax AS DECIMAL(15,2)) AS Late_Fee
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table, all text, with ``line_no``: its place in the file (of transactions:
    the order it belongs to)."""
    return _select(spark, sf_dir, RAW[name])


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _select(spark, sf_dir, STAR[name])


def sql(text: str) -> str:
    """The same SELECT for an engine in which the input tables are views."""
    return text.format(**{t: t for t in BASE_TABLES})
