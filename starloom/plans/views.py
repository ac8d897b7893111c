"""The named SQL views over the star schema.

They join on surrogate keys and therefore answer slightly different questions than the
DataFrame plans of the same letter. Amounts are summed per customer key before the customer
is joined, so a customer with very many transactions reaches the shuffle once per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starloom.session import sized_for, stage, tasks_for

# Fixed values throughout the views: table and column names, output aliases, type and region codes.
_NAME = "concat(c.Customer_Title, ' ', c.Customer_First_Name, ' ', c.Customer_Last_Name)"

# Versions of one policy collapse to its types (per owner on the current side) before they are
# paired, and version_pairs says how many pairs of versions a row stands for; pairing the
# versions themselves would grow with the square of a policy's history. A type is a code of a
# fixed table. The name is free text and no part of the state: the first one in code-point
# order stands for all. The directed change of each version is plans.batches.policy_changes.
# Both sides of the pairing read one shuffle of the states: naming the partition keeps Spark from
# copying the text of ``states`` into each, which had every task sort all versions twice.
POLICY_CHANGES = f"""
WITH states AS (
  SELECT /*+ REBALANCE(Policy_Id) */ Policy_Id, Customer_ID, Policy_Type_Id, Policy_Type,
         min(Policy_Name) AS Policy_Name, count(*) AS versions
  FROM dim_policy
  GROUP BY Policy_Id, Customer_ID, Policy_Type_Id, Policy_Type
  HAVING spark_partition_id() >= 0
),
earlier AS (
  SELECT Policy_Id, Policy_Type_Id, Policy_Type, min(Policy_Name) AS Policy_Name,
         sum(versions) AS versions
  FROM states
  GROUP BY Policy_Id, Policy_Type_Id, Policy_Type
),
active AS (
  SELECT c.Customer_ID, {_NAME} AS Customer_Name
  FROM dim_customer c
  WHERE c.Effective_End_Dt IS NULL
)
SELECT curr.Customer_ID,
       a.Customer_Name,
       curr.Policy_Id,
       curr.Policy_Type_Id AS Current_Policy_Type_Id,
       curr.Policy_Type    AS Current_Policy_Type,
       curr.Policy_Name    AS Current_Policy_Name,
       prev.Policy_Type_Id AS Previous_Policy_Type_Id,
       prev.Policy_Type    AS Previous_Policy_Type,
       prev.Policy_Name    AS Previous_Policy_Name,
       curr.versions * prev.versions AS version_pairs
FROM states curr
JOIN earlier prev
  ON curr.Policy_Id = prev.Policy_Id AND curr.Policy_Type_Id <> prev.Policy_Type_Id
LEFT JOIN active a ON a.Customer_ID = curr.Customer_ID
"""

TOTAL_POLICY_ALL = f"""
WITH per_version AS (
  SELECT Customer_SK, sum(Total_Policy_Amt) AS amt FROM fact_transactions GROUP BY Customer_SK
),
named AS (
  SELECT c.Customer_ID, {_NAME} AS Customer_Name, f.amt
  FROM per_version f JOIN dim_customer c ON f.Customer_SK = c.Customer_SK
)
SELECT Customer_ID, Customer_Name, 'All' AS Region, sum(amt) AS Total_Policy_Amt
FROM named
GROUP BY Customer_ID, Customer_Name
ORDER BY Total_Policy_Amt DESC, Customer_ID
"""

AUTO_POLICY_AMOUNT = f"""
WITH per_version AS (
  SELECT f.Customer_SK, sum(f.Total_Policy_Amt) AS amt
  FROM fact_transactions f JOIN dim_policy p ON f.Policy_SK = p.Policy_SK
  WHERE lower(p.Policy_Type) = 'auto'
  GROUP BY f.Customer_SK
),
named AS (
  SELECT c.Customer_ID, {_NAME} AS Customer_Name, f.amt
  FROM per_version f JOIN dim_customer c ON f.Customer_SK = c.Customer_SK
)
SELECT Customer_ID, Customer_Name, 'All' AS Region, 'Auto' AS Policy_Type,
       sum(amt) AS Total_Policy_Amt
FROM named
GROUP BY Customer_ID, Customer_Name
ORDER BY Total_Policy_Amt DESC, Customer_ID
"""

EAST_WEST_QUARTERLY = f"""
WITH per_version AS (
  SELECT f.Customer_SK, p.Policy_Term, p.Policy_Start_Dt, sum(f.Total_Policy_Amt) AS amt
  FROM fact_transactions f JOIN dim_policy p ON f.Policy_SK = p.Policy_SK
  WHERE p.Region IN ('EAST', 'WEST')
    AND p.Policy_Term = 'Quarterly'
    AND p.Policy_Start_Dt >= DATE '{{year}}-01-01'
    AND p.Policy_Start_Dt < DATE '{{next_year}}-01-01'
  GROUP BY f.Customer_SK, p.Policy_Term, p.Policy_Start_Dt
),
named AS (
  SELECT c.Customer_ID, {_NAME} AS Customer_Name, f.Policy_Term, f.Policy_Start_Dt, f.amt
  FROM per_version f JOIN dim_customer c ON f.Customer_SK = c.Customer_SK
)
SELECT Customer_ID, Customer_Name, 'East and West' AS Region, Policy_Term, Policy_Start_Dt,
       sum(amt) AS Total_Policy_Amt
FROM named
GROUP BY Customer_ID, Customer_Name, Policy_Term, Policy_Start_Dt
ORDER BY Total_Policy_Amt DESC, Customer_ID, Policy_Start_Dt
"""

# Customers with several statuses, as a semi join. The grouped side would keep its
# partitioning by customer, and adaptive execution could not split a customer with very many
# versions; the hint gives up that partitioning, so both sides come out of the join's own shuffle.
MARITAL_CHANGES = """
WITH changed AS (
  SELECT /*+ REPARTITION */ Customer_ID
  FROM (SELECT Customer_ID FROM dim_customer
        GROUP BY Customer_ID HAVING min(Marital_Status) < max(Marital_Status))
)
SELECT c.Customer_ID, c.Customer_Title, c.Customer_First_Name, c.Customer_Last_Name,
       c.Customer_Segment, c.Marital_Status,
       c.Effective_Start_Dt AS Start_Dt_Marital_Status,
       c.Effective_End_Dt   AS End_Dt_Marital_Status
FROM dim_customer c
LEFT SEMI JOIN changed s ON c.Customer_ID = s.Customer_ID
ORDER BY c.Customer_ID, Start_Dt_Marital_Status, c.Customer_SK
"""

# customer LEFT JOIN fact, written as the inner join plus the customers without a
# transaction: a left join cannot split a customer with very many transactions. Those customers
# have no policy or address either and are added last. A transaction without a policy or address
# key meets no partner (the second condition says so, whatever the keys are), and would meet all
# others like it in one task; a hash of the row in place of the missing key deals them out.
_FULL_ROWS = """
WITH paired AS (
  SELECT c.Customer_ID, c.Customer_Name, c.Customer_Segment, c.Marital_Status, c.Gender,
         c.Region, f.Transaction_SK, f.Policy_SK, f.Address_SK, f.Is_Late, f.Late_Fee
  FROM dim_customer c JOIN fact_transactions f ON c.Customer_SK = f.Customer_SK
),
full_rows AS (
  SELECT c.Customer_ID, c.Customer_Name, c.Customer_Segment, c.Marital_Status, c.Gender,
         c.Region, p.Policy_Id, p.Policy_Type_Id, p.Policy_Type, p.Policy_Type_Desc,
         p.Policy_Name, p.Policy_Term, p.Policy_Start_Dt, p.Policy_End_Dt, p.Premium_Amt,
         p.Total_Policy_Amt, a.Country, a.State, a.City, a.Postal_Code, c.Is_Late, c.Late_Fee,
         c.Transaction_SK
  FROM paired c
  LEFT JOIN dim_policy  p ON coalesce(c.Policy_SK, xxhash64(c.Transaction_SK, c.Customer_ID)) = p.Policy_SK
                         AND c.Policy_SK IS NOT NULL
  LEFT JOIN dim_address a ON coalesce(c.Address_SK, xxhash64(c.Transaction_SK, c.Customer_ID)) = a.Address_SK
                         AND c.Address_SK IS NOT NULL
  UNION ALL
  SELECT c.Customer_ID, c.Customer_Name, c.Customer_Segment, c.Marital_Status, c.Gender,
         c.Region, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL
  FROM dim_customer c
  LEFT ANTI JOIN (SELECT DISTINCT Customer_SK FROM fact_transactions) f
    ON c.Customer_SK = f.Customer_SK
)
"""
_FULL_COLUMNS = """Customer_ID, Customer_Name, Customer_Segment, Marital_Status, Gender, Region,
  Policy_Id, Policy_Type_Id, Policy_Type, Policy_Type_Desc, Policy_Name, Policy_Term,
  Policy_Start_Dt, Policy_End_Dt, Premium_Amt, Total_Policy_Amt, Country, State, City, Postal_Code,
  Is_Late, Late_Fee"""

# The sort ends on the transaction key so that a hot customer's rows can go to several ranges.
_FULL_ORDER = ("Region", "Customer_ID", "Transaction_SK")
FULL_FACT = ("Transaction_SK", "Customer_SK", "Policy_SK", "Address_SK", "Is_Late", "Late_Fee")

ALL_REGIONS_FULL = f"""{_FULL_ROWS}
SELECT {_FULL_COLUMNS}
FROM full_rows
ORDER BY {", ".join(_FULL_ORDER)}
"""


def all_regions_full(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of ``vw_all_regions_full`` in their order, for tables of any size.

    The view as registered is planned with the session's number of shuffle partitions, so its
    tasks grow with the tables. Here the number follows from the rows: the joined rows are written
    by as many tasks as that takes, then ranged and sorted by as many. The fact should be a
    written table (it is counted and read more than once).
    """
    for name in ("dim_customer", "dim_policy", "dim_address", "fact_transactions"):
        tables[name].createOrReplaceTempView(name)
    with sized_for(spark, tables["fact_transactions"].count()):
        rows = stage(spark.sql(f"{_FULL_ROWS} SELECT * FROM full_rows"), "full-view")
    ranged = rows.repartitionByRange(tasks_for(spark, rows.count()), *_FULL_ORDER)
    return ranged.sortWithinPartitions(*_FULL_ORDER).drop("Transaction_SK")


def view_texts(year: int = 2012) -> dict[str, str]:
    """View name -> SQL. The year only matters to the quarterly view."""
    return {
        "vw_policy_changes": POLICY_CHANGES,
        "vw_total_policy_all": TOTAL_POLICY_ALL,
        "vw_auto_policy_amount": AUTO_POLICY_AMOUNT,
        f"vw_east_west_quarterly_{year}": EAST_WEST_QUARTERLY.format(year=year, next_year=year + 1),
        "vw_marital_changes": MARITAL_CHANGES,
        "vw_all_regions_full": ALL_REGIONS_FULL,
    }


def register(spark: SparkSession, tables: Mapping[str, DataFrame], year: int = 2012) -> list[str]:
    """Register the star schema and the views as temporary views; returns the view names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    texts = view_texts(year)
    for name, text in texts.items():
        spark.sql(text).createOrReplaceTempView(name)
    return list(texts)
