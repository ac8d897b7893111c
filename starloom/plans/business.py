"""The business questions over the star schema, as parameterised DataFrame plans.

Totals are summed per key before any join, so a customer with very many transactions
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions import dates
from starloom.operators import aggregates
from starloom.operators.changes import multi_value_history, snapshot_changes
from starloom.operators.columns import select_present, suffix_overlap
from starloom.operators.joins import as_lookup, left_to_many
from starloom.operators.keys import keep_first

# Fixed values in the plans below: column names, output columns and labels.
NAME = "Customer_Name"
AMOUNT = "Total_Policy_Amt"


def customer_names(dim_customer: DataFrame) -> DataFrame:
    """Customer id -> name in the customer's first version."""
    named = dim_customer.select("Customer_ID", NAME, "Customer_SK")
    return (
        named.where(F.col("Customer_ID").isNotNull())
        .groupBy("Customer_ID")
        .agg(F.min_by(NAME, "Customer_SK").alias(NAME))
    )


def policy_changes(
    previous: DataFrame, current: DataFrame, dim_customer: DataFrame, limit: int | None = None
) -> DataFrame:
    """Policies whose type differs between two snapshots, with the customer's name; all of them,
    or the first ``limit`` by policy."""
    fields = ["Policy_Id", "Policy_Type_Id", "Policy_Type", "Policy_Name", "Customer_ID"]
    changed = snapshot_changes(
        select_present(previous, fields), select_present(current, fields), "Policy_Id",
        ["Policy_Type_Id", "Policy_Type", "Policy_Name"],
    )
    named = changed.join(customer_names(dim_customer), "Customer_ID", "left")
    result = named.select(
        "Customer_ID", NAME, "Policy_Id", "Current_Policy_Type_Id", "Current_Policy_Type",
        "Current_Policy_Name", "Previous_Policy_Type_Id", "Previous_Policy_Type",
    )
    return result if limit is None else result.orderBy("Policy_Id").limit(limit)


def _named_totals(totals: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Totals of customers that have a name; grouping by name leaves the others out."""
    names = customer_names(dim_customer).where(F.col(NAME).isNotNull())
    return totals.join(names, "Customer_ID")


def total_by_customer(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Transaction total per customer over all regions, largest first."""
    totals = aggregates.totals(fact, ["Customer_ID"], AMOUNT)
    return (
        _named_totals(totals, dim_customer)
        .select("Customer_ID", NAME, F.lit("All").alias("Region"), AMOUNT)
        .orderBy(F.desc(AMOUNT), "Customer_ID")
    )


def total_of_type_owners(
    fact: DataFrame, dim_policy: DataFrame, dim_customer: DataFrame, policy_type: str = "Auto"
) -> DataFrame:
    """All transaction totals of customers owning any policy of a type, largest first."""
    owners = dim_policy.where(F.lower("Policy_Type") == policy_type.lower()).select("Customer_ID")
    totals = aggregates.totals(fact, ["Customer_ID"], AMOUNT)
    owned = totals.join(owners.distinct(), "Customer_ID", "left_semi")
    return (
        _named_totals(owned, dim_customer)
        .select(
            "Customer_ID", NAME, F.lit("All").alias("Region"),
            F.lit(policy_type).alias("Policy_Type"), AMOUNT,
        )
        .orderBy(F.desc(AMOUNT), "Customer_ID")
    )


def total_by_region_term_year(
    dim_policy: DataFrame,
    dim_customer: DataFrame,
    regions: Sequence[str] = ("EAST", "WEST"),
    term: str = "Quarterly",
    year: int = 2012,
    label: str = "East and West",
) -> DataFrame:
    """Policy total per customer for regions, term and start year, with the start date of
    the customer's first such policy."""
    chosen = dim_policy.where(
        F.col("Region").isin(*regions)
        & (F.col("Policy_Term") == term)
        & dates.in_year(F.col("Policy_Start_Dt"), year)
        & F.col("Customer_ID").isNotNull()
    )
    totals = chosen.groupBy("Customer_ID", "Policy_Term").agg(
        F.min_by("Policy_Start_Dt", "Policy_SK").alias("Policy_Start_Dt"),
        F.coalesce(F.sum(AMOUNT), F.lit(0)).alias(AMOUNT),
    )
    return (
        _named_totals(totals, dim_customer)
        .select(
            "Customer_ID", NAME, F.lit(label).alias("Region"), "Policy_Term",
            dates.us(F.col("Policy_Start_Dt")).alias("Policy_Start_Dt"), AMOUNT,
        )
        .orderBy(F.desc(AMOUNT), "Customer_ID")
    )


def marital_changes(dim_customer: DataFrame) -> DataFrame:
    """All versions of customers with more than one marital status."""
    versions = dim_customer.select(
        "Customer_SK", "Customer_ID", "Customer_Title", "Customer_First_Name", "Customer_Last_Name",
        "Customer_Segment", "Marital_Status", "Effective_Start_Dt", "Effective_End_Dt",
    )
    return (
        multi_value_history(versions, "Customer_ID", "Marital_Status")
        .withColumnsRenamed({
            "Effective_Start_Dt": "Start_Dt_Marital_Status",
            "Effective_End_Dt": "End_Dt_Marital_Status",
        })
        .orderBy("Customer_ID", F.asc_nulls_last("Start_Dt_Marital_Status"), "Customer_SK")
        .drop("Customer_SK")
    )


def full_view(dim_customer: DataFrame, dim_policy: DataFrame, dim_address: DataFrame) -> DataFrame:
    """Every customer (first version) with its policies and addresses, by region and id."""
    customers = keep_first(
        dim_customer.select(
            "Customer_ID", NAME, "Customer_Segment", "Marital_Status", "Gender", "Region",
            "Customer_SK",
        ),
        ["Customer_ID"], ["Customer_SK"],
    ).drop("Customer_SK")
    policies = dim_policy.select(
        "Policy_Id", "Policy_Type_Id", "Policy_Type", "Policy_Type_Desc", "Policy_Name",
        "Policy_Term", "Policy_Start_Dt", "Policy_End_Dt", "Premium_Amt", AMOUNT,
        "Customer_ID", "Region",
    )
    addresses = dim_address.select("Customer_ID", "Country", "State", "City", "Postal_Code")
    customers, policies = suffix_overlap(customers, policies, ["Customer_ID"], ("", "_pol"))
    located = customers.join(addresses, "Customer_ID", "left")
    return left_to_many(as_lookup(located, "located-customers"), policies, "Customer_ID").orderBy(
        F.asc_nulls_last("Region"), F.asc_nulls_last("Customer_ID"),
        F.asc_nulls_last("Policy_Id"),
    )


def run_all(
    tables: Mapping[str, DataFrame], previous_policies: DataFrame, current_policies: DataFrame, year: int = 2012
) -> dict[str, DataFrame]:
    """All six questions by letter; ``year`` is that of question e."""
    customers, policies = tables["dim_customer"], tables["dim_policy"]
    fact = tables["fact_transactions"]
    return {
        "b": policy_changes(previous_policies, current_policies, customers),
        "c": total_by_customer(fact, customers),
        "d": total_of_type_owners(fact, policies, customers),
        "e": total_by_region_term_year(policies, customers, year=year),
        "f": marital_changes(customers),
        "g": full_view(customers, policies, tables["dim_address"]),
    }
