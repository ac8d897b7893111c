"""Overview tables: key figures, breakdowns and the change summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from starloom.operators.aggregates import frequencies, row_counts, share_of_max

# The labels of the key figures.
KPI_LABELS = {
    "dim_customer": "Total Customers",
    "dim_policy": "Total Policies",
    "dim_address": "Addresses",
    "fact_transactions": "Transactions",
}


def kpis(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = row_counts({KPI_LABELS[t]: tables[t] for t in KPI_LABELS})
    return counts.withColumnsRenamed({"table": "label", "n_rows": "value"})


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Value counts of a column with bar widths."""
    return share_of_max(frequencies(df, column))


def change_summary(
    fact: DataFrame, policy_changes: DataFrame, marital_changes: DataFrame
) -> DataFrame:
    """Late payments and their fees, changed policies, customers with several statuses."""
    late = fact.agg(
        F.count_if("Is_Late").alias("n"),
        F.coalesce(F.sum("Late_Fee"), F.lit(0)).alias("fees"),
    ).select(
        F.inline(F.array(
            F.struct(F.lit("late_payments").alias("measure"), F.col("n").cast("double").alias("value")),
            F.struct(F.lit("late_fees").alias("measure"), F.col("fees").cast("double").alias("value")),
        ))
    )
    policies = policy_changes.agg(F.count("*").cast("double").alias("value"))
    customers = marital_changes.agg(F.countDistinct("Customer_ID").cast("double").alias("value"))
    return (
        late
        .unionByName(policies.select(F.lit("policy_changes").alias("measure"), "value"))
        .unionByName(customers.select(F.lit("customers_with_status_change").alias("measure"), "value"))
    )
