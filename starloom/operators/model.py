"""Derived columns and the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions import codes, dates, numbers, text
from starloom.operators.joins import as_lookup
from starloom.operators.keys import assign_keys, keep_last
from starloom.schemas import DEFAULTS, GOLD, MONEY, conform
from starloom.session import stage


def with_installments(policies: DataFrame) -> DataFrame:
    """Installments a year from the policy term."""
    n = text.lookup(F.col("Policy_Term"), codes.INSTALLMENTS, codes.DEFAULT_INSTALLMENTS)
    return policies.withColumn("Num_Installments", n.cast("int"))


def with_late_fee(payments: DataFrame, due: str = "Due_Dt", rate: str = codes.LATE_FEE_RATE) -> DataFrame:
    """Late flag and fee of payments that already carry their due date."""
    late = dates.strictly_after(F.col("Actual_Premium_Paid_Dt"), F.col(due))
    fee = numbers.half_even(F.col("Premium_Amt") * F.lit(rate).cast("decimal(3,2)"))
    return payments.withColumn("Is_Late", late).withColumn(
        "Late_Fee", F.when(F.col("Is_Late"), fee).otherwise(F.lit(0)).cast(MONEY)
    )


def late_fees(
    transactions: DataFrame, policies: DataFrame, rate: str = codes.LATE_FEE_RATE
) -> DataFrame:
    """A payment is late when made after its policy's due date (one row per policy).

    A payment without policy, due date or payment date is not late.
    """
    due = policies.select("Policy_Id", F.col("Next_Premium_Dt").alias("Due_Dt"))
    joined = transactions.join(due, "Policy_Id", "left")
    return with_late_fee(joined, rate=rate).drop("Due_Dt").select(
        *transactions.columns, "Is_Late", "Late_Fee"
    )


def dim_customer(customers: DataFrame, order_by: Sequence[str], start: int = 0) -> DataFrame:
    """One row per customer and version start (the last wins), keyed in id, start order."""
    versions = keep_last(customers, ["Customer_ID", "Effective_Start_Dt"], order_by)
    named = versions.withColumn(
        "Customer_Name",
        text.joined_name(
            F.col("Customer_Title"), F.col("Customer_First_Name"), F.col("Customer_Last_Name")
        ),
    )
    keyed = assign_keys(named, "Customer_SK", ["Customer_ID", "Effective_Start_Dt"], start)
    return conform(keyed, GOLD["dim_customer"])


def dim_policy(policies: DataFrame, order_by: Sequence[str], start: int = 0) -> DataFrame:
    """One row per policy (the last wins), keyed in input order."""
    latest = with_installments(keep_last(policies, ["Policy_Id"], order_by))
    return conform(assign_keys(latest, "Policy_SK", order_by, start), GOLD["dim_policy"])


def dim_address(address: DataFrame, order_by: Sequence[str], start: int = 0) -> DataFrame:
    """One row per customer (the last wins), keyed in input order."""
    latest = keep_last(address, ["Customer_ID"], order_by)
    return conform(assign_keys(latest, "Address_SK", order_by, start), GOLD["dim_address"])


def fact_rows(
    transactions: DataFrame, customers: DataFrame, policies: DataFrame, addresses: DataFrame
) -> DataFrame:
    """Transactions with surrogate keys, late flag and fee.

    ``customers``, ``policies`` and ``addresses`` are dimension tables with any number of
    versions per natural key: the first version gives the surrogate key, the policy's
    latest version the due date. The lookups that share a join key are merged first, so
    the transactions are joined twice (by policy, by customer) instead of four times;
    adaptive execution splits hot policies and customers in those joins.
    """
    by_policy = (
        policies.where(F.col("Policy_Id").isNotNull())
        .groupBy("Policy_Id")
        .agg(
            F.min("Policy_SK").alias("Policy_SK"),
            F.max_by("Next_Premium_Dt", "Policy_SK").alias("Due_Dt"),
        )
    )
    by_customer = (
        customers.select("Customer_ID", "Customer_SK")
        .unionByName(addresses.select("Customer_ID", "Address_SK"), allowMissingColumns=True)
        .where(F.col("Customer_ID").isNotNull())
        .groupBy("Customer_ID")
        .agg(F.min("Customer_SK").alias("Customer_SK"), F.min("Address_SK").alias("Address_SK"))
    )
    joined = transactions.join(as_lookup(by_policy, "policy-keys"), "Policy_Id", "left")
    joined = joined.join(as_lookup(by_customer, "customer-keys"), "Customer_ID", "left")
    return with_late_fee(joined).drop("Due_Dt")


def fact_transactions(
    transactions: DataFrame,
    customers: DataFrame,
    policies: DataFrame,
    addresses: DataFrame,
    order_by: Sequence[str],
    start: int = 0,
) -> DataFrame:
    """:func:`fact_rows` keyed densely in transaction order.

    The transactions are written first: a global sort reads its input twice, to find its ranges
    and to place the rows, and would work out the checked rows both times.
    """
    keyed = assign_keys(stage(transactions, "transactions"), "Transaction_SK", order_by, start)
    rows = fact_rows(keyed, customers, policies, addresses)
    return conform(rows, GOLD["fact_transactions"], DEFAULTS["fact_transactions"])
