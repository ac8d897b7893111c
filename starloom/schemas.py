"""Declared schemas: bronze (all text), silver (typed), gold (star schema)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, types as T

MONEY = T.DecimalType(15, 2)

_S, _L, _D = T.StringType(), T.LongType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Table names, column names and types of the extracts and of the star schema.
SILVER: dict[str, T.StructType] = {
    "customers": _struct(
        ("Customer_ID", _L), ("Customer_Title", _S), ("Customer_First_Name", _S),
        ("Customer_Last_Name", _S), ("Customer_Segment", _S), ("Marital_Status", _S),
        ("Gender", _S), ("DOB", _D), ("Effective_Start_Dt", _D), ("Effective_End_Dt", _D),
        ("Region", _S),
    ),
    "policies": _struct(
        ("Policy_Type_Id", _S), ("Policy_Type", _S), ("Policy_Type_Desc", _S),
        ("Policy_Id", _L), ("Policy_Name", _S), ("Customer_ID", _L), ("Premium_Amt", MONEY),
        ("Policy_Term", _S), ("Policy_Start_Dt", _D), ("Policy_End_Dt", _D),
        ("Next_Premium_Dt", _D), ("Actual_Premium_Paid_Dt", _D), ("Total_Policy_Amt", MONEY),
        ("Premium_Amt_Paid_TillDate", MONEY), ("Region", _S),
    ),
    "address": _struct(
        ("Customer_ID", _L), ("Country", _S), ("Region", _S), ("State", _S), ("City", _S),
        ("Postal_Code", _S),
    ),
    "transactions": _struct(
        ("Policy_Id", _L), ("Customer_ID", _L), ("Premium_Amt", MONEY),
        ("Total_Policy_Amt", MONEY), ("Premium_Amt_Paid_TillDate", MONEY),
        ("Next_Premium_Dt", _D), ("Actual_Premium_Paid_Dt", _D), ("Region", _S),
    ),
}

TABLES = tuple(SILVER)

BRONZE: dict[str, T.StructType] = {
    table: _struct(*[(f.name, _S) for f in schema.fields]) for table, schema in SILVER.items()
}

GOLD: dict[str, T.StructType] = {
    "dim_customer": _struct(
        ("Customer_SK", _L), ("Customer_ID", _L), ("Customer_Title", _S),
        ("Customer_First_Name", _S), ("Customer_Last_Name", _S), ("Customer_Name", _S),
        ("Customer_Segment", _S), ("Marital_Status", _S), ("Gender", _S), ("DOB", _D),
        ("Effective_Start_Dt", _D), ("Effective_End_Dt", _D), ("Region", _S),
    ),
    "dim_policy": _struct(
        ("Policy_SK", _L), ("Policy_Type_Id", _S), ("Policy_Type", _S),
        ("Policy_Type_Desc", _S), ("Policy_Id", _L), ("Policy_Name", _S),
        ("Customer_ID", _L), ("Premium_Amt", MONEY), ("Policy_Term", _S),
        ("Policy_Start_Dt", _D), ("Policy_End_Dt", _D), ("Next_Premium_Dt", _D),
        ("Actual_Premium_Paid_Dt", _D), ("Total_Policy_Amt", MONEY),
        ("Premium_Amt_Paid_TillDate", MONEY), ("Num_Installments", T.IntegerType()),
        ("Region", _S),
    ),
    "dim_address": _struct(
        ("Address_SK", _L), ("Customer_ID", _L), ("Country", _S), ("Region", _S),
        ("State", _S), ("City", _S), ("Postal_Code", _S),
    ),
    "fact_transactions": _struct(
        ("Transaction_SK", _L), ("Policy_Id", _L), ("Customer_ID", _L), ("Customer_SK", _L),
        ("Policy_SK", _L), ("Address_SK", _L), ("Premium_Amt", MONEY),
        ("Total_Policy_Amt", MONEY), ("Premium_Amt_Paid_TillDate", MONEY),
        ("Next_Premium_Dt", _D), ("Actual_Premium_Paid_Dt", _D), ("Is_Late", T.BooleanType()),
        ("Late_Fee", MONEY), ("Region", _S),
    ),
    "policy_changes": _struct(
        ("Policy_Id", _L), ("Customer_ID", _L), ("Policy_Name", _S),
        ("Current_Policy_Type_Id", _S), ("Current_Policy_Type", _S),
        ("Previous_Policy_Type_Id", _S), ("Previous_Policy_Type", _S),
    ),
    "marital_changes": _struct(
        ("Customer_ID", _L), ("Customer_Title", _S), ("Customer_First_Name", _S),
        ("Customer_Last_Name", _S), ("Customer_Segment", _S), ("Marital_Status", _S),
        ("Effective_Start_Dt", _D), ("Effective_End_Dt", _D),
    ),
    "validation_report": _struct(
        ("table", _S), ("status", _S), ("issues", T.ArrayType(_S)), ("rows_in", _L),
        ("rows_out", _L),
    ),
}

# Sums of the fact per batch; they take the fact's place where only totals are asked for.
_SUM = T.DecimalType(25, 2)
FACT_TOTALS = _struct(
    ("Customer_ID", _L), ("Customer_SK", _L), ("Policy_SK", _L), ("n_rows", _L), ("Premium_Amt", _SUM),
    ("Total_Policy_Amt", _SUM), ("Late_Fee", _SUM),
)

# Dimensions load before the fact that refers to them.
LOAD_ORDER = ("dim_customer", "dim_policy", "dim_address", "fact_transactions")

PRIMARY_KEYS = {
    "dim_customer": "Customer_SK",
    "dim_policy": "Policy_SK",
    "dim_address": "Address_SK",
    "fact_transactions": "Transaction_SK",
}

# fact column -> (dimension, key column)
FOREIGN_KEYS = {
    "Customer_SK": ("dim_customer", "Customer_SK"),
    "Policy_SK": ("dim_policy", "Policy_SK"),
    "Address_SK": ("dim_address", "Address_SK"),
}

NOT_NULL = {
    "dim_customer": ("Customer_SK", "Customer_ID", "Customer_First_Name", "Customer_Last_Name"),
    "dim_policy": ("Policy_SK", "Policy_Id"),
    "dim_address": ("Address_SK",),
    "fact_transactions": ("Transaction_SK",),
}

DEFAULTS = {"fact_transactions": {"Is_Late": False, "Late_Fee": 0}}


def conform(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Project ``df`` onto a declared schema: order, cast, add absent columns, fill defaults."""
    defaults = defaults or {}
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        value = f"TRY_CAST({f'`{field.name}`' if field.name in present else 'NULL'} AS {kind})"
        if field.name in defaults:
            value = f"coalesce({value}, CAST({defaults[field.name]} AS {kind}))"
        columns.append(f"{value} AS `{field.name}`")
    return df.selectExpr(*columns)
