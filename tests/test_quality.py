"""Every rule on hand-written dirty rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality, standardize
from starloom.schemas import BRONZE

ORDER = ["line"]


def bronze(spark, table, *rows):
    """Rows given as dicts over a valid default row; ``line`` is the file order."""
    names = BRONZE[table].names
    data = [(*[row.get(n) for n in names], i) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names) + ", line int")


def customer(**changes):
    return {
        "Customer_ID": "1", "Customer_Title": "Mr.", "Customer_First_Name": "ann", "Customer_Last_Name": "o'neil",
        "Customer_Segment": "SME", "Marital_Status": "m", "Gender": "F", "DOB": "1990-01-02",
        "Effective_Start_Dt": "2020-01-01", "Effective_End_Dt": None, "Region": " eAsT ", **changes,
    }


def policy(**changes):
    return {
        "Policy_Type_Id": "PT001", "Policy_Type": "Auto", "Policy_Type_Desc": "d", "Policy_Id": "10",
        "Policy_Name": "n", "Customer_ID": "1", "Premium_Amt": "100", "Policy_Term": "qtr",
        "Policy_Start_Dt": "2012-01-02", "Policy_End_Dt": "2013-01-02", "Next_Premium_Dt": "2012-02-01",
        "Actual_Premium_Paid_Dt": "2012-01-20", "Total_Policy_Amt": "500", "Premium_Amt_Paid_TillDate": "1",
        "Region": "w", **changes,
    }


def address(**changes):
    return {
        "Customer_ID": "1", "Country": "united states", "Region": "n", "State": "new york", "City": "x",
        "Postal_Code": "00123", **changes,
    }


def payment(**changes):
    return {
        "Policy_Id": "10", "Customer_ID": "1", "Premium_Amt": "100", "Total_Policy_Amt": "500",
        "Premium_Amt_Paid_TillDate": "1", "Next_Premium_Dt": "2012-02-01",
        "Actual_Premium_Paid_Dt": "2012-02-02", "Region": "s", **changes,
    }


def outcome(checked):
    report = checked.report.first()
    counts = {(r["rule"], r["column"]): r["n_rows"] for r in checked.counts.collect()}
    assert report["rows_in"] - sum(counts.values()) == report["rows_out"] == checked.rows.count()
    return report, {k: n for k, n in counts.items() if n}


def test_customers(spark):
    df = bronze(
        spark, "customers",
        customer(),
        customer(Customer_ID="1", Region="W"),  # repeat: the first stays
        customer(Customer_ID="01"),  # another text, so not a repeat; the same number afterwards
        customer(Customer_ID=None),
        customer(Customer_ID="2", Customer_First_Name=None),
        customer(Customer_ID="3", Region=None),
        customer(Customer_ID="abc"), customer(Customer_ID="-4"), customer(Customer_ID="0"),
        customer(Customer_ID="5", DOB="nope"),
        customer(Customer_ID="5", DOB="1990-01-02"),  # lost: the repeat rule ran first
        customer(Customer_ID="6", DOB="02/03/1990", Effective_End_Dt="9999-12-31"),
    )
    checked = quality.validate(df, "customers", ORDER)
    report, dropped = outcome(checked)
    assert dropped == {
        ("not_null", "Customer_ID"): 1, ("not_null", "Customer_First_Name"): 1, ("not_null", "Region"): 1,
        ("unique", "Customer_ID"): 2, ("positive_id", "Customer_ID"): 3, ("valid_date", "DOB"): 1,
    }
    assert report["issues"][0] == "Customer_ID: 1 null values found → dropped"
    assert "Customer_ID duplicates: 2 removed" in report["issues"]
    assert [(r["Customer_ID"], r["Region"]) for r in checked.rows.orderBy("line").collect()] == [
        (1, " eAsT "), (1, " eAsT "), (6, " eAsT "),
    ]


def test_policies(spark):
    df = bronze(
        spark, "policies",
        policy(),
        *[policy(Policy_Id=str(20 + i), Premium_Amt=p) for i, p in enumerate(["0", "-1", "x", "1e3", "1d", "NaN"])],
        policy(Policy_Id="10", Premium_Amt="7"), policy(Policy_Id="010"),  # both repeat 10: ids are numbers first
        policy(Policy_Id="30", Policy_End_Dt="2011-01-01"),
        policy(Policy_Id="31", Policy_End_Dt=None),
        policy(Policy_Id="32", Policy_Start_Dt="later"),
        policy(Policy_Id="x"), policy(Policy_Id="40", Customer_ID=None), policy(Policy_Id="41", Region=None),
    )
    _, dropped = outcome(quality.validate(df, "policies", ORDER))
    assert dropped == {
        ("numeric", "Policy_Id"): 1, ("numeric", "Customer_ID"): 1, ("numeric", "Premium_Amt"): 3,
        ("positive", "Premium_Amt"): 2, ("unique", "Policy_Id"): 2, ("not_before", "Policy_End_Dt"): 1,
    }
    strict = quality.validate(df, "policies", ORDER, quality.rules_for("policies", strict=True))
    _, dropped = outcome(strict)
    assert dropped[("not_null", "Region")] == 1
    assert dropped[("valid_date", "Policy_Start_Dt")] == 1 and dropped[("valid_date", "Policy_End_Dt")] == 1


def test_address_key_stays_text(spark):
    df = bronze(
        spark, "address", address(), address(Customer_ID="01"), address(City="y"),
        address(Customer_ID="2", Country=None), address(Customer_ID="3", City=None),
    )
    checked = quality.validate(df, "address", ORDER)
    _, dropped = outcome(checked)
    assert dropped == {("not_null", "Country"): 1, ("unique", "Customer_ID"): 1}
    city = standardize.standardize(checked.rows, "address").where("Customer_ID = 3").first()
    assert city["City"] is None and city["Postal_Code"] == "00123" and city["Country"] == "United States"


def test_transactions_may_repeat(spark):
    df = bronze(
        spark, "transactions", payment(), payment(), payment(Premium_Amt="0"), payment(Total_Policy_Amt="?"),
        payment(Actual_Premium_Paid_Dt="bad"), payment(Policy_Id=None),
    )
    checked = quality.validate(df, "transactions", ORDER)
    _, dropped = outcome(checked)
    assert dropped == {
        ("numeric", "Policy_Id"): 1, ("numeric", "Total_Policy_Amt"): 1, ("positive", "Premium_Amt"): 1,
    }
    assert checked.rows.where(F.col("Actual_Premium_Paid_Dt").isNull()).count() == 1


@pytest.mark.parametrize("table", ["customers", "policies", "address", "transactions"])
def test_empty_table_passes(spark, table):
    empty = spark.createDataFrame([], bronze(spark, table, {}).schema)
    report = quality.validate(empty, table, ORDER).report.first()
    assert (report["rows_in"], report["rows_out"], report["status"]) == (0, 0, "passed")
    assert report["issues"] == [quality.ALL_PASSED]


def test_missing_columns_are_reported_and_survived(spark):
    df = bronze(spark, "customers", customer(), customer(Customer_ID="2")).drop("DOB", "Region")
    checked = quality.validate(df, "customers", ORDER)
    report = checked.report.first()
    assert report["issues"] == ["Missing columns: ['DOB', 'Region']"]
    silver = standardize.standardize(checked.rows, "customers")
    assert silver.where("DOB IS NULL AND Region IS NULL").count() == 2


def test_a_filter_does_not_copy_the_rule_expressions(spark):
    plan = quality.validate(bronze(spark, "customers", customer()), "customers", ORDER).rows
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if "Filter" in line]
    assert filters and not any("try_cast" in line for line in filters)


def test_standardize_customers(spark):
    df = bronze(
        spark, "customers", customer(), customer(Marital_Status="Martian", Gender=None, Customer_Last_Name="mcDONALD-smith ")
    )
    a, b = standardize.standardize(df, "customers").orderBy("line").collect()
    assert (a["Region"], a["Marital_Status"], a["Gender"], a["Customer_Last_Name"]) == ("EAST", "Married", "Female", "O'Neil")
    assert (b["Marital_Status"], b["Gender"], b["Customer_Last_Name"]) == ("Martian", None, "Mcdonald-Smith")
    unknown = standardize.unknown_report(df, "customers").collect()
    assert [(r["column"], r["value"], r["n_rows"]) for r in unknown] == [("Marital_Status", "Martian", 1)]


def test_report_summary_shows_two_issues(spark):
    df = bronze(spark, "address", address(Customer_ID=None), address(Region=None), address(Country=None))
    summary = quality.report_summary(quality.validate(df, "address", ORDER).report).first()
    assert summary["first_issues"] == "Customer_ID: 1 nulls → dropped; Region: 1 nulls → dropped"
