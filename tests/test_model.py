from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.operators import model
from starloom.plans import business, overview, views
from starloom.schemas import GOLD, SILVER, conform


def frame(spark, schema, *rows):
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def d(text):
    return dt.date.fromisoformat(text)


def pay(policy, paid, premium="100.00", customer=1, **more):
    paid = d(paid) if paid else None
    return {"Policy_Id": policy, "Customer_ID": customer, "Premium_Amt": Decimal(premium),
            "Total_Policy_Amt": Decimal("500.00"), "Actual_Premium_Paid_Dt": paid, **more}


def test_late_fees(spark):
    policies = frame(spark, SILVER["policies"], {"Policy_Id": 1, "Next_Premium_Dt": d("2012-02-01")}, {"Policy_Id": 2})
    payments = frame(
        spark, SILVER["transactions"],
        pay(1, "2012-02-01"), pay(1, "2012-02-02"), pay(2, "2012-02-02"), pay(9, "2012-02-02"), pay(1, None),
        pay(1, "2013-01-01", "6.25"), pay(1, "2013-01-01", "18.75"),
    )
    got = model.late_fees(payments, policies).select("Policy_Id", "Premium_Amt", "Is_Late", "Late_Fee")
    fees = sorted((r[0], r[1], r[2], r[3]) for r in got.collect())
    D = Decimal
    assert fees == [
        (1, D("6.25"), True, D("0.12")), (1, D("18.75"), True, D("0.38")),
        (1, D("100.00"), False, D("0.00")), (1, D("100.00"), False, D("0.00")), (1, D("100.00"), True, D("2.00")),
        (2, D("100.00"), False, D("0.00")), (9, D("100.00"), False, D("0.00")),
    ]


def test_conform_applies_types_and_defaults(spark):
    df = spark.createDataFrame([("1", None)], "Transaction_SK string, Is_Late boolean")
    row = conform(df, GOLD["fact_transactions"], {"Is_Late": False, "Late_Fee": 0}).first()
    assert (row["Transaction_SK"], row["Is_Late"], row["Late_Fee"], row["Region"]) == (1, False, Decimal("0.00"), None)


def star(spark):
    """Two customers (1 with two versions), three policies (one with two versions)."""
    customers = frame(
        spark, GOLD["dim_customer"],
        dict(Customer_SK=1, Customer_ID=1, Customer_Title="Mr.", Customer_First_Name="A", Customer_Last_Name="B",
             Customer_Name="Mr. A B", Marital_Status="Married", Region="WEST", Effective_Start_Dt=d("2024-04-12"),
             Effective_End_Dt=d("2024-04-12")),
        dict(Customer_SK=2, Customer_ID=2, Customer_Title="Ms.", Customer_First_Name="C", Customer_Last_Name="D",
             Customer_Name="Ms. C D", Marital_Status="Single", Region="EAST"),
        dict(Customer_SK=3, Customer_ID=1, Customer_Title="Mr.", Customer_First_Name="A", Customer_Last_Name="Z",
             Customer_Name="Mr. A Z", Marital_Status="Divorced", Region="WEST", Effective_Start_Dt=d("2024-04-13")),
    )

    def policy(sk, pid, cust, kind, kid, start="2012-05-01", region="EAST", term="Quarterly"):
        return dict(Policy_SK=sk, Policy_Id=pid, Customer_ID=cust, Policy_Type=kind, Policy_Type_Id=kid,
                    Policy_Name=f"{kind} {pid}", Total_Policy_Amt=Decimal("10.00"), Region=region,
                    Policy_Term=term, Policy_Start_Dt=d(start))

    policies = frame(
        spark, GOLD["dim_policy"],
        policy(1, 10, 1, "Auto", "PT001"), policy(2, 11, 1, "Home", "PT005", "2012-01-01"),
        policy(3, 12, 2, "Home", "PT005", region="NORTH"), policy(4, 10, 1, "Health", "PT004", "2013-01-01"),
    )
    addresses = frame(spark, GOLD["dim_address"], dict(Address_SK=1, Customer_ID=1, City="X"))
    fact = frame(
        spark, GOLD["fact_transactions"],
        *[dict(Transaction_SK=i, Customer_ID=c, Customer_SK=csk, Policy_SK=psk, Address_SK=ask, Policy_Id=pid,
               Total_Policy_Amt=Decimal(amt), Is_Late=late, Late_Fee=Decimal(fee))
          for i, c, csk, psk, ask, pid, amt, late, fee in [
              (1, 1, 1, 1, 1, 10, "100.00", True, "2.00"), (2, 1, 1, 2, 1, 11, "50.00", False, "0.00"),
              (3, 2, 2, 3, None, 12, "70.00", False, "0.00"), (4, 8, None, None, None, 99, "5.00", False, "0.00")]],
    )
    return {"dim_customer": customers, "dim_policy": policies, "dim_address": addresses, "fact_transactions": fact}


def test_business_questions(spark):
    t = star(spark)
    D = Decimal
    c = business.total_by_customer(t["fact_transactions"], t["dim_customer"])
    assert [tuple(r) for r in c.collect()] == [(1, "Mr. A B", "All", D("150.00")), (2, "Ms. C D", "All", D("70.00"))]
    owners = business.total_of_type_owners(t["fact_transactions"], t["dim_policy"], t["dim_customer"])
    assert [tuple(r) for r in owners.collect()] == [(1, "Mr. A B", "All", "Auto", D("150.00"))]
    e = business.total_by_region_term_year(t["dim_policy"], t["dim_customer"])
    assert [tuple(r) for r in e.collect()] == [(1, "Mr. A B", "East and West", "Quarterly", "05/01/2012", D("20.00"))]
    f = business.marital_changes(t["dim_customer"])
    assert [(r["Customer_ID"], r["Marital_Status"]) for r in f.collect()] == [(1, "Married"), (1, "Divorced")]
    g = business.full_view(t["dim_customer"], t["dim_policy"], t["dim_address"])
    assert [(r["Region"], r["Customer_ID"], r["Policy_Id"], r["Region_pol"], r["City"]) for r in g.collect()] == [
        ("EAST", 2, 12, "NORTH", None), ("WEST", 1, 10, "EAST", "X"), ("WEST", 1, 10, "EAST", "X"),
        ("WEST", 1, 11, "EAST", "X"),
    ]
    everything = business.run_all(t, t["dim_policy"].where("Policy_SK < 4"), t["dim_policy"].where("Policy_SK = 4"))
    assert list(everything) == list("bcdefg")
    b = everything["b"].first()
    assert (b["Policy_Id"], b["Current_Policy_Type"], b["Previous_Policy_Type"]) == (10, "Health", "Auto")


def test_views(spark):
    names = views.register(spark, star(spark))
    assert names == ["vw_policy_changes", "vw_total_policy_all", "vw_auto_policy_amount",
                     "vw_east_west_quarterly_2012", "vw_marital_changes", "vw_all_regions_full"]
    D = Decimal
    changes = spark.table("vw_policy_changes").collect()
    assert sorted((r["Policy_Id"], r["Customer_Name"], r["Previous_Policy_Type"], r["Current_Policy_Type"], r["version_pairs"])
                  for r in changes) == [(10, "Mr. A Z", "Auto", "Health", 1), (10, "Mr. A Z", "Health", "Auto", 1)]
    assert [tuple(r) for r in spark.table("vw_total_policy_all").collect()] == [
        (1, "Mr. A B", "All", D("150.00")), (2, "Ms. C D", "All", D("70.00"))]
    # Only the payments on Auto policies, unlike the question about owners of Auto policies.
    assert [r["Total_Policy_Amt"] for r in spark.table("vw_auto_policy_amount").collect()] == [D("100.00")]
    assert [(r["Policy_Start_Dt"], r["Total_Policy_Amt"]) for r in spark.table("vw_east_west_quarterly_2012").collect()] == [
        (d("2012-05-01"), D("100.00")), (d("2012-01-01"), D("50.00"))]
    assert spark.table("vw_marital_changes").count() == 2
    full = spark.table("vw_all_regions_full").collect()
    assert sorted((r["Customer_ID"], r["Customer_Name"], r["Policy_Id"], r["Is_Late"]) for r in full if r["Policy_Id"]) == [
        (1, "Mr. A B", 10, True), (1, "Mr. A B", 11, False), (2, "Ms. C D", 12, False)]
    assert [r["Customer_Name"] for r in full if r["Policy_Id"] is None] == ["Mr. A Z"]


def test_overview(spark):
    t = star(spark)
    kpis = {r["label"]: r["value"] for r in overview.kpis(t).collect()}
    assert kpis == {"Total Customers": 3, "Total Policies": 4, "Addresses": 1, "Transactions": 4}
    shares = {r["value"]: r["pct"] for r in overview.breakdown(t["dim_policy"], "Policy_Type").collect()}
    assert shares == {"Home": 100, "Auto": 50, "Health": 50}
    summary = overview.change_summary(
        t["fact_transactions"], t["dim_policy"].limit(0), business.marital_changes(t["dim_customer"])
    )
    assert {r["measure"]: r["value"] for r in summary.collect()} == {
        "late_payments": 1.0, "late_fees": 2.0, "policy_changes": 0.0, "customers_with_status_change": 1.0}


def test_totals_add_up(spark):
    t = star(spark)
    by_customer = business.total_by_customer(t["fact_transactions"], t["dim_customer"])
    named = t["fact_transactions"].where("Customer_ID IN (1, 2)").agg(F.sum("Total_Policy_Amt")).first()[0]
    assert by_customer.agg(F.sum("Total_Policy_Amt")).first()[0] == named


def hot_conf(spark):
    return {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }


def test_hot_policy_and_customer_are_split_in_the_fact_joins(spark):
    """A third of the payments belong to one policy and one customer."""
    payments = spark.range(20000).repartition(4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("Policy_Id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("Customer_ID"),
        F.lit(1).cast("decimal(15,2)").alias("Premium_Amt"), F.lit(d("2012-01-01")).alias("Actual_Premium_Paid_Dt"),
        F.col("id").alias("Transaction_SK"),
    )
    ids = spark.range(500)
    policies = ids.select(F.col("id").alias("Policy_Id"), (F.col("id") + 1).alias("Policy_SK"), F.lit(d("2011-01-01")).alias("Next_Premium_Dt"))
    customers = ids.select(F.col("id").alias("Customer_ID"), (F.col("id") + 1).alias("Customer_SK"))
    addresses = ids.select(F.col("id").alias("Customer_ID"), (F.col("id") + 1).alias("Address_SK"))
    before = {k: spark.conf.get(k, None) for k in hot_conf(spark)}
    try:
        for k, v in hot_conf(spark).items():
            spark.conf.set(k, v)
        fact = model.fact_rows(payments, customers, policies, addresses)
        got = fact.agg(F.count("*"), F.sum("Policy_SK"), F.sum("Customer_SK"), F.sum("Address_SK"), F.count_if("Is_Late"))
        fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString()
        row = tuple(got.first())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    expected = sum((7 if i % 3 == 0 else i % 500) + 1 for i in range(20000))
    assert row == (20000, expected, expected, expected, 20000)
    assert plan.count("SortMergeJoin(skew=true)") >= 2, plan


def test_hot_customer_is_split_in_the_full_view_and_the_status_view(spark, tmp_path):
    """One customer owns a third of the policies and has a third of the customer versions."""
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("bigint")
    ids = spark.range(12000).repartition(4)
    policies = conform(ids.select((F.col("id") + 1).alias("Policy_SK"), F.col("id").alias("Policy_Id"), hot.alias("Customer_ID"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("Policy_Name")), GOLD["dim_policy"])
    versions = conform(ids.select((F.col("id") + 1).alias("Customer_SK"), hot.alias("Customer_ID"),
                                  F.concat(F.lit("S"), F.col("id") % 2).alias("Marital_Status"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("Customer_Title")), GOLD["dim_customer"])
    addresses = conform(spark.range(900).select(F.col("id").alias("Customer_ID")), GOLD["dim_address"])
    versions.createOrReplaceTempView("dim_customer")
    before = {k: spark.conf.get(k, None) for k in hot_conf(spark)}
    try:
        for k, v in hot_conf(spark).items():
            spark.conf.set(k, v)
        full = business.full_view(versions, policies, addresses)
        status = spark.sql(views.MARITAL_CHANGES)
        assert len(full.collect()) == 12000
        assert len(status.collect()) > 4000
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (full, status)]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plans[0], plans[0]
    assert "SortMergeJoin(skew=true)" in plans[1], plans[1]


def test_policy_changes_grow_with_the_history_not_with_its_square(spark):
    """One policy with 10,000 versions, each with a name of its own."""
    ids = spark.range(10000)
    t = star(spark)
    t["dim_policy"] = conform(ids.select((F.col("id") + 1).alias("Policy_SK"), F.lit(10).alias("Policy_Id"), F.lit(1).alias("Customer_ID"),
                                         F.concat(F.lit("PT00"), F.col("id") % 5).alias("Policy_Type_Id"),
                                         F.format_string("name %05d", F.col("id")).alias("Policy_Name")), GOLD["dim_policy"])
    views.register(spark, t)
    changes = spark.table("vw_policy_changes").collect()
    assert len(changes) == 20 and {r["version_pairs"] for r in changes} == {2000 * 2000}
    assert {(r["Current_Policy_Type_Id"], r["Current_Policy_Name"]) for r in changes} == {(f"PT00{i}", f"name {i:05d}") for i in range(5)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    tables = {}
    for name, df in star(spark).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    plan = plan_of(business.total_by_region_term_year(tables["dim_policy"], tables["dim_customer"]))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "Policy_SK" in line)
    assert "GreaterThanOrEqual(Policy_Start_Dt,2012-01-01)" in scan and "EqualTo(Policy_Term,Quarterly)" in scan
    assert "Policy_Type_Desc" not in scan and "Premium_Amt" not in scan
    plan = plan_of(business.total_by_customer(tables["fact_transactions"], tables["dim_customer"]))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "Total_Policy_Amt" in line)
    assert "ReadSchema: struct<Customer_ID:bigint,Total_Policy_Amt:decimal(15,2)>" in scan


def test_no_plan_pairs_rows_without_a_key(spark):
    t = star(spark)
    views.register(spark, t)
    frames = [*business.run_all(t, t["dim_policy"], t["dim_policy"]).values(),
              *[spark.sql(text) for text in views.view_texts().values()]]
    for df in frames:
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
