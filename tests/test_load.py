"""The incremental load on hand-written files: three batches, dirty rows, reruns, arrivals."""

from __future__ import annotations

import csv
import datetime as dt
import json
from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators.keys import ORDINAL
from starloom.plans import batches as plan, business
from starloom.plans.batches import load_batches
from starloom.schemas import BRONZE, FOREIGN_KEYS, GOLD, PRIMARY_KEYS, SILVER
from starloom.session import staging_root
from starloom.sources import extracts, key_index
from starloom.sources.raw import read_batch, read_columns, read_csv, read_csv_or_empty, read_raw_table
from starloom.sources.versions import ConcurrentLoad
from starloom.sources.warehouse import Load, Warehouse, insert_if_absent, load_warehouse
from starloom.streaming.arrivals import load_arrivals

KEYED = tuple(PRIMARY_KEYS)


def customer(cid, start="2000-01-01", end="", marital="m", **more):
    return {"Customer_ID": cid, "Customer_Title": "Mr.", "Customer_First_Name": " aARON", "Customer_Last_Name": "o'dillon",
            "Customer_Segment": "Consumer", "Marital_Status": marital, "Gender": "M", "DOB": "1985-02-15",
            "Effective_Start_Dt": start, "Effective_End_Dt": end, "Region": "ea", **more}


def policy(pid, cid=1, kind="PT001", due="2012-02-01", **more):
    names = {"PT001": "Auto", "PT004": "Health", "": ""}
    return {"Policy_Type_Id": kind, "Policy_Type": names[kind], "Policy_Type_Desc": "x", "Policy_Id": pid,
            "Policy_Name": f"Policy {pid}", "Customer_ID": cid, "Premium_Amt": "100", "Policy_Term": "qtr",
            "Policy_Start_Dt": "2012-01-02", "Policy_End_Dt": "2014-01-02", "Next_Premium_Dt": due,
            "Actual_Premium_Paid_Dt": "2012-01-20", "Total_Policy_Amt": "500", "Premium_Amt_Paid_TillDate": "1.5",
            "Region": "EAST", **more}


def address(cid, **more):
    return {"Customer_ID": cid, "Country": "united states", "Region": "ea", "State": "new york", "City": "x, y",
            "Postal_Code": "00501", **more}


def payment(pid, cid=1, paid="2012-03-01", premium="6.25", **more):
    return {"Policy_Id": pid, "Customer_ID": cid, "Premium_Amt": premium, "Total_Policy_Amt": "500",
            "Premium_Amt_Paid_TillDate": "1", "Next_Premium_Dt": "2012-02-01", "Actual_Premium_Paid_Dt": paid,
            "Region": "e", **more}


BATCHES = {
    0: {
        "customers": [customer(1), customer(2), customer(2, marital="s"), customer("abc"), customer(1354, "2024-04-12", "2024-04-12")],
        "policies": [policy(1), policy(2, 2, ""), policy(3, 2, ""), policy(4, premium=1, Premium_Amt="0")],
        "address": [address(1), address(2, Country="NA")],
        "transactions": [payment(1), payment(1, paid="2012-02-01"), payment(9, 99), payment("x"), payment(2, 2, premium="18.75")],
    },
    1: {
        "customers": [customer(1354, "2024-04-13", "2099-12-31", "div"), customer(3)],
        "policies": [policy(1, kind="PT004", due="2012-06-01"), policy(2, 2, "PT001"), policy(3, 2, "")],
        "address": [address(3)],
        "transactions": [payment(1, 1, "2012-03-01"), payment(1, 1, "2012-07-01"), payment(3, 3)],
    },
    3: {  # policy 1 was absent from batch 2, which has no files at all
        "policies": [policy(1)],
        "transactions": [payment(1, 1, "2012-03-01")] * 2,
    },
}


def write_sources(root, batches=BATCHES):
    for batch, tables in batches.items():
        for table, data in tables.items():
            with open(f"{root}/day{batch}_{table}.csv", "w", newline="") as f:
                writer = csv.DictWriter(f, BRONZE[table].names, extrasaction="ignore")
                writer.writeheader()
                writer.writerows(data)
    return str(root)


def content(warehouse):
    return {
        t: sorted(map(str, (tuple(r) for r in warehouse.gold(t).collect()))) for t in GOLD
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    source = write_sources(tmp_path_factory.mktemp("source"))
    target = str(tmp_path_factory.mktemp("warehouse"))
    assert load_batches(spark, source, target, [0, 1, 2, 3]) == [0, 1, 3]
    return source, target


def test_surrogate_keys_are_dense_over_all_batches(spark, loaded):
    warehouse = Warehouse(spark, loaded[1])
    for table in KEYED:
        found = sorted(r[0] for r in warehouse.gold(table).select(PRIMARY_KEYS[table]).collect())
        assert found == list(range(1, len(found) + 1)), table
    tables = warehouse.tables()
    for fk, (parent, pk) in FOREIGN_KEYS.items():
        used = tables["fact_transactions"].where(F.col(fk).isNotNull())
        assert used.join(tables[parent], used[fk] == tables[parent][pk], "left_anti").isEmpty()


def test_dimensions(spark, loaded):
    warehouse = Warehouse(spark, loaded[1])
    customers = [tuple(r) for r in warehouse.gold("dim_customer").orderBy("Customer_SK")
                 .select("Customer_SK", "Customer_ID", "Customer_Name", "Marital_Status", "Region").collect()]
    assert customers == [
        (1, 1, "Mr. Aaron O'Dillon", "Married", "EAST"), (2, 2, "Mr. Aaron O'Dillon", "Married", "EAST"),
        (3, 1354, "Mr. Aaron O'Dillon", "Married", "EAST"), (4, 3, "Mr. Aaron O'Dillon", "Married", "EAST"),
        (5, 1354, "Mr. Aaron O'Dillon", "Divorced", "EAST"),
    ]
    policies = [tuple(r) for r in warehouse.gold("dim_policy").orderBy("Policy_SK")
                .select("Policy_SK", "Policy_Id", "Policy_Type_Id", "Num_Installments", "batch_id").collect()]
    assert policies == [(1, 1, "PT001", 4, 0), (2, 2, None, 4, 0), (3, 3, None, 4, 0),
                        (4, 1, "PT004", 4, 1), (5, 2, "PT001", 4, 1), (6, 3, None, 4, 1), (7, 1, "PT001", 4, 3)]
    assert warehouse.gold("dim_address").orderBy("Address_SK").first()["Postal_Code"] == "00501"


def test_fact(spark, loaded):
    fact = Warehouse(spark, loaded[1]).gold("fact_transactions").orderBy("Transaction_SK")
    D = Decimal
    assert [tuple(r) for r in fact.select("batch_id", "Policy_Id", "Customer_SK", "Policy_SK", "Address_SK", "Is_Late", "Late_Fee").collect()] == [
        (0, 1, 1, 1, 1, True, D("0.12")), (0, 1, 1, 1, 1, False, D("0.00")), (0, 9, None, None, None, False, D("0.00")),
        (0, 2, 2, 2, None, True, D("0.38")),
        # Batch 1 moved the due date of policy 1; keys stay those of the first version.
        (1, 1, 1, 1, 1, False, D("0.00")), (1, 1, 1, 1, 1, True, D("0.12")), (1, 3, 4, 3, 2, True, D("0.12")),
        (3, 1, 1, 1, 1, True, D("0.12")), (3, 1, 1, 1, 1, True, D("0.12")),
    ]


def test_changes(spark, loaded):
    warehouse = Warehouse(spark, loaded[1])
    changes = warehouse.gold("policy_changes").select(
        "batch_id", "Policy_Id", "Previous_Policy_Type_Id", "Current_Policy_Type_Id"
    )
    assert sorted(map(tuple, changes.collect()), key=str) == [
        (1, 1, "PT001", "PT004"), (1, 2, None, "PT001"), (3, 1, "PT004", "PT001"),
    ]
    marital = warehouse.gold("marital_changes").orderBy("Effective_Start_Dt")
    assert [(r["batch_id"], r["Customer_ID"], r["Marital_Status"]) for r in marital.collect()] == [
        (1, 1354, "Married"), (1, 1354, "Divorced")]


def test_report(spark, loaded, tmp_path):
    report = Warehouse(spark, loaded[1]).gold("validation_report")
    found = {(r["batch_id"], r["table"]): (r["rows_in"], r["rows_out"], r["issues"]) for r in report.collect()}
    assert found[0, "customers"] == (5, 3, ["Customer_ID duplicates: 1 removed", "Invalid Customer_ID: 1 rows dropped"])
    assert found[0, "address"] == (2, 1, ["Country: 1 nulls → dropped"])
    assert found[1, "transactions"] == (3, 3, ["All checks passed."])
    assert found[3, "customers"] == (0, 0, ["All checks passed."])
    extracts.write_report(report, str(tmp_path / "report"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert {line["batch_id"] for line in lines} == {0, 1, 3}
    assert [t["table"] for t in lines[0]["tables"]] == ["address", "customers", "policies", "transactions"]
    texts = extracts.report_json(report).orderBy("batch_id").collect()
    assert json.loads(texts[0]["report"])[0]["rows_in"] == 2


def test_inventory(spark, loaded):
    found = {r["table"]: (r["n_rows"], r["columns"]) for r in Warehouse(spark, loaded[1]).inventory().collect()}
    assert found["fact_transactions"] == (9, "Transaction_SK, Policy_Id, Customer_ID, Customer_SK")


def test_loading_again_changes_nothing(spark, loaded):
    warehouse = Warehouse(spark, loaded[1])
    before = content(warehouse)
    assert load_batches(spark, *loaded, [0, 1]) == [0, 1]
    assert content(warehouse) == before


def test_a_changed_batch_moves_the_later_keys(spark, loaded, tmp_path):
    batches = {b: {k: list(v) for k, v in BATCHES[b].items()} for b in (0, 1)}
    (tmp_path / "in").mkdir()
    source, target = write_sources(tmp_path / "in", batches), str(tmp_path / "w")
    load_batches(spark, source, target, [0, 1])
    del batches[0]["customers"][0]
    write_sources(tmp_path / "in", batches)
    with pytest.raises(ValueError, match="dim_customer"):
        load_batches(spark, source, target, [0])
    load_batches(spark, source, target, [0, 1], reload=True)
    found = sorted(r[0] for r in Warehouse(spark, target).gold("dim_customer").select("Customer_SK").collect())
    assert found == [1, 2, 3, 4]


def test_arrivals_give_the_same_warehouse(spark, loaded, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    write_sources(tmp_path / "in", {0: BATCHES[0]})
    load_arrivals(spark, source, target, checkpoint)
    write_sources(tmp_path / "in", {b: BATCHES[b] for b in (1, 3)})
    load_arrivals(spark, source, target, checkpoint)
    assert content(Warehouse(spark, target)) == content(Warehouse(spark, loaded[1]))


def test_a_changed_batch_of_equal_size_is_not_loaded_below_later_ones(spark, tmp_path):
    batches = {0: {"customers": [customer(1), customer(2)], "policies": [policy(1)]}, 1: {"transactions": [payment(1, 1)]}}
    (tmp_path / "in").mkdir()
    source, target = write_sources(tmp_path / "in", batches), str(tmp_path / "w")
    load_batches(spark, source, target, [0, 1])
    before = content(Warehouse(spark, target))
    batches[0]["customers"] = [customer(2), customer(5)]
    write_sources(tmp_path / "in", batches)
    with pytest.raises(ValueError, match="dim_customer"):
        load_batches(spark, source, target, [0])
    kept = content(Warehouse(spark, target))
    assert all(kept[t] == before[t] for t in KEYED)
    load_batches(spark, source, target, [0, 1], reload=True)
    assert [r["Customer_SK"] for r in Warehouse(spark, target).gold("fact_transactions").collect()] == [None]
    batches[0]["policies"] = [policy(1, due="2012-06-01")]  # a due date that batch 1 has looked up
    write_sources(tmp_path / "in", batches)
    with pytest.raises(ValueError, match="dim_policy"):
        load_batches(spark, source, target, [0])


def test_marital_changes_are_told_once(spark, tmp_path):
    status = ["m", "s", "m", "div"]
    batches = {b: {"customers": [customer(8, f"20{10 + b}-01-01", marital=s), customer(9, f"20{10 + b}-01-01")]} for b, s in enumerate(status)}
    (tmp_path / "in").mkdir()
    load_batches(spark, write_sources(tmp_path / "in", batches), str(tmp_path / "w"), range(4))
    told = Warehouse(spark, str(tmp_path / "w")).gold("marital_changes").collect()
    assert sorted((r["batch_id"], r["Customer_ID"], str(r["Effective_Start_Dt"])[:4]) for r in told) == [
        (1, 8, "2010"), (1, 8, "2011"), (2, 8, "2012"), (3, 8, "2013")]


def test_late_arrivals_and_batches_without_payments(spark, loaded, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    only = {5: {"customers": [customer(77)]}}
    ordered = str(tmp_path / "ordered")
    everything = write_sources(tmp_path_of(tmp_path, "all"), {**BATCHES, **only})
    load_batches(spark, everything, ordered, [0, 1, 3, 5])
    for part in ({1: BATCHES[1], **only}, {0: BATCHES[0]}, {3: BATCHES[3]}):
        write_sources(tmp_path / "in", part)
        load_arrivals(spark, source, target, checkpoint)
    assert content(Warehouse(spark, target)) == content(Warehouse(spark, ordered))


def tmp_path_of(root, name):
    (root / name).mkdir()
    return root / name


def test_partitioning_does_not_show(spark, loaded, tmp_path):
    changed = {"spark.sql.shuffle.partitions": "7", "spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        load_batches(spark, loaded[0], str(tmp_path / "w"), [0, 1, 3])
        assert content(Warehouse(spark, str(tmp_path / "w"))) == content(Warehouse(spark, loaded[1]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_same_batch_lookup_knows_only_the_batch(spark, loaded, tmp_path):
    load_batches(spark, loaded[0], str(tmp_path / "w"), [0, 1], same_batch_only=True)
    fact = Warehouse(spark, str(tmp_path / "w")).gold("fact_transactions").where("batch_id = 1")
    assert [(r["Policy_Id"], r["Customer_SK"], r["Policy_SK"]) for r in fact.orderBy("Transaction_SK").collect()] == [
        (1, None, 4), (1, None, 4), (3, 4, 6)]


def test_raw_reading(spark, tmp_path):
    path = tmp_path / "day0_customers.csv"
    path.write_text('Region,Customer_ID,Extra\n" e ",007,"a ""q"", b"\nNA,,null\n')
    df = read_csv(spark, str(path), ordinal=True)
    assert [tuple(r)[:3] for r in df.orderBy(ORDINAL).collect()] == [(" e ", "007", 'a "q", b'), (None, None, None)]
    assert read_columns(spark, str(path), ["Customer_ID", "Gone"]).columns == ["Customer_ID"]
    batch = read_batch(spark, str(tmp_path), 0)
    assert batch["policies"].isEmpty() and batch["policies"].columns == [*BRONZE["policies"].names, ORDINAL]
    assert BRONZE["policies"].names[-1] == "Region"  # reading leaves the declaration alone
    assert read_raw_table(spark, str(path), "customers").count() == 2
    path.write_text('Customer_ID,City,Region\n1,"New\nYork, ""NY""",e\n2,Rome,w\n')
    found = read_raw_table(spark, str(path), "customers").orderBy(ORDINAL).collect()
    assert [tuple(r)[:3] for r in found] == [("1", 'New\nYork, "NY"', "e"), ("2", "Rome", "w")]


def test_results_round_trip_through_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, " a,\"b\" ", dt.date(2012, 1, 2), Decimal("1.50"))], "k int, s string, d date, m decimal(9,2)")
    extracts.write_csv(df, str(tmp_path / "out"))
    assert read_csv_or_empty(spark, str(tmp_path / "out"), df.schema).collect() == df.collect()
    assert read_csv_or_empty(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_json_records_round_half_even(spark):
    df = spark.createDataFrame([(2, 0.125, None), (1, 0.375, "x")], "k int, v double, s string")
    assert [r["record"] for r in extracts.json_records(df, ["k"], 5).collect()] == [
        '{"k":1,"v":0.38,"s":"x"}', '{"k":2,"v":0.12,"s":null}']


def test_insert_if_absent(spark, tmp_path):
    schema = GOLD["dim_address"]
    first = spark.createDataFrame([(1, 1, "nan"), (1, 2, "b"), (2, 2, "c")], "Address_SK bigint, Customer_ID bigint, City string")
    path = str(tmp_path / "dim_address")
    assert tuple(insert_if_absent(spark, path, first, "dim_address", ["Customer_ID"]).first()) == ("dim_address", 3, 2, 1)
    again = first.unionByName(spark.createDataFrame([(5, 9, "z")], first.schema))
    assert tuple(insert_if_absent(spark, path, again, "dim_address", ["Customer_ID"]).first()) == ("dim_address", 4, 1, 3)
    stored = spark.read.schema(schema).parquet(path).orderBy("Address_SK").collect()
    assert [(r["Address_SK"], r["Customer_ID"], r["City"]) for r in stored] == [(1, 1, None), (2, 2, "c"), (5, 9, "z")]


def test_the_first_row_of_a_key_is_stored(spark, tmp_path):
    rows = spark.createDataFrame([(1, 9, "z"), (1, 2, "a"), (2, 5, "b"), (2, 1, "c")], "Address_SK bigint, Customer_ID bigint, City string")
    path = str(tmp_path / "db")
    assert [tuple(r) for r in load_warehouse(spark, path, {"dim_address": rows.coalesce(1)}).collect()] == [("dim_address", 4, 2, 2)]
    stored = spark.read.parquet(f"{path}/dim_address").orderBy("Address_SK").collect()
    assert [(r["Address_SK"], r["Customer_ID"], r["City"]) for r in stored] == [(1, 9, "z"), (2, 5, "b")]


def test_load_warehouse_twice(spark, loaded, tmp_path):
    tables = Warehouse(spark, loaded[1]).tables()
    first = load_warehouse(spark, str(tmp_path / "db"), tables).collect()
    assert [(r["table"], r["inserted"], r["ignored"]) for r in first] == [
        ("dim_customer", 5, 0), ("dim_policy", 7, 0), ("dim_address", 2, 0), ("fact_transactions", 9, 0)]
    second = load_warehouse(spark, str(tmp_path / "db"), tables).collect()
    assert all(r["inserted"] == 0 for r in second)


def test_a_later_batch_reads_its_first_key_from_the_manifest(spark, tmp_path):
    """The numbers that loads note give the keys; without one the tables are searched."""
    source, target = write_sources(tmp_path), str(tmp_path / "warehouse")
    load_batches(spark, source, target, [0, 1])
    warehouse = Warehouse(spark, target)
    before = {t: warehouse.gold(t).agg(F.max(PRIMARY_KEYS[t])).first()[0] for t in KEYED}
    assert {t: warehouse.last_key(t, 2) for t in KEYED} == before
    with warehouse.begin() as load:
        load.own.update(load.base.batches)
        load._note(1, lambda e: replace(e, last_keys={}))
    assert {t: warehouse.last_key(t, 2) for t in KEYED} == before
    load_batches(spark, source, target, [3])
    keys = sorted(r[0] for r in warehouse.gold("dim_policy").select("Policy_SK").collect())
    assert keys == list(range(1, len(keys) + 1))


def everything(warehouse):
    """All that a reader can see: gold, silver with the rejected rows, report."""
    silver = {t: warehouse.silver(t) for t in SILVER}
    rejected = {t + "!": warehouse.rejected(t) for t in SILVER}
    seen = {t: sorted(map(str, map(tuple, df.collect()))) for t, df in {**silver, **rejected}.items()}
    return content(warehouse) | {"silver": seen, "loaded": warehouse.loaded()}


def test_a_refused_batch_leaves_silver_and_report(spark, tmp_path):
    batches = {0: {"customers": [customer(1), customer(2)]}, 1: {"customers": [customer(3)]}}
    source, target = write_sources(tmp_path_of(tmp_path, "in"), batches), str(tmp_path / "w")
    load_batches(spark, source, target, [0, 1])
    before = everything(Warehouse(spark, target))
    batches[0]["customers"] = [customer(1), customer(5), customer(6), customer("abc")]
    write_sources(tmp_path / "in", batches)
    with pytest.raises(ValueError, match="dim_customer"):
        load_batches(spark, source, target, [0])
    assert everything(Warehouse(spark, target)) == before
    assert len(list(Path(target).glob("silver/customers/batch_id=0/*"))) == 1  # nothing is left behind


class Lost(RuntimeError):
    pass


def test_a_load_that_is_lost_after_any_write_changes_nothing(spark, tmp_path, monkeypatch):
    batches = {0: {"customers": [customer(1), customer(1)], "transactions": [payment(1, 1), payment("x")]},
               1: {"customers": [customer(2)], "transactions": [payment(2, 2)]}}
    source, target = write_sources(tmp_path_of(tmp_path, "in"), batches), str(tmp_path / "w")
    load_batches(spark, source, target, [0])
    warehouse, write = Warehouse(spark, target), Load.write
    before, tables = everything(warehouse), []

    def told(self, df, layer, table, *more):
        tables.append((layer, table))
        return write(self, df, layer, table, *more)

    # The same load again writes every table of a batch once; lose it after each of them.
    monkeypatch.setattr(Load, "write", told)
    load_batches(spark, source, target, [0])
    assert len(set(tables)) == len(tables) == 17 and everything(warehouse) == before
    for lost in [("bronze", "customers"), ("silver", "transactions"), ("gold", "validation_report"),
                 ("index", "customer_keys"), ("gold", "fact_transactions"), ("gold", "marital_changes")]:
        def fails(self, df, layer, table, *more, lost=lost):
            out = write(self, df, layer, table, *more)
            if (layer, table) == lost:
                raise Lost(table)
            return out

        monkeypatch.setattr(Load, "write", fails)
        with monkeypatch.context() as killed:
            killed.setattr(Load, "discard", lambda self: None)  # a killed process cannot tidy up
            with pytest.raises(Lost):
                load_batches(spark, source, target, [1])
        assert Warehouse(spark, target).version() == warehouse.version() and warehouse.loaded() == [0]
    assert everything(warehouse) == before
    monkeypatch.setattr(Load, "write", write)
    load_batches(spark, source, target, [1])
    assert warehouse.loaded() == [0, 1] and everything(warehouse.at(warehouse.versions()[-2])) == before
    gone = warehouse.expire(keep=1, abandoned_hours=-1)
    assert gone and warehouse.versions() == [3]
    assert not warehouse.expire(keep=1, abandoned_hours=-1) and warehouse.gold("fact_transactions").count() == 2


def test_of_two_loads_from_one_version_one_is_published(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "a")], "Customer_SK bigint, City string")
    with pytest.raises(ConcurrentLoad):
        with warehouse.begin() as late:
            late.write(rows, "gold", "dim_address", 0)
            with warehouse.begin() as early:
                early.write(rows, "gold", "dim_address", 7)
    assert warehouse.loaded() == [7] and warehouse.versions() == [1]
    assert not list(Path(str(tmp_path)).glob("gold/dim_address/batch_id=0/*"))


def test_a_reload_is_published_at_once(spark, tmp_path, monkeypatch):
    source, target = write_sources(tmp_path_of(tmp_path, "in")), str(tmp_path / "w")
    load_batches(spark, source, target, [0, 1])
    before = everything(Warehouse(spark, target))
    changed = {**BATCHES, 0: {**BATCHES[0], "customers": [customer(2), customer(8)]}}
    write_sources(tmp_path / "in", changed)
    add = plan.add_batch

    def second_fails(load, raw, batch_id, **options):
        if batch_id == 1:
            raise Lost
        return add(load, raw, batch_id, **options)

    monkeypatch.setattr(plan, "add_batch", second_fails)
    with pytest.raises(Lost):
        load_batches(spark, source, target, [0, 1], reload=True)
    assert everything(Warehouse(spark, target)) == before


def test_rejected_rows_are_kept_under_their_rule(spark, loaded):
    warehouse = Warehouse(spark, loaded[1])
    found = {t: sorted((r["batch_id"], r["rule_no"], r["rule"], r["column"], json.loads(r["raw"]).get("Customer_ID")) for r in warehouse.rejected(t).collect()) for t in BRONZE}
    assert found == {
        "customers": [(0, 5, "unique", "Customer_ID", "2"), (0, 6, "positive_id", "Customer_ID", "abc")],
        "policies": [(0, 4, "positive", "Premium_Amt", "1")],
        "address": [(0, 3, "not_null", "Country", "2")],
        "transactions": [(0, 1, "numeric", "Policy_Id", "1")],
    }
    assert json.loads(warehouse.rejected("transactions").first()["raw"])["Policy_Id"] == "x"


def test_a_late_batch_opens_no_more_files_after_many_batches(spark, tmp_path, monkeypatch):
    days = {b: {"customers": [customer(1, f"20{10 + b}-01-01"), customer(b + 50)], "policies": [policy(1, due=f"2012-0{b + 1}-01"), policy(b + 50)],
                "address": [address(b + 50)], "transactions": [payment(1, 1, "2012-03-05"), payment(52, 51, "2012-03-05")]} for b in range(5)}
    days[5] = {"transactions": [payment(1, 1, "2012-03-05"), payment(52, 51, "2012-12-05"), payment(54, 54)]}
    source, opened, state = write_sources(tmp_path_of(tmp_path, "in"), days), {}, key_index.state

    def noted(warehouse, index, buckets, batches):
        found = state(warehouse, index, buckets, batches)
        opened.setdefault(index.table, []).append((len(buckets), len(found.inputFiles())))
        return found

    monkeypatch.setattr(key_index, "state", noted)
    load_batches(spark, source, str(tmp_path / "w"), [0, 1, 2, 3, 4])
    opened.clear()
    load_batches(spark, source, str(tmp_path / "w"), [5])
    assert {t: max(n) for t, n in opened.items()} == {"policy_keys": (3, 3), "customer_keys": (3, 3)}
    # Without an index the dimensions of all batches are searched, with the same result.
    monkeypatch.setattr(key_index, "state", lambda *a: None)
    load_batches(spark, source, str(tmp_path / "scan"), range(6))
    assert not list((tmp_path / "scan").glob("index/*"))
    assert content(Warehouse(spark, str(tmp_path / "w"))) == content(Warehouse(spark, str(tmp_path / "scan")))


def test_totals_follow_a_late_and_a_changed_batch(spark, tmp_path):
    source, target = write_sources(tmp_path_of(tmp_path, "in")), str(tmp_path / "w")
    warehouse = Warehouse(spark, target)

    def equal():
        fact, customers, policies = (warehouse.gold(t) for t in ("fact_transactions", "dim_customer", "dim_policy"))
        sums = warehouse.fact_totals()
        assert not any("fact_transactions" in f for f in sums.inputFiles())
        assert sums.agg(F.sum("n_rows"), F.sum("Late_Fee"), F.sum("Premium_Amt")).first() == fact.agg(
            F.count("*"), F.sum("Late_Fee"), F.sum("Premium_Amt")).first()
        for one, other in [(business.total_by_customer(sums, customers), business.total_by_customer(fact, customers)),
                           (business.total_of_type_owners(sums, policies, customers), business.total_of_type_owners(fact, policies, customers))]:
            assert list(map(tuple, one.collect())) == list(map(tuple, other.collect()))

    load_batches(spark, source, target, [0, 3])
    changed = {**BATCHES, 1: {**BATCHES[1], "transactions": [payment(1, 1, premium="50"), payment(2, 2)]}}
    write_sources(tmp_path / "in", changed)
    load_batches(spark, source, target, [1, 3], reload=True)  # late
    equal()
    before = warehouse.fact_totals().agg(F.sum("Premium_Amt")).first()[0]
    write_sources(tmp_path / "in", {**changed, 3: {**BATCHES[3], "transactions": [payment(1, 1, premium="1000")]}})
    load_batches(spark, source, target, [3])  # changed
    equal()
    assert warehouse.fact_totals().agg(F.sum("Premium_Amt")).first()[0] == before - 2 * Decimal("6.25") + 1000


def test_transactions_are_parsed_once(spark, tmp_path, monkeypatch):
    source, target = write_sources(tmp_path_of(tmp_path, "in")), str(tmp_path / "w")
    scans, write = [], Load.write

    def planned(self, df, layer, table, *more):
        scans.append((layer, table, df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")))
        return write(self, df, layer, table, *more)

    monkeypatch.setattr(Load, "write", planned)
    load_batches(spark, source, target, [0], multiline=False)
    assert sorted(s for s in scans if s[2]) == [(("silver" if t == "transactions" else "bronze"), t, 1) for t in ("address", "customers", "policies")] + [("silver", "transactions", 1)]


def test_a_load_leaves_no_staged_tables(spark, tmp_path):
    write_sources(tmp_path)
    folder = Path(staging_root(spark)) / "starloom"
    before = set(folder.iterdir()) if folder.exists() else set()
    load_batches(spark, str(tmp_path), str(tmp_path / "warehouse"), [0, 1])
    assert set(folder.iterdir()) == before
