"""Work that must not be done twice, on small hand-written rows."""

from __future__ import annotations

import datetime as dt
import time
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F, types as T

from starloom.operators import model
from starloom.plans import views
from starloom.schemas import GOLD, SILVER, conform
from starloom.streaming import arrivals
from tests.test_load import BATCHES, write_sources


def test_triggers_of_one_call_load_a_batch_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    source, loaded, add = write_sources(tmp_path / "in", {1: BATCHES[1]}), [], arrivals.add_batch
    monkeypatch.setattr(arrivals, "add_batch", lambda load, raw, batch, **o: (loaded.append(batch), add(load, raw, batch, **o)))
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    arrivals.load_arrivals(spark, source, target, checkpoint, files_per_trigger=1)
    assert loaded == [1]
    write_sources(tmp_path / "in", {3: {"policies": BATCHES[3]["policies"]}})
    arrivals.load_arrivals(spark, source, target, checkpoint, files_per_trigger=1)
    assert loaded == [1, 3]


def test_versions_of_policies_are_grouped_once(spark, tmp_path, rows):
    kinds = [(1, 7, "A"), (1, 7, "A"), (1, 7, "B"), (1, 8, "B"), (2, 8, "A"), (2, 8, None), (None, 8, "A")]
    schema = "Policy_Id long, Customer_ID long, Policy_Type_Id string, Policy_Type string, Policy_Name string"
    versions = [(p, c, k, k and "type " + k, f"name {i}") for i, (p, c, k) in enumerate(kinds)]
    spark.createDataFrame(versions, schema).write.parquet(str(tmp_path / "p"))
    spark.read.parquet(str(tmp_path / "p")).createOrReplaceTempView("dim_policy")
    spark.createDataFrame([], GOLD["dim_customer"]).createOrReplaceTempView("dim_customer")
    found = spark.sql(views.POLICY_CHANGES)
    shown = ["Policy_Id", "Customer_ID", "Current_Policy_Name", "Previous_Policy_Name", "version_pairs"]
    assert rows(found.select(*shown)) == [
        (1, 7, "name 0", "name 2", 4), (1, 7, "name 2", "name 0", 2), (1, 8, "name 3", "name 0", 2)]
    plan = found.select("*")
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()


def test_fact_reads_its_transactions_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def told(policy):
        seen.add(1)
        return policy

    day, amount = dt.date(2012, 3, 1), Decimal("6.25")
    payments = [(p, 1, amount, amount, amount, day, day, "EAST") for p in (3, 1, 2)]
    payments = spark.createDataFrame(payments, T.StructType(SILVER["transactions"].fields))
    empty = [spark.createDataFrame([], GOLD[t]) for t in ("dim_customer", "dim_policy", "dim_address")]
    fact = model.fact_transactions(payments.withColumn("Policy_Id", told("Policy_Id")), *empty, payments.columns)
    assert [tuple(r) for r in fact.select("Transaction_SK", "Policy_Id").orderBy("Transaction_SK").collect()] == [(1, 1), (2, 2), (3, 3)]
    assert seen.value == 3


def test_batch_files_read_written_rows(spark, tmp_path, monkeypatch):
    from starloom.catalogue import queries

    staged, stage = [], queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, name, *more: (staged.append(name), stage(df, name, *more))[1])
    rows = spark.createDataFrame([(str(i), i) for i in (5, None, 1, 4, 1, 3)], "Policy_Id string, line_no long")
    text = rows.select(*[F.col("Policy_Id").alias(c) for c in SILVER["transactions"].names], "line_no")
    monkeypatch.setattr(queries, "raw", lambda spark, sf, name: text)
    root = queries.write_batch_files(spark, "unused")
    assert sorted(staged) == ["raw-policies", "raw-transactions"]
    read = [spark.read.option("header", True).csv(f"{root}/day{b}_transactions.csv") for b in queries.BATCHES]
    assert [sorted(r["Policy_Id"] for r in df.collect()) for df in read] == [["3"], ["1", "1", "4"], ["5"]]


def test_full_view_deals_out_transactions_without_policy_and_address(spark):
    """Nearly all transactions lack both keys; dimension rows that carry the keys' stand-ins still don't match."""
    facts = spark.range(2000).select(
        F.col("id").alias("Transaction_SK"), (F.col("id") % 5).alias("Customer_SK"),
        F.when(F.col("id") == 4, 4).cast("long").alias("Policy_SK"), F.when(F.col("id") == 4, 4).cast("long").alias("Address_SK"))
    conform(facts, GOLD["fact_transactions"]).createOrReplaceTempView("fact_transactions")
    customers = spark.range(7).select(F.col("id").alias("Customer_SK"), F.col("id").alias("Customer_ID"))
    conform(customers, GOLD["dim_customer"]).createOrReplaceTempView("dim_customer")
    stand_ins = facts.select(F.xxhash64("Transaction_SK", "Customer_SK").alias("key")).union(spark.range(9).toDF("key"))
    conform(stand_ins.select(F.col("key").alias("Policy_SK"), F.col("key").alias("Policy_Id")), GOLD["dim_policy"]).createOrReplaceTempView("dim_policy")
    conform(stand_ins.select(F.col("key").alias("Address_SK"), F.lit("X").alias("City")), GOLD["dim_address"]).createOrReplaceTempView("dim_address")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.sql(views.ALL_REGIONS_FULL.rsplit("ORDER BY", 1)[0])
        largest = rows.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        found = rows.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 2002
    assert [(r["Customer_ID"], r["Policy_Id"], r["City"]) for r in found if r["Policy_Id"] is not None or r["City"]] == [(4, 4, "X")]
    assert sorted(r["Customer_ID"] for r in found)[-2:] == [5, 6]
    assert largest < 1000


def test_full_view_has_tasks_for_its_rows(spark, tmp_path, monkeypatch):
    from starloom import session
    from starloom.catalogue import queries

    day = dt.datetime(2012, 3, 1)
    tables = {
        "region": ([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string"),
        "nation": ([(0, "A", 0), (1, "B", 1), (2, None, None)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"c{i}", i % 3, "SEG") for i in range(1, 20)] + [(None, "c", 0, "SEG")],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": ([(i, 1 if i % 3 else i % 17, "F", 5.0, day, "1-URGENT") for i in range(400)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(i % 400, i // 400, 1.0, 2.0, 0.5, day) for i in range(1200)] + [(None, 1, 1.0, 2.0, 0.5, day)],
                     "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_shipdate timestamp"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    lazy = queries.present(queries._view(spark, str(tmp_path), "vw_all_regions_full")).collect()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100, raising=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    written, stage = [], views.stage
    monkeypatch.setattr(views, "stage", lambda df, name: (written.append(spark.conf.get("spark.sql.shuffle.partitions")), stage(df, name))[1])
    full = queries.QUERIES["q_view_full"](spark, str(tmp_path))
    rows = full.collect()
    n = len(rows)
    assert n > 1000 and sorted(map(str, rows)) == sorted(map(str, lazy))
    assert [(r["Region"], r["Customer_ID"]) for r in rows] == [(r["Region"], r["Customer_ID"]) for r in lazy]
    assert n / 100 <= full.rdd.getNumPartitions() <= n / 100 + 1
    assert int(written[0]) >= 10 and spark.conf.get("spark.sql.shuffle.partitions") == before == "4"


def policy_tables(folder, spark):
    """Six orders, the second of them a later version of the first one's policy (its number less one)."""
    day, kinds = dt.datetime(2012, 3, 1), ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    orders = [(13, 1, kinds[1]), (12, 1, kinds[0]), (7, 2, kinds[2]), (8, 1, kinds[2]), (9, 2, kinds[0]), (None, 2, kinds[0])]
    tables = {
        "nation": ([(0, "A", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"c{i}", 0, "SEG") for i in (1, 2)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": ([(o, c, "F", 5.0, day, kind) for o, c, kind in orders],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(o, i, 1.0, 2.0, day) for i in (10, 20) for o, _, _ in orders],
                     "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


def test_a_query_holds_the_files_of_one_batch(spark, tmp_path, monkeypatch, rows):
    from starloom.catalogue import queries
    from starloom.session import staging_path, staging_root

    folder, seen, load = Path(staging_root(spark)) / "starloom", [], queries.batches.load_batches

    def staged(name):
        return [p for p in folder.glob(f"{name}-*") if p not in before]

    def loaded(spark, source, target, ids, **more):
        files = sorted({f.name for root in staged("batches") for f in root.iterdir()})
        seen.append((list(ids), files, staged("raw")))
        return load(spark, source, target, ids, **more)

    sf, before = policy_tables(tmp_path, spark), set(folder.glob("*"))
    monkeypatch.setattr(queries.batches, "load_batches", loaded)
    found = queries.QUERIES["q_incremental_policy_changes"](spark, sf)
    spread = ["policies.csv", "transactions.csv"]
    assert seen == [
        ([0], [f"day0_{t}" for t in ("address.csv", "customers.csv", *spread)], []),
        ([1], [f"day1_{t}" for t in spread], []), ([2], [f"day2_{t}" for t in spread], [])]
    assert not staged("batches") and len(staged("incremental")) == 1
    # The same rows as from all files at once.
    target, told = staging_path(spark, "at-once"), found.columns
    load(spark, queries.write_batch_files(spark, sf), target, queries.BATCHES)
    at_once = queries.wh.Warehouse(spark, target)
    assert rows(found) == rows(at_once.gold("policy_changes").select(*told)) and found.count() == 1
    in_turn = queries.wh.Warehouse(spark, str(staged("incremental")[0]))
    for table in GOLD:
        assert rows(in_turn.gold(table)) == rows(at_once.gold(table))
    assert in_turn.gold("fact_transactions").count() == 10
    files = [p.name for p in staged("incremental")[0].rglob("part-*.parquet")]
    assert files and all(".zstd." in name for name in files)


def test_staging_drops_the_shuffle_files_of_each_action(spark, tmp_path):
    from starloom.session import staging

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), shuffled()
    with staging(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "written"))
        assert spark.range(1000).select(F.col("id") % 9).distinct().count() == 9
        for _ in range(100):  # executors delete them in the background
            if not shuffled() - before:
                break
            time.sleep(0.1)
        assert not shuffled() - before
    assert spark.conf.get(name, None) == setting
