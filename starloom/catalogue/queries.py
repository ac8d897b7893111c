"""Spark side of the catalogue: name -> (spark, sf_dir) -> DataFrame.

Results are presented in plain types (dates as text, money as double, flags as 0/1), so
that they compare with the SQL side column by column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.catalogue.inputs import raw, star, table
from starloom.functions import codes, dates, numbers, text
from starloom.operators import (
    aggregates, changes, constraints, filters, keys, merge, model, paging, quality,
    standardize,
)
from starloom.operators.columns import load_values_all, null_tokens_all
from starloom.plans import batches, business, overview, views
from starloom.schemas import BRONZE, SILVER, TABLES
from starloom.session import scratch, sized_for, stage, staging, staging_path, together
from starloom.sources import extracts, raw as raw_files, split_csv, warehouse as wh
from starloom.streaming.arrivals import load_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE = ["line_no"]
YEAR = 1997


def query(fn: Query) -> Query:
    """Register ``fn`` as ``q_<name>`` with presented results."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(spark, sf_dir))

    QUERIES["q_" + fn.__name__] = run
    return fn


def present(df: DataFrame) -> DataFrame:
    plain = []
    for field in df.schema.fields:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.DateType):
            c = dates.iso(c)
        elif isinstance(kind, (T.BooleanType, T.IntegerType)):
            c = c.cast("bigint")
        plain.append(c.alias(field.name))
    return df.select(*plain)


def raw_clean(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return null_tokens_all(raw(spark, sf_dir, name))


def checked(spark: SparkSession, sf_dir: str, name: str) -> quality.Checked:
    return quality.validate(raw_clean(spark, sf_dir, name), name, LINE)


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return standardize.standardize(checked(spark, sf_dir, name).rows, name)


# ---- business questions -------------------------------------------------------------


@query
def total_by_customer(spark, sf):
    return business.total_by_customer(star(spark, sf, "payments"), star(spark, sf, "dim_customer"))


@query
def total_owner_of_type(spark, sf):
    return business.total_of_type_owners(
        star(spark, sf, "payments"), star(spark, sf, "dim_policy"), star(spark, sf, "dim_customer")
    )


@query
def total_region_term_year(spark, sf):
    return business.total_by_region_term_year(
        star(spark, sf, "dim_policy"), star(spark, sf, "dim_customer"), year=YEAR
    )


@query
def marital_changes(spark, sf):
    return business.marital_changes(star(spark, sf, "dim_customer"))


@query
def full_view(spark, sf):
    return business.full_view(*(star(spark, sf, t) for t in ("dim_customer", "dim_policy", "dim_address")))


def _policy_changes(spark, sf, limit):
    return business.policy_changes(
        star(spark, sf, "dim_policy"), star(spark, sf, "next_policies"),
        star(spark, sf, "dim_customer"), limit,
    )


@query
def policy_changes(spark, sf):
    return _policy_changes(spark, sf, None)


@query
def limit_ordered(spark, sf):
    return _policy_changes(spark, sf, 20)


@query
def multi_status_history(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return changes.multi_value_history(lines, "l_orderkey", "l_returnflag")


@query
def history_changes(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_id", "event_type"
    )
    return changes.history_changes(events, "user_id", "day", "event_id", ["event_type"])


# ---- SQL views ----------------------------------------------------------------------


def _view(spark, sf, name, **replaced):
    tables = {
        t: star(spark, sf, replaced.get(t, t))
        for t in ("dim_customer", "dim_policy", "dim_address", "fact_transactions")
    }
    for t, df in tables.items():
        df.createOrReplaceTempView(t)
    return spark.sql(views.view_texts(YEAR)[name])


@query
def view_policy_changes(spark, sf):
    return _view(spark, sf, "vw_policy_changes", dim_policy="policy_versions")


@query
def view_total(spark, sf):
    return _view(spark, sf, "vw_total_policy_all")


@query
def view_type_amount(spark, sf):
    return _view(spark, sf, "vw_auto_policy_amount")


@query
def view_region_term_year(spark, sf):
    return _view(spark, sf, f"vw_east_west_quarterly_{YEAR}")


@query
def view_multi_status(spark, sf):
    return _view(spark, sf, "vw_marital_changes")


@query
def view_full(spark, sf):
    fact = star(spark, sf, "fact_transactions").select(*views.FULL_FACT)
    with sized_for(spark, table(spark, sf, "lineitem").count()):
        fact = stage(fact, "fact")
    dims = {t: star(spark, sf, t) for t in ("dim_customer", "dim_policy", "dim_address")}
    return views.all_regions_full(spark, {**dims, "fact_transactions": fact})


# ---- derivations and the star schema ------------------------------------------------


@query
def late_fee(spark, sf):
    return model.late_fees(star(spark, sf, "payments"), star(spark, sf, "dim_policy")).select(
        "Policy_Id", "Customer_ID", "Premium_Amt", "Actual_Premium_Paid_Dt", "Is_Late", "Late_Fee"
    )


@query
def late_summary(spark, sf):
    late = model.late_fees(star(spark, sf, "payments"), star(spark, sf, "dim_policy"))
    customers = star(spark, sf, "dim_customer")
    return overview.change_summary(
        late, _policy_changes(spark, sf, None),
        changes.keys_with_many_values(customers, "Customer_ID", "Marital_Status"),
    )


@query
def installments(spark, sf):
    policies = standardize.standardize(raw_clean(spark, sf, "policies"), "policies")
    return model.with_installments(policies).select(
        F.col("line_no").alias("o_orderkey"), "Policy_Term", "Num_Installments"
    )


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))


@query
def dedup_first(spark, sf):
    first = keys.keep_first(_lines(spark, sf), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag")


@query
def dedup_last(spark, sf):
    last = keys.keep_last(_lines(spark, sf), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return last.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag")


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate")
    )


_ORDER_ORDER = ["o_custkey", "o_orderdate", "o_orderkey"]


@query
def surrogate_keys(spark, sf):
    return keys.assign_keys(_orders(spark, sf), "order_sk", _ORDER_ORDER)


@query
def surrogate_keys_increment(spark, sf):
    orders = _orders(spark, sf)
    first = keys.assign_keys(orders.where("o_orderstatus <> 'P'"), "order_sk", _ORDER_ORDER)
    start = keys.max_key(first, "order_sk")
    rest = keys.assign_keys(orders.where("o_orderstatus = 'P'"), "order_sk", _ORDER_ORDER, start)
    return first.unionByName(rest)


@query
def dim_customer(spark, sf):
    return model.dim_customer(silver(spark, sf, "customers"), LINE)


@query
def dim_policy(spark, sf):
    return model.dim_policy(silver(spark, sf, "policies"), LINE)


@query
def dim_address(spark, sf):
    return model.dim_address(silver(spark, sf, "address"), LINE)


@query
def fact(spark, sf):
    payments = silver(spark, sf, "transactions").drop("line_no")
    return model.fact_transactions(
        payments,
        star(spark, sf, "dim_customer"), star(spark, sf, "dim_policy"), star(spark, sf, "dim_address"),
        payments.columns,
    )


@query
def run_all(spark, sf):
    names = ("dim_customer", "dim_policy", "dim_address")
    tables = {**{t: star(spark, sf, t) for t in names}, "fact_transactions": star(spark, sf, "payments")}
    answers = business.run_all(tables, tables["dim_policy"], star(spark, sf, "next_policies"), YEAR)
    parts = [
        df.agg(F.count("*").alias("n_rows"), F.sum("Customer_ID").alias("customer_ids"))
        .select(F.lit(letter).alias("letter"), "n_rows", "customer_ids")
        for letter, df in answers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- data quality -------------------------------------------------------------------


def _validated(name: str) -> None:
    def run(spark, sf):
        return checked(spark, sf, name).rows.drop("line_no")

    run.__name__ = "validate_" + name
    query(run)


def _standardized(name: str) -> None:
    def run(spark, sf):
        return standardize.standardize(raw_clean(spark, sf, name), name).drop("line_no")

    run.__name__ = "standardize_" + name
    query(run)


def _validated_strict(name: str) -> None:
    def run(spark, sf):
        found = quality.validate(raw_clean(spark, sf, name), name, LINE, quality.rules_for(name, strict=True))
        return found.rows.drop("line_no")

    run.__name__ = "validate_strict_" + name
    query(run)


for _name in TABLES:
    _validated(_name)
    _standardized(_name)
for _name in ("policies", "transactions"):
    _validated_strict(_name)


@query
def validation_report(spark, sf):
    report = quality.combined_report({t: checked(spark, sf, t) for t in TABLES})
    return quality.report_summary(report)


@query
def report_json(spark, sf):
    report = quality.combined_report({t: checked(spark, sf, t) for t in TABLES})
    return extracts.report_json(report.withColumn("batch_id", F.lit(0)))


@query
def rule_counts(spark, sf):
    parts = [checked(spark, sf, t).counts for t in TABLES]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def rejected_rows(spark, sf):
    """Every row that a rule drops, with the region text it came with."""
    parts = []
    for t in TABLES:
        tagged = quality.quarantine(raw_clean(spark, sf, t), t, LINE)
        parts.append(tagged.rejected(tagged.rows).select(
            "table", "rule_no", "rule", "column", F.get_json_object("raw", "$.line_no").cast("bigint").alias("line_no"),
            F.get_json_object("raw", "$.Region").alias("region"),
        ))
    return reduce(DataFrame.unionByName, parts)


@query
def required_columns(spark, sf):
    short = raw_clean(spark, sf, "customers").drop("Gender", "DOB")
    report = quality.validate(short, "customers", LINE).report
    return report.select("table", "rows_in", "rows_out", F.col("issues")[0].alias("first_issue"))


@query
def pk_check(spark, sf):
    return constraints.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(spark, sf):
    kept = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return constraints.orphan_keys(table(spark, sf, "lineitem"), "l_orderkey", kept, "o_orderkey")


@query
def fk_set_null(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return constraints.null_out_orphans(lines, {
        "l_partkey": (table(spark, sf, "part").where("p_type <> 'ECONOMY'"), "p_partkey"),
        "l_suppkey": (table(spark, sf, "supplier").where("s_acctbal >= 0"), "s_suppkey"),
    })


@query
def not_null_check(spark, sf):
    return constraints.null_counts(
        raw_clean(spark, sf, "customers"), ["Customer_ID", "Customer_First_Name", "Customer_Title", "Region"]
    )


# ---- reading and coercion -----------------------------------------------------------


@query
def null_tokens(spark, sf):
    return raw_clean(spark, sf, "customers").select(
        "line_no", "Customer_ID", "Customer_Last_Name", "Effective_End_Dt", "Region"
    )


@query
def load_values(spark, sf):
    payments = raw(spark, sf, "transactions").select(
        "line_no", "Customer_ID", "Actual_Premium_Paid_Dt", "Total_Policy_Amt"
    )
    return load_values_all(payments)


@query
def numeric_coerce(spark, sf):
    return raw(spark, sf, "policies").select(
        "line_no",
        numbers.to_id(F.col("Policy_Id")).alias("policy_id"),
        numbers.to_amount(F.col("Premium_Amt")).alias("premium"),
    )


@query
def date_coerce(spark, sf):
    return raw(spark, sf, "customers").select(
        "line_no",
        dates.parse_date(F.col("DOB")).alias("dob"),
        dates.parse_date(F.col("Effective_End_Dt")).alias("end_dt"),
    )


@query
def unknown_values(spark, sf):
    customers = raw_clean(spark, sf, "customers")
    return standardize.unknown_values(customers, "Region", codes.REGIONS).unionByName(
        standardize.unknown_values(customers, "Marital_Status", codes.MARITAL_STATUSES)
    ).unionByName(standardize.unknown_values(customers, "Gender", codes.GENDERS))


@query
def unknown_report(spark, sf):
    return standardize.unknown_report(raw_clean(spark, sf, "customers"), "customers")


@query
def read_columns(spark, sf):
    path = staging_path(spark, "csv")
    extracts.write_csv(raw(spark, sf, "customers"), path)
    return raw_files.read_columns(spark, path, ["Customer_ID", "Region", "Not_There"])


@query
def result_or_empty(spark, sf):
    """A stored result, and one that was never written."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    path = staging_path(spark, "result")
    extracts.write_csv(orders, path)
    stored = raw_files.read_csv_or_empty(spark, path, orders.schema)
    return stored.unionByName(raw_files.read_csv_or_empty(spark, path + "-absent", orders.schema))


@query
def csv_source(spark, sf):
    path = staging_path(spark, "csv")
    extracts.write_csv(raw(spark, sf, "customers").withColumn("line_no", F.col("line_no").cast("string")), path)
    return raw_files.read_raw_table(spark, path, "customers").drop(raw_files.ORDINAL)


@query
def csv_breaks(spark, sf):
    """Quoted line breaks, quotes and commas in every row, read line by line and put together."""
    name = F.concat("Customer_Last_Name", F.lit('\n"x",\n y'))
    rows = raw(spark, sf, "customers").select(
        F.col("line_no").cast("string").alias("line_no"), "Customer_ID", name.alias("Customer_Last_Name"), "Region"
    )
    path = staging_path(spark, "breaks")
    extracts.write_csv(rows, path)
    return null_tokens_all(split_csv.read_records(spark, path, whole_below=0).drop(raw_files.ORDINAL))


# ---- combining and loading ----------------------------------------------------------


@query
def union_align(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return merge.append_aligned(customers, suppliers)


def _existing_orders(spark, sf):
    return table(spark, sf, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderstatus")


def _incoming_orders(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("o_custkey"),
        F.col("l_returnflag").alias("o_orderstatus"),
    )


@query
def insert_if_absent(spark, sf):
    return merge.insert_if_absent(
        _existing_orders(spark, sf), _incoming_orders(spark, sf), "o_orderkey",
        ["o_custkey", "o_orderstatus"],
    )


@query
def upsert_latest(spark, sf):
    return merge.upsert_latest(
        _existing_orders(spark, sf), _incoming_orders(spark, sf), ["o_orderkey"],
        ["o_custkey", "o_orderstatus"],
    )


@query
def load_warehouse(spark, sf):
    tables = {t: star(spark, sf, t) for t in ("dim_customer", "dim_policy", "dim_address", "fact_transactions")}
    return wh.load_warehouse(spark, staging_path(spark, "warehouse"), tables)


@query
def load_warehouse_rows(spark, sf):
    """The rows that an insert-if-absent stores, half of them by a second load of all."""
    path, rows = staging_path(spark, "warehouse"), star(spark, sf, "dim_customer")
    wh.load_warehouse(spark, path, {"dim_customer": rows.where("Customer_SK % 2 = 0")})
    wh.load_warehouse(spark, path, {"dim_customer": rows})
    return spark.read.parquet(f"{path}/dim_customer")


@query
def load_text_dates(spark, sf):
    """Dates that arrive as text are stored as dates; a second load leaves stored rows as they are."""
    rows = raw_clean(spark, sf, "customers").withColumnRenamed("line_no", "Customer_SK")
    path = staging_path(spark, "text-dates")
    first = rows.where("Customer_SK % 2 = 0").withColumn("Region", F.lit("FIRST"))
    wh.insert_if_absent(spark, path, first, "dim_customer")
    wh.insert_if_absent(spark, path, rows, "dim_customer")
    stored = spark.read.parquet(path)
    return stored.select("Customer_SK", "Region", "DOB", "Effective_Start_Dt", "Effective_End_Dt")


@query
def inventory(spark, sf):
    names = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events")
    return aggregates.inventory({t: table(spark, sf, t) for t in names})


# ---- overview -----------------------------------------------------------------------


@query
def kpis(spark, sf):
    return overview.kpis({
        t: star(spark, sf, t) for t in ("dim_customer", "dim_policy", "dim_address", "fact_transactions")
    })


@query
def breakdown_region(spark, sf):
    return aggregates.frequencies(star(spark, sf, "dim_policy"), "Region")


@query
def breakdown_type(spark, sf):
    return aggregates.frequencies(star(spark, sf, "dim_policy"), "Policy_Type")


@query
def breakdown_term(spark, sf):
    return aggregates.frequencies(star(spark, sf, "dim_policy"), "Policy_Term")


@query
def share_of_max(spark, sf):
    return overview.breakdown(star(spark, sf, "dim_customer"), "Region")


@query
def keyword_search(spark, sf):
    return filters.search(star(spark, sf, "dim_customer"), "MACHINERY").select("Customer_SK", "Customer_Name", "Region")


def _priced(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price")
    )


@query
def page(spark, sf):
    return paging.page(_priced(spark, sf), [F.desc("price"), "o_orderkey"], 3)


@query
def page_deep(spark, sf):
    return paging.page(_priced(spark, sf), [F.desc("price"), "o_orderkey"], 600)


@query
def top_n(spark, sf):
    totals = aggregates.totals(star(spark, sf, "payments"), ["Customer_ID"], "Total_Policy_Amt")
    return paging.top(totals, [F.desc("Total_Policy_Amt"), "Customer_ID"], 10)


@query
def json_extract(spark, sf):
    return extracts.json_records(_priced(spark, sf), [F.desc("price"), "o_orderkey"], 200)


@query
def display_format(spark, sf):
    return raw_clean(spark, sf, "policies").select(
        "line_no",
        text.display(F.col("line_no") * 1000, True).alias("shown_number"),
        text.display(F.col("Policy_Term"), False).alias("shown_term"),
    )


@query
def hash_sample(spark, sf):
    return filters.hash_sample(star(spark, sf, "dim_policy"), "Policy_Id", 10).select("Policy_Id", "Policy_Type")


# ---- incremental load ---------------------------------------------------------------

BATCHES = (0, 1, 2)


def write_batch_files(spark: SparkSession, sf: str, root: str | None = None, only: Sequence[int] = BATCHES) -> str:
    """Raw CSV files of three batches, or some of them: customers and addresses in the first one,
    policies and transactions spread by their order key."""
    root = root or staging_path(spark, "batches")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = {name: ["line_no"] for name in TABLES}
    # Line numbers of transactions repeat; whole rows that are alike may change places.
    order["transactions"] = ["line_no", *[F.col(c).asc_nulls_first() for c in BRONZE["transactions"].names]]
    batch = F.col("line_no") % len(BATCHES)

    def write(name: str, rows: DataFrame, number: int) -> None:
        # Keys follow the order of files and rows; transactions are spread over several files.
        placed = rows.repartitionByRange(files, *order[name]).sortWithinPartitions(*order[name])
        extracts.write_csv(placed.drop("line_no"), f"{root}/day{number}_{name}.csv")

    def write_spread(name: str) -> None:
        # Written once: each batch reads its rows twice, to find the ranges and to place them.
        df = stage(raw(spark, sf, name).where(batch.isin(*only)), f"raw-{name}")
        together(*[partial(write, name, df.where(batch == b), b) for b in only])

    jobs = [partial(write_spread, name) for name in ("policies", "transactions")]
    if BATCHES[0] in only:
        jobs += [partial(write, name, raw(spark, sf, name), BATCHES[0]) for name in ("customers", "address")]
    with staging(spark):
        together(*jobs)
    return root


def load_as_they_come(spark: SparkSession, sf: str, target: str) -> None:
    """The three batches into a warehouse. The files of a batch are written before its load and
    removed after it, so that no more than one batch of them is on disk."""
    for batch in BATCHES:
        with scratch(spark, "batches") as source:
            batches.load_batches(spark, write_batch_files(spark, sf, source, [batch]), target, [batch])


def loaded_totals(spark: SparkSession, root: str) -> DataFrame:
    """The loaded fact per customer, with enough keys to notice a wrong one."""
    fact = wh.Warehouse(spark, root).gold("fact_transactions")
    return fact.groupBy("Customer_ID").agg(
        F.count("*").alias("n"),
        F.min("Customer_SK").alias("customer_sk"),
        F.sum("Policy_SK").alias("policy_sks"),
        F.sum("Address_SK").alias("address_sks"),
        F.sum("Transaction_SK").alias("transaction_sks"),
        F.sum("Premium_Amt").alias("premium"),
        F.count_if("Is_Late").alias("n_late"),
        F.sum("Late_Fee").alias("late_fees"),
    )


@query
def incremental_load(spark, sf):
    target = staging_path(spark, "incremental")
    load_as_they_come(spark, sf, target)
    return loaded_totals(spark, target)


@query
def load_versions(spark, sf):
    """Each published version of a three-batch load, read after all of them are there: the fact
    itself, and the sums that each batch adds."""
    target = staging_path(spark, "versions")
    load_as_they_come(spark, sf, target)
    warehouse, parts = wh.Warehouse(spark, target), []
    for number in warehouse.versions():
        version, then = F.lit(number).cast("long").alias("version"), warehouse.at(number)
        premium = F.sum("Premium_Amt").alias("premium")
        parts.append(then.gold("fact_transactions").agg(
            F.count("*").alias("n_rows"), F.max("Transaction_SK").alias("last_key"), premium
        ).select(version, F.lit("fact").alias("source"), "*"))
        parts.append(then.fact_totals().agg(F.sum("n_rows").alias("n_rows"), premium).select(
            version, F.lit("totals").alias("source"), "n_rows", F.lit(None).cast("long").alias("last_key"), "premium"
        ))
    return reduce(DataFrame.unionByName, parts)


@query
def stream_increment(spark, sf):
    source, target = write_batch_files(spark, sf), staging_path(spark, "stream")
    load_arrivals(spark, source, target, staging_path(spark, "stream-checkpoint"))
    return loaded_totals(spark, target)


@query
def incremental_policy_changes(spark, sf):
    target = staging_path(spark, "incremental")
    load_as_they_come(spark, sf, target)
    return wh.Warehouse(spark, target).gold("policy_changes")
