"""Ordered data-quality rules with a per-rule reject count.

A table's rules run in order and each count is taken on the survivors of the rules
before it. Row rules between two uniqueness rules are evaluated in one projection that
tags a row with the first rule it fails; a uniqueness rule then keeps the first
survivor per key. Counting needs one small aggregate per tagged stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions import dates, numbers, text
from starloom.operators.columns import missing_columns
from starloom.operators.joins import as_lookup
from starloom.operators.keys import keep_first

ALL_PASSED = "All checks passed."
REJECTED_BY = "rejected_by"  # 0 for a good row, else the number of the rule that drops it
RAW = "raw"  # a rejected row's columns as they came, as JSON
_FAILED = "_failed"


@dataclass(frozen=True)
class Rule:
    """``coerce`` rewrites the column, ``bad`` marks rows to drop, ``unique`` drops repeats."""

    name: str
    column: str
    message: str = ""
    coerce: Callable[[Column], Column] | None = None
    bad: Callable[[Column], Column] | None = None
    unique: bool = False
    needs: tuple[str, ...] = ()


def not_null(column: str, message: str) -> Rule:
    return Rule("not_null", column, message, bad=lambda c: c.isNull())


def numeric_id(column: str, message: str) -> Rule:
    return Rule("numeric", column, message, coerce=numbers.to_id, bad=lambda c: c.isNull())


def numeric_amount(column: str, message: str) -> Rule:
    return Rule("numeric", column, message, coerce=numbers.to_exact, bad=lambda c: c.isNull())


def positive_id(column: str, message: str) -> Rule:
    return Rule(
        "positive_id", column, message,
        coerce=numbers.to_id, bad=lambda c: c.isNull() | (c <= 0),
    )


def positive(column: str, message: str) -> Rule:
    return Rule("positive", column, message, bad=lambda c: c <= 0)


def unique(column: str, message: str) -> Rule:
    return Rule("unique", column, message, unique=True)


def valid_date(column: str, message: str) -> Rule:
    return Rule(
        "valid_date", column, message, coerce=dates.parse_date, bad=lambda c: c.isNull()
    )


def as_date(column: str) -> Rule:
    """Parse; an unusable text becomes NULL and the row stays."""
    return Rule("as_date", column, coerce=dates.parse_date)


def not_before(column: str, earlier: str, message: str) -> Rule:
    """Drop rows whose ``column`` lies before ``earlier``; a missing date does not fail."""
    return Rule(
        "not_before", column, message, bad=lambda c: c < F.col(earlier), needs=(earlier,)
    )


# The columns a raw table must have.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": (
        "Customer_ID", "Customer_First_Name", "Customer_Last_Name", "Customer_Segment",
        "Marital_Status", "Gender", "DOB", "Effective_Start_Dt", "Region",
    ),
    "policies": (
        "Policy_Id", "Customer_ID", "Policy_Type_Id", "Policy_Type", "Premium_Amt",
        "Policy_Term", "Policy_Start_Dt", "Total_Policy_Amt",
    ),
    "address": (),
    "transactions": (),
}


def rules_for(table: str, strict: bool = False) -> list[Rule]:
    """The rule list of a table. ``strict`` also drops rows with a missing region or an
    unusable policy or payment date, which the default keeps."""
    # The issue texts are fixed values: reports are read by their wording.
    if table == "customers":
        return [
            *[
                not_null(c, c + ": {n} null values found → dropped")
                for c in ("Customer_ID", "Customer_First_Name", "Customer_Last_Name", "Region")
            ],
            unique("Customer_ID", "Customer_ID duplicates: {n} removed"),
            positive_id("Customer_ID", "Invalid Customer_ID: {n} rows dropped"),
            valid_date("DOB", "DOB unparseable: {n} rows dropped"),
        ]
    if table == "policies":
        non_numeric = ": {n} non-numeric/null → dropped"
        rules = [
            numeric_id("Policy_Id", "Policy_Id" + non_numeric),
            numeric_id("Customer_ID", "Customer_ID" + non_numeric),
            numeric_amount("Premium_Amt", "Premium_Amt" + non_numeric),
            positive("Premium_Amt", "Premium_Amt ≤ 0: {n} rows removed"),
            unique("Policy_Id", "Policy_Id duplicates: {n} removed"),
        ]
        if strict:
            rules.append(not_null("Region", "Region: {n} nulls → dropped"))
        for c in ("Policy_Start_Dt", "Policy_End_Dt"):
            rules.append(valid_date(c, c + " unparseable: {n} rows dropped") if strict else as_date(c))
        end_first = "End before start: {n} rows removed"
        return [*rules, not_before("Policy_End_Dt", "Policy_Start_Dt", end_first)]
    if table == "address":
        return [
            *[not_null(c, c + ": {n} nulls → dropped") for c in ("Customer_ID", "Region", "Country")],
            unique("Customer_ID", "Customer_ID address duplicates: {n} removed"),
        ]
    if table == "transactions":
        non_numeric = ": {n} nulls/non-numeric → dropped"
        paid = "Actual_Premium_Paid_Dt"
        rules = [
            numeric_id("Policy_Id", "Policy_Id" + non_numeric),
            numeric_id("Customer_ID", "Customer_ID" + non_numeric),
            numeric_amount("Premium_Amt", "Premium_Amt" + non_numeric),
            numeric_amount("Total_Policy_Amt", "Total_Policy_Amt" + non_numeric),
            positive("Premium_Amt", "Premium_Amt ≤ 0: {n} rows removed"),
        ]
        if strict:
            rules.append(not_null("Region", "Region: {n} nulls → dropped"))
        rules.append(valid_date(paid, paid + " unparseable: {n} rows dropped") if strict else as_date(paid))
        return rules
    raise ValueError(f"no rules for table {table!r}")


def _steps(rules: Sequence[tuple[int, Rule]]) -> list[list[tuple[int, Rule]]]:
    """Cut a rule list where a column is rewritten after it was tested."""
    steps: list[list[tuple[int, Rule]]] = [[]]
    tested: set[str] = set()
    for number, rule in rules:
        if rule.coerce is not None and rule.column in tested:
            steps.append([])
            tested = set()
        steps[-1].append((number, rule))
        if rule.bad is not None:
            tested.update((rule.column, *rule.needs))
    return steps


def _evaluated_once(c: Column) -> Column:
    """``c`` in a form the optimizer will not copy into a filter below its projection.

    A filter on a computed column is pushed down by writing the whole computation into
    the filter, and the column is then computed a second time above it. Naming the
    partition makes the projection non-deterministic, which keeps the filter above.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def _tag(df: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """Add ``_failed``: the number of the first row rule a row fails, or NULL."""
    failed: list[Column] = []
    for step in _steps(rules):
        coerced = {r.column: r.coerce(F.col(r.column)) for _, r in step if r.coerce is not None}
        failed += [F.when(r.bad(F.col(r.column)), F.lit(n)) for n, r in step if r.bad is not None]
        if coerced:
            df = df.withColumns(coerced)
        if failed:
            df = df.withColumn(_FAILED, _evaluated_once(F.coalesce(*failed)))
            failed = [F.col(_FAILED)]
    return df if failed else df.withColumn(_FAILED, F.lit(None).cast("int"))


def _stages(
    df: DataFrame, rules: Sequence[tuple[int, Rule]], order_by: Sequence[str]
) -> list[DataFrame]:
    """Tagged frames, one before the first uniqueness rule and one after each."""
    chunks: list[list[tuple[int, Rule]]] = [[]]
    keys: list[str] = []
    for number, rule in rules:
        if rule.unique:
            keys.append(rule.column)
            chunks.append([])
        else:
            chunks[-1].append((number, rule))
    stages = [_tag(df, chunks[0])]
    for key, chunk in zip(keys, chunks[1:]):
        alive = stages[-1].where(F.col(_FAILED).isNull()).drop(_FAILED)
        stages.append(_tag(keep_first(alive, [key], order_by), chunk))
    return stages


def _report(table: str, absent: Sequence[str], rules: Sequence[tuple[int, Rule]], verdict: DataFrame) -> DataFrame:
    """One row: table, status, issues, rows_in, rows_out."""
    found = [text.sql_text(f"Missing columns: {list(absent)}")] if absent else []
    for number, rule in rules:
        if rule.message:
            head, tail = map(text.sql_text, rule.message.split("{n}"))
            found.append(f"CASE WHEN rule_{number} > 0 THEN concat({head}, rule_{number}, {tail}) END")
    issues = F.expr(f"array_compact(CAST(array({', '.join(found)}) AS array<string>))")
    passed = F.size(issues) == 0
    return verdict.select(
        F.lit(table).alias("table"),
        F.when(passed, "passed").otherwise("issues").alias("status"),
        F.when(passed, F.array(F.lit(ALL_PASSED))).otherwise(issues).alias("issues"),
        "rows_in",
        "rows_out",
    )


def _counts(table: str, rules: Sequence[tuple[int, Rule]], verdict: DataFrame) -> DataFrame:
    """One row per dropping rule: table, rule_no, rule, column, n_rows."""
    entries = ", ".join(
        f"struct({number} AS rule_no, '{rule.name}' AS rule, '{rule.column}' AS column, rule_{number} AS n_rows)"
        for number, rule in rules
        if rule.unique or rule.bad is not None
    )
    return verdict.select(F.lit(table).alias("table"), F.expr(f"inline(array({entries}))"))


def _verdict(rules: Sequence[tuple[int, Rule]], stages: Sequence[DataFrame]) -> DataFrame:
    """One row: rows in, rows out and the number of rows each rule dropped."""
    tallies = [
        stage.groupBy(_FAILED).agg(F.count("*").alias("n")).withColumn("stage", F.lit(i))
        for i, stage in enumerate(stages)
    ]
    tally = reduce(DataFrame.unionByName, tallies)

    def total(condition: str) -> str:
        return f"coalesce(sum(n) FILTER (WHERE {condition}), 0)"

    last, passed = len(stages) - 1, f"{_FAILED} IS NULL"
    repeats = iter(range(last))
    measures = {"rows_in": total("stage = 0"), "rows_out": total(f"stage = {last} AND {passed}")}
    for number, rule in rules:
        if rule.unique:
            i = next(repeats)
            n = f"{total(f'stage = {i} AND {passed}')} - {total(f'stage = {i + 1}')}"
        else:
            n = total(f"{_FAILED} = {number}")
        measures[f"rule_{number}"] = n
    return tally.agg(*[F.expr(n).alias(name) for name, n in measures.items()])


@dataclass(frozen=True)
class Checked:
    """The outcome of a table's rules; nothing runs until one of the frames is used."""

    table: str
    absent: tuple[str, ...]
    rules: tuple[tuple[int, Rule], ...]
    stages: tuple[DataFrame, ...]

    @property
    def rows(self) -> DataFrame:
        """The surviving rows, with the columns the rules coerced."""
        return self.stages[-1].where(F.col(_FAILED).isNull()).drop(_FAILED)

    @property
    def report(self) -> DataFrame:
        """One row: table, status, issues, rows_in, rows_out."""
        return _report(self.table, self.absent, self.rules, _verdict(self.rules, self.stages))

    @property
    def counts(self) -> DataFrame:
        """One row per dropping rule: table, rule_no, rule, column, n_rows."""
        return _counts(self.table, self.rules, _verdict(self.rules, self.stages))


def _chosen(
    df: DataFrame, table: str, rules: Iterable[Rule] | None, required: Sequence[str] | None
) -> tuple[list[str], list[tuple[int, Rule]]]:
    """Absent required columns, and the numbered rules whose columns are there."""
    absent = missing_columns(df, REQUIRED[table] if required is None else required)
    chosen = rules_for(table) if rules is None else rules
    numbered = [
        (i, rule)
        for i, rule in enumerate(chosen, start=1)
        if not missing_columns(df, (rule.column, *rule.needs))
    ]
    return absent, numbered


def validate(
    df: DataFrame,
    table: str,
    order_by: Sequence[str],
    rules: Iterable[Rule] | None = None,
    required: Sequence[str] | None = None,
) -> Checked:
    """Run a table's rules. ``order_by`` is the file order that decides which repeat stays.

    A rule on a column the input lacks is skipped; absent required columns are reported.
    """
    absent, numbered = _chosen(df, table, rules, required)
    stages = _stages(df, numbered, order_by)
    return Checked(table, tuple(absent), tuple(numbered), tuple(stages))


@dataclass(frozen=True)
class Tagged:
    """A table's rows, good and rejected, in one frame that can be written in one pass.

    ``rows`` has the columns the rules coerced, ``rejected_by`` and, for rejected rows, ``raw``. The
    report and the counts read the tag column of the written frame only.
    """

    table: str
    absent: tuple[str, ...]
    rules: tuple[tuple[int, Rule], ...]
    rows: DataFrame

    def _verdict(self, written: DataFrame) -> DataFrame:
        tally = written.groupBy(REJECTED_BY).agg(F.count("*").alias("n"))

        def total(condition: str) -> Column:
            return F.expr(f"coalesce(sum(n) FILTER (WHERE {condition}), 0)")

        return tally.agg(
            total("TRUE").alias("rows_in"), total(f"{REJECTED_BY} = 0").alias("rows_out"),
            *[total(f"{REJECTED_BY} = {i}").alias(f"rule_{i}") for i, _ in self.rules],
        )

    def report(self, written: DataFrame) -> DataFrame:
        """One row: table, status, issues, rows_in, rows_out."""
        return _report(self.table, self.absent, self.rules, self._verdict(written))

    def counts(self, written: DataFrame) -> DataFrame:
        """One row per dropping rule: table, rule_no, rule, column, n_rows."""
        return _counts(self.table, self.rules, self._verdict(written))

    def rejected(self, written: DataFrame) -> DataFrame:
        """The rejected rows with the rule that dropped them: table, rule_no, rule, column, raw."""
        names = ", ".join(f"struct({i} AS no, '{r.name}' AS rule, '{r.column}' AS column)" for i, r in self.rules)
        told = written.where(F.col(REJECTED_BY) > 0).withColumn(
            "_rule", F.expr(f"filter(array({names}), r -> r.no = {REJECTED_BY})[0]")
        )
        return told.select(
            F.lit(self.table).alias("table"), F.col(REJECTED_BY).alias("rule_no"), "_rule.rule", "_rule.column", RAW
        )


def _tag_repeats(df: DataFrame, number: int, key: str, order_by: Sequence[str]) -> DataFrame:
    """Mark all but the first of the rows without a mark that share a key. The firsts are found by a
    pre-aggregated minimum and joined back as a written lookup, so that a hot key can be split."""
    place = F.struct(*order_by)
    alive = df.where(F.col(_FAILED).isNull())
    first = as_lookup(alive.groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_first")), "first-of-key")
    joined = df.join(first, F.col(_FAILED).isNull() & F.col(key).eqNullSafe(F.col("_key")), "left")
    repeat = F.when(F.col("_first").isNotNull() & (place != F.col("_first")), F.lit(number))
    return joined.withColumn(_FAILED, F.coalesce(_FAILED, repeat)).drop("_key", "_first")


def quarantine(
    df: DataFrame,
    table: str,
    order_by: Sequence[str],
    rules: Iterable[Rule] | None = None,
    required: Sequence[str] | None = None,
) -> Tagged:
    """Run a table's rules and keep the rejected rows. The verdicts are those of :func:`validate`;
    ``order_by`` must be a total order. A table without a uniqueness rule is read once, by whatever
    writes the rows."""
    absent, numbered = _chosen(df, table, rules, required)
    given = [c for c in df.columns if c not in order_by or not isinstance(df.schema[c].dataType, T.StructType)]
    tagged = df.withColumn("_given", F.struct(*given)).withColumn(_FAILED, F.lit(None).cast("int"))
    chunk: list[tuple[int, Rule]] = []

    def flush(tagged: DataFrame) -> DataFrame:
        marked = _tag(tagged.withColumnRenamed(_FAILED, "_earlier"), chunk)
        return marked.withColumn(_FAILED, F.coalesce("_earlier", _FAILED)).drop("_earlier")

    for number, rule in numbered:
        if rule.unique:
            tagged = _tag_repeats(flush(tagged), number, rule.column, order_by)
            chunk = []
        else:
            chunk.append((number, rule))
    tagged = flush(tagged)
    raw = F.when(F.col(_FAILED).isNotNull(), F.to_json("_given"))
    rows = tagged.withColumn(RAW, raw).withColumn(REJECTED_BY, F.coalesce(_FAILED, F.lit(0)))
    return Tagged(table, tuple(absent), tuple(numbered), rows.drop("_given", _FAILED))


def quarantine_all(raw: Mapping[str, DataFrame], order_by: Sequence[str], strict: bool = False) -> dict[str, Tagged]:
    return {table: quarantine(df, table, order_by, rules_for(table, strict)) for table, df in raw.items()}


def validate_all(raw: Mapping[str, DataFrame], order_by: Sequence[str], strict: bool = False) -> dict[str, Checked]:
    return {
        table: validate(df, table, order_by, rules_for(table, strict))
        for table, df in raw.items()
    }


def combined_report(checked: Mapping[str, Checked]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.report for c in checked.values()])


def report_summary(report: DataFrame) -> DataFrame:
    """Status line per table with its first two issues."""
    return report.select(
        *[c for c in ("batch_id",) if c in report.columns],
        "table",
        "status",
        "rows_in",
        "rows_out",
        F.array_join(F.slice("issues", 1, 2), "; ").alias("first_issues"),
    )
