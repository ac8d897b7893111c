"""SQL side of the catalogue: the same answers in DuckDB SQL over the same tables.

Written from the semantics of each operator, without the reshaping the Spark plans use
for balance (pre-aggregation, merged lookups, inner-plus-anti joins). Column lists, code
tables and missing-value texts are written out here a second time, so that a wrong entry on
the Spark side turns a row red.
"""

from __future__ import annotations

from starloom.catalogue.inputs import RAW, STAR, sql

# Fixed values in the texts below: column names, codes and the issue texts of the rules.
ORACLE: dict[str, str] = {}

# The texts a CSV reader and the relational loader take as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
LOAD_NULL_TOKENS = ("", "nan", "NaT", "None")

# Columns and types of the cleaned extracts.
_MONEY = "decimal(15,2)"
KINDS: dict[str, dict[str, str]] = {
    "customers": {
        "Customer_ID": "bigint", "Customer_Title": "string", "Customer_First_Name": "string",
        "Customer_Last_Name": "string", "Customer_Segment": "string", "Marital_Status": "string",
        "Gender": "string", "DOB": "date", "Effective_Start_Dt": "date", "Effective_End_Dt": "date",
        "Region": "string",
    },
    "policies": {
        "Policy_Type_Id": "string", "Policy_Type": "string", "Policy_Type_Desc": "string",
        "Policy_Id": "bigint", "Policy_Name": "string", "Customer_ID": "bigint", "Premium_Amt": _MONEY,
        "Policy_Term": "string", "Policy_Start_Dt": "date", "Policy_End_Dt": "date",
        "Next_Premium_Dt": "date", "Actual_Premium_Paid_Dt": "date", "Total_Policy_Amt": _MONEY,
        "Premium_Amt_Paid_TillDate": _MONEY, "Region": "string",
    },
    "address": {
        "Customer_ID": "bigint", "Country": "string", "Region": "string", "State": "string",
        "City": "string", "Postal_Code": "string",
    },
    "transactions": {
        "Policy_Id": "bigint", "Customer_ID": "bigint", "Premium_Amt": _MONEY, "Total_Policy_Amt": _MONEY,
        "Premium_Amt_Paid_TillDate": _MONEY, "Next_Premium_Dt": "date", "Actual_Premium_Paid_Dt": "date",
        "Region": "string",
    },
}


def _list(texts) -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in texts)


def _ctes(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql(STAR[n])})" for n in names)


def _id(c: str) -> str:
    t = f"trim(CAST({c} AS VARCHAR))"
    n = f"try_cast({t} AS DECIMAL(38,18))"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+[.]?0*') THEN try_cast(split_part({t}, '.', 1) AS BIGINT) "
        f"WHEN regexp_matches({t}, '[eE]') AND {n} = floor({n}) THEN try_cast({n} AS BIGINT) END"
    )


def _exact(c: str) -> str:
    return f"CASE WHEN {_amount(c)} IS NOT NULL THEN try_cast({c} AS DECIMAL(38,18)) END"


def _amount(c: str) -> str:
    return f"try_cast({c} AS DECIMAL(15,2))"


def _date(c: str) -> str:
    return f"CAST(coalesce(try_strptime(trim({c}), '%Y-%m-%d'), try_strptime(trim({c}), '%m/%d/%Y')) AS DATE)"


def _canonical(c: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE lower(trim({c})) {whens} ELSE trim({c}) END"


def _title(c: str) -> str:
    runs = f"regexp_extract_all(trim({c}), '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def _fee(premium: str) -> str:
    """2 % of a two-digit amount, rounded half-even to two digits, in whole cents."""
    units = f"CAST({premium} * 100 AS BIGINT) * 2"
    half = f"(({units}) % 100 > 50 OR (({units}) % 100 = 50 AND (({units}) // 100) % 2 = 1))"
    return f"CAST((({units}) // 100 + CASE WHEN {half} THEN 1 ELSE 0 END) AS DOUBLE) / 100"


# ---- the raw tables, cleaned, validated, standardized -------------------------------


def _columns(table: str) -> list[str]:
    return list(KINDS[table])


def clean(table: str) -> str:
    cells = ", ".join(
        f"CASE WHEN {c} NOT IN ({_list(NULL_TOKENS)}) THEN {c} END AS {c}" for c in _columns(table)
    )
    return f"SELECT {cells}, line_no FROM ({sql(RAW[table])}) raw"


def _first(key: str, batch: str = "") -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {batch}{key} ORDER BY line_no) = 1"


def validated(table: str, batch: str = "") -> str:
    """``batch`` is an extra partition of the uniqueness rule (one file per batch)."""
    source = f"({clean(table)})"
    if table == "customers":
        return f"""
SELECT * REPLACE ({_id('Customer_ID')} AS Customer_ID, {_date('DOB')} AS DOB)
FROM (SELECT * FROM {source}
      WHERE Customer_ID IS NOT NULL AND Customer_First_Name IS NOT NULL
        AND Customer_Last_Name IS NOT NULL AND Region IS NOT NULL
      {_first('Customer_ID', batch)})
WHERE {_id('Customer_ID')} > 0 AND {_date('DOB')} IS NOT NULL"""
    if table == "policies":
        return f"""
SELECT * FROM (
  SELECT * REPLACE ({_date('Policy_Start_Dt')} AS Policy_Start_Dt, {_date('Policy_End_Dt')} AS Policy_End_Dt)
  FROM (SELECT * REPLACE ({_id('Policy_Id')} AS Policy_Id, {_id('Customer_ID')} AS Customer_ID,
                          {_exact('Premium_Amt')} AS Premium_Amt) FROM {source})
  WHERE Policy_Id IS NOT NULL AND Customer_ID IS NOT NULL AND Premium_Amt > 0
  {_first('Policy_Id', batch)})
WHERE NOT coalesce(Policy_End_Dt < Policy_Start_Dt, FALSE)"""
    if table == "address":
        return f"""
SELECT * FROM {source}
WHERE Customer_ID IS NOT NULL AND Region IS NOT NULL AND Country IS NOT NULL
{_first('Customer_ID', batch)}"""
    return f"""
SELECT * FROM (
  SELECT * REPLACE ({_id('Policy_Id')} AS Policy_Id, {_id('Customer_ID')} AS Customer_ID,
                    {_exact('Premium_Amt')} AS Premium_Amt, {_exact('Total_Policy_Amt')} AS Total_Policy_Amt,
                    {_date('Actual_Premium_Paid_Dt')} AS Actual_Premium_Paid_Dt)
  FROM {source})
WHERE Policy_Id IS NOT NULL AND Customer_ID IS NOT NULL AND Total_Policy_Amt IS NOT NULL
  AND Premium_Amt > 0"""


def _text_type(column: str, typed: tuple[str, ...]) -> bool:
    return column not in typed


# Aliases, matched on stripped lower case.
_REGIONS = {
    "east": "EAST", "e": "EAST", "ea": "EAST", "west": "WEST", "w": "WEST", "we": "WEST",
    "north": "NORTH", "n": "NORTH", "no": "NORTH", "south": "SOUTH", "s": "SOUTH", "so": "SOUTH",
}
_MARITAL_STATUSES = {
    "single": "Single", "s": "Single", "unmarried": "Single", "married": "Married", "m": "Married", "wed": "Married",
    "divorced": "Divorced", "d": "Divorced", "div": "Divorced", "widowed": "Widowed", "w": "Widowed", "widow": "Widowed",
}
_GENDERS = {"male": "Male", "m": "Male", "female": "Female", "f": "Female"}
_TERMS = {
    "monthly": "Monthly", "month": "Monthly", "mo": "Monthly", "quarterly": "Quarterly", "quarter": "Quarterly",
    "qtr": "Quarterly", "q": "Quarterly", "annual": "Annual", "annually": "Annual", "yearly": "Annual",
    "year": "Annual", "yr": "Annual",
}
_CODES = {
    "customers": {"Region": _REGIONS, "Marital_Status": _MARITAL_STATUSES, "Gender": _GENDERS},
    "policies": {"Region": _REGIONS, "Policy_Term": _TERMS},
    "address": {"Region": _REGIONS},
    "transactions": {"Region": _REGIONS},
}
_TITLES = {
    "customers": ("Customer_First_Name", "Customer_Last_Name"),
    "policies": (),
    "address": ("Country", "State", "City"),
    "transactions": (),
}


def standardized(table: str, source: str) -> str:
    """Typed canonical rows; ``source`` may hold typed and text columns alike."""
    cells = []
    for c, kind in KINDS[table].items():
        if c in _CODES[table]:
            cell = _canonical(c, _CODES[table][c])
        elif c in _TITLES[table]:
            cell = _title(c)
        elif kind == "date":
            cell = _date(_text(c))
        elif kind == "bigint":
            cell = _id(f"trim({_text(c)})")
        elif kind.startswith("decimal"):
            cell = _amount(f"trim({_text(c)})")
        else:
            cell = f"trim({c})"
        cells.append(f"{cell} AS {c}")
    return f"SELECT {', '.join(cells)}, line_no FROM ({source})"


def shown(table: str, source: str, extra: str = "") -> str:
    """Silver columns in presented types."""
    cells = []
    for c, kind in KINDS[table].items():
        if kind == "date":
            cells.append(f"{_text(c)} AS {c}")
        elif kind.startswith("decimal"):
            cells.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            cells.append(c)
    return f"SELECT {extra}{', '.join(cells)} FROM ({source})"


def silver(table: str, batch: str = "") -> str:
    return standardized(table, validated(table, batch))


# Columns that stay text after validation are compared as text.
_VALIDATED_TYPED = {
    "customers": {"DOB": "date"},
    "policies": {"Premium_Amt": "money", "Policy_Start_Dt": "date", "Policy_End_Dt": "date"},
    "address": {},
    "transactions": {"Premium_Amt": "money", "Total_Policy_Amt": "money", "Actual_Premium_Paid_Dt": "date"},
}

for _table in KINDS:
    _cells = []
    for _c in _columns(_table):
        _kind = _VALIDATED_TYPED[_table].get(_c)
        if _kind == "date":
            _cells.append(f"{_text(_c)} AS {_c}")
        elif _kind == "money":
            _cells.append(f"CAST({_c} AS DOUBLE) AS {_c}")
        else:
            _cells.append(_c)
    ORACLE["q_validate_" + _table] = f"SELECT {', '.join(_cells)} FROM ({validated(_table)})"
    if _table in ("policies", "transactions"):
        _dates = ("Policy_Start_Dt", "Policy_End_Dt") if _table == "policies" else ("Actual_Premium_Paid_Dt",)
        _needed = " AND ".join(f"{c} IS NOT NULL" for c in ("Region", *_dates))
        ORACLE["q_validate_strict_" + _table] = f"SELECT {', '.join(_cells)} FROM ({validated(_table)}) WHERE {_needed}"
    ORACLE["q_standardize_" + _table] = shown(_table, standardized(_table, clean(_table)))

# ---- rule counts, one step at a time ------------------------------------------------

_STEPS = f"""
WITH c0 AS ({clean('customers')}),
c1 AS (SELECT * FROM c0 WHERE Customer_ID IS NOT NULL),
c2 AS (SELECT * FROM c1 WHERE Customer_First_Name IS NOT NULL),
c3 AS (SELECT * FROM c2 WHERE Customer_Last_Name IS NOT NULL),
c4 AS (SELECT * FROM c3 WHERE Region IS NOT NULL),
c5 AS (SELECT * FROM c4 {_first('Customer_ID')}),
c6 AS (SELECT * FROM c5 WHERE {_id('Customer_ID')} > 0),
c7 AS (SELECT * FROM c6 WHERE {_date('DOB')} IS NOT NULL),
p0 AS (SELECT * REPLACE ({_id('Policy_Id')} AS Policy_Id, {_id('Customer_ID')} AS Customer_ID,
       {_exact('Premium_Amt')} AS Premium_Amt, {_date('Policy_Start_Dt')} AS Policy_Start_Dt,
       {_date('Policy_End_Dt')} AS Policy_End_Dt) FROM ({clean('policies')})),
p1 AS (SELECT * FROM p0 WHERE Policy_Id IS NOT NULL),
p2 AS (SELECT * FROM p1 WHERE Customer_ID IS NOT NULL),
p3 AS (SELECT * FROM p2 WHERE Premium_Amt IS NOT NULL),
p4 AS (SELECT * FROM p3 WHERE Premium_Amt > 0),
p5 AS (SELECT * FROM p4 {_first('Policy_Id')}),
p8 AS (SELECT * FROM p5 WHERE NOT coalesce(Policy_End_Dt < Policy_Start_Dt, FALSE)),
a0 AS ({clean('address')}),
a1 AS (SELECT * FROM a0 WHERE Customer_ID IS NOT NULL),
a2 AS (SELECT * FROM a1 WHERE Region IS NOT NULL),
a3 AS (SELECT * FROM a2 WHERE Country IS NOT NULL),
a4 AS (SELECT * FROM a3 {_first('Customer_ID')}),
t0 AS (SELECT * REPLACE ({_id('Policy_Id')} AS Policy_Id, {_id('Customer_ID')} AS Customer_ID,
       {_exact('Premium_Amt')} AS Premium_Amt, {_exact('Total_Policy_Amt')} AS Total_Policy_Amt)
       FROM ({clean('transactions')})),
t1 AS (SELECT * FROM t0 WHERE Policy_Id IS NOT NULL),
t2 AS (SELECT * FROM t1 WHERE Customer_ID IS NOT NULL),
t3 AS (SELECT * FROM t2 WHERE Premium_Amt IS NOT NULL),
t4 AS (SELECT * FROM t3 WHERE Total_Policy_Amt IS NOT NULL),
t5 AS (SELECT * FROM t4 WHERE Premium_Amt > 0)"""

# table, rule number, rule, column, step before, step after, message
_RULES = [
    ("customers", 1, "not_null", "Customer_ID", "c0", "c1", "Customer_ID: {} null values found → dropped"),
    ("customers", 2, "not_null", "Customer_First_Name", "c1", "c2", "Customer_First_Name: {} null values found → dropped"),
    ("customers", 3, "not_null", "Customer_Last_Name", "c2", "c3", "Customer_Last_Name: {} null values found → dropped"),
    ("customers", 4, "not_null", "Region", "c3", "c4", "Region: {} null values found → dropped"),
    ("customers", 5, "unique", "Customer_ID", "c4", "c5", "Customer_ID duplicates: {} removed"),
    ("customers", 6, "positive_id", "Customer_ID", "c5", "c6", "Invalid Customer_ID: {} rows dropped"),
    ("customers", 7, "valid_date", "DOB", "c6", "c7", "DOB unparseable: {} rows dropped"),
    ("policies", 1, "numeric", "Policy_Id", "p0", "p1", "Policy_Id: {} non-numeric/null → dropped"),
    ("policies", 2, "numeric", "Customer_ID", "p1", "p2", "Customer_ID: {} non-numeric/null → dropped"),
    ("policies", 3, "numeric", "Premium_Amt", "p2", "p3", "Premium_Amt: {} non-numeric/null → dropped"),
    ("policies", 4, "positive", "Premium_Amt", "p3", "p4", "Premium_Amt ≤ 0: {} rows removed"),
    ("policies", 5, "unique", "Policy_Id", "p4", "p5", "Policy_Id duplicates: {} removed"),
    ("policies", 8, "not_before", "Policy_End_Dt", "p5", "p8", "End before start: {} rows removed"),
    ("address", 1, "not_null", "Customer_ID", "a0", "a1", "Customer_ID: {} nulls → dropped"),
    ("address", 2, "not_null", "Region", "a1", "a2", "Region: {} nulls → dropped"),
    ("address", 3, "not_null", "Country", "a2", "a3", "Country: {} nulls → dropped"),
    ("address", 4, "unique", "Customer_ID", "a3", "a4", "Customer_ID address duplicates: {} removed"),
    ("transactions", 1, "numeric", "Policy_Id", "t0", "t1", "Policy_Id: {} nulls/non-numeric → dropped"),
    ("transactions", 2, "numeric", "Customer_ID", "t1", "t2", "Customer_ID: {} nulls/non-numeric → dropped"),
    ("transactions", 3, "numeric", "Premium_Amt", "t2", "t3", "Premium_Amt: {} nulls/non-numeric → dropped"),
    ("transactions", 4, "numeric", "Total_Policy_Amt", "t3", "t4", "Total_Policy_Amt: {} nulls/non-numeric → dropped"),
    ("transactions", 5, "positive", "Premium_Amt", "t4", "t5", "Premium_Amt ≤ 0: {} rows removed"),
]


def _counted() -> str:
    rows = [
        f"SELECT '{t}' AS \"table\", {n} AS rule_no, '{rule}' AS rule, '{c}' AS \"column\", "
        f"CAST((SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b}) AS BIGINT) AS n_rows, "
        f"'{m.split('{}')[0]}' AS head, '{m.split('{}')[1]}' AS tail"
        for t, n, rule, c, a, b, m in _RULES
    ]
    return f"{_STEPS}, counted AS ({' UNION ALL '.join(rows)})"


ORACLE["q_rule_counts"] = f"""{_counted()}
SELECT "table", CAST(rule_no AS BIGINT) AS rule_no, rule, "column", n_rows FROM counted"""

ORACLE["q_rejected_rows"] = _STEPS + " UNION ALL ".join(
    f"""
SELECT '{t}' AS "table", CAST({n} AS BIGINT) AS rule_no, '{rule}' AS rule, '{c}' AS "column", line_no, Region AS region
FROM (SELECT line_no, Region FROM {a} EXCEPT ALL SELECT line_no, Region FROM {b})"""
    for t, n, rule, c, a, b, _ in _RULES
)

_SIZES = {"customers": ("c0", "c7"), "policies": ("p0", "p8"), "address": ("a0", "a4"), "transactions": ("t0", "t5")}

_REPORT = f"""{_counted()},
sizes AS ({' UNION ALL '.join(
    f"SELECT '{t}' AS tab, (SELECT count(*) FROM {a}) AS rows_in, (SELECT count(*) FROM {b}) AS rows_out"
    for t, (a, b) in _SIZES.items())}),
found AS (
  SELECT "table" AS tab, head || CAST(n_rows AS VARCHAR) || tail AS issue, rule_no,
         row_number() OVER (PARTITION BY "table" ORDER BY rule_no) AS pos
  FROM counted WHERE n_rows > 0)"""

ORACLE["q_validation_report"] = f"""{_REPORT}
SELECT s.tab AS "table",
       CASE WHEN count(f.issue) = 0 THEN 'passed' ELSE 'issues' END AS status,
       s.rows_in, s.rows_out,
       coalesce(string_agg(f.issue, '; ' ORDER BY f.pos) FILTER (WHERE f.pos <= 2), 'All checks passed.') AS first_issues
FROM sizes s LEFT JOIN found f ON f.tab = s.tab
GROUP BY s.tab, s.rows_in, s.rows_out"""

ORACLE["q_report_json"] = f"""{_REPORT},
entries AS (
  SELECT s.tab, '{{"table":"' || s.tab || '","issues":['
         || coalesce(string_agg('"' || f.issue || '"', ',' ORDER BY f.pos), '"All checks passed."')
         || '],"rows_in":' || CAST(s.rows_in AS VARCHAR) || ',"rows_out":' || CAST(s.rows_out AS VARCHAR) || '}}' AS entry
  FROM sizes s LEFT JOIN found f ON f.tab = s.tab GROUP BY s.tab, s.rows_in, s.rows_out)
SELECT CAST(0 AS BIGINT) AS batch_id, '[' || string_agg(entry, ',' ORDER BY tab) || ']' AS report FROM entries"""

ORACLE["q_required_columns"] = f"""{_STEPS}
SELECT 'customers' AS "table", (SELECT count(*) FROM c0) AS rows_in, (SELECT count(*) FROM c6) AS rows_out,
       'Missing columns: [''Gender'', ''DOB'']' AS first_issue"""

# ---- business questions -------------------------------------------------------------

_NAMES = "names AS (SELECT Customer_ID, arg_min(Customer_Name, Customer_SK) AS Customer_Name FROM dim_customer GROUP BY Customer_ID)"

ORACLE["q_total_by_customer"] = f"""{_ctes('payments', 'dim_customer')}, {_NAMES}
SELECT Customer_ID, Customer_Name, 'All' AS Region, CAST(sum(Total_Policy_Amt) AS DOUBLE) AS Total_Policy_Amt
FROM payments JOIN names USING (Customer_ID) GROUP BY Customer_ID, Customer_Name"""

ORACLE["q_total_owner_of_type"] = f"""{_ctes('payments', 'dim_customer', 'dim_policy')}, {_NAMES}
SELECT Customer_ID, Customer_Name, 'All' AS Region, 'Auto' AS Policy_Type,
       CAST(sum(Total_Policy_Amt) AS DOUBLE) AS Total_Policy_Amt
FROM payments JOIN names USING (Customer_ID)
WHERE Customer_ID IN (SELECT Customer_ID FROM dim_policy WHERE Policy_Type = 'Auto')
GROUP BY Customer_ID, Customer_Name"""

ORACLE["q_total_region_term_year"] = f"""{_ctes('dim_customer', 'dim_policy')}, {_NAMES}
SELECT Customer_ID, Customer_Name, 'East and West' AS Region, Policy_Term,
       strftime(arg_min(Policy_Start_Dt, Policy_SK), '%m/%d/%Y') AS Policy_Start_Dt,
       CAST(sum(Total_Policy_Amt) AS DOUBLE) AS Total_Policy_Amt
FROM dim_policy JOIN names USING (Customer_ID)
WHERE Region IN ('EAST', 'WEST') AND Policy_Term = 'Quarterly' AND year(Policy_Start_Dt) = 1997
GROUP BY Customer_ID, Customer_Name, Policy_Term"""

_MARITAL = f"""
SELECT Customer_ID, Customer_Title, Customer_First_Name, Customer_Last_Name, Customer_Segment, Marital_Status,
       {_text('Effective_Start_Dt')} AS Start_Dt_Marital_Status, {_text('Effective_End_Dt')} AS End_Dt_Marital_Status
FROM dim_customer
WHERE Customer_ID IN (SELECT Customer_ID FROM dim_customer GROUP BY Customer_ID
                      HAVING count(DISTINCT Marital_Status) > 1)"""
ORACLE["q_marital_changes"] = _ctes("dim_customer") + _MARITAL
ORACLE["q_view_multi_status"] = _ctes("dim_customer") + _MARITAL

ORACLE["q_full_view"] = f"""{_ctes('dim_customer', 'dim_policy', 'dim_address')},
c AS (SELECT * FROM dim_customer QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY Customer_SK) = 1)
SELECT c.Customer_ID, c.Customer_Name, c.Customer_Segment, c.Marital_Status, c.Gender, c.Region,
       p.Policy_Id, p.Policy_Type_Id, p.Policy_Type, p.Policy_Type_Desc, p.Policy_Name, p.Policy_Term,
       {_text('p.Policy_Start_Dt')} AS Policy_Start_Dt, {_text('p.Policy_End_Dt')} AS Policy_End_Dt,
       CAST(p.Premium_Amt AS DOUBLE) AS Premium_Amt, CAST(p.Total_Policy_Amt AS DOUBLE) AS Total_Policy_Amt,
       p.Region AS Region_pol, a.Country, a.State, a.City, a.Postal_Code
FROM c LEFT JOIN dim_policy p ON p.Customer_ID = c.Customer_ID
LEFT JOIN dim_address a ON a.Customer_ID = c.Customer_ID"""

_CHANGES = f"""{_ctes('dim_customer', 'dim_policy', 'next_policies')}, {_NAMES},
changed AS (
  SELECT n.Customer_ID, names.Customer_Name, n.Policy_Id,
         n.Policy_Type_Id AS Current_Policy_Type_Id, n.Policy_Type AS Current_Policy_Type,
         n.Policy_Name AS Current_Policy_Name,
         p.Policy_Type_Id AS Previous_Policy_Type_Id, p.Policy_Type AS Previous_Policy_Type
  FROM next_policies n JOIN dim_policy p ON p.Policy_Id = n.Policy_Id
  LEFT JOIN names ON names.Customer_ID = n.Customer_ID
  WHERE n.Policy_Type_Id IS DISTINCT FROM p.Policy_Type_Id)"""
ORACLE["q_policy_changes"] = _CHANGES + " SELECT * FROM changed"
ORACLE["q_limit_ordered"] = _CHANGES + " SELECT * FROM changed ORDER BY Policy_Id LIMIT 20"

ORACLE["q_multi_status_history"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_returnflag FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1)"""

ORACLE["q_history_changes"] = """
WITH states AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1),
compared AS (
  SELECT *, lag(event_type) OVER w AS before_type, lag(day) OVER w AS before_day FROM states
  WINDOW w AS (PARTITION BY user_id ORDER BY day))
SELECT user_id, CAST(day AS VARCHAR) AS day, CAST(before_day AS VARCHAR) AS "Previous_day",
       event_type AS "Current_event_type", before_type AS "Previous_event_type"
FROM compared WHERE before_day IS NOT NULL AND event_type IS DISTINCT FROM before_type"""

# ---- SQL views ----------------------------------------------------------------------

_VIEW_NAME = "concat_ws(' ', c.Customer_Title, c.Customer_First_Name, c.Customer_Last_Name)"

ORACLE["q_view_policy_changes"] = f"""{_ctes('dim_customer', 'policy_versions')},
v AS (SELECT *, row_number() OVER () AS sk FROM policy_versions)
SELECT curr.Customer_ID, {_VIEW_NAME} AS Customer_Name, curr.Policy_Id,
       curr.Policy_Type_Id AS Current_Policy_Type_Id, curr.Policy_Type AS Current_Policy_Type,
       min(curr.Policy_Name) AS Current_Policy_Name, prev.Policy_Type_Id AS Previous_Policy_Type_Id,
       prev.Policy_Type AS Previous_Policy_Type, min(prev.Policy_Name) AS Previous_Policy_Name,
       count(*) AS version_pairs
FROM v curr JOIN v prev ON curr.Policy_Id = prev.Policy_Id AND curr.sk <> prev.sk
  AND curr.Policy_Type_Id <> prev.Policy_Type_Id
LEFT JOIN dim_customer c ON c.Customer_ID = curr.Customer_ID AND c.Effective_End_Dt IS NULL
GROUP BY ALL"""

ORACLE["q_view_total"] = f"""{_ctes('dim_customer', 'fact_transactions')}
SELECT c.Customer_ID, {_VIEW_NAME} AS Customer_Name, 'All' AS Region,
       CAST(sum(f.Total_Policy_Amt) AS DOUBLE) AS Total_Policy_Amt
FROM fact_transactions f JOIN dim_customer c ON f.Customer_SK = c.Customer_SK GROUP BY ALL"""

ORACLE["q_view_type_amount"] = f"""{_ctes('dim_customer', 'dim_policy', 'fact_transactions')}
SELECT c.Customer_ID, {_VIEW_NAME} AS Customer_Name, 'All' AS Region, 'Auto' AS Policy_Type,
       CAST(sum(f.Total_Policy_Amt) AS DOUBLE) AS Total_Policy_Amt
FROM fact_transactions f JOIN dim_customer c ON f.Customer_SK = c.Customer_SK
JOIN dim_policy p ON f.Policy_SK = p.Policy_SK
WHERE lower(p.Policy_Type) = 'auto' GROUP BY ALL"""

ORACLE["q_view_region_term_year"] = f"""{_ctes('dim_customer', 'dim_policy', 'fact_transactions')}
SELECT c.Customer_ID, {_VIEW_NAME} AS Customer_Name, 'East and West' AS Region, p.Policy_Term,
       {_text('p.Policy_Start_Dt')} AS Policy_Start_Dt, CAST(sum(f.Total_Policy_Amt) AS DOUBLE) AS Total_Policy_Amt
FROM fact_transactions f JOIN dim_customer c ON f.Customer_SK = c.Customer_SK
JOIN dim_policy p ON f.Policy_SK = p.Policy_SK
WHERE p.Region IN ('EAST', 'WEST') AND p.Policy_Term = 'Quarterly' AND year(p.Policy_Start_Dt) = 1997
GROUP BY ALL"""

ORACLE["q_view_full"] = f"""{_ctes('dim_customer', 'dim_policy', 'dim_address', 'fact_transactions')}
SELECT c.Customer_ID, c.Customer_Name, c.Customer_Segment, c.Marital_Status, c.Gender, c.Region,
       p.Policy_Id, p.Policy_Type_Id, p.Policy_Type, p.Policy_Type_Desc, p.Policy_Name, p.Policy_Term,
       {_text('p.Policy_Start_Dt')} AS Policy_Start_Dt, {_text('p.Policy_End_Dt')} AS Policy_End_Dt,
       CAST(p.Premium_Amt AS DOUBLE) AS Premium_Amt, CAST(p.Total_Policy_Amt AS DOUBLE) AS Total_Policy_Amt,
       a.Country, a.State, a.City, a.Postal_Code, CAST(f.Is_Late AS BIGINT) AS Is_Late,
       CAST(f.Late_Fee AS DOUBLE) AS Late_Fee
FROM dim_customer c LEFT JOIN fact_transactions f ON c.Customer_SK = f.Customer_SK
LEFT JOIN dim_policy p ON f.Policy_SK = p.Policy_SK
LEFT JOIN dim_address a ON f.Address_SK = a.Address_SK"""

# ---- derivations and the star schema ------------------------------------------------

_LATE = f"""late AS (
  SELECT t.Policy_Id, t.Customer_ID, t.Premium_Amt, t.Actual_Premium_Paid_Dt,
         coalesce(t.Actual_Premium_Paid_Dt > p.Next_Premium_Dt, FALSE) AS is_late
  FROM payments t LEFT JOIN dim_policy p ON p.Policy_Id = t.Policy_Id),
fees AS (SELECT *, CASE WHEN is_late THEN {_fee('Premium_Amt')} ELSE 0.0 END AS fee FROM late)"""

ORACLE["q_late_fee"] = f"""{_ctes('payments', 'dim_policy')}, {_LATE}
SELECT Policy_Id, Customer_ID, CAST(Premium_Amt AS DOUBLE) AS Premium_Amt,
       {_text('Actual_Premium_Paid_Dt')} AS Actual_Premium_Paid_Dt, CAST(is_late AS BIGINT) AS Is_Late,
       CAST(fee AS DOUBLE) AS Late_Fee FROM fees"""

ORACLE["q_late_summary"] = f"""{_CHANGES}, payments AS ({sql(STAR['payments'])}), {_LATE}
SELECT 'late_payments' AS measure, CAST(count(*) FILTER (WHERE is_late) AS DOUBLE) AS value FROM fees
UNION ALL SELECT 'late_fees', CAST(sum(CAST(fee AS DECIMAL(15,2))) AS DOUBLE) FROM fees
UNION ALL SELECT 'policy_changes', CAST(count(*) AS DOUBLE) FROM changed
UNION ALL SELECT 'customers_with_status_change', CAST(count(*) AS DOUBLE) FROM (
  SELECT Customer_ID FROM dim_customer GROUP BY Customer_ID HAVING count(DISTINCT Marital_Status) > 1)"""

ORACLE["q_installments"] = f"""
SELECT line_no AS o_orderkey, Policy_Term,
       CAST(CASE Policy_Term WHEN 'Monthly' THEN 12 WHEN 'Quarterly' THEN 4 ELSE 1 END AS BIGINT) AS Num_Installments
FROM ({standardized('policies', clean('policies'))})"""

_LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount")


def _dedup(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {_text('CAST(l_shipdate AS DATE)')} AS l_shipdate,
       l_partkey, l_suppkey, l_returnflag FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


ORACLE["q_dedup_first"] = _dedup("ASC")
ORACLE["q_dedup_last"] = _dedup("DESC")

_ORDERED = "ORDER BY o_custkey, o_orderdate, o_orderkey"
ORACLE["q_surrogate_keys"] = f"""
SELECT row_number() OVER ({_ORDERED}) AS order_sk, o_orderkey, o_custkey, o_orderstatus,
       {_text('CAST(o_orderdate AS DATE)')} AS o_orderdate FROM orders"""
ORACLE["q_surrogate_keys_increment"] = f"""
SELECT row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, o_custkey, o_orderdate, o_orderkey)
       AS order_sk, o_orderkey, o_custkey, o_orderstatus, {_text('CAST(o_orderdate AS DATE)')} AS o_orderdate FROM orders"""

_FULL_NAME = (
    "trim(coalesce(Customer_Title, '') || ' ' || coalesce(Customer_First_Name, '') || ' ' "
    "|| coalesce(Customer_Last_Name, ''))"
)
_INSTALLMENTS = (
    "CAST(CASE Policy_Term WHEN 'Monthly' THEN 12 WHEN 'Quarterly' THEN 4 ELSE 1 END AS BIGINT)"
)


def _last(keys: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY line_no DESC) = 1"


ORACLE["q_dim_customer"] = shown(
    "customers",
    f"SELECT * FROM ({silver('customers')}) {_last('Customer_ID, Effective_Start_Dt')}",
    "row_number() OVER (ORDER BY Customer_ID NULLS LAST, Effective_Start_Dt NULLS LAST) AS Customer_SK, "
    f"{_FULL_NAME} AS Customer_Name, ",
)
ORACLE["q_dim_policy"] = shown(
    "policies",
    f"SELECT * FROM ({silver('policies')}) {_last('Policy_Id')}",
    f"row_number() OVER (ORDER BY line_no) AS Policy_SK, {_INSTALLMENTS} AS Num_Installments, ",
)
ORACLE["q_dim_address"] = shown(
    "address",
    f"SELECT * FROM ({silver('address')}) {_last('Customer_ID')}",
    "row_number() OVER (ORDER BY line_no) AS Address_SK, ",
)

ORACLE["q_fact"] = f"""{_ctes('dim_customer', 'dim_policy', 'dim_address')},
t AS (SELECT *, row_number() OVER (ORDER BY {', '.join(c + ' NULLS LAST' for c in KINDS['transactions'])})
      AS Transaction_SK FROM ({silver('transactions')})),
c AS (SELECT Customer_ID, min(Customer_SK) AS Customer_SK FROM dim_customer GROUP BY Customer_ID),
a AS (SELECT Customer_ID, min(Address_SK) AS Address_SK FROM dim_address GROUP BY Customer_ID),
j AS (SELECT t.*, c.Customer_SK, p.Policy_SK, a.Address_SK,
             coalesce(t.Actual_Premium_Paid_Dt > p.Next_Premium_Dt, FALSE) AS late
      FROM t LEFT JOIN c ON c.Customer_ID = t.Customer_ID LEFT JOIN dim_policy p ON p.Policy_Id = t.Policy_Id
      LEFT JOIN a ON a.Customer_ID = t.Customer_ID)
{shown('transactions', 'SELECT * FROM j', 'Transaction_SK, Customer_SK, Policy_SK, Address_SK, CAST(late AS BIGINT) AS Is_Late, '
       f"CASE WHEN late THEN {_fee('Premium_Amt')} ELSE 0.0::DOUBLE END AS Late_Fee, ")}"""

# ---- constraints --------------------------------------------------------------------

ORACLE["q_pk_check"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1"""
ORACLE["q_fk_orphans"] = """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey"""
ORACLE["q_fk_set_null"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY') THEN l_partkey END AS l_partkey,
       CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN l_suppkey END AS l_suppkey
FROM lineitem"""
ORACLE["q_not_null_check"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ({clean('customers')})"
    for c in ("Customer_ID", "Customer_First_Name", "Customer_Title", "Region")
)

# ---- reading and coercion -----------------------------------------------------------

ORACLE["q_null_tokens"] = f"SELECT line_no, Customer_ID, Customer_Last_Name, Effective_End_Dt, Region FROM ({clean('customers')})"
ORACLE["q_load_values"] = "SELECT line_no, " + ", ".join(
    f"CASE WHEN trim({c}) NOT IN ({_list(LOAD_NULL_TOKENS)}) THEN {c} END AS {c}"
    for c in ("Customer_ID", "Actual_Premium_Paid_Dt", "Total_Policy_Amt")
) + f" FROM ({sql(RAW['transactions'])})"
ORACLE["q_numeric_coerce"] = f"""
SELECT line_no, {_id('Policy_Id')} AS policy_id, CAST({_amount('Premium_Amt')} AS DOUBLE) AS premium
FROM ({sql(RAW['policies'])})"""
ORACLE["q_date_coerce"] = f"""
SELECT line_no, {_text(_date('DOB'))} AS dob, {_text(_date('Effective_End_Dt'))} AS end_dt
FROM ({sql(RAW['customers'])})"""
ORACLE["q_unknown_values"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", trim({c}) AS value, count(*) AS n_rows FROM ({clean('customers')}) "
    f"WHERE lower(trim({c})) NOT IN ({_list(m)}) GROUP BY trim({c})"
    for c, m in _CODES["customers"].items()
)
ORACLE["q_unknown_report"] = f"""
SELECT * FROM ({ORACLE['q_unknown_values']})
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY value) <= 5"""
ORACLE["q_read_columns"] = f"SELECT Customer_ID, Region FROM ({clean('customers')})"
ORACLE["q_result_or_empty"] = """
SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderpriority FROM orders"""
ORACLE["q_load_text_dates"] = f"""
SELECT line_no AS Customer_SK, CASE WHEN line_no % 2 = 0 THEN 'FIRST' ELSE Region END AS Region,
       {', '.join(f"{_text(_date(c))} AS {c}" for c in ('DOB', 'Effective_Start_Dt', 'Effective_End_Dt'))}
FROM ({clean('customers')})"""
ORACLE["q_csv_source"] = f"SELECT * REPLACE (CAST(line_no AS VARCHAR) AS line_no) FROM ({clean('customers')})"

_KNOWN = _list(NULL_TOKENS)
ORACLE["q_csv_breaks"] = f"""
SELECT CAST(line_no AS VARCHAR) AS line_no, CASE WHEN Customer_ID NOT IN ({_KNOWN}) THEN Customer_ID END AS Customer_ID,
       Customer_Last_Name || chr(10) || '"x",' || chr(10) || ' y' AS Customer_Last_Name,
       CASE WHEN Region NOT IN ({_KNOWN}) THEN Region END AS Region
FROM ({sql(RAW['customers'])}) raw"""

# ---- combining and loading ----------------------------------------------------------

ORACLE["q_union_align"] = """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, CAST(s_nationkey AS BIGINT) FROM supplier"""

_SIDES = """
WITH e AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'),
i AS (SELECT l_orderkey AS o_orderkey, l_partkey AS o_custkey, l_returnflag AS o_orderstatus FROM lineitem)"""
ORACLE["q_insert_if_absent"] = _SIDES + """
SELECT * FROM e UNION ALL
(SELECT * FROM i WHERE o_orderkey NOT IN (SELECT o_orderkey FROM e)
 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey, o_orderstatus) = 1)"""
ORACLE["q_upsert_latest"] = _SIDES + """
SELECT * EXCLUDE (side) FROM (SELECT *, 0 AS side FROM e UNION ALL SELECT *, 1 FROM i)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY side DESC, o_custkey DESC, o_orderstatus DESC) = 1"""

ORACLE["q_load_warehouse"] = f"""{_ctes('dim_customer', 'dim_policy', 'dim_address', 'fact_transactions')}
SELECT 'dim_customer' AS "table", count(*) AS rows_in, count(*) AS inserted, CAST(0 AS BIGINT) AS ignored FROM dim_customer
UNION ALL SELECT 'dim_policy', count(*), count(*), 0 FROM dim_policy
UNION ALL SELECT 'dim_address', count(*), count(*), 0 FROM dim_address
UNION ALL SELECT 'fact_transactions', count(*), count(DISTINCT Transaction_SK), count(*) - count(DISTINCT Transaction_SK)
FROM fact_transactions"""

ORACLE["q_load_warehouse_rows"] = f"""{_ctes('dim_customer')}
SELECT Customer_SK, Customer_ID, Customer_Title, Customer_First_Name, Customer_Last_Name, Customer_Name, Customer_Segment,
       Marital_Status, Gender, {_text('DOB')} AS DOB, {_text('Effective_Start_Dt')} AS Effective_Start_Dt,
       {_text('Effective_End_Dt')} AS Effective_End_Dt, Region FROM dim_customer"""

_FIRST_COLUMNS = {
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber",
    "part": "p_partkey, p_name, p_brand, p_type",
    "supplier": "s_suppkey, s_name, s_nationkey, s_acctbal",
    "nation": "n_nationkey, n_name, n_regionkey",
    "region": "r_regionkey, r_name",
    "events": "event_id, ts, user_id, event_type",
}
ORACLE["q_inventory"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS n_rows, '{c}' AS columns FROM {t}" for t, c in _FIRST_COLUMNS.items()
)

# ---- overview -----------------------------------------------------------------------

ORACLE["q_kpis"] = f"""{_ctes('dim_customer', 'dim_policy', 'dim_address', 'fact_transactions')}
SELECT 'Total Customers' AS label, count(*) AS value FROM dim_customer
UNION ALL SELECT 'Total Policies', count(*) FROM dim_policy
UNION ALL SELECT 'Addresses', count(*) FROM dim_address
UNION ALL SELECT 'Transactions', count(*) FROM fact_transactions"""


def _frequency(table: str, column: str) -> str:
    return (
        f"{_ctes(table)} SELECT {column} AS value, count(*) AS n FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column}"
    )


ORACLE["q_breakdown_region"] = _frequency("dim_policy", "Region")
ORACLE["q_breakdown_type"] = _frequency("dim_policy", "Policy_Type")
ORACLE["q_breakdown_term"] = _frequency("dim_policy", "Policy_Term")
ORACLE["q_share_of_max"] = f"""
SELECT value, n, CAST(round(100.0 * n / max(n) OVER ()) AS BIGINT) AS pct
FROM ({_frequency('dim_customer', 'Region')})"""

ORACLE["q_keyword_search"] = f"""{_ctes('dim_customer')}
SELECT Customer_SK, Customer_Name, Region FROM dim_customer
WHERE {' OR '.join(f"contains(lower(CAST({c} AS VARCHAR)), 'machinery')" for c in (
    'Customer_SK', 'Customer_ID', 'Customer_Title', 'Customer_First_Name', 'Customer_Last_Name',
    'Customer_Name', 'Customer_Segment', 'Marital_Status', 'Gender', 'DOB', 'Effective_Start_Dt',
    'Effective_End_Dt', 'Region'))}"""

_PRICED = "SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) AS price FROM orders"
_PRICE_ORDER = "ORDER BY price DESC, o_orderkey"


def _page(page_no: int) -> str:
    return (
        "SELECT o_orderkey, o_custkey, CAST(price AS DOUBLE) AS price FROM "
        f"(SELECT * FROM ({_PRICED}) {_PRICE_ORDER} LIMIT 20 OFFSET {20 * page_no})"
    )


ORACLE["q_page"] = _page(3)
ORACLE["q_page_deep"] = _page(600)

ORACLE["q_top_n"] = f"""{_ctes('payments')}
SELECT Customer_ID, CAST(total AS DOUBLE) AS Total_Policy_Amt
FROM (SELECT Customer_ID, sum(Total_Policy_Amt) AS total FROM payments GROUP BY Customer_ID
      ORDER BY total DESC, Customer_ID LIMIT 10)"""

ORACLE["q_json_extract"] = f"""
SELECT '{{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_custkey":' || CAST(o_custkey AS VARCHAR)
       || ',"price":' || CAST(price AS VARCHAR) || '}}' AS record
FROM (SELECT * FROM ({_PRICED}) {_PRICE_ORDER} LIMIT 200)"""

ORACLE["q_display_format"] = f"""
SELECT line_no, format('{{:,}}', line_no * 1000) AS shown_number, coalesce(Policy_Term, '—') AS shown_term
FROM ({clean('policies')})"""

# ---- incremental load ---------------------------------------------------------------

# Transactions with their place in the files: by line number, then by their texts.
_TEXT_ORDER = ", ".join(f"raw.{c} NULLS FIRST" for c in ("line_no", *_columns("transactions")))
_PLACED = validated("transactions").replace(
    clean("transactions"),
    clean("transactions").replace(", line_no FROM", f", line_no, row_number() OVER (ORDER BY {_TEXT_ORDER}) AS place FROM"),
)

_LOADED = f"""
WITH dc AS (SELECT *, row_number() OVER (ORDER BY Customer_ID, Effective_Start_Dt NULLS LAST) AS Customer_SK
            FROM ({silver('customers')})),
da AS (SELECT *, row_number() OVER (ORDER BY line_no) AS Address_SK FROM ({silver('address')})),
dp AS (SELECT *, line_no % 3 AS batch, row_number() OVER (ORDER BY line_no % 3, line_no) AS Policy_SK
       FROM ({silver('policies', 'line_no % 3, ')})),
t AS (SELECT *, line_no % 3 AS batch, row_number() OVER () AS tx FROM ({silver('transactions')})),
o AS (SELECT Customer_ID, row_number() OVER (ORDER BY line_no % 3, place) AS Transaction_SK FROM ({_PLACED})),
k AS (SELECT Customer_ID, sum(Transaction_SK) AS sks FROM o GROUP BY Customer_ID),
p AS (SELECT t.tx, min(dp.Policy_SK) AS Policy_SK,
             list(dp.Next_Premium_Dt ORDER BY dp.Policy_SK DESC)[1] AS due
      FROM t JOIN dp ON dp.Policy_Id = t.Policy_Id AND dp.batch <= t.batch GROUP BY t.tx),
c AS (SELECT Customer_ID, min(Customer_SK) AS Customer_SK FROM dc GROUP BY Customer_ID),
a AS (SELECT Customer_ID, min(Address_SK) AS Address_SK FROM da GROUP BY Customer_ID),
f AS (SELECT t.*, c.Customer_SK, p.Policy_SK, a.Address_SK, coalesce(t.Actual_Premium_Paid_Dt > p.due, FALSE) AS late
      FROM t LEFT JOIN p ON p.tx = t.tx LEFT JOIN c ON c.Customer_ID = t.Customer_ID
      LEFT JOIN a ON a.Customer_ID = t.Customer_ID)
SELECT Customer_ID, count(*) AS n, min(Customer_SK) AS customer_sk, CAST(sum(Policy_SK) AS BIGINT) AS policy_sks,
       CAST(sum(Address_SK) AS BIGINT) AS address_sks,
       CAST((SELECT sks FROM k WHERE k.Customer_ID = f.Customer_ID) AS BIGINT) AS transaction_sks, CAST(sum(Premium_Amt) AS DOUBLE) AS premium,
       count(*) FILTER (WHERE late) AS n_late,
       CAST(sum(CAST(CASE WHEN late THEN {_fee('Premium_Amt')} ELSE 0 END AS DECIMAL(15,2))) AS DOUBLE) AS late_fees
FROM f GROUP BY Customer_ID"""
ORACLE["q_incremental_load"] = _LOADED
ORACLE["q_stream_increment"] = _LOADED
ORACLE["q_load_versions"] = f"""
WITH t AS ({silver('transactions')})
SELECT CAST(v.version AS BIGINT) AS version, s.source, count(*) AS n_rows,
       CASE s.source WHEN 'fact' THEN count(*) END AS last_key, CAST(sum(Premium_Amt) AS DOUBLE) AS premium
FROM t, (VALUES (1), (2), (3)) v(version), (VALUES ('fact'), ('totals')) s(source)
WHERE t.line_no % 3 < v.version GROUP BY v.version, s.source"""

ORACLE["q_incremental_policy_changes"] = f"""
WITH dp AS (SELECT *, line_no % 3 AS batch FROM ({silver('policies', 'line_no % 3, ')})),
v AS (SELECT *, lag(Policy_Type_Id) OVER w AS before_id, lag(Policy_Type) OVER w AS before_type,
             row_number() OVER w AS version
      FROM dp WINDOW w AS (PARTITION BY Policy_Id ORDER BY batch))
SELECT Policy_Id, Customer_ID, Policy_Name, Policy_Type_Id AS Current_Policy_Type_Id, Policy_Type AS Current_Policy_Type,
       before_id AS Previous_Policy_Type_Id, before_type AS Previous_Policy_Type, batch AS batch_id
FROM v WHERE version > 1 AND Policy_Type_Id IS DISTINCT FROM before_id"""

ORACLE["q_hash_sample"] = f"""{_ctes('dim_policy')}
SELECT Policy_Id, Policy_Type FROM dim_policy
WHERE ('0x' || substr(md5('0:' || coalesce(CAST(Policy_Id AS VARCHAR), '')), 1, 8))::BIGINT % 100 < 10"""

# The six questions by letter: how many rows each has, and a sum that notices other ones.
_SIX = {
    "b": "q_policy_changes", "c": "q_total_by_customer", "d": "q_total_owner_of_type",
    "e": "q_total_region_term_year", "f": "q_marital_changes", "g": "q_full_view",
}
ORACLE["q_run_all"] = " UNION ALL ".join(
    f"SELECT '{letter}' AS letter, count(*) AS n_rows, CAST(sum(Customer_ID) AS BIGINT) AS customer_ids "
    f"FROM ({ORACLE[name]}) {letter}" for letter, name in _SIX.items()
)
