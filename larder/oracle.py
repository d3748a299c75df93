"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL rebuilds the same derived domain from the test tables and states each
view the way the original job states it (row-level fan-out joins, windows over
aggregates), with the same determinism rules: smallest value for columns that
are neither grouped nor aggregated, half-up integer rounding for averages and
percentages. Types are cast to the widths the Spark side returns.
"""

from __future__ import annotations


def _avg(total: str, count: str, digits: int = 4, factor: int = 1) -> str:
    twice_k = 2 * factor * 10 ** digits
    n = f"nullif({count}, 0)"
    return f"(CAST(sign({total}) * ((abs({total}) * {twice_k} + {n}) // (2 * {n})) AS DOUBLE) / {10 ** digits}.0)"


PRELUDE = r"""
WITH
part_names AS (
    SELECT l.l_orderkey AS ok, list_sort(list(p.p_name)) AS names
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY l.l_orderkey
),
raw_invoices AS (
    SELECT o.o_orderkey AS row_order,
        CAST(o.o_orderkey AS VARCHAR) AS Order_Id,
        strftime(o.o_orderdate, '%d-%m-%Y') AS "Date",
        'M' || CAST(o.o_orderkey AS VARCHAR) AS Meal_Id,
        CAST(c.c_nationkey AS VARCHAR) AS Company_Id,
        strftime(o.o_orderdate + to_days(CAST(o.o_orderkey % 11 - 5 AS INTEGER))
                 + to_hours(CAST(o.o_orderkey * 7 % 24 AS INTEGER))
                 + to_minutes(CAST(o.o_orderkey % 60 AS INTEGER)), '%Y-%m-%d %H:%M:%S') || '+02:00' AS Date_of_Meal,
        '[' || coalesce(array_to_string(list_transform(pn.names, lambda x: '''' || x || ''''), ' '), '') || ']' AS Participants,
        CAST(CAST(floor(o.o_totalprice / 100) AS SMALLINT) AS VARCHAR) AS Meal_Price,
        CASE o.o_orderkey % 3 WHEN 0 THEN 'Breakfast' WHEN 1 THEN 'Lunch' ELSE 'Dinner' END AS Type_of_Meal
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN part_names pn ON pn.ok = o.o_orderkey
),
raw_leads AS (
    SELECT o.o_orderkey AS row_order,
        CAST(o.o_orderkey AS VARCHAR) AS Order_Id,
        CAST(c.c_nationkey AS VARCHAR) AS Company_Id,
        n.n_name AS Company_Name,
        strftime(o.o_orderdate, '%Y-%m-%d') AS "Date",
        CAST(CAST(floor(o.o_totalprice / 50) AS SMALLINT) AS VARCHAR) AS Order_Value,
        CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN '1' ELSE '0' END AS Converted
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_salesteam AS (
    SELECT s.s_suppkey AS row_order, s.s_name AS Sales_Rep, CAST(s.s_suppkey AS VARCHAR) AS Sales_Rep_Id,
        n.n_name AS Company_Name, CAST(n.n_nationkey AS VARCHAR) AS Company_Id
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
invoice_ts AS (
    SELECT *, strptime(split_part(Date_of_Meal, '+', 1), '%Y-%m-%d %H:%M:%S') AS meal_ts
    FROM raw_invoices
),
invoice AS (
    SELECT row_order, Order_Id,
        CAST(strptime("Date", '%d-%m-%Y') AS DATE) AS "Date",
        Meal_Id, Company_Id,
        meal_ts AS Date_of_Meal,
        Participants,
        CAST(Meal_Price AS SMALLINT) AS Meal_Price,
        Type_of_Meal,
        CASE WHEN hour(meal_ts) BETWEEN 5 AND 8 THEN 'Early Morning'
             WHEN hour(meal_ts) BETWEEN 9 AND 12 THEN 'Late Morning'
             WHEN hour(meal_ts) BETWEEN 13 AND 15 THEN 'Early Afternoon'
             WHEN hour(meal_ts) BETWEEN 16 AND 19 THEN 'Evening'
             WHEN hour(meal_ts) BETWEEN 20 AND 23 THEN 'Night'
             ELSE 'Late Night' END AS Part_of_Day,
        CAST((length(Participants) - length(replace(Participants, '''', ''))) // 2 AS TINYINT) AS Number_of_Participants
    FROM invoice_ts
),
leads AS (
    SELECT row_order, Order_Id, Company_Id, Company_Name,
        CAST(strptime("Date", '%Y-%m-%d') AS DATE) AS "Date",
        CAST(Order_Value AS SMALLINT) AS Order_Value,
        CAST(Converted AS SMALLINT) AS Converted
    FROM raw_leads
),
salesteam AS (
    SELECT Sales_Rep, Sales_Rep_Id, Company_Name, Company_Id FROM raw_salesteam
),
invoice_names AS (
    SELECT row_order, Order_Id, regexp_extract_all(Participants, '''(.*?)''', 1) AS names FROM invoice
),
exploded AS (
    SELECT i.row_order, i.Order_Id,
        CASE WHEN len(i.names) > 0 THEN CAST(g.k - 1 AS INTEGER) END AS "Position",
        CASE WHEN len(i.names) > 0 THEN i.names[g.k] END AS Participant_Name
    FROM invoice_names i,
        LATERAL (SELECT unnest(generate_series(1, greatest(coalesce(len(i.names), 0), 1))) AS k) g
),
name_ids AS (
    SELECT Participant_Name, row_number() OVER (ORDER BY first_place) AS Customer_Id
    FROM (
        SELECT Participant_Name, min({'r': row_order, 'p': "Position"}) AS first_place
        FROM exploded WHERE Participant_Name IS NOT NULL GROUP BY Participant_Name
    )
),
customer_order AS (
    SELECT e.Order_Id, e.Participant_Name,
        CAST(coalesce(n.Customer_Id, 0) AS VARCHAR) AS Customer_Id,
        DATE '2024-01-01' AS Last_Updated
    FROM exploded e LEFT JOIN name_ids n ON e.Participant_Name = n.Participant_Name
)
"""

MEAL_ORDER_SQL = "CASE {c} WHEN 'Breakfast' THEN 1 WHEN 'Lunch' THEN 2 WHEN 'Dinner' THEN 3 ELSE 0 END"

_COMPANY_MONTH = f"""
    SELECT o.Company_Name AS company_name, CAST(year(i."Date") AS INTEGER) AS year,
        monthname(i."Date") AS month, month(i."Date") AS month_no, {{meal}} AS meal_typ_sale,
        CAST(SUM(i.Meal_Price) AS BIGINT) AS monthly_total,
        {_avg('SUM(i.Meal_Price)', 'COUNT(i.Meal_Price)')} AS monthly_average,
        COUNT(*) AS number_of_sales
    FROM leads o JOIN invoice i ON o.Order_Id = i.Order_Id
    GROUP BY {{group}}
"""

_COMPANY_WINDOWS = """
SELECT company_name, year, month, meal_typ_sale, monthly_total, monthly_average, number_of_sales,
    CAST(SUM(monthly_total) OVER (PARTITION BY company_name, year ORDER BY {order}
         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS year_to_date,
    CAST(SUM(monthly_total) OVER (PARTITION BY company_name, year) AS BIGINT) AS yearly_total
FROM ({inner})
"""

VIEWS: dict[str, str] = {
    "customer_stats": f"""
SELECT co.Participant_Name AS customer_name, COUNT(*) AS number_of_order,
    CAST(SUM(i.Meal_Price) AS BIGINT) AS total_spent,
    {_avg('SUM(i.Meal_Price)', 'COUNT(i.Meal_Price)')} AS average_spent
FROM customer_order co JOIN invoice i ON co.Order_Id = i.Order_Id
GROUP BY co.Participant_Name
""",
    "company_metrics": _COMPANY_WINDOWS.format(
        order="month_no",
        inner=_COMPANY_MONTH.format(meal="min(i.Type_of_Meal)", group="1, 2, 3, 4"),
    ),
    "company_metrics_by_meal": _COMPANY_WINDOWS.format(
        order=f"month_no, {MEAL_ORDER_SQL.format(c='meal_typ_sale')}, meal_typ_sale",
        inner=_COMPANY_MONTH.format(meal="i.Type_of_Meal", group="1, 2, 3, 4, 5"),
    ),
    "sales_rep_performance": """
SELECT s.Sales_Rep AS Sales_Rep,
    min({'a': s.Sales_Rep_Id, 'b': s.Company_Id}).a AS Sales_Rep_Id,
    s.Company_Name AS Company_Name,
    min({'a': s.Sales_Rep_Id, 'b': s.Company_Id}).b AS Company_Id,
    CAST(SUM(i.Meal_Price) AS BIGINT) AS Profit_by_Sales_Rep,
    MIN(i.Meal_Price) AS Min_Sale,
    MAX(i.Meal_Price) AS Max_Sale
FROM salesteam s
JOIN leads o ON s.Company_Id = o.Company_Id
JOIN invoice i ON o.Order_Id = i.Order_Id
GROUP BY s.Sales_Rep, s.Company_Name
""",
    "customer_purchases": f"""
SELECT c.Participant_Name AS Customer_Name, i.Type_of_Meal AS Meal_Type,
    min({{'p': i.Part_of_Day, 'c': s.Company_Name}}).p AS Part_of_Day,
    min({{'p': i.Part_of_Day, 'c': s.Company_Name}}).c AS Company_Name,
    COUNT(i.Order_Id) AS Number_of_Purchases,
    CAST(SUM(i.Meal_Price) AS BIGINT) AS Total_Spent,
    {_avg('SUM(i.Meal_Price)', 'COUNT(i.Meal_Price)')} AS Avg_Spent_per_Meal
FROM invoice i
JOIN customer_order c ON i.Order_Id = c.Order_Id
JOIN salesteam s ON s.Company_Id = i.Company_Id
GROUP BY 1, 2
""",
    "sales_by_year": """
SELECT CAST(year("Date") AS INTEGER) AS Year, COUNT(*) AS Total_Invoices
FROM invoice GROUP BY 1
""",
    "percent_converted": f"""
SELECT Company_Name,
    COUNT(Converted) AS Converted_Total,
    CAST(SUM(CASE WHEN Converted = 1 THEN Converted ELSE 0 END) AS BIGINT) AS Converted_to_Order,
    CAST(COUNT(Converted) - SUM(CASE WHEN Converted = 1 THEN Converted ELSE 0 END) AS BIGINT) AS Not_Converted,
    {_avg('SUM(Converted)', 'COUNT(*)', digits=2, factor=100)} AS Percent_Converted
FROM leads GROUP BY Company_Name
""",
    "avg_meal_price": f"""
SELECT Type_of_Meal, {_avg('SUM(Meal_Price)', 'COUNT(Meal_Price)', digits=2)} AS Average_Meal_Price
FROM invoice GROUP BY Type_of_Meal
""",
    "total_sales": """
SELECT CAST(year("Date") AS INTEGER) AS Year, Type_of_Meal, CAST(SUM(Meal_Price) AS BIGINT) AS Total_Sales
FROM invoice GROUP BY 1, 2
""",
    "avg_participants": f"""
SELECT Type_of_Meal,
    {_avg('SUM(Number_of_Participants)', 'COUNT(Number_of_Participants)')} AS Average_Participants_Per_Meal
FROM invoice GROUP BY Type_of_Meal
""",
    "difference_days": """
SELECT "Date", Date_of_Meal, CAST(date_diff('day', CAST(Date_of_Meal AS DATE), "Date") AS INTEGER) AS Days_Between
FROM invoice
""",
}


def oracle_queries() -> dict[str, str]:
    out = {}
    for key, body in {**VIEWS, **EXTRA}.items():
        out[key] = PRELUDE + body
    return out


EXTRA: dict[str, str] = {}


# ---------------------------------------------------------------------------
# operator-level keys
# ---------------------------------------------------------------------------
_RAW = {  # raw frame name -> (CTE, [(source column name, CTE column)])
    "invoices": ("raw_invoices", [
        ("Order Id", "Order_Id"), ("Date", '"Date"'), ("Meal Id", "Meal_Id"), ("Company Id", "Company_Id"),
        ("Date of Meal", "Date_of_Meal"), ("Participants", "Participants"), ("Meal Price", "Meal_Price"),
        ("Type of Meal", "Type_of_Meal"),
    ]),
    "orderleads": ("raw_leads", [
        ("Order Id", "Order_Id"), ("Company Id", "Company_Id"), ("Company Name", "Company_Name"),
        ("Date", '"Date"'), ("Order Value", "Order_Value"), ("Converted", "Converted"),
    ]),
    "salesteam": ("raw_salesteam", [
        ("Sales Rep", "Sales_Rep"), ("Sales Rep Id", "Sales_Rep_Id"), ("Company Name", "Company_Name"),
        ("Company Id", "Company_Id"),
    ]),
}
_CLEAN = {"orders": "leads", "invoice": "invoice", "salesteam": "salesteam", "customer_order": "customer_order"}


def _union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _profile_nulls() -> str:
    parts = []
    for table, (cte, cols) in _RAW.items():
        for name, col in cols:
            parts.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
                f"COUNT(*) FILTER (WHERE {col} IS NULL) AS missing FROM {cte}"
            )
    return _union_all(parts)


def _profile_duplicates() -> str:
    parts = []
    for table, (cte, cols) in _RAW.items():
        keys = ", ".join(c for _, c in cols)
        parts.append(
            f"SELECT '{table}' AS table_name, CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS duplicates "
            f"FROM (SELECT COUNT(*) AS n FROM {cte} GROUP BY {keys})"
        )
    return _union_all(parts)


def _profile_types() -> str:
    parts = []
    for table, (cte, cols) in _RAW.items():
        for name, c in cols:
            filled = f"{c} IS NOT NULL"
            whole = f"regexp_full_match({c}, '[+-]?[0-9]{{1,18}}')"
            number = f"({whole} OR regexp_full_match({c}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'))"
            date = (f"(try_strptime({c}, '%Y-%m-%d') IS NOT NULL AND regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
                    f"OR try_strptime({c}, '%d-%m-%Y') IS NOT NULL AND regexp_full_match({c}, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}'))")
            moment = (f"({date} OR try_strptime(replace({c}[1:19], 'T', ' '), '%Y-%m-%d %H:%M:%S') IS NOT NULL "
                      f"AND regexp_full_match({c}[20:], '([.][0-9]+)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?'))")
            every = lambda cond: f"bool_and({cond}) FILTER (WHERE {filled})"
            parts.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, CASE WHEN count({c}) = 0 THEN 'empty' WHEN {every(whole)} THEN 'integer' "
                f"WHEN {every(number)} THEN 'decimal' WHEN {every(date)} THEN 'date' WHEN {every(moment)} THEN 'timestamp' ELSE 'text' END AS column_type FROM {cte}"
            )
    return _union_all(parts)


# The candidate formats of the lead dates, in order of preference.
_DATE_FORMATS = {
    "yyyy-M-d": "%Y-%m-%d", "yyyy/M/d": "%Y/%m/%d", "yyyyMMdd": "%Y%m%d", "M/d/yyyy": "%m/%d/%Y", "M-d-yyyy": "%m-%d-%Y",
    "d/M/yyyy": "%d/%m/%Y", "d-M-yyyy": "%d-%m-%Y", "d.M.yyyy": "%d.%m.%Y",
}


def _date_votes() -> str:
    parts = [f"SELECT {k + 1} AS preference, '{name}' AS date_format, count(try_strptime(\"Date\", '{fmt}')) AS parsed, count(\"Date\") AS filled FROM raw_leads"
             for k, (name, fmt) in enumerate(_DATE_FORMATS.items())]
    return f"""
SELECT preference, date_format, parsed, filled, chosen, chosen AND fitting > 1 AND filled > 0 AS ambiguous
FROM (
    SELECT *, coalesce(preference = min(CASE WHEN parsed = filled THEN preference END) OVER (), false) AS chosen, count(*) FILTER (WHERE parsed = filled) OVER () AS fitting
    FROM ({_union_all(parts)})
)
"""


def _check_rows(check: str, table: str, terms: dict[str, str]) -> list[str]:
    cte = _CLEAN.get(table) or _RAW[table][0]
    return [
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
        f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {cte}"
        for col, cond in terms.items()
    ]


def _repeated(check: str, table: str, keys: list[str]) -> str:
    cols = ", ".join(f'"{k}"' for k in keys)
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{','.join(keys)}' AS column_name, "
        f"CAST(coalesce(SUM(n), 0) AS BIGINT) AS violations "
        f"FROM (SELECT COUNT(*) AS n FROM {_CLEAN[table]} GROUP BY {cols} HAVING COUNT(*) > 1)"
    )


# ---------------------------------------------------------------------------
# The constraints that the target tables declare, as the checks
# must find them (stated here on their own, so that a rule missing from the
# checks shows up as a difference).
# ---------------------------------------------------------------------------
_NOT_NULL = {
    "orders": ["Order_Id", "Company_Id"],
    "invoice": ["Order_Id", "Date", "Meal_Id", "Company_Id", "Date_of_Meal"],
}
_PRIMARY_KEYS = {"orders": ["Order_Id", "Company_Id"], "invoice": ["Order_Id", "Date"]}
_UNIQUE_KEYS = {"invoice": ["Order_Id"]}
_FOREIGN_KEYS = [
    ("invoice", "Order_Id", "orders", "Order_Id"),
    ("invoice", "Company_Id", "orders", "Company_Id"),
    ("salesteam", "Company_Id", "orders", "Company_Id"),
    ("customer_order", "Order_Id", "orders", "Order_Id"),
]
_MAX_LENGTHS = {
    "orders": {"Order_Id": 100, "Company_Id": 100, "Company_Name": 255},
    "invoice": {"Order_Id": 100, "Meal_Id": 100, "Company_Id": 100, "Participants": 255},
    "salesteam": {"Sales_Rep": 255, "Sales_Rep_Id": 100, "Company_Name": 255, "Company_Id": 100},
    "customer_order": {"Order_Id": 100, "Participant_Name": 255, "Customer_Id": 255},
}
_RANGES = {
    "invoices": {"Meal Price": (-32768, 32767)},
    "orderleads": {"Order Value": (-32768, 32767), "Converted": (0, 255)},
}
_ROW_KEYS = {
    "orders": ["Order_Id", "Company_Id"], "invoice": ["Order_Id"], "salesteam": ["Sales_Rep_Id"],
    "customer_order": ["Order_Id"], "invoices": ["Order Id"], "orderleads": ["Order Id", "Company Id"],
}
_MEALS = "'Breakfast', 'Lunch', 'Dinner'"
_PARTS = "'Early Morning', 'Late Morning', 'Early Afternoon', 'Evening', 'Night', 'Late Night'"
_PARTS_DECLARED = "'Early Morning', 'Late Morning', 'Early Afternoon', 'Night', 'Late Night'"


def _checks() -> dict[str, str]:
    not_null = []
    for t, cols in _NOT_NULL.items():
        not_null += _check_rows("not_null", t, {c: f'"{c}" IS NULL' for c in cols})
    fk = []
    for child, ck, parent, pk in _FOREIGN_KEYS:
        fk.append(
            f"SELECT 'foreign_key' AS check_name, '{child}' AS table_name, '{ck} -> {parent}.{pk}' AS column_name, "
            f"CAST(COUNT(*) AS BIGINT) AS violations FROM {_CLEAN[child]} c "
            f"WHERE c.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_CLEAN[parent]} p WHERE p.{pk} = c.{ck})"
        )
    domain = _check_rows("domain", "invoice", {
        "Type_of_Meal": f"Type_of_Meal IS NOT NULL AND Type_of_Meal NOT IN ({_MEALS})",
        "Part_of_Day": f"Part_of_Day IS NOT NULL AND Part_of_Day NOT IN ({_PARTS})",
    }) + _check_rows("domain_declared", "invoice", {
        "Part_of_Day": f"Part_of_Day IS NOT NULL AND Part_of_Day NOT IN ({_PARTS_DECLARED})",
    })
    length = []
    for t, cols in _MAX_LENGTHS.items():
        length += _check_rows("length", t, {c: f"length({c}) > {n}" for c, n in cols.items()})
    rng = []
    for t, cols in _RANGES.items():
        _, mapping = _RAW[t]
        col_of = dict(mapping)
        rng += _check_rows("range", t, {
            c: f"{col_of[c]} IS NOT NULL AND (TRY_CAST({col_of[c]} AS BIGINT) IS NULL "
               f"OR TRY_CAST({col_of[c]} AS BIGINT) < {lo} OR TRY_CAST({col_of[c]} AS BIGINT) > {hi})"
            for c, (lo, hi) in cols.items()
        })
    qc = "(length(Participants) - length(replace(Participants, '''', '')))"
    rng += _check_rows("range", "invoices", {
        "Number_of_Participants": f"Participants IS NOT NULL AND ({qc} // 2 > 127)",
    })
    parts = _check_rows("participants", "invoice", {
        "odd_quotes": f"{qc} % 2 = 1",
        "count_vs_names": f"{qc} // 2 <> len(regexp_extract_all(Participants, '''(.*?)''', 1))",
    })
    return {
        "check_not_null": _union_all(not_null),
        "check_pk": _union_all([_repeated("primary_key", t, k) for t, k in _PRIMARY_KEYS.items()]),
        "check_unique_order": _union_all([_repeated("unique", t, k) for t, k in _UNIQUE_KEYS.items()]),
        "check_fk": _union_all(fk),
        "check_domain": _union_all(domain),
        "check_length": _union_all(length),
        "check_range": _union_all(rng),
        "check_participants": _union_all(parts),
    }


def _violation_rows() -> str:
    def key(table):
        mapping = dict(_RAW[table][1]) if table in ("invoices", "orderleads") else {}
        cols = [mapping.get(c, c) for c in _ROW_KEYS[table]]
        return "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"

    def rule(check, table, column, cond, detail="NULL"):
        cte = _CLEAN.get(table) or _RAW[table][0]
        return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
                f"{key(table)} AS row_key, CAST({detail} AS VARCHAR) AS detail FROM {cte} WHERE {cond}")

    qc = "(length(Participants) - length(replace(Participants, '''', '')))"
    names = "len(regexp_extract_all(Participants, '''(.*?)''', 1))"
    parts = []
    for t, cols in _NOT_NULL.items():
        parts += [rule("not_null", t, c, f'"{c}" IS NULL') for c in cols]
    parts += [
        rule("domain", "invoice", "Type_of_Meal",
             f"Type_of_Meal IS NOT NULL AND Type_of_Meal NOT IN ({_MEALS})", "Type_of_Meal"),
        rule("domain", "invoice", "Part_of_Day",
             f"Part_of_Day IS NOT NULL AND Part_of_Day NOT IN ({_PARTS})", "Part_of_Day"),
        rule("domain_declared", "invoice", "Part_of_Day",
             f"Part_of_Day IS NOT NULL AND Part_of_Day NOT IN ({_PARTS_DECLARED})", "Part_of_Day"),
        rule("participants", "invoice", "odd_quotes", f"{qc} % 2 = 1", qc),
        rule("participants", "invoice", "count_vs_names", f"{qc} // 2 <> {names}", names),
    ]
    for t, cols in _MAX_LENGTHS.items():
        parts += [rule("length", t, c, f"length({c}) > {n}", f"length({c})") for c, n in cols.items()]
    for t, cols in _RANGES.items():
        col_of = dict(_RAW[t][1])
        for c, (lo, hi) in cols.items():
            v = col_of[c]
            parts.append(rule("range", t, c, f"{v} IS NOT NULL AND (TRY_CAST({v} AS BIGINT) IS NULL "
                                             f"OR TRY_CAST({v} AS BIGINT) < {lo} OR TRY_CAST({v} AS BIGINT) > {hi})", v))
    parts.append(rule("range", "invoices", "Number_of_Participants", f"{qc} // 2 > 127", f"{qc} // 2"))
    for check, keysets in (("primary_key", _PRIMARY_KEYS), ("unique", _UNIQUE_KEYS)):
        for t, keys in keysets.items():
            cols = ", ".join(f'"{k}"' for k in keys)
            row_key = "concat_ws('|', " + ", ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) + ")"
            parts.append(
                f"SELECT '{check}' AS check_name, '{t}' AS table_name, '{','.join(keys)}' AS column_name, "
                f"{row_key} AS row_key, CAST(COUNT(*) AS VARCHAR) AS detail "
                f"FROM {_CLEAN[t]} GROUP BY {cols} HAVING COUNT(*) > 1"
            )
    for child, ck, parent, pk in _FOREIGN_KEYS:
        parts.append(
            f"SELECT 'foreign_key' AS check_name, '{child}' AS table_name, '{ck} -> {parent}.{pk}' AS column_name, "
            f"CAST(c.{ck} AS VARCHAR) AS row_key, CAST(COUNT(*) AS VARCHAR) AS detail FROM {_CLEAN[child]} c "
            f"WHERE c.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_CLEAN[parent]} p WHERE p.{pk} = c.{ck}) "
            f"GROUP BY c.{ck}"
        )
    return _union_all(parts)


def _gate() -> str:
    """CTEs that decide every raw row: ``decided`` (table_name, row_order, row_key, reasons as a list)."""
    qc = "(length(Participants) - length(replace(Participants, '''', '')))"

    def listed(rules):
        return "list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules) + "], lambda x: x IS NOT NULL)"

    def common(table, source, dates):
        rules = [(f"format:{c}", f'"{c}" IS NOT NULL AND try_strptime({text}, \'{fmt}\') IS NULL') for c, (text, fmt) in dates.items()]
        rules += [(f"not_null:{c}", f'"{c}" IS NULL') for c in _NOT_NULL.get(table, [])]
        rules += [(f"length:{c}", f'length("{c}") > {n}') for c, n in _MAX_LENGTHS[table].items()]
        for c, (lo, hi) in _RANGES.get(source, {}).items():
            v = c.replace(" ", "_")
            rules.append((f"range:{v}", f"{v} IS NOT NULL AND (TRY_CAST({v} AS BIGINT) IS NULL OR TRY_CAST({v} AS BIGINT) NOT BETWEEN {lo} AND {hi})"))
        return rules

    leads = common("orders", "orderleads", {"Date": ('"Date"', "%Y-%m-%d")})
    invoices = common("invoice", "", {"Date": ('"Date"', "%d-%m-%Y"), "Date_of_Meal": ("split_part(Date_of_Meal, '+', 1)", "%Y-%m-%d %H:%M:%S")})
    invoices += [("domain:Type_of_Meal", f"Type_of_Meal IS NOT NULL AND Type_of_Meal NOT IN ({_MEALS})")]
    invoices += common("salesteam", "invoices", {})[len(_MAX_LENGTHS["salesteam"]):]
    invoices += [("range:Number_of_Participants", f"Participants IS NOT NULL AND {qc} // 2 > 127")]
    order_gone = "Order_Id IS NOT NULL AND Order_Id NOT IN (SELECT Order_Id FROM good_leads)"
    company_gone = "Company_Id IS NOT NULL AND Company_Id NOT IN (SELECT Company_Id FROM good_leads)"
    return f""",
flawed_leads AS (
    SELECT * REPLACE (
        CASE WHEN row_order % 10 = 0 THEN replace("Date", '-', '.') ELSE "Date" END AS "Date",
        CASE WHEN row_order % 17 = 0 THEN Order_Value || '000' ELSE Order_Value END AS Order_Value,
        CASE WHEN row_order % 41 <> 0 THEN Company_Id END AS Company_Id) FROM raw_leads
),
flawed_invoices AS (
    SELECT * REPLACE (
        CASE WHEN row_order % 29 = 0 THEN 'Brunch' ELSE Type_of_Meal END AS Type_of_Meal,
        CASE WHEN row_order % 31 <> 0 THEN Meal_Id END AS Meal_Id)
    FROM (SELECT * FROM raw_invoices UNION ALL SELECT * REPLACE (row_order + 1000000000000 AS row_order) FROM raw_invoices WHERE row_order % 13 = 0)
),
flawed_salesteam AS (SELECT * REPLACE (CASE WHEN row_order % 11 = 0 THEN 'none' ELSE Company_Id END AS Company_Id) FROM raw_salesteam),
leads_by_row AS (SELECT *, {listed(leads)} AS r FROM flawed_leads),
leads_firsts AS (SELECT min(row_order) AS row_order FROM leads_by_row WHERE len(r) = 0 GROUP BY Order_Id, Company_Id),
leads_decided AS (
    SELECT *, CASE WHEN len(r) = 0 AND row_order NOT IN (SELECT row_order FROM leads_firsts) THEN ['primary_key:Order_Id,Company_Id'] ELSE r END AS reasons FROM leads_by_row
),
good_leads AS (SELECT * FROM leads_decided WHERE len(reasons) = 0),
invoices_by_row AS (
    SELECT *, list_concat({listed(invoices)}, {listed([("foreign_key:Order_Id", order_gone), ("foreign_key:Company_Id", company_gone)])}) AS r FROM flawed_invoices
),
invoices_firsts AS (SELECT min(row_order) AS row_order FROM invoices_by_row WHERE len(r) = 0 GROUP BY Order_Id),
decided AS (
    SELECT 'orders' AS table_name, CAST(row_order AS BIGINT) AS row_order, concat_ws('|', Order_Id, Company_Id) AS row_key, reasons FROM leads_decided
    UNION ALL
    SELECT 'invoice', row_order, coalesce(Order_Id, ''),
        CASE WHEN len(r) = 0 AND row_order NOT IN (SELECT row_order FROM invoices_firsts) THEN ['unique:Order_Id'] ELSE r END FROM invoices_by_row
    UNION ALL
    SELECT 'salesteam', row_order, coalesce(Sales_Rep_Id, ''),
        list_concat({listed(common("salesteam", "", {}))}, {listed([("foreign_key:Company_Id", company_gone)])}) FROM flawed_salesteam
)
"""


_PERCENT = VIEWS["percent_converted"]
_DIFF = VIEWS["difference_days"]

EXTRA.update({
    "parse_invoice_date": 'SELECT Order_Id, "Date" FROM invoice',
    "parse_lead_date": 'SELECT Order_Id, "Date" FROM leads',
    "strip_offset": "SELECT Order_Id, split_part(Date_of_Meal, '+', 1) AS Date_of_Meal_Local FROM raw_invoices",
    "parse_meal_ts": "SELECT Order_Id, Date_of_Meal FROM invoice",
    "meal_hour": "SELECT Order_Id, CAST(hour(Date_of_Meal) AS INTEGER) AS Meal_Hour FROM invoice",
    "part_of_day": "SELECT Order_Id, CAST(hour(Date_of_Meal) AS INTEGER) AS Meal_Hour, Part_of_Day FROM invoice",
    "participant_count": "SELECT Order_Id, Number_of_Participants FROM invoice",
    "extract_names": "SELECT Order_Id, CAST(len(names) AS INTEGER) AS Name_Count, "
                     "array_to_string(names, '|') AS Names FROM invoice_names",
    "explode_participants": 'SELECT Order_Id, "Position", Participant_Name FROM exploded',
    "customer_order": "SELECT Order_Id, Participant_Name, Customer_Id, Last_Updated FROM customer_order",
    "load_orders": 'SELECT Order_Id, Company_Id, Company_Name, "Date", Order_Value, Converted FROM leads',
    "load_invoice": 'SELECT Order_Id, "Date", Meal_Id, Company_Id, Date_of_Meal, Participants, Meal_Price, '
                    'Type_of_Meal, Part_of_Day, Number_of_Participants FROM invoice',
    "invoice_year_pruned": 'SELECT Order_Id, "Date", Meal_Id, Company_Id, Date_of_Meal, Participants, Meal_Price, '
                           'Type_of_Meal, Part_of_Day, Number_of_Participants, CAST(year("Date") AS INTEGER) AS Year '
                           'FROM invoice WHERE year("Date") = 1998',
    "load_salesteam": "SELECT Sales_Rep, Sales_Rep_Id, Company_Name, Company_Id FROM salesteam",
    "load_customer_order": "SELECT Order_Id, Participant_Name, Customer_Id, Last_Updated FROM customer_order",
    "top_converted": f"SELECT * FROM ({_PERCENT}) ORDER BY Percent_Converted DESC, Company_Name LIMIT 5",
    "avg_meal_price_ranked": f"SELECT * FROM ({VIEWS['avg_meal_price']}) ORDER BY Average_Meal_Price DESC",
    "preview_difference_days": f'SELECT * FROM ({_DIFF}) ORDER BY "Date", Date_of_Meal, Days_Between LIMIT 2',
    "profile_nulls": _profile_nulls(),
    "profile_duplicates": _profile_duplicates(),
    "profile_types": _profile_types(),
    "lead_date_votes": _date_votes(),
    "load_admitted": _gate() + "SELECT table_name, row_order, row_key FROM decided WHERE len(reasons) = 0",
    "load_rejected": _gate() + "SELECT table_name, row_order, row_key, array_to_string(reasons, ',') AS reasons FROM decided WHERE len(reasons) > 0",
    **_checks(),
    "integrity_violations": _violation_rows(),
    "load_audit": _union_all(
        [f"SELECT 'extract' AS stage, '{t}' AS table_name, COUNT(*) AS row_count FROM {cte}"
         for t, (cte, _) in _RAW.items()]
        + [f"SELECT 'load' AS stage, '{t}' AS table_name, COUNT(*) AS row_count FROM {cte}"
           for t, cte in _CLEAN.items()]
    ),
})
