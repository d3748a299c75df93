"""Integrity checks: the target tables' declared constraints as violation counts.

The original database enforced these on insert; Spark tables do not, so each
constraint becomes a query returning ``(check_name, table_name, column_name,
violations)``. Run them on tables cleaned with ``strict=False`` so unparseable
values show up as nulls instead of failing the job.

Cost model: per-row checks (not null, domain, length, range, participant text)
are ``count_if`` terms in a single pass per table. Primary keys group by the key
(partially aggregated, so a hot key collapses before the shuffle). Unique keys and
references that share a key column (Order_Id, Company_Id) are settled together:
one aggregate counts the rows of every table per value, so each such column
crosses one exchange, without a join, and a hot value costs one row a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalar import extract_names, quote_count
from larder.sources.schemas import (
    ID_MAX_LENGTH,
    MEAL_TYPES,
    PART_OF_DAY_DECLARED,
    PART_OF_DAY_LABELS,
    TEXT_MAX_LENGTH,
)

# ---------------------------------------------------------------------------
# Constraints declared by the target tables.
# ---------------------------------------------------------------------------
NOT_NULL = {
    "orders": ["Order_Id", "Company_Id"],
    "invoice": ["Order_Id", "Date", "Meal_Id", "Company_Id", "Date_of_Meal"],
}
PRIMARY_KEYS = {
    "orders": ["Order_Id", "Company_Id"],
    "invoice": ["Order_Id", "Date"],
}
UNIQUE_KEYS = {"invoice": ["Order_Id"]}
FOREIGN_KEYS = [
    ("invoice", "Order_Id", "orders", "Order_Id"),
    ("invoice", "Company_Id", "orders", "Company_Id"),
    ("salesteam", "Company_Id", "orders", "Company_Id"),
    ("customer_order", "Order_Id", "orders", "Order_Id"),
]
MAX_LENGTHS = {
    "orders": {"Order_Id": ID_MAX_LENGTH, "Company_Id": ID_MAX_LENGTH, "Company_Name": TEXT_MAX_LENGTH},
    "invoice": {
        "Order_Id": ID_MAX_LENGTH, "Meal_Id": ID_MAX_LENGTH, "Company_Id": ID_MAX_LENGTH,
        "Participants": TEXT_MAX_LENGTH,
    },
    "salesteam": {
        "Sales_Rep": TEXT_MAX_LENGTH, "Sales_Rep_Id": ID_MAX_LENGTH,
        "Company_Name": TEXT_MAX_LENGTH, "Company_Id": ID_MAX_LENGTH,
    },
    "customer_order": {
        "Order_Id": ID_MAX_LENGTH, "Participant_Name": TEXT_MAX_LENGTH, "Customer_Id": TEXT_MAX_LENGTH,
    },
}
SMALLINT_RANGE = (-32768, 32767)
TINYINT_RANGE = (-128, 127)
TINYINT_UNSIGNED_RANGE = (0, 255)
# raw text columns (CSV names) and the integer range their target column accepts
RAW_RANGES = {
    "invoices": {"Meal Price": SMALLINT_RANGE},
    "orderleads": {"Order Value": SMALLINT_RANGE, "Converted": TINYINT_UNSIGNED_RANGE},
}

SUMMARY_COLUMNS = ["check_name", "table_name", "column_name", "violations"]


def _summary(df: DataFrame, check_name: str, table_name: str, terms: dict) -> DataFrame:
    """One pass over ``df``: ``count_if`` per term, unpivoted to summary rows.

    ``terms`` maps a column name, or a ``(check_name, column_name)`` pair when
    one pass serves several checks, to its violation condition.
    """
    keys = [k if isinstance(k, tuple) else (check_name, k) for k in terms]
    conds = list(terms.values())
    agg = df.agg(*[F.count_if(c).alias(f"_t{i}") for i, c in enumerate(conds)])
    stacked = F.explode(
        F.array(*[F.struct(F.lit(chk).alias("check_name"), F.lit(col).alias("column_name"),
                           F.col(f"_t{i}").alias("violations"))
                  for i, (chk, col) in enumerate(keys)])
    ).alias("_r")
    return agg.select(stacked).select(
        F.col("_r.check_name"),
        F.lit(table_name).alias("table_name"),
        F.col("_r.column_name"),
        F.col("_r.violations").cast("long").alias("violations"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        _summary(tables[t], "not_null", t, {c: F.col(c).isNull() for c in cols})
        for t, cols in NOT_NULL.items()
    ])


#: Keys that settle constraints of several tables: the tables that hold each, parent first.
_SHARED_KEYS = {
    "Order_Id": ["orders", "invoice", "customer_order"],
    "Company_Id": ["orders", "invoice", "salesteam"],
}


def _key_counts(tables: dict[str, DataFrame], key: str, names: list[str]) -> DataFrame:
    """Rows of each table per value of ``key``: (_k, n_<table>...), one exchange for all tables.

    The tables are put below each other and counted by value, with a partial
    count before the exchange, so a hot value is one row a task.
    """
    tagged = _union([tables[t].select(F.col(key).alias("_k"), F.lit(i).alias("_t")) for i, t in enumerate(names)])
    return tagged.groupBy("_k").agg(*[F.count_if(F.col("_t") == i).alias(f"n_{t}") for i, t in enumerate(names)])


def _orphans(count: str, parent: str) -> Column:
    return F.col("_k").isNotNull() & (F.col(f"n_{count}") > 0) & (F.col(f"n_{parent}") == 0)


def _shared_key_rules(key: str) -> list[tuple[str, str, str, str, Column]]:
    """(check, table, column, table whose rows count, condition) of the rules that ``_key_counts`` of a key settles."""
    unique = [("unique", t, key, t, F.col(f"n_{t}") > 1) for t, cols in UNIQUE_KEYS.items() if cols == [key]]
    references = [
        ("foreign_key", child, f"{ck} -> {parent}.{pk}", child, _orphans(child, parent))
        for child, ck, parent, pk in FOREIGN_KEYS if ck == pk == key
    ]
    return unique + references


def _settled_by(key: str, checks: list[str]) -> list[tuple[str, str, str, str, Column]]:
    return [r for r in _shared_key_rules(key) if r[0] in checks]


def _shared_key_summary(tables: dict[str, DataFrame], checks: list[str]) -> DataFrame:
    """Violations of the rules of the given checks, from one count per shared key."""
    parts = []
    for key, names in _SHARED_KEYS.items():
        rules = _settled_by(key, checks)
        if not rules:
            continue
        used = [t for t in names if t in {r[3] for r in rules} or (t == names[0] and "foreign_key" in checks)]
        counts = _key_counts(tables, key, used)
        sums = counts.agg(*[
            F.coalesce(F.sum(F.when(cond, F.col(f"n_{t}"))), F.lit(0)).cast("long").alias(f"_r{i}")
            for i, (_, _, _, t, cond) in enumerate(rules)
        ])
        rows = F.array(*[
            F.struct(F.lit(chk).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(col).alias("column_name"), F.col(f"_r{i}").alias("violations"))
            for i, (chk, table, col, _, _) in enumerate(rules)
        ])
        parts.append(sums.select(F.inline(rows)))
    return _union(parts)


def _repeated_key_rows(df: DataFrame, keys: list[str], check_name: str, table_name: str) -> DataFrame:
    """Rows whose key value occurs more than once."""
    counts = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return counts.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("violations")).select(
        F.lit(check_name).alias("check_name"),
        F.lit(table_name).alias("table_name"),
        F.lit(",".join(keys)).alias("column_name"),
        "violations",
    )


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(_k, count) of non-null child keys missing from the parent; without an exchange where both are bucketed by the key."""
    child_keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).count()
    return child_keys.join(parent.select(F.col(parent_key).alias("_k")).distinct(), "_k", "left_anti")


def check_pk(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([_repeated_key_rows(tables[t], k, "primary_key", t) for t, k in PRIMARY_KEYS.items()])


def check_unique_order(tables: dict[str, DataFrame]) -> DataFrame:
    return _shared_key_summary(tables, ["unique"])


def check_fk(tables: dict[str, DataFrame]) -> DataFrame:
    return _shared_key_summary(tables, ["foreign_key"])


def _outside(c: str, allowed: list[str]) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*allowed)


def check_domain(
    tables: dict[str, DataFrame],
    meal_types: list[str] = MEAL_TYPES,
    part_labels: list[str] = PART_OF_DAY_LABELS,
    declared_labels: list[str] | None = PART_OF_DAY_DECLARED,
) -> DataFrame:
    """Value domains of the invoice enums. ``domain`` uses the labels the cleaning
    produces; ``domain_declared`` audits the narrower declared set (no Evening)."""
    terms = {
        ("domain", "Type_of_Meal"): _outside("Type_of_Meal", meal_types),
        ("domain", "Part_of_Day"): _outside("Part_of_Day", part_labels),
    }
    if declared_labels is not None:
        terms[("domain_declared", "Part_of_Day")] = _outside("Part_of_Day", declared_labels)
    return _summary(tables["invoice"], "domain", "invoice", terms)


def check_length(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        _summary(tables[t], "length", t, {c: F.length(c) > n for c, n in cols.items()})
        for t, cols in MAX_LENGTHS.items()
    ])


def _out_of_range(text: Column, lo: int, hi: int) -> Column:
    v = text.try_cast("bigint")
    return text.isNotNull() & (v.isNull() | (v < lo) | (v > hi))


def _listed_count() -> Column:
    """Participants by the quote count, of any size (not narrowed to the target type)."""
    return F.shiftright(quote_count("Participants"), 1)


def _too_many_participants() -> Column:
    lo, hi = TINYINT_RANGE
    return F.coalesce((_listed_count() < lo) | (_listed_count() > hi), F.lit(False))


def _count_differs() -> Column:
    return _listed_count() != F.size(extract_names("Participants"))


def check_range(raw: dict[str, DataFrame]) -> DataFrame:
    """Integer text that does not parse or does not fit the target integer type;
    includes the derived participant count (TINYINT)."""
    derived = {"invoices": {"Number_of_Participants": _too_many_participants()}}
    return _union([
        _summary(raw[t], "range", t, {
            **{c: _out_of_range(F.col(c), rlo, rhi) for c, (rlo, rhi) in cols.items()},
            **derived.get(t, {}),
        })
        for t, cols in RAW_RANGES.items()
    ])


def check_participants(tables: dict[str, DataFrame]) -> DataFrame:
    """Participant text quality: odd number of quotes; quote-based count differing
    from the number of extracted names."""
    inv = tables["invoice"]
    return _summary(inv, "participants", "invoice", {
        "odd_quotes": (quote_count("Participants") % 2) == 1,
        "count_vs_names": _count_differs(),
    })


# ---------------------------------------------------------------------------
# Row-level violations: which rows break which rule
# ---------------------------------------------------------------------------
ROW_KEYS = {
    "orders": ["Order_Id", "Company_Id"],
    "invoice": ["Order_Id"],
    "salesteam": ["Sales_Rep_Id"],
    "customer_order": ["Order_Id"],
    "invoices": ["Order Id"],
    "orderleads": ["Order Id", "Company Id"],
}
VIOLATION_COLUMNS = ["check_name", "table_name", "column_name", "row_key", "detail"]


def _row_key(table: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ROW_KEYS[table]])


def _failed_rules(df: DataFrame, table: str, rules: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """One narrow pass: each row carries the (check, column, detail) of every rule
    it breaks; rows breaking none are dropped before these are built, since building
    them evaluates every condition without generated code, and more than once."""
    failed = F.filter(
        F.array(*[
            F.when(cond, F.struct(F.lit(chk).alias("c"), F.lit(col).alias("k"), detail.cast("string").alias("d")))
            for chk, col, cond, detail in rules
        ]),
        lambda x: x.isNotNull(),
    )
    broken = reduce(Column.__or__, [cond for _, _, cond, _ in rules])
    return (
        df.filter(broken)
        .select(_row_key(table).alias("row_key"), failed.alias("_f"))
        .filter(F.size("_f") > 0)
        .select("row_key", F.explode("_f").alias("_v"))
        .select(
            F.col("_v.c").alias("check_name"),
            F.lit(table).alias("table_name"),
            F.col("_v.k").alias("column_name"),
            "row_key",
            F.col("_v.d").alias("detail"),
        )
    )


def violation_rows(tables: dict[str, DataFrame], raw: dict[str, DataFrame]) -> DataFrame:
    """Every violation as (check_name, table_name, column_name, row_key, detail).

    Per-row rules (not null, domain, declared domain, length, integer range,
    participant text) are evaluated in one pass per table. Repeated keys are
    reported once per key value (detail: number of rows), orphan references once
    per missing key value (detail: number of child rows); both come from
    aggregated keys, so a hot key is a single row.
    """
    parts = []
    per_table: dict[str, list] = {}
    for t, cols in NOT_NULL.items():
        per_table.setdefault(t, []).extend(
            ("not_null", c, F.col(c).isNull(), F.lit(None)) for c in cols)
    per_table.setdefault("invoice", []).extend([
        ("domain", "Type_of_Meal", _outside("Type_of_Meal", MEAL_TYPES), F.col("Type_of_Meal")),
        ("domain", "Part_of_Day", _outside("Part_of_Day", PART_OF_DAY_LABELS), F.col("Part_of_Day")),
        ("domain_declared", "Part_of_Day", _outside("Part_of_Day", PART_OF_DAY_DECLARED), F.col("Part_of_Day")),
        ("participants", "odd_quotes", (quote_count("Participants") % 2) == 1, quote_count("Participants")),
        ("participants", "count_vs_names", _count_differs(), F.size(extract_names("Participants"))),
    ])
    for t, cols in MAX_LENGTHS.items():
        per_table.setdefault(t, []).extend(
            ("length", c, F.length(c) > n, F.length(c)) for c, n in cols.items())
    for t, rules in per_table.items():
        parts.append(_failed_rules(tables[t], t, rules))
    for t, cols in RAW_RANGES.items():
        rules = [("range", c, _out_of_range(F.col(c), lo, hi), F.col(c)) for c, (lo, hi) in cols.items()]
        if t == "invoices":
            rules.append(("range", "Number_of_Participants", _too_many_participants(), _listed_count()))
        parts.append(_failed_rules(raw[t], t, rules))
    for t, keys in PRIMARY_KEYS.items():
        dup = tables[t].groupBy(*keys).count().filter(F.col("count") > 1)
        parts.append(dup.select(
            F.lit("primary_key").alias("check_name"), F.lit(t).alias("table_name"),
            F.lit(",".join(keys)).alias("column_name"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("row_key"),
            F.col("count").cast("string").alias("detail"),
        ))
    for key, names in _SHARED_KEYS.items():
        rules = _shared_key_rules(key)
        broken = F.filter(F.array(*[
            F.when(cond, F.struct(F.lit(chk).alias("check_name"), F.lit(table).alias("table_name"),
                                  F.lit(col).alias("column_name"), F.col(f"n_{t}").cast("string").alias("detail")))
            for chk, table, col, t, cond in rules
        ]), lambda x: x.isNotNull())
        found = _key_counts(tables, key, names).select(F.coalesce(F.col("_k").cast("string"), F.lit("")).alias("row_key"), F.inline(broken))
        parts.append(found.select(*VIOLATION_COLUMNS))
    return _union(parts)
