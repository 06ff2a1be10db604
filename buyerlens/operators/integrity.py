"""Key and value rules as distributed checks.

Spark enforces no constraints on files, so every rule becomes a count of the
rows that break it. Keys and references of all tables are checked in one pass: each table is
read once and gives one small row per key or reference (domain, key, role), and one aggregation
over (domain, key) tells which keys repeat and which references have no parent. It
combines inside map tasks, so a value held by many rows is one row per task.

Value rules are bits: one expression per table yields a mask of the rules a row breaks, from
which rows are counted, listed with the names of the rules, or set aside.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.sources.schemas import TABLES, ForeignKey, Table

BROKEN = "broken_rules"
MAX_RULES = 63


class IntegrityError(ValueError):
    """A table breaks one of its declared rules."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _all_set(columns: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys that are missing or held by several rows, with the number of rows."""
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.where((F.col("row_count") > 1) | ~_all_set(keys))


def orphan_keys(child: DataFrame, key: ForeignKey, parent: DataFrame) -> DataFrame:
    """Referenced values with no parent row, with the number of child rows. NULL references nothing."""
    used = (
        child.where(F.col(key.column).isNotNull())
        .groupBy(F.col(key.column).alias("missing_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    # A parent key that repeats would otherwise bring all its rows to one task.
    known = parent.select(F.col(key.parent_column).alias("missing_key")).distinct()
    return used.join(known, "missing_key", "left_anti")


class _Use(NamedTuple):
    """A use of a domain of keys: role 0 holds the keys, the others refer to them."""

    table: str
    columns: tuple[str, ...]
    domain: int
    role: int


def _uses(names: Iterable[str], keys: bool, references: bool) -> list[_Use]:
    """All uses to be looked at. Without ``keys`` only those keys are that something refers to."""
    names = [n for n in TABLES if n in set(names)]
    found: list[_Use] = []
    domains: dict[tuple[str, tuple[str, ...]], int] = {}
    roles: dict[int, int] = {}

    def own(table: str, columns: tuple[str, ...]) -> int:
        if (table, columns) not in domains:
            domains[table, columns] = len(domains)
            found.append(_Use(table, columns, domains[table, columns], 0))
        return domains[table, columns]

    for name in names if keys else ():
        own(name, TABLES[name].primary_key)
    for name in names if references else ():
        for key in TABLES[name].foreign_keys:
            if key.parent in names:
                domain = own(key.parent, (key.parent_column,))
                roles[domain] = roles.get(domain, 0) + 1
                found.append(_Use(name, (key.column,), domain, roles[domain]))
    return found


def _key_hashes(columns: tuple[str, ...]) -> tuple[str, str]:
    """A key as two 64-bit hashes of its text, the first NULL unless the key is complete.

    Keys of any type and number of columns then group as two whole numbers. Different
    keys would have to agree in 128 bits to be taken for one.
    """
    texts = ", ".join(f"CAST({c} AS STRING)" for c in columns)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"IF({complete}, XXHASH64({texts}), NULL)", f"XXHASH64(1L, {texts})"


def _used_keys(df: DataFrame, uses: list[_Use]) -> DataFrame:
    """(domain, role, key, key_2) of every row of a table, read once."""
    rows = [(str(u.domain), str(u.role), *_key_hashes(u.columns)) for u in uses]
    names = ("domain", "role", "key", "key_2")
    if len(rows) == 1:
        used = df.selectExpr(*(f"{value} AS {name}" for value, name in zip(rows[0], names)))
    else:
        used = df.selectExpr(f"STACK({len(rows)}, {', '.join(v for row in rows for v in row)}) AS ({', '.join(names)})")
    return used.where("role = 0 OR key IS NOT NULL")


def _key_facts(tables: Mapping[str, DataFrame], uses: list[_Use]) -> DataFrame:
    """Per domain: what is wrong with its keys, and per role the references without a parent."""
    used = _union([
        _used_keys(tables[name], [u for u in uses if u.table == name]) for name in dict.fromkeys(u.table for u in uses)
    ])
    roles = range(1, max(u.role for u in uses) + 1)
    held = used.groupBy("domain", "key", F.expr("IF(key IS NULL, 0L, key_2)").alias("key_2")).agg(
        F.expr("COUNT_IF(role = 0) AS held"), *(F.expr(f"COUNT_IF(role = {r}) AS used_{r}") for r in roles))
    return held.groupBy("domain").agg(
        F.expr("COUNT_IF(key IS NOT NULL AND held > 1) AS duplicate_keys"),
        F.expr("COALESCE(SUM(held - 1) FILTER (WHERE key IS NOT NULL AND held > 1), 0) AS surplus_rows"),
        F.expr("COALESCE(SUM(held) FILTER (WHERE key IS NULL), 0) AS null_key_rows"),
        *(F.expr(f"COUNT_IF(held = 0 AND used_{r} > 0) AS orphan_keys_{r}") for r in roles),
        *(F.expr(f"COALESCE(SUM(used_{r}) FILTER (WHERE held = 0), 0) AS orphan_rows_{r}") for r in roles),
    )


def _named(facts: DataFrame, uses: list[_Use]) -> DataFrame:
    """One row per use with its table and columns; a use without any row has counts of zero."""
    parents = {u.domain: u for u in uses if u.role == 0}
    rows = [(u.domain, u.role, u.table, ", ".join(u.columns), parents[u.domain].table) for u in uses]
    labels = facts.sparkSession.createDataFrame(
        rows, "domain int, role int, table_name string, columns string, parent_table string")
    roles = range(1, max(u.role for u in uses) + 1)

    def of_role(name: str) -> Column:
        picked = [F.when(F.col("role") == r, F.col(f"{name}_{r}")) for r in roles]
        return F.coalesce(*picked, F.lit(0).cast("bigint")).alias(name)

    own = [F.when(F.col("role") == 0, F.col(c)).alias(c) for c in ("duplicate_keys", "surplus_rows", "null_key_rows")]
    return F.broadcast(labels).join(facts, "domain", "left").select(
        "role", "table_name", "columns", "parent_table",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(n) for c, n in zip(own, ("duplicate_keys", "surplus_rows", "null_key_rows"))),
        of_role("orphan_keys"), of_role("orphan_rows"),
    )


def key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: keys held more than once, rows too many, rows without a full key."""
    uses = _uses(tables, keys=True, references=False)
    return _named(_key_facts(tables, uses), uses).select(
        "table_name", F.col("columns").alias("key_columns"), "duplicate_keys", "surplus_rows", "null_key_rows")


def orphan_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: distinct orphan values and the child rows that hold them."""
    uses = _uses(tables, keys=False, references=True)
    return _named(_key_facts(tables, uses), uses).where("role > 0").select(
        "table_name", F.col("columns").alias("column_name"), "parent_table", "orphan_keys", "orphan_rows")


def key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys and foreign keys of all tables in one pass: the rule in words, and the rows that break it."""
    uses = _uses(tables, keys=True, references=True)
    rule = F.when(F.col("role") == 0, F.concat(F.lit("key "), "columns")).otherwise(F.concat_ws(" -> ", "columns", "parent_table"))
    broken = F.when(F.col("role") == 0, F.col("surplus_rows") + F.col("null_key_rows")).otherwise(F.col("orphan_rows"))
    return _named(_key_facts(tables, uses), uses).select("table_name", rule.alias("rule"), broken.alias("violations"))


class Rule(NamedTuple):
    """A rule over the columns of one row; ``broken`` is a SQL predicate that is never NULL."""

    column: str
    name: str
    broken: str


def null_and_length_rules(table: Table) -> list[Rule]:
    """Required columns hold a value, limited ones are short enough; trailing spaces do not count."""
    missing = [Rule(c, "not null", f"{c} IS NULL") for c in table.required]
    return missing + [
        Rule(c, f"length <= {n}", f"COALESCE(LENGTH(RTRIM(CAST({c} AS STRING))) > {n}, FALSE)")
        for c, n in table.max_lengths.items()
    ]


def check_rules(table: Table) -> list[Rule]:
    """The declared value rules; NULL satisfies a rule."""
    return [Rule(name, rule, f"COALESCE(NOT ({rule}), FALSE)") for name, rule in table.checks.items()]


def row_rules(table: Table) -> list[Rule]:
    """All rules that one row can break by itself; at most ``MAX_RULES``."""
    rules = null_and_length_rules(table) + check_rules(table)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{table.name} declares {len(rules)} rules; a mask holds {MAX_RULES}")
    return rules


def broken_mask(rules: list[Rule]) -> str:
    """The rules that a row breaks, as bits of one number."""
    return " | ".join(["0L", *(f"IF({rule.broken}, {1 << k}L, 0L)" for k, rule in enumerate(rules))])


def rule_names(rules: list[Rule], mask: str = BROKEN) -> str:
    """The names of the rules in a mask, in their declared order."""
    names = ", ".join(f"IF(BIT_GET({mask}, {k}) = 1, '{f'{r.column}: {r.name}'}', NULL)" for k, r in enumerate(rules))
    return f"ARRAY_COMPACT(ARRAY({names}))" if rules else "CAST(ARRAY() AS ARRAY<STRING>)"


def broken_rows(df: DataFrame, table: Table) -> DataFrame:
    """The rows that break a rule, with the names of those rules besides their columns."""
    rules = row_rules(table)
    masked = df.selectExpr("*", f"{broken_mask(rules)} AS {BROKEN}").where(f"{BROKEN} <> 0")
    return masked.withColumn(BROKEN, F.expr(rule_names(rules)))


def quarantine(tables: Mapping[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Write each table below ``folder``, sound rows apart from others; returns (sound, set aside).

    A table is read once. What is set aside carries the names of the rules it breaks.
    """
    sound, aside = {}, {}
    for name, df in tables.items():
        rules = row_rules(TABLES[name])
        masked = df.selectExpr("*", f"{broken_mask(rules)} AS {BROKEN}").withColumn("sound", F.expr(f"{BROKEN} = 0"))
        masked.write.partitionBy("sound").parquet(f"{folder}/{name}")
        back = df.sparkSession.read.schema(masked.schema).parquet(f"{folder}/{name}")
        sound[name] = back.where("sound").select(*df.columns)
        aside[name] = back.where("NOT sound").select(*df.columns, F.expr(rule_names(rules)).alias(BROKEN))
    return sound, aside


def _broken_rules(df: DataFrame, table: Table, rules: list[Rule]) -> DataFrame:
    """Count every rule of a table in one pass, then turn the counts into rows."""
    counts = df.agg(*(F.expr(f"COUNT_IF({rule.broken}) AS r{k}") for k, rule in enumerate(rules)))
    rows = F.explode(F.array(*(
        F.struct(
            F.lit(table.name).alias("table_name"),
            F.lit(rule.column).alias("column_name"),
            F.lit(rule.name).alias("rule"),
            F.col(f"r{k}").alias("violations"),
        )
        for k, rule in enumerate(rules)
    )))
    return counts.select(rows.alias("row")).select("row.*")


def null_and_length_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per required column that are NULL, and per limited column that are too long."""
    return _union([
        _broken_rules(tables[t.name], t, null_and_length_rules(t)) for t in TABLES.values() if t.name in tables
    ])


def check_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per value rule for which the rule is false."""
    return _union([
        _broken_rules(tables[t.name], t, check_rules(t)).withColumnRenamed("column_name", "check_name")
        for t in TABLES.values() if t.checks and t.name in tables
    ])


def rule_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per rule of either kind, each table read once."""
    return _union([_broken_rules(tables[t.name], t, row_rules(t)) for t in TABLES.values() if t.name in tables])


def require_integrity(tables: Mapping[str, DataFrame]) -> None:
    """Raise ``IntegrityError`` if any declared rule is broken.

    Two passes: one for keys and references, one for the rules of single rows. Only
    one row per broken rule reaches the driver.
    """
    rows = rule_violations(tables).select(
        "table_name", F.concat_ws(" ", "column_name", "rule").alias("rule"), "violations")
    broken = key_report(tables).unionByName(rows).where("violations > 0").orderBy("table_name", "rule").collect()
    if broken:
        raise IntegrityError("; ".join(f"{row.table_name} {row.rule}: {row.violations}" for row in broken))
