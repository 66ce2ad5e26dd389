"""Checks for what a relational server would enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DOMAINS, FOREIGN_KEYS


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their row counts. NULL keys are allowed.

    Counting per key first leaves one row per key to compare, hot or not.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key_value"))
        .agg(F.count("*").alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias("key_value"))
    return used.join(known, "key_value", "left_anti")


def domain_violations(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the domain with their row counts; NULL is not a violation."""
    return (
        df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
        .groupBy(F.col(col).cast("string").alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key_value")).agg(F.count("*").alias("rows")).filter("rows > 1")


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared foreign key and domain: how many rows break it.

    All checks are one aggregation. Each table is read once; a row gives its own key, the keys it refers to and its values
    outside their domains. Rows that meet on (referenced table, key) tell whether the key exists and how often each
    foreign key uses it. Uses are counted before the shuffle, so a hot key is no hot task. NULL
    breaks nothing. A missing table or column is an error. Keys must be integers.
    """
    parents = list(dict.fromkeys((parent, key) for _, _, parent, key in FOREIGN_KEYS))
    uses = {p: [f for f in FOREIGN_KEYS if f[2:] == p] for p in parents}
    width = max(map(len, uses.values()))
    names = {(i, j): f"{f[0]}.{f[1]} -> {f[2]}.{f[3]}" for i, p in enumerate(parents) for j, f in enumerate(uses[p])}
    names |= {(len(parents) + i, 0): f"{table}.{col}" for i, (table, col) in enumerate(DOMAINS)}
    text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    # One expression text per table: as columns, the entries of all tables would take seconds to build.
    entries: dict[str, list[str]] = {}
    for i, (parent, key) in enumerate(parents):
        entries.setdefault(parent, []).append(_entry(f"`{key}` IS NOT NULL", i, "CAST(NULL AS INT)", f"`{key}`"))
        for j, (child, column, _, _) in enumerate(uses[parent, key]):
            entries.setdefault(child, []).append(_entry(f"`{column}` IS NOT NULL", i, str(j), f"`{column}`"))
    for i, ((table, column), values) in enumerate(DOMAINS.items(), len(parents)):
        outside = f"`{column}` NOT IN ({', '.join(map(text, values))})"
        entries.setdefault(table, []).append(_entry(outside, i, "0", value=f"`{column}`"))

    met = reduce(DataFrame.unionByName, (
        tables[table].selectExpr(f"inline(array({', '.join(found)}))") for table, found in entries.items()))
    groups = met.where("role IS NOT NULL").groupBy("role", "key", "value").agg(
        F.expr("max(use IS NULL) AS known"), *(F.expr(f"count_if(use = {j}) AS n{j}") for j in range(width)))
    each = groups.where("NOT known").selectExpr("role", "inline(array({}))".format(", ".join(
        f"named_struct('use', {j}, 'rows', n{j})" for j in range(width))))
    # every check has a row, broken or not
    listed = met.sparkSession.range(1).selectExpr("inline(array({}))".format(", ".join(
        f"named_struct('role', {role}, 'use', {use}, 'rows', 0L)" for role, use in names)))
    label = "map({})[role * {} + use]".format(", ".join(
        f"{role * width + use}, {text(name)}" for (role, use), name in names.items()), width)
    return each.where("rows > 0").unionByName(listed).groupBy("role", "use").agg(
        F.expr("count_if(rows > 0) AS bad_keys"), F.expr("sum(rows) AS bad_rows")).selectExpr(
        f"{label} AS check_name", "bad_keys", "bad_rows")


def _entry(where: str, role: int, use: str, key: str = "NULL", value: str = "NULL") -> str:
    return (f"IF({where}, named_struct('role', {role}, 'use', {use}, 'key', CAST({key} AS BIGINT), "
            f"'value', CAST({value} AS STRING)), NULL)")
