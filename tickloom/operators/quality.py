"""Declarative data tests.  NULLs pass every test but ``not_null``."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Test:
    model: str
    column: str
    kind: str  # unique, not_null, accepted_values, relationships
    values: tuple = ()
    parent: str = ""
    parent_column: str = "key"
    severity: str = "error"

    __test__ = False  # not a test case for pytest


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("n")).filter("n > 1")
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their frequency."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count("*").alias("n"))


def check_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their frequency.

    Both sides are combined per value first: a hot value joins as one row.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return values.join(known, F.col(column) == F.col("_parent"), "left_anti")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Label frequencies, most frequent first."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.col(column).asc_nulls_last())


def check_signal(df: DataFrame, flag: str, column: str, value: str) -> DataFrame:
    """Is an enrichment flag informative: some 1, both values, overlap with a class."""
    on = F.col(flag) == 1
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(on).alias("flagged"),
        F.count_distinct(flag).alias("distinct_values"),
        F.count_if(on & (F.col(column) == value)).alias("overlap"),
    )
    usable = (F.col("flagged") > 0) & (F.col("distinct_values") >= 2)
    return counts.withColumn("status", F.when(usable, "PASS").otherwise("ERROR"))


def domains(tests: list[Test]) -> list[list[tuple[str, str]]]:
    """Columns (model, column) in groups that relationships connect; every tested column is in one."""
    group: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for t in tests:
        own = group.setdefault((t.model, t.column), [(t.model, t.column)])
        if t.kind == "relationships":
            other = group.setdefault((t.parent, t.parent_column), [(t.parent, t.parent_column)])
            if own is not other:
                own += other
                group.update({place: own for place in other})
    return [list(g) for g in {id(g): g for g in group.values()}.values()]


def _values(df: DataFrame, columns: list[tuple[str, int, int, list[str] | None]]) -> DataFrame:
    """domain, source, value of the columns (name, domain, source, passing): NULLs,
    and the values not in ``passing``; none where that is None.

    Where no column gives all its values, a filter says so beforehand: Spark pushes
    it below the joins of a view, and to the files.
    """
    needed, entries = [], []
    for name, domain, source, passing in columns:
        value = F.col(name)
        text = (F.lit(None) if passing is None else value).cast("string")
        found = F.struct(F.lit(domain).alias("domain"), F.lit(source).alias("source"), text.alias("value"))
        if passing == []:
            entries.append(found)
            continue
        needed.append(value.isNull() | ~text.isin(passing) if passing else value.isNull())
        entries.append(F.when(needed[-1], found))
    rows = df.filter(reduce(Column.__or__, needed)) if len(needed) == len(columns) else df
    return rows.select(F.inline(F.array_compact(F.array(*entries))))


def tested_values(tables: dict[str, DataFrame], tests: list[Test], place: dict[tuple[str, str], tuple[int, int]]) -> DataFrame:
    """domain, source, value: what the tests must count, out of one pass over each table.

    ``place`` gives the columns their domain and source.  Unique columns and both
    sides of a relationship give every value; of a column with listed values only
    those outside the lists can fail a test, and of the rest only NULLs.
    """
    counted = {(t.model, t.column) for t in tests if t.kind in ("unique", "relationships")} | {
        (t.parent, t.parent_column) for t in tests if t.kind == "relationships"}
    listed: dict[tuple[str, str], set[str]] = {}
    for t in tests:
        if t.kind == "accepted_values":
            own = {str(v) for v in t.values}
            listed[t.model, t.column] = listed.get((t.model, t.column), own) & own
    by_model: dict[str, list[tuple[str, int, int, list[str] | None]]] = {}
    for (model, column), (domain, source) in place.items():
        lists = listed.get((model, column))
        passing = [] if (model, column) in counted else None if lists is None else sorted(lists)
        by_model.setdefault(model, []).append((column, domain, source, passing))
    return reduce(DataFrame.unionByName, [_values(tables[model], columns) for model, columns in by_model.items()])


def run_suite(tables: dict[str, DataFrame], tests: list[Test]) -> DataFrame:
    """One row per test: PASS, WARN or ERROR and the number of failures.

    The suite is compiled to one pass: every table is read once and gives the
    values of its tested columns that a test may have to count
    (:func:`tested_values`), which are counted per domain, value and column.  Columns that a
    relationship connects are one domain, so a child value without a parent is a
    counted row, and no table is joined.  Values are compared as texts.
    """
    groups = domains(tests)
    place = {member: (d, s) for d, group in enumerate(groups) for s, member in enumerate(group)}
    values = tested_values(tables, tests, place)
    counted = values.groupBy("domain", "value").agg(*[
        F.count_if(F.col("source") == s).alias(f"n{s}") for s in range(max(map(len, groups)))])

    def failures(t: Test) -> Column:
        domain, source = place[t.model, t.column]
        here, n, value = F.col("domain") == domain, F.col(f"n{source}"), F.col("value")
        if t.kind == "not_null":
            return F.coalesce(F.sum(F.when(here & value.isNull(), n)), F.lit(0))
        if t.kind == "unique":
            return F.count_if(here & value.isNotNull() & (n > 1))
        if t.kind == "accepted_values":
            return F.count_if(here & (n > 0) & ~value.isin([str(v) for v in t.values]))
        if t.kind == "relationships":
            parents = F.col(f"n{place[t.parent, t.parent_column][1]}")
            return F.coalesce(F.sum(F.when(here & value.isNotNull() & (parents == 0), n)), F.lit(0))
        raise ValueError(t.kind)

    found = counted.agg(*[failures(t).alias(f"t{i}") for i, t in enumerate(tests)])
    row = lambda i, t: F.struct(
        F.lit(t.model).alias("model"), F.lit(t.column).alias("column"), F.lit(t.kind).alias("test"), F.lit(t.severity).alias("severity"),
        F.col(f"t{i}").alias("failures"))
    result = found.select(F.inline(F.array(*[row(i, t) for i, t in enumerate(tests)])))
    bad = F.when(F.col("severity") == "warn", "WARN").otherwise("ERROR")
    return result.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise(bad))
