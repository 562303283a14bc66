"""Groups too large for one task.

A window or an ordered aggregate puts a whole group into one task.  That is
fine for almost every group, and not for the one key that holds a third of all
rows.  Such hot groups are set apart and cut along their order into ranges of
bounded size.

Which groups are hot is read from a sketch of the landed table (:class:`HeavyKeys`),
made once when the table is written: with it, stating a plan runs no job.  Without
a sketch the groups are counted (map-side combined).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.sources.tables import read_table, write_table, written_once

MAX_GROUP_ROWS = 2_000_000
MAX_GROUP_ROWS_CONF = "tickloom.maxGroupRows"
MAX_GROUP_BYTES = 512 << 20
MAX_GROUP_BYTES_CONF = "tickloom.maxGroupBytes"
PART = "_part"
ROW_BYTES = 64  # what a row counts besides its texts
TASK_ROWS = 400_000  # a task takes this many rows of hot groups, or the limit if that is more
LISTED = 200  # hot keys that a filter names; more are joined


def max_group_rows(df: DataFrame) -> int:
    """Largest group one task may take (``tickloom.maxGroupRows``)."""
    return int(df.sparkSession.conf.get(MAX_GROUP_ROWS_CONF, str(MAX_GROUP_ROWS)))


def max_group_bytes(df: DataFrame) -> int:
    """Largest texts of a group one task may take (``tickloom.maxGroupBytes``)."""
    return int(df.sparkSession.conf.get(MAX_GROUP_BYTES_CONF, str(MAX_GROUP_BYTES)))


@dataclass(frozen=True)
class HeavyKeys:
    """The heaviest keys of a table with their bytes: none of them too high, each
    too low by no more than ``missed``.

    A table that comes from the sketched one by filters and projections has no
    heavier groups, so the sketch serves every step on the way.
    """

    column: str
    keys: tuple[tuple[object, int], ...]
    missed: int

    def above(self, size: int) -> list:
        """All keys that may have more than so many bytes.  A key that is not
        listed has at most what the sketch has missed, less than a limit where it
        had :func:`slots_for` the table."""
        return [k for k, n in self.keys if n + self.missed > size]


def slots_for(size: int, limit: int = MAX_GROUP_BYTES) -> int:
    """Counters of a task with which a table of so many bytes misses less than half the limit."""
    return max(4096, -(-2 * size // limit))


def heavy_keys(table: DataFrame, key: str, texts: list[str], path: str, slots: int = 4096) -> HeavyKeys:
    """Sketch a landed table in one pass, write the sketch to path and return it.

    A row weighs the bytes of its texts and ``ROW_BYTES``.  Each task keeps about
    ``slots`` counters (Misra and Gries, with weights): when there are too many
    keys, the weight of the first one too many is taken from all.  Such sketches
    add up, and so does the weight they have taken, which bounds what any key has
    lost to 1 / slots of the whole.
    """
    kind = table.schema[key].dataType
    weight = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], F.lit(ROW_BYTES))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        missed = 0

        def cut() -> int:
            over = sorted(held.values(), reverse=True)[slots] if len(held) > slots else 0
            for k in list(held):
                held[k] -= over
                if held[k] <= 0:
                    del held[k]
            return over

        for batch in batches:
            grouped = pa.table({"k": batch.column(0), "w": batch.column(1)}).group_by("k").aggregate([("w", "sum")])
            for k, w in zip(grouped["k"].to_pylist(), grouped["w_sum"].to_pylist()):
                held[k] = held.get(k, 0) + w
            if len(held) > 2 * slots:
                missed += cut()
        missed += cut()
        lost = [missed] + [0] * (len(held) - 1)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), to_arrow_type(kind)), pa.array(list(held.values()), pa.int64()), pa.array(lost, pa.int64())],
                                             names=["k", "bytes", "missed"])

    narrow = table.select(F.col(key).alias("k"), weight.cast("bigint").alias("w"))
    parts = narrow.mapInArrow(sketch, f"k {kind.simpleString()}, bytes bigint, missed bigint")
    write_table(parts.groupBy("k").agg(F.sum("bytes").alias("bytes"), F.sum("missed").alias("missed")), path)
    return read_heavy_keys(table.sparkSession, path, key, slots)


def read_heavy_keys(spark: SparkSession, path: str, key: str, slots: int = 4096) -> HeavyKeys:
    """The sketch in path; no more than slots keys reach the driver."""
    found = read_table(spark, path)
    total = found.agg(F.coalesce(F.sum("missed"), F.lit(0)).alias("missed"), F.count("*").alias("n")).first()
    most = [(r["k"], r["bytes"]) for r in found.orderBy(F.desc("bytes"), "k").limit(slots).select("k", "bytes").collect()]
    # A key that the list leaves out is no heavier than its last one.
    return HeavyKeys(key, tuple(most), total["missed"] + (most[-1][1] if total["n"] > slots else 0))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition on keys where NULL equals NULL, as in a group."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def separate_hot(df: DataFrame, keys: list[str], heavy: HeavyKeys | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of hot groups or None.

    With a sketch whose column is among the keys, hot are all groups of the keys
    that it cannot rule out, and no job runs.  Else groups above the row limit are
    counted; there are at most rows / limit of them, so their list is small, and
    Spark broadcasts it when its measured size allows.
    """
    if heavy is not None and heavy.column in keys:
        hot_keys = heavy.above(max_group_bytes(df))
        if not hot_keys:
            return df, None
        column = F.col(heavy.column)
        if len(hot_keys) <= LISTED:
            named = column.isin([k for k in hot_keys if k is not None])
            is_hot = F.coalesce(named, F.lit(None in hot_keys))
            return df.filter(~is_hot), df.filter(is_hot)
        hot_groups = df.sparkSession.createDataFrame([(k,) for k in hot_keys], df.select(column).schema)
        condition = same_keys(df, hot_groups, [heavy.column])
        return df.join(hot_groups, condition, "left_anti"), df.join(hot_groups, condition, "left_semi")
    limit = max_group_rows(df)
    hot_groups = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
    hot_groups = written_once(hot_groups.select(*keys), "hot-groups")
    if hot_groups.isEmpty():
        return df, None
    condition = same_keys(df, hot_groups, keys)
    return (
        df.join(hot_groups, condition, "left_anti"),
        df.join(hot_groups, condition, "left_semi"),
    )


def ascending(order: list[str]) -> list[Column]:
    """Ascending with NULLs last, the order every job uses."""
    return [F.col(c).asc_nulls_last() for c in order]


def order_value(order: list[str]) -> Column:
    """One comparable value that sorts like :func:`ascending`."""
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def split_by_order(hot: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``_part``: consecutive ranges of each group, none with more rows than the limit.

    Spark's range partitioning of the full sort key deals the rows out, with a
    row number behind it, so that even a group of equal rows is cut.  Its
    partitions are sorted and cut into ranges by the place of a row, so there are
    as many tasks as the rows need and not one for each range.  ``_part`` grows
    with the order.  The numbered rows are written before the shuffle and the
    ranges after it: neither may change when a lost executor makes Spark repeat a
    task.
    """
    limit = max_group_rows(hot)
    numbered = written_once(hot.withColumn("_row", F.monotonically_increasing_id()), "hot-rows")
    tasks = max(2, 2 * -(-numbered.count() // max(limit, TASK_ROWS)))
    columns = [*[F.col(k) for k in keys], *ascending(order), F.col("_row")]
    ranged = numbered.repartitionByRange(tasks, *columns).sortWithinPartitions(*columns)
    # The partition in the upper bits, the place in it below.
    place = F.monotonically_increasing_id()
    inside = F.col(PART).bitwiseAND(F.lit((1 << 33) - 1))
    return written_once(ranged.withColumn(PART, place).withColumn(PART, F.col(PART) - inside % limit), "hot-ranges")
