"""Delimited-text sources: all strings first, types later."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import fixed_values as fv
from tickloom.sources.tables import write_table

BAD, FILE, NULLED = "_bad", "_file", "_nulled"


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(
        header=True, sep=",", quote='"', escape='"', multiLine=multi_line, encoding="UTF-8",
    )


def header_of(spark: SparkSession, line: str) -> list[str]:
    """Column names in a header line."""
    return spark.read.options(header=True, sep=",", quote='"', escape='"').csv(spark.sparkContext.parallelize([line], 1)).columns


# So large that every file is one split, and every split a task.
ONE_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 42), "spark.sql.files.openCostInBytes": str(1 << 42),
                   "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, files: the first line with text of every file, and the files that begin with it.

    One job, with a task a file.  A task stops after that line, so of a file no
    more than a read buffer is fetched; files without any line are left out.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, line in enumerate(batch.column(0).to_pylist()):
                if line.strip():
                    yield batch.slice(i, 1)
                    return

    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(first, lines.schema).groupBy(F.col("value").alias("line")).agg(F.sort_array(F.collect_list("file")).alias("files"))


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a folder or pattern by their column names, in the order of the names of the files."""
    before = {name: spark.conf.get(name) for name in ONE_FILE_A_TASK}
    try:
        for name, value in ONE_FILE_A_TASK.items():
            spark.conf.set(name, value)
        found = first_lines(spark, path).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in found:
        groups.setdefault(tuple(header_of(spark, row["line"])), []).extend(map(unquote, row["files"]))
    return dict(sorted(((header, sorted(files)) for header, files in groups.items()), key=lambda g: g[1][0]))


def _rows(spark: SparkSession, path: str, names: list[str] | None, multi_line: bool, options: dict[str, str],
          more: list[str], file_as: str | None = None) -> DataFrame:
    """Columns by name: files may order them differently, one that lacks a name raises."""
    groups = files_by_header(spark, path)
    if not groups:
        raise ValueError(f"no files in {path}")
    names = names or list(next(iter(groups)))
    parts = []
    for header, files in groups.items():
        missing = [n for n in names if n not in header]
        if missing:
            raise ValueError(f"missing columns: {', '.join(missing)} in {files[0]}")
        read = _reader(spark, multi_line).options(enforceSchema=False, **options).schema(strings([*header, *more])).csv(files)
        file = [F.col("_metadata.file_path").alias(file_as)] if file_as else []
        parts.append(read.select(*[F.col(f"`{n}`") for n in [*names, *more]], *file))
    return reduce(DataFrame.unionByName, parts)


def read_csv_table(spark: SparkSession, path: str, names: list[str] | None = None,
                   multi_line: bool = True) -> DataFrame:
    """SRC-01: comma separated, optional quotes, header, all strings, plain or gzip.

    Quoted fields may hold newlines, so one task reads a file: export a large
    table as a folder of many files.  A table without such newlines can be read
    with ``multi_line=False``, which splits its files.  Every file is read by
    its own header.
    """
    return _rows(spark, path, names, multi_line, {}, [])


def read_tolerant(spark: SparkSession, path: str, names: list[str] | None = None,
                  multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """SRC-04: good rows and rejected rows.

    A row with too few or too many fields is rejected as a whole and keeps its
    text in ``_bad``; the load goes on.
    """
    rows = with_rejected(spark, path, names, multi_line)
    names = rows.columns
    # Always true.  Spark refuses a query that reads the rejected text alone, as
    # a plain count would, so both filters look at the first column too.
    seen = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    return (
        rows.filter(F.col(BAD).isNull() & seen).drop(BAD),
        rows.filter(F.col(BAD).isNotNull() & seen).select(BAD),
    )


def with_rejected(spark: SparkSession, path: str, names: list[str] | None = None, multi_line: bool = True,
                  file_as: str | None = None) -> DataFrame:
    """All rows; a rejected one has its text in ``_bad``, a good one NULL.  ``file_as`` names a column for the file."""
    # Without pruning: a parser that skips columns does not see that a row is short.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "columnPruning": "false"}
    return _rows(spark, path, names, multi_line, options, [BAD], file_as)


def null_tokens(df: DataFrame, tokens: list[str] = fv.NULL_TOKENS) -> DataFrame:
    """SRC-02: texts that stand for nothing become NULL in every string column."""
    def clean(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        return (F.when(~c.isin(tokens), c) if kind == "string" else c).alias(name)

    return df.select(*[clean(n, t) for n, t in df.dtypes])


def select_contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """SRC-03: pick and rename columns by header name; missing names raise."""
    missing = [n for n in contract if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{n}`").alias(landed) for n, landed in contract.items()])


def land(df: DataFrame, contract: dict[str, str], tokens: list[str] = fv.NULL_TOKENS) -> DataFrame:
    """Raw table: contract columns, null tokens removed."""
    return with_field_norm(null_tokens(select_contract(df, contract), tokens))


@dataclass
class Landing:
    """A landed table: its rows by fate, and what the pass that wrote it has counted."""

    table: DataFrame
    totals: dict[str, int]

    @property
    def good(self) -> DataFrame:
        return self.table.filter(F.col(BAD).isNull()).drop(BAD, FILE, NULLED)

    @property
    def rejected(self) -> DataFrame:
        return self.table.filter(F.col(BAD).isNotNull()).select(BAD)

    def files(self) -> DataFrame:
        """file, loaded, rejected: rows of each file, from two narrow columns of the landed table."""
        return self.table.groupBy(F.col(FILE).alias("file")).agg(
            F.count_if(F.col(BAD).isNull()).alias("loaded"), F.count_if(F.col(BAD).isNotNull()).alias("rejected"))

    def nulled(self) -> DataFrame:
        """file, column_name, nulled: loaded values that a null token has turned into NULL."""
        return self.table.filter(F.col(BAD).isNull()).select(F.col(FILE).alias("file"), F.explode(NULLED).alias("column_name")).groupBy(
            "file", "column_name").agg(F.count("*").alias("nulled"))

    def losses(self, parsers: dict[str, Callable[[Column], Column]]) -> DataFrame:
        """file, column_name, reason, lost: loaded texts that the parsers cannot read."""
        return parse_losses(self.table.filter(F.col(BAD).isNull()).withColumnRenamed(FILE, "file"), parsers, "file")


def land_counted(spark: SparkSession, path: str, contract: dict[str, str], target: str, multi_line: bool,
                 tokens: list[str] = fv.NULL_TOKENS) -> Landing:
    """SRC-08 with the accounting of SRC-04 and SRC-05.

    The text files are parsed once: rejected rows lie in the same table with
    their text, every row with its file and the names of the columns that a null
    token has emptied.  ``totals`` (loaded, rejected, nulled, and nulled by
    column) are observed while the rows are written.  Changes are sorted by
    ``field_norm`` inside each file, so that filters on it skip most row groups.
    ``multi_line`` has no default, for it decides whether a file can be split
    (see :func:`read_csv_table`).
    """
    rows = with_rejected(spark, path, list(contract), multi_line, FILE).select(
        *[F.col(f"`{n}`").alias(new) for n, new in contract.items()], BAD, FILE)
    good = F.col(BAD).isNull()
    emptied = F.array_compact(F.array(*[F.when(F.col(f"`{new}`").isin(tokens), F.lit(new)) for new in contract.values()]))
    landed = rows.withColumn(NULLED, F.when(good, emptied)).withColumns({
        new: F.when(~F.col(f"`{new}`").isin(tokens), F.col(f"`{new}`")) for new in contract.values()})
    seen = Observation()
    counted = with_field_norm(landed).observe(
        seen, F.count_if(good).alias("loaded"), F.count_if(~good).alias("rejected"), F.coalesce(F.sum(F.size(NULLED)), F.lit(0)).alias("nulled"),
        *[F.count_if(F.array_contains(NULLED, new)).alias(f"nulled.{new}") for new in contract.values()])
    return Landing(write_table(counted, target, sort_by="field_norm" if "field_norm" in counted.columns else None), seen.get)


def land_raw(spark: SparkSession, path: str, contract: dict[str, str], target: str, multi_line: bool,
             tokens: list[str] = fv.NULL_TOKENS) -> tuple[DataFrame, DataFrame]:
    """SRC-08: the raw table, written once as Parquet, and its rejected rows."""
    landing = land_counted(spark, path, contract, target, multi_line, tokens)
    return landing.good, landing.rejected


def with_field_norm(raw: DataFrame) -> DataFrame:
    """Give changes their field name in upper case too: a filter on that column
    reaches the files, one on ``upper(field)`` does not."""
    return raw.withColumn("field_norm", F.upper("field")) if "field" in raw.columns else raw


def load_seed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """SRC-06: small lookup table with pinned string columns."""
    return spark.read.options(header=True, quote='"', escape='"').schema(strings(columns)).csv(path)


def row_count_audit(tables: dict[str, DataFrame], expected: dict[str, int], tolerance: float = 0.01) -> DataFrame:
    """SRC-05: rows per table against the expected number."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(expected[name]).cast("bigint").alias("expected"))
        for name, df in tables.items()
    ]
    error = F.abs(F.col("row_count") - F.col("expected")) / F.col("expected").cast("double")
    close = F.when(error <= tolerance, "OK").otherwise("CHECK")
    return reduce(DataFrame.unionByName, counts).withColumns({"rel_error": F.round(error, 6), "status": close})


def parse_losses(df: DataFrame, parsers: dict[str, Callable[[Column], Column]], *by: str) -> DataFrame:
    """*by, column_name, reason, lost: texts that the parsers (value and reason)
    could not read, all columns in one pass."""
    lost = F.array_compact(F.array(*[
        F.when(parse(F.col(f"`{name}`"))["reason"].isNotNull(), F.struct(F.lit(name).alias("column_name"), parse(F.col(f"`{name}`"))["reason"].alias("reason")))
        for name, parse in parsers.items()]))
    return df.select(*by, F.inline(lost)).groupBy(*by, "column_name", "reason").agg(F.count("*").alias("lost"))
