"""Layers, predictions and exports; tables that are replaced while others read them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import checkpoint_dir

PREDICTION_SCHEMA = {
    "key": "string", "true_issuetype": "string", "true_resolution": "string",
    "pred_issuetype": "string", "pred_resolution": "string",
    "conf_issuetype": "double", "conf_resolution": "double",
    "method": "string", "fix_summary": "string",
}
COMPRESSION = "zstd"  # of written tables
VERSION = "_v"  # a hidden folder: listing the table's folder finds no stray files


def materialize(df: DataFrame, layer: str, name: str, base: str) -> DataFrame:
    """SRC-08: staging stays a lazy view, every other layer is a rebuilt table."""
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return df
    return write_table(df, f"{base}/{layer}/{name}")


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder for checkpoints.

    For a table that several jobs need: each reads only its own columns, and
    none repeats the plan behind the table, also when executors are lost.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop knows them."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[str]:
    """Whole versions of a table, oldest first.

    A write ends with its ``_SUCCESS`` mark, so a version counts from the moment
    it is complete; what a failed write has left never does.
    """
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    jvm = spark._jvm
    names = sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(VERSION))
    return [f"{path}/{n}" for n in names if files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


def write_table(df: DataFrame, path: str, sort_by: str | None = None) -> DataFrame:
    """Replace a table; its rows as written.

    The rows go to a new version, and a reader opens the last complete one: who
    has opened the table before ends with the old rows, and a failed write leaves
    the old table.  Old versions stay until :func:`drop_old_versions`.
    ``sort_by`` orders each file, without a shuffle, so that a filter on that
    column skips most row groups.
    """
    spark = df.sparkSession
    rows = df.sortWithinPartitions(sort_by) if sort_by else df
    last = versions(spark, path)
    number = int(last[-1].rsplit("/", 1)[1][len(VERSION):].split("-")[0]) + 1 if last else 1
    version = f"{path}/{VERSION}{number:09d}-{uuid.uuid4().hex}"
    rows.write.options(**{"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true", "compression": COMPRESSION}).parquet(version)
    return spark.read.schema(df.schema).parquet(version)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The last complete version of a table."""
    found = versions(spark, path)
    if not found:
        raise ValueError(f"no table in {path}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(found[-1])


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove all complete versions but the last ``keep``, once no reader is left; how many."""
    old = versions(spark, path)[:-max(1, keep)]
    for version in old:
        files, where = _folder(spark, version)
        files.delete(where, True)
    return len(old)


def prediction_columns(df: DataFrame) -> DataFrame:
    columns = {c: F.col(c).cast(t) for c, t in PREDICTION_SCHEMA.items()}
    columns["fix_summary"] = F.coalesce(columns["fix_summary"], F.lit(""))
    return df.select(*[c.alias(n) for n, c in columns.items()])


def write_predictions(df: DataFrame, path: str) -> DataFrame:
    """SRC-09: replace the nine-column predictions table."""
    return write_table(prediction_columns(df), path)


def export_csv(df: DataFrame, path: str) -> None:
    """SRC-10: a folder of CSV files with header."""
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
