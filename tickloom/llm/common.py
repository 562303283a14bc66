"""Helpers shared by the text operators."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.session import checkpoint_dir, configure

# An Arrow batch is cut by rows and by bytes, so that neither many short nor
# a few very long texts fill a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, and read
    again by any executor, whatever happens to the one that wrote it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """df as a side of a join that tasks read by key, whatever its size seems to be.

    Spark takes a table for as large as its compressed files, and an explode for
    no larger than what it reads: a side that it would broadcast on these grounds
    can be many times as large in the driver's memory.
    """
    return df.hint("merge")


def free_name(names: Sequence[str], wish: str) -> str:
    """wish, or wish with underscores when a column has that name already."""
    taken = {n.lower() for n in names}
    while wish.lower() in taken:
        wish += "_"
    return wish


def per_text(
    df: DataFrame,
    text: str,
    result: str,
    schema: T.StructType,
    start: Callable[[], Callable[..., Sequence[Sequence]]],
    also: Sequence[str] = (),
) -> DataFrame:
    """df with one more struct column, computed from whole texts in Arrow batches.

    start() runs once per task and returns the function that maps a list of
    texts (UTF-8 bytes or None), and the values of the columns in also, to one
    sequence of values per field of schema.
    Every other column passes through, whatever its name; the caller chooses
    a free name for result.
    """
    names = df.columns
    at, extra = names.index(text), [names.index(c) for c in also]
    short = df.toDF(*[f"c{i}" for i in range(len(names))])
    fed = short.withColumn("t", F.col(f"c{at}").cast("binary"))
    out = T.StructType([*short.schema.fields, T.StructField("r", schema, True)])
    kinds = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = function(batch.column(batch.num_columns - 1).to_pylist(),
                               *(batch.column(i).to_pylist() for i in extra))
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(columns, kinds)]
            struct = pa.StructArray.from_arrays(arrays, fields=kinds)
            kept = list(range(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), struct], names=[f"c{i}" for i in kept] + ["r"])

    return fed.mapInArrow(run, out).toDF(*names, result)


def aggregated_in_tasks(
    df: DataFrame,
    schema: str,
    start: Callable[[], tuple[Callable[[pa.RecordBatch], None], Callable[[], pa.RecordBatch | None]]],
) -> DataFrame:
    """What each task has gathered from its rows, ahead of a shuffle.

    start() returns (take, give): take(batch) adds a batch, give() returns what
    is ready to leave the task, or None; give(True) at the end returns the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, give = start()
        for batch in batches:
            take(batch)
            if (out := give(False)) is not None:
                yield out
        if (out := give(True)) is not None:
            yield out

    return df.mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
SPANS = T.ArrayType(SPAN)


def replace_spans(text: Column, spans: Column, by: str) -> Column:
    """text with every span replaced; spans in order and apart."""
    whole = F.length(text).cast("long")
    gap = lambda i: F.substring(
        text,
        F.when(i == 0, F.lit(1)).otherwise(F.get(spans, i - 1)["end"].cast("int") + 1),
        (F.when(i == F.size(spans), whole).otherwise(F.get(spans, i)["start"])
         - F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"])).cast("int"))
    pieces = F.transform(F.sequence(F.lit(0), F.size(spans)), gap)
    return F.when(F.size(spans) > 0, F.array_join(pieces, by)).otherwise(text)


def with_text(df: DataFrame, new: Column, drop: str) -> DataFrame:
    """df with another text; n_chars follows where it counts the characters."""
    columns = []
    for name in df.columns:
        if name == drop:
            continue
        if name == "text":
            columns.append(new.alias("text"))
        elif name == "n_chars":
            columns.append(F.when(new.isNull(), F.col("n_chars")).otherwise(F.length(new)).cast(df.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"`{name}`"))
    return df.select(*columns)


def blocks_for(total: int, most: int) -> int:
    return max(1, math.ceil(total / most))

