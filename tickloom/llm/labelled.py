"""Labelled rows for fits, and word counts gathered from texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distinct words that a task holds before it hands them on.
HELD_WORDS = 200_000


def bounded_sample(labels: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` rows, chosen by a hash of doc_id; all, if there are no more."""
    total = labels.count()
    if total <= most:
        return labels
    return labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(most / total * (1 << 20)))


def of_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of a bounded sample of labelled rows.  The sample's size is a
    parameter of its maker, so it may be broadcast; no text is shuffled."""
    return docs.join(F.broadcast(labels), "doc_id")


def unique_labels(labels: DataFrame, column: str) -> DataFrame:
    """One label per document: the largest, where rows repeat; NULLs are left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return known.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias(column))


def word_counter(words_of, names: list[str], weigh=None):
    """start() for common.aggregated_in_tasks: sums per word.

    words_of(text) gives words (bytes); weigh(row) the numbers that each of
    them adds, one per name, from the batch's other columns.
    """

    def start():
        sums: dict[bytes, list[int]] = {}

        def take(batch):
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns):
                add = weigh(row[1:])
                for w in words_of(row[0]):
                    old = sums.get(w)
                    if old is None:
                        sums[w] = list(add)
                    else:
                        for i, a in enumerate(add):
                            old[i] += a

        def give(end):
            if not sums or not (end or len(sums) > HELD_WORDS):
                return None
            arrays = [pa.array(list(sums), pa.binary())]
            arrays += [pa.array(c, pa.int64()) for c in zip(*sums.values())]
            sums.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["word", *names])

        return take, give

    return start


def part_of(column: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts
