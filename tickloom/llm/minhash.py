"""Near-duplicate documents by fast similarity sketching.

A document's set holds the 64-bit hashes of its distinct shingles of five words
(of the whole word sequence, where there are fewer).  A sketch has
``COORDINATES`` bins.  In round i every element is thrown into one bin and
competes there with the value i + hash: in the first rounds the bin is drawn by
hash, from round ``COORDINATES`` on it is bin i - COORDINATES for all elements,
so that after twice as many rounds every bin is filled; a document leaves the
rounds as soon as its bins are full.  Two sketches agree in a coordinate with a
probability equal to the similarity of the sets, concentrated as for
independent samples.

Documents with equal sets are one class, met by its smallest doc_id.  Classes
that agree in all coordinates of a band share a bucket; buckets that touch form
a candidate group (a pair at the threshold shares none of the 32 bands of four
coordinates with probability 5e-6).  Inside a group links are confirmed on the
full sets.  A group is cut into blocks of bounded size; each block is compared
whole, and with a few pivots that all blocks of the group have in common.  A
group of one block is then done.  In a larger one the documents that are not yet
linked with its largest class are compared with all its blocks.  Tasks return
the links of a forest, never all pairs.  All joins meet in tasks: every side
grows with the documents, so none is sent through the driver.

Defined results: NULL and empty texts have no set and are linked with nothing;
so is a NULL doc_id, whose component is NULL; rows with the same doc_id are one
document and share their links; an empty table gives no rows; other columns
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import by_shuffle, free_name, per_text, prepare, written

SHINGLE = 5
COORDINATES = 128
ROWS = 4  # coordinates of a band; each is kept in 16 bits, so a band is one long
BANDS = COORDINATES // ROWS
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LINK = 75  # percent of the union that two sets share at least
BLOCK_DOCS, BLOCK_SHINGLES = 200, 400_000  # of a block of a candidate group
PIVOTS = 4
REMEMBERED = 300_000
FACTORS = np.random.default_rng(11).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
SEEDS = np.random.default_rng(12).integers(1, 2**63, 2 * COORDINATES, dtype=np.uint64)


class Words(dict):
    """word -> 64-bit hash; remembers words, within bounds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = out = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, words: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    tokens = (text or b"").translate(LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    size = min(SHINGLE, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total += h[i:len(h) - size + 1 + i] * FACTORS[i]
    return np.unique(mixed(total))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BANDS longs per set (none of them empty): COORDINATES lanes of 16 bits."""
    out = np.full((len(sets), COORDINATES), np.iinfo(np.uint64).max, np.uint64)
    flat = out.ravel()
    open_, elements = np.arange(len(sets)), sets
    for i in range(2 * COORDINATES):
        if not len(open_):
            break
        if i < 2 or len(keep) < len(open_):
            if i:
                open_, elements = open_[keep], [elements[k] for k in keep]
            if not len(open_):
                break
            owner = np.repeat(open_ * COORDINATES, [len(e) for e in elements])
            joined = np.concatenate(elements)
        h = mixed(joined ^ SEEDS[i])
        bins = (h >> np.uint64(57)).astype(np.int64) if i < COORDINATES else np.int64(i - COORDINATES)
        # The round in the high bits, the hash below: earlier rounds win.
        value = (h & np.uint64((1 << 54) - 1)) | np.uint64(i << 55)
        np.minimum.at(flat, owner + bins, value)
        keep = np.flatnonzero((out[open_] == np.iinfo(np.uint64).max).any(1))
    return mixed(out).astype(np.uint16).reshape(len(sets), COORDINATES).view(np.int64)


SKETCHED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def _sketcher():
    words = Words()

    def sketch(texts: list[bytes | None]):
        sets = [shingles(t, words) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        for i, row in zip(full, sketches([sets[i] for i in full])):
            bands[i] = row
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        return [len(s) for s in sets], digests, bands

    return sketch


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over slices of the elements held twice or more."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(often.sum()), 8192):
        a, b = np.searchsorted(column, [first, first + 8192])
        dense = np.zeros((len(sets), 8192), np.float32)
        dense[owner[a:b], column[a:b] - first] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which sets are similar enough, from their full elements."""
    both = shared(sets)
    size = np.array([len(s) for s in sets])
    return 100 * both >= LINK * (size[:, None] + size[None, :] - both)


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links connect."""
    left = np.ones(len(links), bool)
    out = []
    for root in range(len(links)):
        if left[root]:
            left[root] = False
            todo = [root]
            while todo:
                new = np.flatnonzero(links[todo.pop()] & left)
                left[new] = False
                out += [(root, int(i)) for i in new]
                todo += new.tolist()
    return out


EDGES = "a long, b long"


def _edges(across: bool):
    """Links of one block; across: only those between rows that are marked minor and others."""

    def edges(table: pa.Table) -> pa.Table:
        words = Words()
        ids = table["id"].to_numpy()
        sets = [shingles(t, words) for t in table["text"].to_pylist()]
        # A text without words, which a repeated id may have besides, links with nothing.
        full = np.array([len(s) > 0 for s in sets], bool)
        ids, sets = ids[full], [s for s in sets if len(s)]
        if not sets:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        links = linked(sets)
        if across:
            minor = table["minor"].to_numpy(zero_copy_only=False)[full]
            links &= minor[:, None] | minor[None, :]
        found = np.array(forest(links), np.int64).reshape(-1, 2)
        return pa.table({"a": ids[found[:, 0]], "b": ids[found[:, 1]]})

    return edges


def components(edges: DataFrame) -> DataFrame:
    """id and component (smallest id) of every id in edges (a, b).

    Each round hangs every id below its smallest neighbour, climbs to the tops
    of these trees and goes on with the edges between different tops, at most
    half as many ids; so a hot id costs its edges once.
    """
    ends = lambda df: df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = written(ends(edges))
    labels = edges.select(F.col("a").alias("id"), F.col("b").alias("component")).limit(0)
    first = True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tree = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("top")))
        while True:
            higher = tree.select(F.col("id").alias("top"), F.col("top").alias("new"))
            tree = written(tree.join(by_shuffle(higher), "top").select("id", F.col("new").alias("top"), (F.col("new") != F.col("top")).alias("moved")))
            still = tree.where("moved").isEmpty()
            tree = tree.drop("moved")
            if still:
                break
        up = tree.select(F.col("id").alias("component"), "top")
        labels = written(tree.withColumnRenamed("top", "component") if first else labels.join(by_shuffle(up), "component", "left").select(
            "id", F.coalesce("top", "component").alias("component")))
        first = False
        edges = written(ends(
            edges.join(by_shuffle(tree.select(F.col("id").alias("a"), F.col("top").alias("x"))), "a")
            .join(by_shuffle(tree.select(F.col("id").alias("b"), F.col("top").alias("y"))), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))))
    return labels


def candidate_groups(classes: DataFrame) -> DataFrame:
    """id and component of the classes (id, bands) whose buckets touch others."""
    rows = classes.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return components(rows.join(by_shuffle(buckets), ["band", "key"]).select(F.col("first").alias("a"), F.col("id").alias("b")))


def confirmed_links(docs: DataFrame, classes: DataFrame, repeated: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all links, from texts of docs
    and the table of classes (id, n, bands).  Ids in repeated (id) have several rows:
    each of their different texts counts once, and has a block of its own choice."""
    groups = candidate_groups(classes)
    sized = groups.join(by_shuffle(classes.select("id", "n")), "id")
    blocks = sized.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    # An id has one component; grouped by it alone, no task gets a whole group.
    each = sized.groupBy("id").agg(F.min("component").alias("component"), F.max("n").alias("n"))
    placed = written(each.join(by_shuffle(blocks), "component"))
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    part = F.lit(0).cast("long").alias("part")
    if repeated.isEmpty():
        texts = written(texts.join(by_shuffle(placed.select("id")), "id").select("id", part, "text"))
        members = placed.withColumn("part", part)
    else:
        again = placed.select("id").join(by_shuffle(repeated.withColumn("again", F.lit(True))), "id", "left")
        read = written(texts.join(by_shuffle(again), "id"))
        once = read.where("again").select("id", "text").distinct().select("id", F.xxhash64("text").alias("part"), "text")
        texts = written(read.where("again IS NULL").select("id", part, "text").unionByName(once))
        members = placed.join(by_shuffle(texts.select("id", "part")), "id")
    members = written(members.withColumn("block", F.pmod(F.xxhash64("id", "part"), F.col("blocks")).cast("int")))
    # Each document is in its block; the pivots of a group are in all its blocks.
    pivot = F.pmod(F.xxhash64("id", "part", F.lit(1)), F.col("blocks") * BLOCK_DOCS) < PIVOTS
    own = F.when((F.col("blocks") > 1) & pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    inside = members.select("id", "part", "component", F.explode(own).alias("block"))
    edges = written(inside.join(by_shuffle(texts), ["id", "part"]).groupBy("component", "block").applyInArrow(_edges(False), EDGES))
    large = members.where("blocks > 1")
    if large.isEmpty():
        return edges
    return edges.unionByName(written(_across_blocks(large, texts, edges)))


def _across_blocks(members: DataFrame, texts: DataFrame, edges: DataFrame) -> DataFrame:
    """Links of large groups between the largest class that is known so far and the rest, and within the rest."""
    known = components(edges.join(by_shuffle(members.select(F.col("id").alias("a"))), "a", "left_semi"))
    state = members.join(by_shuffle(known.withColumnRenamed("component", "label")), "id", "left").withColumn("label", F.coalesce("label", "id"))
    sizes = state.groupBy("component", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    largest = sizes.groupBy("component").agg(
        F.max(F.struct("size", "label", "shingles")).alias("most"), F.sum("size").alias("all"), F.sum("shingles").alias("all_shingles"))
    stray, stray_shingles = F.col("all") - F.col("most")["size"], F.col("all_shingles") - F.col("most")["shingles"]
    minors = largest.where(stray > 0).select(
        "component", F.col("most")["label"].alias("major"),
        F.greatest(F.ceil(stray / BLOCK_DOCS), F.ceil(stray_shingles / BLOCK_SHINGLES)).cast("int").alias("minor_blocks"))
    state = written(state.join(by_shuffle(minors), "component").withColumn("minor", F.col("label") != F.col("major")))
    # A minor document, in one of minor_blocks rows, meets every block; each block is there once a row.
    row = F.pmod(F.xxhash64("id", "part", F.lit(2)), F.col("minor_blocks")).cast("int")
    names = ["id", "part", "component", "minor", "row", "block"]
    put = state.where("minor").withColumn("row", row).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = state.withColumn("own", row).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)))
    # A minor document that lies in this block and this row has been put there already.
    met = met.where(~(F.col("minor") & (F.col("own") == F.col("row"))))
    grid = put.select(*names).unionByName(met.select(*names))
    return grid.join(by_shuffle(texts), ["id", "part"]).groupBy("component", "row", "block").applyInArrow(_edges(True), EDGES)


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs (doc_id, text)."""
    prepare(docs.sparkSession)
    narrow = docs.select("doc_id", "text")
    rows = written(per_text(narrow, "text", "r", SKETCHED, _sketcher).select(F.col("doc_id").cast("long").alias("doc_id"), "r.*"))
    full = rows.where(F.col("n") > 0).where(F.col("doc_id").isNotNull())
    # A class goes on with its smallest doc_id; rows of one doc_id may be in several classes.
    copies = written(full.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    classes = copies.select("id", "n", "bands")
    repeated = copies.where("copies > 1").select("digest", "id")
    again = written(rows.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.count(F.lit(1)).alias("rows")).where("rows > 1").select("id"))
    links = confirmed_links(narrow, classes, again)
    # Rows with one doc_id in different classes tie those classes together.
    ties = full.join(by_shuffle(repeated), "digest").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    same = full.groupBy("doc_id").agg(F.count_distinct("digest").alias("sets")).where("sets > 1").select("doc_id")
    ties = ties.join(by_shuffle(same), F.col("b") == F.col("doc_id"), "left_semi")
    found = components(links.unionByName(ties))
    own = rows.join(by_shuffle(repeated), "digest", "left").withColumn(
        "first", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))).drop("id")
    component = F.coalesce("component", "first")
    return own.join(by_shuffle(found.withColumnRenamed("id", "first")), "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs without the documents that are not the first of their component.
    Of rows with one doc_id all stay or go together."""
    gone = grouped(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    name = free_name(docs.columns, "gone")
    return docs.join(by_shuffle(gone.distinct().withColumnRenamed("gone", name)), F.col("doc_id").cast("long") == F.col(name), "left_anti")
