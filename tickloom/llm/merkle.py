"""Merkle manifest of a table: a tree of SHA-256 digests whose parents keep hash states.

A digest as hex text is 64 bytes, exactly one block of SHA-256.  The state of a
parent's hash before child slot s is therefore eight words, the chaining value
after s blocks.  A parent keeps the state before each of its slots; to fold a
changed child, the state before its slot is resumed with the replacement, the
siblings to the right and the padding, and no sibling to the left is hashed
again.  The digest of a proof, whose siblings are blocks as well, is carried up
as such a state.

Leaves get their place in a group from a range partitioning, so a group may hold
any share of all rows.  A group is cut into blocks of 3^LEVELS leaves; a task
builds whole blocks and folds every leaf up to the top of its block.  The tops
are the leaves of the next round, until each group has one; the tops of the
groups, in order, are the leaves of the last tree.  Nodes above the first round
hand down their path: for each level the state before the slot and the siblings.

Defined results: a NULL value is hashed as ``-``; a NULL group is the first; rows
with a NULL id come first in their group and are never tampered with; rows with
one id stand in the order of their leaves (equal rows may change places, which
changes no digest); a single leaf is its group's top; an empty table has no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import prepare, written

ARITY = 3
LEVELS = 6  # of a block: 729 leaves
CHUNK = 8192  # rows that a task hashes together


# --- SHA-256 on many messages at once -------------------------------------------------


def _primes(count: int) -> list[int]:
    out: list[int] = []
    n = 2
    while len(out) < count:
        if all(n % p for p in out):
            out.append(n)
        n += 1
    return out


def _root_bits(n: int, root: int) -> int:
    """First 32 bits of the fraction of n's square or cube root."""
    scaled = n << (32 * root)
    guess = int(round(scaled ** (1 / root)))
    while guess**root > scaled:
        guess -= 1
    while (guess + 1) ** root <= scaled:
        guess += 1
    return guess & 0xFFFFFFFF


START = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
ROUNDS = np.array([_root_bits(p, 3) for p in _primes(64)], np.uint32)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compressed(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16 big-endian words) each."""
    w = list(np.ascontiguousarray(blocks.T))
    a, b, c, d, e, f, g, h = np.ascontiguousarray(state.T)
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + w[i - 7] + (_rotated(x, 7) ^ _rotated(x, 18) ^ (x >> np.uint32(3)))
                     + (_rotated(y, 17) ^ _rotated(y, 19) ^ (y >> np.uint32(10))))
        t = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + (g ^ (e & (f ^ g))) + ROUNDS[i] + w[i]
        u = (_rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + t, c, b, a, t + u
    return state + np.stack([a, b, c, d, e, f, g, h], 1)


HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def hex_words(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 8 words) as hex text: one block (n, 16 words) each."""
    raw = np.ascontiguousarray(digests, ">u4").view(np.uint8).reshape(len(digests), 32)
    text = np.empty((len(digests), 64), np.uint8)
    text[:, ::2], text[:, 1::2] = HEX[raw >> 4], HEX[raw & 15]
    return text.view(">u4").astype(np.uint32)


def closed(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of so many whole blocks, from their states."""
    end = np.zeros((len(state), 16), np.uint32)
    end[:, 0] = 0x80000000
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    end[:, 14], end[:, 15] = (bits >> np.uint64(32)).astype(np.uint32), (bits & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return compressed(state, end)


def starts(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))


# --- a level of the tree ----------------------------------------------------------------


class Level:
    """The parents of one level.

    digests (n, 8) are the children in order, slot (n) their slots, parent (n)
    the number of each one's parent.  Kept for each parent: the number of its
    children, their hex blocks, and the state before each slot.
    """

    def __init__(self, digests: np.ndarray, slot: np.ndarray, parent: np.ndarray) -> None:
        self.slot, self.parent = slot, parent
        parents = int(parent[-1]) + 1
        self.size = np.bincount(parent, minlength=parents)
        self.child = np.full((parents, ARITY), -1, np.int64)
        self.child[parent, slot] = np.arange(len(digests))
        self.digests, self.hex = digests, hex_words(digests)
        self.before = np.empty((parents, ARITY, 8), np.uint32)
        state = starts(parents)
        for s in range(ARITY):
            self.before[:, s] = state
            full = np.flatnonzero(self.child[:, s] >= 0)
            state[full] = compressed(state[full], self.hex[self.child[full, s]])
        self.tops = closed(state, self.size)

    def folded(self, new: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Digests of the parents of the children at, each with new in the child's place."""
        mother, slot = self.parent[at], self.slot[at]
        right = [np.where(slot + k < self.size[mother], self.child[mother, np.minimum(slot + k, ARITY - 1)], -1) for k in range(1, ARITY)]
        return resumed(self.before[mother, slot], new, [(r >= 0, self.hex[r]) for r in right], self.size[mother])

    def siblings(self, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """From left to right: which children have one there, and its number."""
        mother, slot = self.parent[at], self.slot[at]
        out = []
        for k in range(ARITY - 1):
            s = k + (k >= slot)
            out.append((s < self.size[mother], self.child[mother, s]))
        return out


def resumed(before: np.ndarray, new: np.ndarray, right: list[tuple[np.ndarray, np.ndarray]], size: np.ndarray) -> np.ndarray:
    state = compressed(before, hex_words(new))
    for there, blocks in right:
        some = np.flatnonzero(there)
        if len(some):
            state[some] = compressed(state[some], blocks[some])
    return closed(state, size)


def absorbed(state: np.ndarray, count: np.ndarray, there: np.ndarray, blocks: np.ndarray) -> None:
    """Add a block to the states where it is there."""
    some = np.flatnonzero(there)
    if len(some):
        state[some] = compressed(state[some], blocks[some])
        count[some] += 1


# One level of a path: children of the parent, slot, state before it, the two siblings.
RECORD = np.dtype([("size", "u1"), ("slot", "u1"), ("before", ">u4", 8), ("siblings", ">u4", (ARITY - 1, 8))])


def built(segment: np.ndarray, alone: np.ndarray, digests: np.ndarray, most: int = LEVELS) -> list[Level]:
    """Levels of the blocks in segment (numbers from 0, ascending).

    A block that is its whole group (alone) ends with one node; the others go
    through the most levels, because the group goes on above them.
    """
    levels = []
    here, nodes = segment, digests
    for _ in range(most):
        if len(here) == int(here[-1]) + 1 and alone.all():
            break
        first = np.concatenate([[True], here[1:] != here[:-1]])
        start = np.flatnonzero(first)
        within = np.arange(len(here)) - start[here]
        done = alone[here] & (np.bincount(here)[here] == 1)
        lead = first | (within % ARITY == 0)
        parent = np.cumsum(lead) - 1
        level = Level(nodes, within % ARITY, parent)
        tops = level.tops
        # A finished tree passes through unchanged.
        level.passed = done
        tops[parent[done]] = nodes[done]
        levels.append(level)
        here, nodes = here[lead], tops
    return levels


def climbed(levels: list[Level], new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves folded to the tops of their blocks with new in their place; state
    and number of blocks of the digest over the siblings on the way."""
    n = len(new)
    at, state, count = np.arange(n), starts(n), np.zeros(n, np.int64)
    for level in levels:
        live = ~level.passed[at]
        for there, number in level.siblings(at):
            absorbed(state, count, there & live, level.hex[number])
        some = np.flatnonzero(live)
        if len(some):
            new[some] = level.folded(new[some], at[some])
        at = level.parent[at]
    return new, state, count


def paths(levels: list[Level], n: int) -> list[bytes]:
    """The path of each leaf inside its block, as records."""
    at = np.arange(n)
    out = [b""] * n
    for level in levels:
        records = np.zeros(n, RECORD)
        mother = level.parent[at]
        records["size"], records["slot"] = level.size[mother], level.slot[at]
        records["before"] = level.before[mother, level.slot[at]]
        for k, (there, number) in enumerate(level.siblings(at)):
            records["siblings"][there, k] = level.digests[number[there]]
        live = ~level.passed[at]
        raw = records.tobytes()
        for i in np.flatnonzero(live):
            out[i] += raw[i * RECORD.itemsize:(i + 1) * RECORD.itemsize]
        at = mother
    return out


def followed(path: np.ndarray, new: np.ndarray, state: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Digests folded along paths (n, levels) of equal length; states of the proofs are moved on."""
    for step in path.T:
        size, slot = step["size"].astype(np.int64), step["slot"].astype(np.int64)
        blocks = [hex_words(step["siblings"][:, k].astype(np.uint32)) for k in range(ARITY - 1)]
        right = []
        for k in range(ARITY - 1):
            there = k < size - 1
            absorbed(state, count, there, blocks[k])
            right.append((there & (k >= slot), blocks[k]))
        new = resumed(step["before"].astype(np.uint32), new, right, size)
    return new


# --- tables -----------------------------------------------------------------------------


def _words(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Binary digests as (n, 8) words."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)


def _binary(words: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(words, ">u4").tobytes()
    return pa.array([raw[i:i + 32] for i in range(0, len(raw), 32)], pa.binary())


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about CHUNK rows that end where a block (tree, block) ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(np.flatnonzero(_changes(table))[-1])
            if last:
                yield table.slice(0, last)
                held, rows = table.slice(last).to_batches(), table.num_rows - last
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _changes(table: pa.Table) -> np.ndarray:
    """Where another block begins."""
    out = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        block = table["block"].to_numpy()
        tree = table["tree"].combine_chunks()
        tree = tree.chunk(0) if isinstance(tree, pa.ChunkedArray) else tree
        other = pc.not_equal(tree.slice(1), tree.slice(0, len(tree) - 1)).to_numpy(zero_copy_only=False)
        out[1:] = (block[1:] != block[:-1]) | other
    return out


def _lift(leaves: bool, most: int):
    """Build the blocks.  Leaves come out folded, nodes of later rounds with their path."""

    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            first = _changes(table)
            segment = np.cumsum(first) - 1
            alone = table["trees_rows"].to_numpy()[first] <= ARITY**most
            levels = built(segment, alone, _words(table["digest"]), most)
            n = table.num_rows
            top = levels[-1].tops if levels else _words(table["digest"])
            tops = pa.array([t if f else None for t, f in zip(_binary(top[segment]).to_pylist(), first)], pa.binary())
            fixed = [table["tree"], table["block"]]
            if leaves:
                folded, state, count = climbed(levels, _words(table["changed"]))
                out = pa.table([*fixed, table["id"], table["digest"], _binary(folded), _binary(state), pa.array(count), tops],
                               names=["tree", "block", "id", "digest", "folded", "state", "count", "top"])
            else:
                out = pa.table([*fixed, table["place"], pa.array(paths(levels, n), pa.binary()), tops],
                               names=["tree", "block", "place", "path", "top"])
            yield from out.to_batches()

    return lift


def _lifted(rows: DataFrame, leaves: bool, most: int) -> DataFrame:
    """rows (tree, place, trees_rows, digest[, id, changed]) with their blocks built."""
    out = ("tree string, block long, id long, digest binary, folded binary, state binary, count long, top binary" if leaves
           else "tree string, block long, place long, path binary, top binary")
    return written(rows.withColumn("block", F.floor(F.col("place") / ARITY**most))
                   .repartition("tree", "block").sortWithinPartitions("tree", "block", "place").mapInArrow(_lift(leaves, most), out))


def _placed(rows: DataFrame, tree: Column, *order: Column) -> DataFrame:
    """rows with tree, place (from 0, in order within the tree) and trees_rows.

    A range partitioning sorts them; numbers inside a partition and counts per
    partition and tree give the places, so no tree has to fit a task.
    """
    # Equal rows can change places; the last key lets a range end among them.
    rows = rows.withColumn("tree", tree).withColumn("spread", F.monotonically_increasing_id())
    keys = [F.col("tree"), *order, F.col("spread")]
    ranged = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread").withColumn("number", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("part", F.shiftright("number", 33))
    counts = ranged.groupBy("tree", "part").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("tree").orderBy("part")) - F.col("n")
    counts = counts.select("tree", "part", (earlier - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("trees_rows"))
    return ranged.join(counts, ["tree", "part"]).withColumn("place", F.col("number") + F.col("shift")).drop("part", "number", "shift")


def _grown(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Trees over nodes (tree, place, trees_rows, digest): the path of every node
    (tree, place, path), and the tops (tree, top)."""
    block = ARITY**most
    rounds, tops = [], None
    while True:
        lifted = _lifted(nodes, False, most)
        rounds.append(lifted)
        ends = nodes.select("tree", "trees_rows").distinct()
        found = lifted.where(F.col("top").isNotNull()).join(ends, "tree")
        done = found.where(F.col("trees_rows") <= block).select("tree", "top")
        tops = done if tops is None else tops.unionByName(done)
        nodes = written(found.where(F.col("trees_rows") > block).select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("trees_rows") / block).alias("trees_rows"), F.col("top").alias("digest")))
        if nodes.isEmpty():
            break
    path = None
    for lifted in reversed(rounds):
        own = lifted.select("tree", "block", "place", "path")
        if path is None:
            path = own.select("tree", "place", "path")
        else:
            above = path.select("tree", F.col("place").alias("block"), F.col("path").alias("rest"))
            path = own.join(above, ["tree", "block"], "left").select(
                "tree", "place", F.concat("path", F.coalesce("rest", F.lit(b""))).alias("path"))
    return path, tops


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold along the paths above the blocks and close the proofs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new, state = _words(batch.column("folded")), _words(batch.column("state"))
        count = batch.column("count").to_numpy().copy()
        path = batch.column("path").to_pylist()
        long = np.array([len(p) for p in path]) // RECORD.itemsize
        for length in np.unique(long):
            some = np.flatnonzero(long == length)
            if length:
                records = np.frombuffer(b"".join(path[i] for i in some), RECORD).reshape(len(some), length)
                s, c = state[some], count[some]
                new[some] = followed(records, new[some], s, c)
                state[some], count[some] = s, c
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("digest"), batch.column("subroot"), batch.column("root"), _binary(closed(state, count)), _binary(new)],
            names=["id", "digest", "subroot", "root", "proof", "folded"])


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """id, digest, subroot, root, proof, folded (all digests binary) of rows.

    rows has the group (a string), id, digest (the leaf) and changed (the leaf to
    fold, that may differ).  proof is the digest over the hex digests of all
    siblings on the way to the root, folded the root with changed in place.
    """
    # NULL first, then the groups in the order of their bytes.
    tree = F.coalesce(F.concat(F.lit("."), "group"), F.lit(""))
    leaves = _lifted(_placed(rows.select("group", "id", "digest", "changed"), tree, F.col("id"), F.col("digest")).drop("group"), True, levels)
    blocks = leaves.where(F.col("top").isNotNull())
    sizes = blocks.groupBy("tree").agg(F.count(F.lit(1)).alias("blocks"))
    tops = written(blocks.join(sizes, "tree").select(
        "tree", F.col("block").alias("place"), F.col("blocks").alias("trees_rows"), F.col("top").alias("digest")))
    inner, subroots = _grown(tops.where("trees_rows > 1"), levels)
    subroots = written(subroots.unionByName(tops.where("trees_rows = 1").select("tree", F.col("digest").alias("top"))))
    named = written(_placed(subroots.select(F.col("tree").alias("name"), F.col("top").alias("digest")), F.lit(""), F.col("name")))
    outer, root = _grown(named.drop("name"), levels)
    # One digest; none where the table is empty.
    root = F.lit((root.first() or {"top": None})["top"])
    above = (named.select("place", "name", F.col("digest").alias("subroot"))
             .join(outer.select("place", F.col("path").alias("upper")), "place").withColumn("root", root))
    way = written(tops.select("tree", F.col("place").alias("block"))
                  .join(inner.withColumnRenamed("place", "block"), ["tree", "block"], "left")
                  .join(above.withColumnRenamed("name", "tree"), "tree")
                  .select("tree", "block", F.concat(F.coalesce("path", F.lit(b"")), F.coalesce("upper", F.lit(b""))).alias("path"), "subroot", "root"))
    return leaves.drop("top").join(way, ["tree", "block"]).mapInArrow(
        _finish, "id long, digest binary, subroot binary, root binary, proof binary, folded binary")


def field(value: Column) -> Column:
    """A value in a leaf: its UTF-8 bytes after their count, ``-`` for NULL."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Binary digest of a row."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def report(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of documents;
    where the checksum of doc_id is even, the folded text has lost its line ends."""
    prepare(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rest = [F.col(c) for c in ("source", "lang", "n_chars")]
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    rows = docs.select(
        F.col("source").alias("group"), doc_id.alias("id"), leaf(doc_id, *rest, F.col("text")).alias("digest"),
        F.when(tampered & F.contains("text", F.lit("\n")), leaf(doc_id, *rest, F.translate("text", "\n", ""))).alias("other"))
    out = manifest(rows.select("group", "id", "digest", F.coalesce("other", "digest").alias("changed")), levels)
    text = lambda c: F.lower(F.hex(c))
    return out.select(
        F.col("id").alias("doc_id"), text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        text("proof").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


ORACLE = f"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
summed AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents d, crc_table),
leaves AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('.' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN crc % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS changed
  FROM summed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
inner_nodes AS (
  SELECT tree, 0 AS level, place, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM inner_nodes WHERE n > 1
  GROUP BY tree, level, place // 3, n),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
outer_nodes AS (
  SELECT 0 AS level, place, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM outer_nodes WHERE n > 1
  GROUP BY level, place // 3, n),
inner_fold AS (
  SELECT row, tree, 0 AS level, place, n, changed AS folded, '' AS siblings FROM placed
  UNION ALL
  SELECT f.row, f.tree, f.level + 1, f.place // 3, (f.n + 2) // 3,
    sha256(string_agg(CASE WHEN i.place = f.place THEN f.folded ELSE i.digest END, '' ORDER BY i.place)),
    f.siblings || string_agg(CASE WHEN i.place = f.place THEN '' ELSE i.digest END, '' ORDER BY i.place)
  FROM inner_fold f JOIN inner_nodes i ON i.tree = f.tree AND i.level = f.level AND i.place // 3 = f.place // 3
  WHERE f.n > 1 GROUP BY f.row, f.tree, f.level, f.place, f.n, f.siblings),
outer_fold AS (
  SELECT row, 0 AS level, s.place, s.n, folded, siblings FROM inner_fold f JOIN subroots s USING (tree) WHERE f.n = 1
  UNION ALL
  SELECT f.row, f.level + 1, f.place // 3, (f.n + 2) // 3,
    sha256(string_agg(CASE WHEN o.place = f.place THEN f.folded ELSE o.digest END, '' ORDER BY o.place)),
    f.siblings || string_agg(CASE WHEN o.place = f.place THEN '' ELSE o.digest END, '' ORDER BY o.place)
  FROM outer_fold f JOIN outer_nodes o ON o.level = f.level AND o.place // 3 = f.place // 3
  WHERE f.n > 1 GROUP BY f.row, f.level, f.place, f.n, f.siblings)
SELECT doc_id, leaf, subroot, o.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = o.digest AS verified
FROM placed p JOIN subroots USING (tree) JOIN outer_fold f ON f.row = p.row AND f.n = 1 JOIN outer_nodes o ON o.n = 1
"""
