"""Exact similarity join of documents by a token-group matrix.

A document's set holds the 64-bit hashes of its distinct shingles of five words
(of the whole word sequence, where there are fewer).  Documents with equal sets
are one class.  The join goes in four steps.

1.  All shingles are dealt by hash, packed in Arrow batches, and counted.  What
    is left is the table of shared entries (class, token, df): tokens that two or
    more classes hold.  The intersection of two classes lies in their entries, so
    a class with fewer entries than ``LINK`` percent of its set has no partner,
    and for the others entries and set sizes suffice from here on.
2.  The remaining classes are partitioned into groups of similar documents: equal
    smallest token among the entries, cut into groups of bounded size.  A group
    is a column of the matrix: it stores the union of its members' tokens and
    its smallest set size.  Links inside a group are found at once.
3.  In the order of rising df (then of hash), two similar sets share a token
    among the first n - ceil(0.8 n) + 1 of each.  A class asks the groups that
    hold such a token.  Its overlap with the stored union bounds the overlap with
    every member; only groups whose bound reaches ``LINK`` percent of the larger
    size are opened, and their members compared exactly.
4.  As only components are asked for, a class does not ask for what is known:
    first it asks, for each of its tokens, the largest group with that token;
    then, where a token's classes are still in several components, the classes
    outside the token's largest component ask all other groups with the token.
    No pair of classes in different components is left unasked.

Tokens that more than a 128th of the documents hold are recognised in the first
pass; their entries are dealt by class, so that no task meets them all, and they
come last in the order.  That list has at most ``MOST_HOT`` tokens.

Defined results: NULL and empty texts have no set and are linked with nothing; so
is a NULL doc_id, whose component is NULL; rows with the same doc_id are one
document and share their links; an empty table gives no rows; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import aggregated_in_tasks, blocks_for, per_text, prepare, written
from tickloom.llm.minhash import Words, components, forest, mixed, shingles

LINK = 80  # percent of the union that two sets share at least
BUCKET_TOKENS = 1 << 20  # of a counting task
FLUSH_TOKENS = 1 << 21  # packed together by a scanning task
HOT_SHARE, HOT_IN_BATCH, MOST_HOT = 128, 64, 1 << 18
HOT_DF = (1 << 31) - 1
GROUP_CLASSES, GROUP_TOKENS = 200, 400_000
QUERIES_TOKENS = 2_000_000  # of the queries that meet a group in one task


# --- step 1: entries ----------------------------------------------------------------------

SIZED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
    T.StructField("often", T.ArrayType(T.StructType([T.StructField("token", T.LongType()), T.StructField("count", T.LongType())]))),
    T.StructField("sets", T.LongType())])


def digest_of(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sizer():
    words = Words()

    def size(texts: list[bytes | None]):
        sets = [shingles(t, words) for t in texts]
        digests = [digest_of(s) if len(s) else None for s in sets]
        # What many of the different sets of this batch hold goes out with its first row.
        distinct = {d: s for d, s in zip(digests, sets) if d}
        often = []
        if distinct:
            token, count = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            many = count >= max(2, len(distinct) / HOT_IN_BATCH)
            often = [{"token": t, "count": c} for t, c in zip(token[many].view(np.int64).tolist(), count[many].tolist())]
        return [len(s) for s in sets], digests, [often] + [None] * (len(sets) - 1), [len(distinct)] + [0] * (len(sets) - 1)

    return size


def hot_tokens(rows: DataFrame) -> np.ndarray:
    """Sorted tokens that a HOT_SHAREth of the documents hold; their number is
    bounded, because together they hold no more than all tokens."""
    total = rows.agg(F.sum("sets").alias("sets"), F.sum("n").alias("n")).first()
    least = max((total["sets"] or 0) / HOT_SHARE, (total["n"] or 0) / MOST_HOT, 50)
    found = rows.select(F.explode("often").alias("o")).groupBy("o.token").agg(F.sum("o.count").alias("df")).where(F.col("df") >= least)
    return np.sort(np.array([r["token"] for r in found.select("token").collect()], np.int64).view(np.uint64))


def _packed(texts: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Shingles of all texts by bucket: tokens, and the runs of them that belong to one class."""

    def start():
        words, seen = Words(), set()
        sets: list[np.ndarray] = []
        owners: list[int] = []
        size = [0]

        def take(batch: pa.RecordBatch) -> None:
            for text in batch.column(0).to_pylist():
                tokens = shingles(text, words)
                if not len(tokens):
                    continue
                digest = digest_of(tokens)
                if digest in seen:
                    continue
                if len(seen) >= 300_000:
                    seen.clear()
                seen.add(digest)
                sets.append(tokens)
                owners.append(int.from_bytes(digest[:8], "big", signed=True))
                size[0] += len(tokens)

        def give(end: bool):
            if not sets or not (end or size[0] >= FLUSH_TOKENS):
                return None
            lengths = [len(s) for s in sets]
            tokens, owner = np.concatenate(sets), np.repeat(np.array(owners, np.int64), lengths)
            dealt = tokens
            if len(hot):
                often = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
                dealt = np.where(often, mixed(tokens ^ owner.view(np.uint64)), tokens)
            bucket = ((dealt >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, tokens, owner = bucket[order], tokens[order], owner[order]
            edge = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])]))
            runs, lengths = owner[edge], np.diff(np.append(edge, len(tokens))).astype(np.int32)
            used, first = np.unique(bucket, return_index=True)
            run_first = np.searchsorted(edge, first)
            last, run_last = np.append(first[1:], len(tokens)), np.append(run_first[1:], len(runs))
            cut = lambda values, a, b: pa.array([values[i:j].tobytes() for i, j in zip(a, b)], pa.binary())
            out = pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int64)), cut(tokens, first, last), cut(runs, run_first, run_last), cut(lengths, run_first, run_last)],
                names=["bucket", "tokens", "owners", "lengths"])
            sets.clear()
            owners.clear()
            size[0] = 0
            return out

        return take, give

    return aggregated_in_tasks(texts, "bucket long, tokens binary, owners binary, lengths binary", start)


def _counter(hot: np.ndarray):
    def count(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        tokens = read("tokens", np.uint64)
        owner = np.repeat(read("owners", np.int64), read("lengths", np.int32))
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        same = tokens[1:] == tokens[:-1]
        often = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens if len(hot) else np.zeros(len(tokens), bool)
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | often
        tokens, owner, often = tokens[keep], owner[keep], often[keep]
        # A class that several tasks have met counts once.
        order = np.lexsort((owner, tokens))
        tokens, owner, often = tokens[order], owner[order], often[order]
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])]) if len(tokens) else np.zeros(0, bool)
        tokens, owner, often = tokens[new], owner[new], often[new]
        _, at, df = np.unique(tokens, return_inverse=True, return_counts=True)
        df = np.where(often, HOT_DF, df[at])
        keep = df > 1
        return pa.table({"owner": owner[keep], "token": tokens[keep].view(np.int64), "df": df[keep].astype(np.int32)})

    return count


def shared_entries(texts: DataFrame, total: int, hot: np.ndarray) -> DataFrame:
    """owner (first half of the class's digest), token, df of all tokens in several classes of texts (text, as bytes)."""
    packed = _packed(texts, blocks_for(total, BUCKET_TOKENS), hot)
    return packed.groupBy("bucket").applyInArrow(_counter(hot), "owner long, token long, df int")


# --- step 2: groups -----------------------------------------------------------------------


def _sets(table: pa.Table, name: str = "tokens") -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in table[name].to_pylist()]


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of one list with another, over slices of the tokens both hold."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out.astype(np.int64)
    known = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        owner, tokens = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        column = np.searchsorted(known, tokens)
        there = known[np.minimum(column, len(known) - 1)] == tokens if len(known) else np.zeros(len(tokens), bool)
        order = np.argsort(column[there], kind="stable")
        sides.append((owner[there][order], column[there][order], len(sets)))
    for first in range(0, len(known), 4096):
        dense = []
        for owner, column, n in sides:
            a, b = np.searchsorted(column, [first, first + 4096])
            part = np.zeros((n, 4096), np.float32)
            part[owner[a:b], column[a:b] - first] = 1
            dense.append(part)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def linked(both: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    return 100 * both >= LINK * (n_left[:, None] + n_right[None, :] - both)


def _group(table: pa.Table) -> pa.Table:
    """A column of the matrix (a row without b), and the links inside the group (rows with a and b)."""
    ids, n, sets = table["id"].to_numpy(), table["n"].to_numpy(), _sets(table)
    links = forest(linked(overlaps(sets, sets), n, n))
    return pa.table({
        "key": pa.array([table["key"][0].as_py()] * (len(links) + 1), pa.int64()), "part": pa.array([table["part"][0].as_py()] * (len(links) + 1), pa.int64()),
        "a": pa.array([None, *(int(ids[i]) for i, _ in links)], pa.int64()), "b": pa.array([None, *(int(ids[j]) for _, j in links)], pa.int64()),
        "members": pa.array([len(ids)] + [None] * len(links), pa.int64()), "least": pa.array([int(n.min())] + [None] * len(links), pa.int64()),
        "tokens": pa.array([np.unique(np.concatenate(sets)).tobytes()] + [None] * len(links), pa.binary())})


# --- step 3: bound, open ------------------------------------------------------------------


def _bound(table: pa.Table) -> pa.Table:
    """Which queries may have a link into the group, from its stored union alone."""
    is_group = table["is_group"].to_numpy(zero_copy_only=False)
    column = table.filter(pa.array(is_group))
    queries = table.filter(pa.array(~is_group))
    union, least = _sets(column)[0], column["n"][0].as_py()
    kept = []
    for tokens, n in zip(_sets(queries), queries["n"].to_pylist()):
        at = np.searchsorted(union, tokens)
        kept.append(int((union[np.minimum(at, len(union) - 1)] == tokens).sum()) * 100 >= LINK * max(n, least))
    return queries.filter(pa.array(kept, pa.bool_())).select(["key", "part", "id"])


def _open(table: pa.Table) -> pa.Table:
    """Links of the queries with the members of one group."""
    is_group = table["is_group"].to_numpy(zero_copy_only=False)
    members, queries = table.filter(pa.array(is_group)), table.filter(pa.array(~is_group))
    m, q = members["id"].to_numpy(), queries["id"].to_numpy()
    links = linked(overlaps(_sets(queries), _sets(members)), queries["n"].to_numpy(), members["n"].to_numpy())
    square = np.zeros((len(q) + len(m),) * 2, bool) if len(q) + len(m) <= 4000 else None
    if square is None:
        found = np.argwhere(links)
        return pa.table({"a": q[found[:, 0]], "b": m[found[:, 1]]})
    square[:len(q), len(q):], square[len(q):, :len(q)] = links, links.T
    both = np.concatenate([q, m])
    found = np.array(forest(square), np.int64).reshape(-1, 2)
    return pa.table({"a": both[found[:, 0]], "b": both[found[:, 1]]})


def _met(asked: DataFrame, sets: DataFrame, groups: DataFrame, out: str, function) -> DataFrame:
    """function over each group (rows of groups: key, part, id, n, tokens) and its
    queries asked (key, part, id), these in blocks of bounded size."""
    size = sets.select("id", F.octet_length("tokens").alias("bytes"))
    blocks = asked.join(size, "id").groupBy("key", "part").agg(F.ceil(F.sum("bytes") / (8 * QUERIES_TOKENS)).cast("int").alias("blocks"))
    queries = asked.join(blocks, ["key", "part"]).join(sets.select("id", "n", "tokens"), "id").select(
        "key", "part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "n", "tokens", F.lit(False).alias("is_group"))
    met = groups.join(blocks, ["key", "part"]).select(
        "key", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "n", "tokens", F.lit(True).alias("is_group"))
    # A block may have got no query.
    some = queries.select("key", "part", "block").distinct()
    return queries.unionByName(met.join(some, ["key", "part", "block"], "left_semi")).groupBy("key", "part", "block").applyInArrow(function, out)


def _asked(asked: DataFrame, sets: DataFrame, matrix: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of asked (key, part, id) and the members of the groups they may open."""
    columns = matrix.select("key", "part", F.lit(None).cast("long").alias("id"), F.col("least").alias("n"), "tokens")
    open_ = written(_met(asked, sets, columns, "key long, part long, id long", _bound))
    members = sets.select("key", "part", "id", "n", "tokens")
    return written(_met(open_, sets, members, "a long, b long", _open))


def links_of(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) with the components of all links; classes (id, n, owner), entries (owner, token, df)."""
    held = entries.groupBy("owner").agg(F.count(F.lit(1)).alias("shared"))
    able = written(classes.join(held, "owner").where(100 * F.col("shared") >= LINK * F.col("n")))
    own = entries.join(able, "owner").select("id", "n", "shared", "token", "df")
    prefix_size = F.col("n") - F.ceil(F.lit(LINK) * F.col("n") / 100) + 1 - (F.col("n") - F.col("shared"))
    # Tokens of no other class come first in the order; they are no entries.
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "token"))
    ranked = written(own.withColumn("first", rank <= prefix_size).drop("shared"))
    packed = ranked.groupBy("id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("token")).alias("all"))
    keyed = packed.mapInArrow(_pack, "id long, n long, key long, tokens binary")
    keyed = written(keyed)
    sizes = keyed.groupBy("key").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / GROUP_CLASSES), F.ceil(F.sum(F.octet_length("tokens")) / (8 * GROUP_TOKENS))).alias("parts"))
    sets = written(keyed.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("long")).drop("parts"))
    grouped = written(sets.groupBy("key", "part").applyInArrow(
        _group, "key long, part long, a long, b long, members long, least long, tokens binary"))
    matrix = grouped.where(F.col("a").isNull()).drop("a", "b")
    links = grouped.where(F.col("a").isNotNull()).select("a", "b")
    places = sets.select("id", "key", "part")
    prefix = ranked.where("first").select("token", "id").join(places, "id")
    rows = prefix.groupBy("token", "key", "part").agg(F.count(F.lit(1)).alias("classes"))
    rows = written(rows.join(matrix.select("key", "part", "members"), ["key", "part"]))
    # First the largest group of each token.
    star = rows.groupBy("token").agg(F.max(F.struct("members", "key", "part")).alias("g"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    star = star.select("token", F.col("g.key").alias("key"), F.col("g.part").alias("part"))
    outside = lambda df: df.where((F.col("key") != F.col("own_key")) | (F.col("part") != F.col("own_part")))
    query = prefix.select("token", "id", F.col("key").alias("own_key"), F.col("part").alias("own_part"))
    first = written(outside(query.join(star, "token")).select("key", "part", "id").distinct())
    links = links.unionByName(_asked(first, sets, matrix))
    # Then what is still apart.
    label = components(links).withColumnRenamed("component", "label")
    state = written(prefix.join(label, "id", "left").withColumn("label", F.coalesce("label", "id")))
    per_label = state.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
    major = per_label.groupBy("token").agg(F.max(F.struct("c", "label"))["label"].alias("major"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    mixed_tokens = written(major.select("token", "major"))
    group_label = state.groupBy("token", "key", "part").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    strays = state.join(mixed_tokens, "token").where(F.col("label") != F.col("major")).select(
        "token", "id", "label", F.col("key").alias("own_key"), F.col("part").alias("own_part"))
    rest = outside(strays.join(group_label, "token")).where((F.col("lo") != F.col("label")) | (F.col("hi") != F.col("label")))
    rest = written(rest.select("key", "part", "id").distinct().join(first, ["key", "part", "id"], "left_anti"))
    return links.unionByName(_asked(rest, sets, matrix))


def _pack(batches):
    """Sorted tokens of each class as bytes, and the smallest hash among them."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lists = batch.column(2)
        flat, offsets = lists.flatten().to_numpy().view(np.uint64), np.cumsum([0] + [len(x) for x in lists])
        sets = [np.sort(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
        # Another hash than the order of the tokens, which also chose the first ones.
        key = [int(mixed(s).min()) >> 1 for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(key, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                         names=["id", "n", "key", "tokens"])


# --- step 4: documents --------------------------------------------------------------------


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of docs (doc_id, text)."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(per_text(narrow, "text", "r", SIZED, _sizer).select("doc_id", "r.*"))
    full = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    copies = written(full.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")))
    owner = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    classes = copies.select("id", "n", owner.alias("owner"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    entries = written(shared_entries(narrow.select(F.col("text").cast("binary").alias("t")), total, hot_tokens(rows)))
    links = links_of(entries, classes)
    # Rows with one doc_id in different classes tie those classes together.
    repeated = copies.where("copies > 1").select("digest", "id")
    same = full.groupBy("doc_id").agg(F.count_distinct("digest").alias("classes")).where("classes > 1").select("doc_id")
    ties = full.join(same, "doc_id", "left_semi").join(copies.select("digest", "id"), "digest").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.unionByName(ties))
    own = rows.join(repeated, "digest", "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("first"))
    return own.join(found.withColumnRenamed("id", "first"), "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"))
