"""Nearest neighbours, approximate or exact, and a weighted vote.

The index is an inverted file: vectors lie in cells around pivots, about as many
as the square root of their number.  A cell with more than ``block`` rows gets
pivots of its own, chosen among its rows and as many as it has blocks, so that
cells stay balanced where vectors crowd together, and where the table outgrows
``MOST_PIVOTS``.  With ``probes`` a query visits that many cells, the ones
whose pivots are nearest, and ``recall`` says what the search finds.  Without, it
visits every cell that can hold one of its k best neighbours: the triangle
inequality bounds the similarity inside a cell from its pivot and radius, so
nothing that counts is left out.  In many dimensions that bound excludes little,
so the exact form compares nearly all queries with all rows: its time is their
product, its memory is bounded, and its shuffle is queries times rows over
``block * EXACT_BLOCKS``.  A caller may set ``EXACT_QUERIES``, above which it raises.

Visits are grouped by cell first and cut into blocks of ``block`` queries there.
An index row is sent once to each block of visits of its cell, a query once to
each block of rows of the cells it visits.  With cells of at most a block that is
(visits + rows) index rows in all, where visits = probes x queries; no term grows
with the square of the table.  Copies of one vector cannot be told apart by
pivots; their cell is cut into blocks of rows instead.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv
from tickloom.operators.windows import first_n
from tickloom.session import checkpoint_dir
from tickloom.sources.tables import write_table

DIGITS = 6
MOST_PIVOTS = 4096
PIVOT_BYTES = 256 << 20  # of all pivots of the second level, as doubles
EXACT_QUERIES: int | None = None  # a caller may set a number above which the exact form raises
EXACT_BLOCKS = 16  # blocks of neighbouring cells that a task takes together where most cells are visited
CHUNK = 512  # vectors whose distances to all pivots are held at a time
TILE = 8192  # index rows that are compared with CHUNK queries at a time
GROUP = 32
PAIRS = 200_000  # pairs scored with double precision at a time
FEW = 32  # values of a boost that become dimensions
SLACK = 2e-5  # more than the rounding of a product of unit vectors in single precision, with boosts


def _unit(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype="float64") for v in vectors])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1, norm)


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (m @ pivots.T), 0.0))


def _once(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, computed once."""
    return write_table(df, f"{checkpoint_dir(df.sparkSession)}/scratch/{name}-{uuid.uuid4().hex}")


def _codes(ours: pd.Series, theirs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Both columns as numbers that are equal where the values are; NULL is -1, of theirs -2."""
    codes = pd.factorize(pd.concat([ours, theirs], ignore_index=True))[0]
    mine, other = codes[:len(ours)], codes[len(ours):]
    return mine, np.where(other < 0, -2, other)


def _ones(codes: np.ndarray, known: np.ndarray, gain: float) -> np.ndarray:
    return gain * (codes[:, None] == known[None, :]).astype("float32")


def _best(q: np.ndarray, x: np.ndarray, same: list, q_key: np.ndarray, x_key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in q and x of the k best pairs of every query, and their rounded scores.

    x is in the order of its keys, which decides ties.  A tile of pairs is scored
    with single precision first; what comes near the k-th best of its query is
    scored again with double precision, so the outcome is that of double precision.
    A boost of few values is part of the product, as a dimension for each value;
    one of many is added at the equal pairs.
    """
    few = [(gain, a, b, np.unique(b[b >= 0])) for gain, a, b in same]
    many = [(gain, a, b) for gain, a, b, known in few if len(known) > FEW]
    few = [f for f in few if len(f[3]) <= FEW]
    q32 = np.hstack([q.astype("float32"), *[_ones(a, known, 1.0) for _, a, _, known in few]])
    x32 = np.hstack([x.astype("float32"), *[_ones(b, known, gain) for gain, _, b, known in few]])
    out = []
    for start in range(0, len(q), CHUNK):
        asked = slice(start, start + CHUNK)
        n = len(q32[asked])
        at, found, score = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        floor = np.full(n, -np.inf)
        for left in range(0, len(x), TILE):
            near = q32[asked] @ x32[left:left + TILE].T
            for gain, a, b in many:
                order = np.argsort(b[left:left + TILE], kind="stable")
                ordered, wanted = b[left:left + TILE][order], a[asked]
                first = np.searchsorted(ordered, wanted, "left")
                count = np.searchsorted(ordered, wanted, "right") - first
                row = np.repeat(np.arange(n), count)
                near[row, order[np.arange(len(row)) - np.repeat(np.cumsum(count) - count - first, count)]] += gain
            groups = near.shape[1] // GROUP
            if groups > k:  # the largest of each of k + 1 groups: one may be the query itself
                tops = near[:, :groups * GROUP].reshape(n, groups, GROUP).max(axis=2)
                floor = np.maximum(floor, np.partition(tops, groups - k - 1, axis=1)[:, groups - k - 1])
            row, column = np.nonzero(near >= (floor - SLACK)[:, None])
            exact = np.empty(len(row))
            for some in range(0, len(row), PAIRS):
                r, c = row[some:some + PAIRS] + start, column[some:some + PAIRS] + left
                value = np.einsum("ij,ij->i", q[r], x[c])
                for gain, a, b in same:
                    value += gain * (a[r] == b[c])
                exact[some:some + PAIRS] = np.where(q_key[r] == x_key[c], -np.inf, np.round(value, DIGITS))
            own = np.isfinite(exact)
            at, found, score = (np.concatenate(p) for p in ((at, row[own]), (found, column[own] + left), (score, exact[own])))
            order = np.lexsort((found, -score, at))
            at, found, score = at[order], found[order], score[order]
            place = np.arange(len(at)) - np.searchsorted(at, at, "left")
            kept = place < k
            at, found, score, place = at[kept], found[kept], score[kept], place[kept]
            last = place == k - 1
            floor[at[last]] = np.maximum(floor[at[last]], score[last])
        out.append((at + start, found, score))
    return tuple(np.concatenate(p) for p in zip(*out))


class Cells:
    """Pivots of one or two levels, radius and number of rows of every cell."""

    def __init__(self, first: np.ndarray) -> None:
        self.first = self.pivots = first
        self.children: dict[int, np.ndarray] = {}
        self.radius, self.size = np.zeros(len(first)), np.zeros(len(first), "int64")

    def split(self, cell: np.ndarray, vectors: np.ndarray) -> None:
        """Add second-level pivots below their first-level cells."""
        for c in np.unique(cell):
            own = len(self.pivots) + np.arange((cell == c).sum())
            self.pivots = np.concatenate([self.pivots, vectors[cell == c]])
            self.children[int(c)] = np.concatenate([[c], own])

    def place(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and distance from its pivot."""
        d = _distances(m, self.first)
        cell, dist = d.argmin(axis=1), d.min(axis=1)
        for c in np.intersect1d(cell, list(self.children)):
            at = np.flatnonzero(cell == c)
            d = _distances(m[at], self.pivots[self.children[int(c)]])
            cell[at], dist[at] = self.children[int(c)][d.argmin(axis=1)], d.min(axis=1)
        return cell, dist

    def nearest(self, m: np.ndarray, probes: int) -> list[np.ndarray]:
        """The cells with the nearest pivots, of those that hold rows."""
        d = np.where(self.size > 0, _distances(m, self.pivots), np.inf)
        count = min(probes, int((self.size > 0).sum()))
        return list(np.argsort(d, axis=1, kind="stable")[:, :count].astype("int32"))

    def bundles(self, most: int) -> np.ndarray:
        """For every cell the task that takes it: cells in the order of their distance
        from the first pivot, until they have about so many rows."""
        order = np.argsort(_distances(self.pivots, self.first[:1])[:, 0], kind="stable")
        before = np.cumsum(self.size[order]) - self.size[order]
        out = np.empty(len(order), "int32")
        out[order] = before // most
        return out

    def possible(self, m: np.ndarray, k: int, boost: float) -> list[np.ndarray]:
        """All cells that can hold one of the k best, whatever the boosts are."""
        d = _distances(m, self.pivots)
        far = d + self.radius
        order = np.argsort(far, axis=1)
        # The query itself may be in the index, hence more than k.
        enough = np.cumsum(self.size[order], axis=1) > k
        place_k = np.where(enough.any(axis=1), enough.argmax(axis=1), len(self.pivots) - 1)
        reach = np.take_along_axis(np.take_along_axis(far, order, 1), place_k[:, None], 1)
        floor = np.where(enough.any(axis=1)[:, None], 1.0 - reach**2 / 2.0, -np.inf)
        best = 1.0 - np.maximum(d - self.radius, 0.0) ** 2 / 2.0 + boost
        # The slack covers the rounding of both scores.
        visit = (best >= floor - 2 * 10.0**-DIGITS) & (self.size > 0)
        return [np.flatnonzero(r).astype("int32") for r in visit]


def _chunks(v: pd.Series):
    for start in range(0, len(v), CHUNK):
        yield _unit(v.iloc[start:start + CHUNK])


def _placed(index: DataFrame, cells: Cells, vector: str) -> DataFrame:
    @F.pandas_udf("cell int, dist double")
    def place(v: pd.Series) -> pd.DataFrame:
        parts = [cells.place(m) for m in _chunks(v)]
        return pd.DataFrame({"cell": np.concatenate([p[0] for p in parts]).astype("int32"), "dist": np.concatenate([p[1] for p in parts])})

    return index.withColumn("_p", place(F.col(vector)))


def build_cells(index: DataFrame, key: str, vector: str, pivots: int | None = None, block: int = 4096) -> Cells:
    """The cells of an index: rows chosen by hash as pivots, and more of them in large cells."""
    cells = Cells(pivot_vectors(index, key, vector, pivots))
    sizes = {r["cell"]: r["n"] for r in _placed(index, cells, vector).groupBy("_p.cell").agg(F.count("*").alias("n")).collect()}
    large = {c: n for c, n in sizes.items() if n > block}
    if large:
        # A row becomes a pivot by chance; the expected number is one a block, and bounded as a whole.
        most = PIVOT_BYTES // (8 * cells.first.shape[1])
        share = min(1.0, most / sum(2 * n / block for n in large.values()))
        table = index.sparkSession.createDataFrame([(c, min(1.0, 2 * share / block)) for c in large], "cell int, share double")
        chance = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        chosen = _placed(index, cells, vector).select(F.col("_p.cell").alias("cell"), F.col(vector).alias("v"), chance.alias("chance")).join(
            table, "cell").filter("chance < share").select("cell", "v").distinct().orderBy("cell", "v").collect()
        if chosen:
            cells.split(np.array([r["cell"] for r in chosen]), _unit([r["v"] for r in chosen]))
    return cells


def sides(queries: DataFrame, index: DataFrame, cells: Cells, k: int, key: str, vector: str, label: str,
          boosts: dict[str, float], probes: int | None, block: int) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Queries and index rows by (cell, block, query_block), what a task compares; names of boost columns of the index."""
    # Queries and index may be the same table: the index side gets names of its own.
    theirs = {b: f"_index_{b}" for b in boosts}
    rows = _once(_placed(index, cells, vector).select(
        F.col(key).alias("neighbour"), F.col(vector).alias("_w"), F.col(label).alias("label"),
        *[F.col(b).alias(other) for b, other in theirs.items()], "_p"), "placed")
    cells.radius, cells.size = np.zeros(len(cells.pivots)), np.zeros(len(cells.pivots), "int64")
    for r in rows.groupBy("_p.cell").agg(F.max("_p.dist").alias("radius"), F.count("*").alias("n")).collect():
        cells.radius[r["cell"]], cells.size[r["cell"]] = r["radius"], r["n"]
    most = sum(boosts.values())

    # Who visits most cells, as the exact form does, is sent once to a task of neighbouring ones.
    together = probes is None or 2 * probes > len(cells.pivots)
    wide = block * EXACT_BLOCKS if together else block
    task_of = cells.bundles(wide) if together else np.arange(len(cells.pivots), dtype="int32")

    @F.pandas_udf("array<int>")
    def to_visit(v: pd.Series) -> pd.Series:
        return pd.Series([np.unique(task_of[x]) for m in _chunks(v) for x in (cells.possible(m, k, most) if probes is None else cells.nearest(m, probes))])

    if together:
        @F.pandas_udf("int")
        def bundle(cell: pd.Series) -> pd.Series:
            return pd.Series(task_of[cell.to_numpy()])

        rows = rows.withColumn("_p", F.struct(bundle(F.col("_p.cell")).alias("cell")))

    asked = _once(queries.select(
        F.col(key).alias("query"), F.col(vector).alias("_v"), *boosts, to_visit(F.col(vector)).alias("cells")), "asked")
    blocks_of = lambda n: F.greatest(F.lit(1), F.ceil(n / wide)).cast("int")
    # A row a cell.
    visits = asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(blocks_of(F.count("*")).alias("query_blocks"))
    blocks = rows.groupBy(F.col("_p.cell").alias("cell")).agg(blocks_of(F.count("*")).alias("blocks"))
    plan = visits.join(blocks, "cell")
    some = lambda name, many: F.pmod(F.xxhash64(name), F.col(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    query_side = asked.select("query", "_v", *boosts, F.explode("cells").alias("cell")).join(plan, "cell").select(
        "query", "_v", *boosts, "cell", some("query", "query_blocks").alias("query_block"), every("blocks").alias("block"))
    index_side = rows.select("neighbour", "_w", "label", *theirs.values(), F.col("_p.cell").alias("cell")).join(plan, "cell").select(
        "neighbour", "_w", "label", *theirs.values(), "cell", some("neighbour", "blocks").alias("block"), every("query_blocks").alias("query_block"))
    return query_side, index_side, theirs


def nearest(queries: DataFrame, index: DataFrame, k: int = fv.NEIGHBOURS, key: str = "key",
            vector: str = "embedding", label: str = "label", boosts: dict[str, float] | None = None,
            pivots: int | None = None, block: int = 4096, probes: int | None = None) -> DataFrame:
    """ML-15a: the ``k`` best index rows per query by cosine plus metadata boosts.

    A boost is added when the column is equal on both sides.  A query is not
    its own neighbour.  Scores are rounded to six digits; ties go to the
    smaller key.
    """
    boosts = dict(boosts or {})
    if probes is None and EXACT_QUERIES is not None and queries.count() > EXACT_QUERIES:
        raise ValueError(f"exact search takes up to {EXACT_QUERIES} queries; pass probes, or a smaller batch")
    cells = build_cells(index, key, vector, pivots, block)
    query_side, index_side, theirs = sides(queries, index, cells, k, key, vector, label, boosts, probes, block)

    def best_of_block(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({"query": q["query"].iloc[:0], "neighbour": x["neighbour"].iloc[:0],
                                 "score": pd.Series(dtype="float64"), "label": x["label"].iloc[:0]})
        x = x.sort_values("neighbour", kind="stable").reset_index(drop=True)
        same = [(gain, *_codes(q[column], x[theirs[column]])) for column, gain in boosts.items()]
        asked, found, score = _best(_unit(q["_v"]), _unit(x["_w"]), same, q["query"].to_numpy(), x["neighbour"].to_numpy(), k)
        return pd.DataFrame({"query": q["query"].to_numpy()[asked], "neighbour": x["neighbour"].to_numpy()[found],
                             "score": score, "label": x["label"].to_numpy()[found]})

    types = {**dict(queries.dtypes), **dict(index.dtypes)}
    schema = f"query {types[key]}, neighbour {types[key]}, score double, label {types[label]}"
    group = ["cell", "block", "query_block"]
    found = query_side.groupBy(*group).cogroup(index_side.groupBy(*group)).applyInPandas(best_of_block, schema)
    ranked = found.withColumn("_down", -F.col("score"))
    return first_n(ranked, ["query"], ["_down", "neighbour"], k).drop("_down")


def vote(neighbours: DataFrame, digits: int = 4) -> DataFrame:
    """ML-15b: class with the largest summed score and its share of the sum."""
    per_class = neighbours.groupBy("query", "label").agg(F.sum("score").alias("weight"))
    best = F.min_by("label", F.struct(-F.round("weight", DIGITS), F.col("label")))
    confidence = F.try_divide(F.max("weight"), F.sum("weight"))
    return per_class.groupBy("query").agg(
        best.alias("prediction"), F.round(confidence, digits).alias("confidence")
    )


def pivot_vectors(index: DataFrame, key: str, vector: str, pivots: int | None = None) -> np.ndarray:
    """Rows chosen by hash, a bounded number."""
    pivots = pivots or min(MOST_PIVOTS, math.ceil(math.sqrt(max(1, index.count()))))
    chosen = index.orderBy(F.md5(F.col(key).cast("string")), key).select(vector).limit(pivots).collect()
    if not chosen:
        raise ValueError("the index is empty")
    return _unit([r[0] for r in chosen])


def probes_for(queries: DataFrame, index: DataFrame, k: int = fv.NEIGHBOURS, key: str = "key", vector: str = "embedding",
               label: str = "label", boosts: dict[str, float] | None = None, target: float = 0.95, sample: int = 200) -> int:
    """Probes that find the share ``target`` of the exact neighbours of a bounded
    sample of queries: few where vectors lie in groups, most cells where they
    are spread evenly, as no index helps there."""
    cells = build_cells(index, key, vector)
    some = queries.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit("#"))), key).limit(sample)
    exact = nearest(some, index, k, key, vector, label, boosts)
    pairs = exact.select("query", "neighbour").join(
        index.select(F.col(key).alias("neighbour"), F.col(vector).alias("_w")), "neighbour").join(
        queries.select(F.col(key).alias("query"), F.col(vector).alias("_v")), "query").select("_v", "_w").collect()
    if not pairs:
        return 1
    cell, _ = cells.place(_unit([r["_w"] for r in pairs]))
    order = np.argsort(_distances(_unit([r["_v"] for r in pairs]), cells.pivots), axis=1, kind="stable")
    place = (order == cell[:, None]).argmax(axis=1)
    return int(np.quantile(place, target, method="higher")) + 1


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: exact neighbours, and the share of them that was found."""
    hit = found.select("query", "neighbour", F.lit(1).alias("hit"))
    return exact.join(hit, ["query", "neighbour"], "left").agg(
        F.count("*").alias("n"), (F.count("hit") / F.count("*")).alias("recall"))
