"""Nearest neighbours by inner product: multiprobe p-stable hashing, and exact distances among the candidates."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fisclake.llm.shared import stored

#: Rows of a segment of a hash table, and queries, that one task compares at a time.
ROWS, QUERIES = 16_384, 16_384
#: Vectors and queries of the sample that the index is fitted on.
SAMPLE, SAMPLE_QUERIES = 8192, 256
#: Numbers in one temporary array of a task: scores, cells visited, products of pairs. What a task holds doesn't grow with the cells.
AT_ONCE = 1 << 20
#: Rows by which a query that has found nothing yet gets its first bound, and rows of a batch that goes back to Spark.
FIRST_ROWS, BATCH = 4096, 10_000


@dataclass(frozen=True)
class Index:
    """Hash tables of ``k`` projections cut into cells of ``width``; a query visits the ``probes`` cells most likely to hold a vector at
    ``distance``. ``norms``: the largest norm of the vectors of each dimension."""

    k: int
    width: float
    tables: int
    probes: int
    distance: float
    norms: dict[int, float]
    segments: int = 1
    seed: int = 7

    def projections(self, dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, dim, table])
        return rng.standard_normal((dim + 1, self.k)), rng.random(self.k) * self.width

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Scaled into the unit ball, with one more component that brings each to its surface: nearest by distance is then largest by
        inner product with a query."""
        scaled = vectors / self.norms[vectors.shape[1]]
        return np.c_[scaled, np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))]

    def directions(self, queries: np.ndarray) -> np.ndarray:
        return np.c_[queries / np.sqrt((queries**2).sum(axis=1))[:, None], np.zeros(len(queries))]

    def cells(self, points: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each point, and how far into it the point lies."""
        a, shift = self.projections(points.shape[1] - 1, table)
        at = points @ a + shift
        cell = np.floor(at / self.width).astype(np.int64)
        return cell, at - cell * self.width

    def steps(self) -> np.ndarray:
        return np.array(list(itertools.product((-1, 0, 1), repeat=self.k)))

    def ranks(self, inside: np.ndarray) -> np.ndarray:
        """For each query, the place of each step in the order of estimated success: the probability that a vector at ``distance`` falls
        into that cell."""
        edges = np.stack([self.width * e - inside for e in (-1, 0, 1, 2)], axis=2) / self.distance
        chance = np.log(np.diff(normal(edges), axis=2) + 1e-12)
        steps = self.steps()
        total = sum(chance[:, j, :][:, steps[:, j] + 1] for j in range(self.k))
        return np.argsort(np.argsort(-total, axis=1, kind="stable"), axis=1, kind="stable")

    def step_between(self, query_cells: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the step from each query's cell to each row's, and whether there is one."""
        number, near = 0, True
        for j in range(self.k):
            d = cells[None, :, j] - query_cells[:, None, j]
            near = near & (np.abs(d) <= 1)
            number = number * 3 + d + 1
        return np.where(near, number, 0), near

    def key(self, cells: np.ndarray) -> np.ndarray:
        """A number for each cell. Two with the same one are looked at together."""
        value = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(self.k):
            value = (value ^ cells[..., j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        return value

    def segment(self, keys: np.ndarray) -> np.ndarray:
        return (keys % np.uint64(self.segments)).astype(np.int32)

    def visited(self, queries: np.ndarray, table: int) -> np.ndarray:
        """Keys of the cells that each query visits."""
        keys, size = np.zeros((len(queries), self.probes), np.uint64), self.block()
        for begin in range(0, len(queries), size):
            cell, inside = self.cells(self.directions(queries[begin : begin + size]), table)
            order = np.argsort(self.ranks(inside), axis=1)[:, : self.probes]
            keys[begin : begin + size] = self.key(cell[:, None, :] + self.steps()[order])
        return keys

    def block(self) -> int:
        """Queries whose steps are worked out at a time."""
        return max(1, AT_ONCE // (self.k * 3**self.k))


def normal(x: np.ndarray) -> np.ndarray:
    """Distribution function of the standard normal, to about 3e-4."""
    return 0.5 * (1 + np.tanh(0.7978845608028654 * (x + 0.044715 * x**3)))


def fit(sample: np.ndarray, norms: dict[int, float], count: int, wanted: float = 0.97, tables: int = 8, near: int = 20) -> Index:
    """The index, of up to ``tables`` tables, that looks at the fewest pairs of those that reach the recall ``wanted`` on the sample. A sample is sparser than the
    whole, its neighbours are farther away: the whole does better."""
    segments = max(1, -(-count // ROWS))
    queries = sample[:: max(1, len(sample) // SAMPLE_QUERIES)]
    own = np.arange(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))
    scores = queries @ sample.T
    scores[np.arange(len(own)), own] = -np.inf
    near = min(near, len(sample) - 1)
    best = Index(1, 1e9, 1, 3, 1.0, norms, segments)
    if near < 1:
        return best
    top = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    base = Index(1, 1.0, tables, 1, 1.0, norms, segments)
    lifted, directions = base.lifted(sample), base.directions(queries)
    distance = float(np.median(np.sqrt(np.maximum(((directions[:, None, :] - lifted[top]) ** 2).sum(axis=2).max(axis=1), 1e-12))))
    cost = np.inf
    for k in (2, 3, 4, 5, 6):
        for width in (0.7 * distance, distance, 1.5 * distance):
            index = Index(k, width, tables, 1, distance, norms, segments)
            first, pairs = np.full(scores.shape, 3**k), np.zeros(3**k + 1)
            for t in range(tables):
                cell, inside = index.cells(directions, t)
                number, near_by = index.step_between(cell, index.cells(lifted, t)[0])
                rank = np.where(near_by, np.take_along_axis(index.ranks(inside), number, axis=1), 3**k)
                pairs += np.bincount(rank.ravel(), minlength=3**k + 1)
                first = np.minimum(first, rank)
                recall = np.cumsum(np.bincount(np.take_along_axis(first, top, axis=1).ravel(), minlength=3**k + 1)[:-1]) / top.size
                enough = np.flatnonzero(recall >= wanted)
                if len(enough) and (looked := pairs[: enough[0] + 1].sum()) < cost:
                    cost, best = looked, Index(k, width, t + 1, int(enough[0]) + 1, distance, norms, segments)
    return best


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """No null, nothing infinite or not a number, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


class Best:
    """The ``most`` best rows of each query so far; of rows that tie, those with the smallest ``ids``.

    Matrix products only preselect: their last bits depend on the shape. The scores given back are summed in one order everywhere.
    """

    def __init__(self, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, most: int) -> None:
        self.queries, self.rows, self.ids, self.most = queries, rows, ids, most
        self.margin = 1e-12 * np.sqrt((queries**2).sum(axis=1)).max() * np.sqrt((rows**2).sum(axis=1)).max()
        self.least = np.full(len(queries), -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def look(self, queries: np.ndarray, rows: np.ndarray) -> None:
        """Compares some queries with some rows, both by number; no pair may come twice."""
        right = self.rows[rows].T
        size = max(1, AT_ONCE // max(1, len(rows)))
        for begin in range(0, len(queries), size):
            own = queries[begin : begin + size]
            scores = self.queries[own] @ right
            first = scores[:, : max(FIRST_ROWS, self.most)]
            if first.shape[1] >= self.most and np.isinf(self.least[own]).any():
                bound = np.partition(first, first.shape[1] - self.most, axis=1)[:, first.shape[1] - self.most]
                self.least[own] = np.maximum(self.least[own], bound - self.margin)  # the products' bound, not the sums'
            q, r = np.nonzero(scores >= self.least[own][:, None] - self.margin)
            self.parts.append((own[q], rows[r], scores[q, r]))
            self.held += len(q)
            if self.held > self.most * len(self.queries) + AT_ONCE:
                self.keep_best()

    def exact(self, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Scores of pairs, each summed in the same order."""
        found, size = np.zeros(len(q)), max(1, AT_ONCE // self.rows.shape[1])
        for begin in range(0, len(q), size):
            pair = slice(begin, begin + size)
            found[pair] = (self.queries[q[pair]] * self.rows[r[pair]]).sum(axis=1)
        return found

    def keep_best(self) -> None:
        if not self.parts:
            self.parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        q, r, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        order = np.lexsort((-score, q))
        q, r, score = q[order], r[order], score[order]
        last = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == self.most - 1)
        self.least[q[last]] = np.maximum(self.least[q[last]], score[last] - self.margin)
        near = score >= self.least[q] - self.margin
        q, r = q[near], r[near]
        score = self.exact(q, r)
        order = np.lexsort((self.ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < self.most
        self.parts, self.held = [(q[kept], r[kept], score[kept])], int(kept.sum())

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.keep_best()
        return self.parts[0]


_FOUND = "query long, vec_id long, score double"


def _answer(left: pa.Table, right: pa.Table, best: Best, most: int) -> pa.Table:
    """The ``most`` best ids of each query; ``left`` are the rows, each with the ids it stands for."""
    whole = best.result()
    ids = left["ids"].combine_chunks()
    offsets, values, asked = np.asarray(ids.offsets), np.asarray(ids.values), np.asarray(right["query"])
    step = max(1, AT_ONCE // most**2)
    parts = []
    for begin in range(0, len(asked), step):  # a row may stand for as many ids as are wanted
        part = slice(*np.searchsorted(whole[0], (begin, begin + step)))
        q, r, score = (x[part] for x in whole)
        size = np.diff(offsets)[r]
        flat = np.repeat(offsets[r] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        found = pa.table(
            {"query": asked[np.repeat(q, size)], "vec_id": values[flat] if len(flat) else np.zeros(0, np.int64), "score": np.repeat(score, size)}
        )
        found = found.sort_by([("query", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
        query = np.asarray(found["query"])
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        parts.append(found.filter(pa.array(nth < most)))
    return pa.concat_tables(parts)


def _first_ids(left: pa.Table) -> np.ndarray:
    """The smallest id that each row stands for."""
    ids = left["ids"].combine_chunks()
    return np.asarray(ids.values)[np.asarray(ids.offsets)[:-1]]


def _search(classes: DataFrame, queries: DataFrame, index: Index, most: int) -> DataFrame:
    """The ``most`` best of each query among the rows in the cells it visits."""

    def hashed(columns: list[str], visit: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = np.asarray(batch.column("dim"))
                for dim in np.unique(dims):
                    rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
                    vectors = matrix(rows.column("vector"))
                    for t in range(index.tables):
                        if visit:
                            segments = np.sort(index.segment(index.visited(vectors, t)), axis=1)
                            new = np.c_[np.ones(len(segments), bool), np.diff(segments, axis=1) != 0]
                            row, segment = np.nonzero(new)[0], segments[new]
                        else:
                            row, segment = np.arange(len(vectors)), index.segment(index.key(index.cells(index.lifted(vectors), t)[0]))
                        for begin in range(0, len(row), BATCH):  # a query goes to many segments
                            part, where = rows.take(pa.array(row[begin : begin + BATCH])), segment[begin : begin + BATCH].astype(np.int32)
                            yield pa.RecordBatch.from_arrays(
                                [*(part.column(c) for c in columns), pa.array(np.full(len(where), t, np.int32)), pa.array(where)], [*columns, "tab", "segment"]
                            )

        return run

    vector = dict(classes.dtypes)["vector"]
    cell = ["dim", "tab", "segment"]
    count = lambda df, visit, size, name: (
        df.select("dim", "vector").mapInArrow(hashed(["dim"], visit), "dim int, tab int, segment int").groupBy(*cell).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    )
    sizes = stored(count(classes, False, ROWS, "parts").join(count(queries, True, QUERIES, "groups"), cell), "segments")
    rows = classes.mapInArrow(hashed(["ids", "dim", "vector"], False), f"ids array<long>, dim int, vector {vector}, tab int, segment int").join(sizes, cell)
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.col("ids")[0]), "parts").cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    asked = queries.mapInArrow(hashed(["query", "dim", "vector"], True), f"query long, dim int, vector {vector}, tab int, segment int").join(sizes, cell)
    asked = asked.withColumn("group", F.pmod(F.xxhash64("query"), "groups").cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        t = key[1].as_py()
        if not len(left) or not len(right):
            return pa.table({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        queries, rows = matrix(right["vector"]), matrix(left["vector"])
        own = index.key(index.cells(index.lifted(rows), t)[0])
        order = np.argsort(own, kind="stable")
        keys, first = np.unique(own[order], return_index=True)
        best = Best(queries, rows, _first_ids(left), most)
        step = max(1, AT_ONCE // index.probes)
        for begin in range(0, len(queries), step):
            visited = index.visited(queries[begin : begin + step], t)
            cell = np.searchsorted(keys, visited)
            there = keys[np.minimum(cell, len(keys) - 1)] == visited
            pairs = np.unique(cell[there] * len(visited) + np.nonzero(there)[0])  # a cell is visited once, whatever keys agree
            for part in np.split(pairs, np.flatnonzero(np.diff(pairs // len(visited))) + 1) if len(pairs) else ():
                c = int(part[0] // len(visited))
                best.look(begin + part % len(visited), order[first[c] : first[c + 1] if c + 1 < len(keys) else None])
        return _answer(left, right, best, most)

    by = [*cell, "part", "group"]
    return rows.select(*by, "ids", "vector").groupBy(*by).cogroup(asked.select(*by, "query", "vector").groupBy(*by)).applyInArrow(run, _FOUND)


def _scan(classes: DataFrame, queries: DataFrame, blocks: int, groups: int, most: int) -> DataFrame:
    """The ``most`` best of each query among all rows: each block of rows meets each group of queries in a task of its own."""
    rows = classes.withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(blocks)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = queries.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        queries, rows = matrix(right["vector"]), matrix(left["vector"])
        best = Best(queries, rows, _first_ids(left), most)
        best.look(np.arange(len(queries)), np.arange(len(rows)))
        return _answer(left, right, best, most)

    by = ["dim", "block", "group"]
    return rows.select(*by, "ids", "vector").groupBy(*by).cogroup(asked.select(*by, "query", "vector").groupBy(*by)).applyInArrow(run, _FOUND)


def nearest(
    vectors: DataFrame, queries: Column, near: int = 20, id_column: str = "vec_id", vector: str = "embedding", wanted: float = 0.97, tables: int = 8
) -> DataFrame:
    """The ``near`` rows with the largest inner product for each row where ``queries`` (a condition on ``id_column``) holds:
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id.

    Vectors are hashed into ``tables`` tables of cells; a query visits cells in the order of their estimated success and compares itself
    with all they hold, in double precision. How many cells is fitted to a sample of ``SAMPLE`` vectors. Queries that find fewer than
    ``near`` are held against all rows, in blocks. Segments and queries are dealt out in groups of bounded size, and equal vectors are
    compared once: the ``near + 1`` smallest ids stand for them, which are all that can matter.

    Vectors that are null, zero, or hold a null, infinite or undefined component take no part, nor do rows without id. Of rows with the same id the
    one with the smallest vector counts. Only vectors of the same length are compared. A query is no neighbour of its own. Fewer rows
    than ``near``: all of them. No rows: no rows. Other columns, whatever their names, are not looked at.
    """
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast(kind).alias("vector")).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = stored(rows.groupBy("id").agg(F.min("vector").alias("vector")), "vectors")
    smallest = Window.partitionBy("vector").orderBy("id")
    classes = rows.withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= near + 1).groupBy("vector")
    classes = stored(classes.agg(F.sort_array(F.collect_list("id")).alias("ids")).select("ids", F.size("vector").alias("dim"), "vector"), "vector-classes")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    dims = {r["dim"]: (r["n"], r["norm"], r["ids"]) for r in classes.groupBy("dim").agg(F.count("*").alias("n"), F.max(length).alias("norm"), F.sum(F.size("ids")).alias("ids")).collect()}
    members = rows.filter(queries).join(classes.select("vector", F.col("ids")[0].alias("query")), "vector").select(F.col("id").alias("query_id"), "query", F.size("vector").alias("dim"))
    members = stored(members, "query-members")
    asked = stored(classes.join(members.select("query").distinct(), F.col("ids")[0] == F.col("query"), "left_semi").select(F.col("ids")[0].alias("query"), "dim", "vector"), "queries")
    most = near + 1
    if dims:
        common = max(dims, key=lambda d: dims[d][0])
        sample = classes.filter(F.col("dim") == common).orderBy(F.xxhash64(F.col("ids")[0])).limit(SAMPLE).select("vector").collect()
        count = sum(n for n, *_ in dims.values())
        norms = {d: norm for d, (_, norm, _) in dims.items()}
        index = fit(np.array([r["vector"] for r in sample], np.float64), norms, count, wanted, tables, near)
        found = stored(_search(classes, asked, index, most), "found")
        # With as many as this found, or all there are, a query has its neighbours.
        reach = F.create_map(*(F.lit(x) for d in dims for x in (d, min(most, dims[d][2]))))
        reached = found.select("query", "vec_id").distinct().groupBy("query").agg(F.count("*").alias("n"))
        short = asked.join(reached, "query", "left").filter(F.coalesce("n", F.lit(0)) < F.element_at(reach, F.col("dim"))).select("query", "dim", "vector")
        short = stored(short, "short-queries")
        if n_short := short.count():
            found = found.union(_scan(classes, short, -(-count // ROWS), -(-n_short // QUERIES), most))
    else:
        found = vectors.sparkSession.createDataFrame([], _FOUND)
    order = [F.desc("score"), F.asc("vec_id")]
    best = found.distinct().withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("nth") <= most)
    pairs = members.join(best, "query").filter("query_id <> vec_id")
    # Without its own id a query keeps its order: one place less behind it.
    own = best.select("query", F.col("vec_id").alias("query_id"), F.col("nth").alias("own"))
    ranked = pairs.join(own, ["query", "query_id"], "left").withColumn("rank", (F.col("nth") - F.coalesce((F.col("own") < F.col("nth")).cast("int"), F.lit(0))).cast("int"))
    return ranked.filter(F.col("rank") <= near).select("query_id", "rank", "vec_id", "score")
