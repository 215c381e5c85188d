"""Approximate nearest neighbours by multiprobe hashing with Gaussian, that is 2-stable, projections.

Largest inner product becomes least Euclidean distance: vectors are scaled by the largest norm and get
one more component that brings them to the unit sphere, queries are scaled to it. A hash table draws two sets
of Gaussian directions; a vector lies in the cell of the two directions, one of each set and with their sign,
along which it reaches farthest. A query visits all cells whose two directions add up to ``cut`` or more for it.
For a neighbour at a given inner product this sum depends on the draw of the directions only, whatever the data
are, so the cut that finds a share ``SUCCESS`` of such neighbours follows from the number of tables. The inner
product of the farthest wanted neighbours is taken from some sampled vectors that are compared with all others.
Number of tables and directions are those of least expected work; where that is no less than comparing all
with all, this is done instead.

Equal vectors are one class with its smallest ids. Classes are dealt at random into slices that a task holds in
memory, in all tables; queries stream past them. Scores of single precision choose the candidates, with a margin
for their error; what they are judged by is the exact inner product in double precision. A query takes its worst
find so far along to later slices, so these return few rows. Queries for which too few were found are
compared with every class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ledgermill.session import small_batches, stored

#: Share of the neighbours at the sampled distance that the tables together find.
SUCCESS = 1 - (1 - 0.85) ** 2
#: Classes of a slice at most, and of one of up to SLICES slices at least; slices of the first round.
SLICE_ROWS, LEAST_ROWS, SLICES, HEAD = 500_000, 4_096, 8, 8
#: Queries that are searched together, and finds for each, on average, that wait to be ranked.
TOGETHER, WAITING = 100_000, 20
#: Rows of a slice that give a first bound, and sides of a block of scores.
FIRST, BLOCK_QUERIES, BLOCK_ROWS = 2_048, 1_024, 4_096
#: Sampled vectors that look for their neighbours among all.
SAMPLE_QUERIES = 400
#: Choices of tables and of directions in each of a table's two sets.
TABLES, DIRECTIONS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32), (2, 4, 6, 8, 12, 16, 24, 32, 48)
#: Nanoseconds for a pair's score, for a query in a table, for its visit to a cell, and for a cell.
PAIR_NS, PROBE_NS, VISIT_NS, CELL_NS = 4, 600, 100, 25_000


class Hashing:
    """The tables' directions, and the sum from which on a query visits a cell."""

    def __init__(self, dim: int, tables: int, directions: int, cut: float, seed: int = 11):
        random = np.random.Generator(np.random.PCG64(seed))
        a = random.standard_normal((tables, 2, directions, dim + 1))
        self.a = (a * (math.sqrt(dim + 1) / np.linalg.norm(a, axis=3, keepdims=True))).astype(np.float32)
        self.tables, self.directions, self.cut = tables, directions, np.float32(cut)

    def cells(self, points: np.ndarray, rest: np.ndarray, table: int) -> np.ndarray:
        """Cells of points whose last component is ``rest``."""
        code = []
        for a in self.a[table]:
            along = points @ a[:, :-1].T + rest[:, None] * a[:, -1]
            best = np.abs(along).argmax(axis=1)
            code.append(best + self.directions * (along[np.arange(len(best)), best] < 0))
        return code[0] * 2 * self.directions + code[1]

    def visits(self, queries: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells in ascending order, and the query that visits each. The queries' last component is 0."""
        cells, who = [], []
        for s in range(0, len(queries), BLOCK_ROWS):
            one, two = (queries[s : s + BLOCK_ROWS] @ a[:, :-1].T for a in self.a[table])
            one, two = np.hstack([one, -one]), np.hstack([two, -two])
            side = two.shape[1]
            need = self.cut - one
            q, i = np.divmod(np.flatnonzero((need <= two.max(axis=1)[:, None]).ravel()), side)
            at, j = np.divmod(np.flatnonzero((two.take(q, axis=0) >= need[q, i][:, None]).ravel()), side)
            cells.append((i[at] * side + j).astype(np.uint16))  # (2 * 48)^2 at most
            who.append((q[at] + s).astype(np.int32))
        cells, who = np.concatenate(cells), np.concatenate(who)
        order = np.argsort(cells, kind="stable")
        return cells[order], who[order]


def _true(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a mask most of whose rows are false."""
    rows = np.flatnonzero(mask.any(axis=1))
    at, columns = np.divmod(np.flatnonzero(mask.take(rows, axis=0).ravel()), mask.shape[1])
    return rows[at], columns


def chosen(dim: int, near: float, rows: int, queries: int, draws: int = 20_000) -> Hashing | None:
    """The cheapest tables for slices of ``rows`` and inner products of ``near``; None if all is to be compared.

    Directions have the length of the root of their dimension D. A vector reaches M1 + M2 along those of its cell, the
    largest of its projections. A query with the inner product c to it reaches c (M1 + M2) plus about a normal variable of
    variance (1 - c^2) (2 D - M1^2 - M2^2) / (D - 1) there, and one that has nothing to do with it a variable of variance 2.
    """
    random = np.random.Generator(np.random.PCG64(3))
    size = dim + 1
    together = min(TOGETHER, queries)
    best, choice = PAIR_NS * rows, None
    for directions in DIRECTIONS:
        one = random.standard_normal((2, draws, directions))
        rest = random.chisquare(max(1, size - 1), (2, draws, directions))
        reach = np.abs(one / np.sqrt((one * one + rest) / size)).max(axis=2)
        spread = (2 * size - (reach * reach).sum(axis=0)) / max(1, size - 1)
        near_by = near * reach.sum(axis=0) + np.sqrt(max(0.0, 1 - near * near) * spread) * random.standard_normal(draws)
        for tables in TABLES:
            cut = float(np.quantile(near_by, (1 - SUCCESS) ** (1 / tables)))
            share = 0.5 * math.erfc(cut / 2)
            cells = (2 * directions) ** 2
            cost = tables * (share * (PAIR_NS * rows + VISIT_NS * cells) + PROBE_NS + CELL_NS * cells / together)
            if cost < best:
                best, choice = cost, (tables, directions, cut)
    return choice and Hashing(dim, *choice)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector of doubles, or of floats as they are) of the rows that take part."""
    floats = isinstance(table.schema[vector_col].dataType.elementType, FloatType)
    kind = "float" if floats else "double"
    vector = F.col(vector_col).cast(f"array<{kind}>")
    # Looking for NaN gives null if there is none but a null. NaN is above infinity.
    low, high, inf = F.array_min("vector"), F.array_max("vector"), float("inf")
    sound = ~F.array_contains("vector", F.lit(float("nan")).cast(kind)) & (low > -inf) & (high < inf)
    rows = table.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    present = F.col("id").isNotNull() & F.col("vector").isNotNull()
    return rows.filter(present & sound & ((low != 0) | (high != 0)))


def _near(classes: DataFrame, norm: float, top: int) -> float:
    """Inner product on the unit sphere that nine of ten sampled vectors reach with ``top`` others."""
    few = _matrix(classes.orderBy("c1", "c2").limit(SAMPLE_QUERIES).select("vector").toArrow().column("vector")).astype(np.float64)
    few = (few / np.linalg.norm(few, axis=1)[:, None]).astype(np.float32)
    shared = classes.sparkSession.sparkContext.broadcast(few)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = shared.value
        held = np.empty((len(few), 0), np.float32)
        for batch in batches:
            if batch.num_rows:
                vectors = (_matrix(batch.column("vector")) / norm).astype(np.float32)
                held = np.hstack([held, few @ vectors.T])
                if held.shape[1] > top + 1:
                    held = -np.partition(-held, top, axis=1)[:, : top + 1]
        who = np.repeat(np.arange(len(few), dtype=np.int32), held.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(held.ravel().astype(np.float64))], ["who", "score"])

    scores = classes.select("vector").mapInArrow(best, "who int, score double")
    order = Window.partitionBy("who").orderBy(F.desc("score"))
    worst = scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top + 1).groupBy("who").agg(F.min("score").alias("score"))
    return float(np.quantile([r["score"] for r in worst.collect()], 0.1))


class _Slice:
    """Classes of a slice, in the cells of all tables, and the search among them."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]], norm: float, hashing: Hashing | None):
        self.c1, self.c2, self.id = (np.concatenate([p[k] for p in parts]) for k in range(3))
        self.scale = 2.0 ** math.ceil(math.log2(norm))  # a power of two: floats divided by it are the same numbers
        dim = parts[0][3].shape[1]
        self.scan = np.ones((len(self.id), dim + 1), np.float32)  # the last column takes the query's bound
        at = 0
        for p in parts:
            self.scan[at : at + len(p[3]), :dim] = p[3] / p[3].dtype.type(self.scale)
            at += len(p[3])
        self.whole = None if parts[0][3].dtype == np.float32 else np.concatenate([p[3] for p in parts])
        self.margin = np.float32(1.2e-7 * (dim + 16))
        self.hashing, self.tables = hashing, []
        for t in range(hashing.tables if hashing else 0):
            cells = np.empty(len(self.id), np.uint16)  # (2 * 48)^2 at most
            for s in range(0, len(cells), 50_000):
                points = self.scan[s : s + 50_000, :dim]
                rest = np.sqrt(np.maximum(0, np.float32(norm / self.scale) ** 2 - np.einsum("ij,ij->i", points, points)))
                cells[s : s + 50_000] = hashing.cells(points, rest, t)
            starts = np.concatenate([[0], np.cumsum(np.bincount(cells, minlength=4 * hashing.directions**2))])
            self.tables.append((np.argsort(cells, kind="stable").astype(np.int32), starts))

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return self.scan[rows, :-1].astype(np.float64) * self.scale if self.whole is None else self.whole[rows]

    def visits(self, queries: np.ndarray):
        """(queries, rows) that are to be compared."""
        if self.hashing is None:
            for s in range(0, len(queries), BLOCK_QUERIES):
                for v in range(0, len(self.id), BLOCK_ROWS):
                    yield np.arange(s, min(s + BLOCK_QUERIES, len(queries))), np.arange(v, min(v + BLOCK_ROWS, len(self.id)))
        for t, (order, starts) in enumerate(self.tables):
            cells, who = self.hashing.visits(queries, t)
            first = np.flatnonzero(np.diff(cells, prepend=-1))
            last = np.append(first, len(cells))[1:]
            for cell, a, b in zip(cells[first].tolist(), first.tolist(), last.tolist(), strict=True):
                low, high = int(starts[cell]), int(starts[cell + 1])
                for s in range(a, b if high > low else a, BLOCK_QUERIES):
                    for v in range(low, high, BLOCK_ROWS):
                        yield who[s : min(s + BLOCK_QUERIES, b)], order[v : min(v + BLOCK_ROWS, high)]

    def search(self, queries: np.ndarray, least: np.ndarray, top: int):
        """(query, row, score) of the ``top`` best rows of each query, of those that it visits and that reach its ``least``."""
        count, dim = len(self.id), queries.shape[1]
        norms = np.linalg.norm(queries.astype(np.float64), axis=1)
        asked = np.empty((len(queries), dim + 1), np.float32)
        asked[:, :dim] = queries / norms[:, None]
        # Scores of the scan are at least -1. A first bound comes from any rows, as they are dealt at random.
        asked[:, dim] = np.minimum(4, self.margin - least / norms / self.scale)
        open_ = np.flatnonzero(least == -np.inf)
        for s in range(0, len(open_) if count >= top else 0, BLOCK_QUERIES):
            who = open_[s : s + BLOCK_QUERIES]
            scores = asked[who, :dim] @ self.scan[:FIRST, :dim].T
            asked[who, dim] = 2 * self.margin - np.partition(scores, -top, axis=1)[:, -top]
        keys, scores, new, waiting = np.empty(0, np.int64), np.empty(0, np.float32), [], 0

        def settle():
            """The best ``top`` so far by the scan, with all within its error, and the new bounds."""
            k, x = np.concatenate([keys, *(n[0] for n in new)]), np.concatenate([scores, *(n[1] for n in new)])
            order = np.argsort(k, kind="stable")
            k, x = k[order], x[order]
            once = np.diff(k, prepend=-1) != 0
            k, x = k[once], x[once]
            q = k // count
            order = np.lexsort((-x, q))
            k, x, q = k[order], x[order], q[order]
            full = np.arange(len(q)) - np.searchsorted(q, q) == top - 1
            asked[q[full], dim] = np.minimum(asked[q[full], dim], 2 * self.margin - x[full])
            reach = x + asked[q, dim] >= 0
            return k[reach], x[reach]

        block, mask = np.empty(BLOCK_QUERIES * BLOCK_ROWS, np.float32), np.empty(BLOCK_QUERIES * BLOCK_ROWS, bool)
        for who, rows in self.visits(asked[:, :dim]):
            part, size, shape = asked.take(who, axis=0), len(who) * len(rows), (len(who), len(rows))
            above = np.matmul(part, self.scan.take(rows, axis=0).T, out=block[:size].reshape(shape))
            q, v = _true(np.greater_equal(above, 0, out=mask[:size].reshape(shape)))
            if len(q):
                new.append((who[q].astype(np.int64) * count + rows[v], above[q, v] - part[q, dim]))
                waiting += len(q)
                if waiting > WAITING * len(queries):
                    keys, scores = settle()
                    new, waiting = [], 0
        keys, scores = settle()
        exact = np.empty(len(keys))
        for s in range(0, len(keys), 20_000):
            q, v = np.divmod(keys[s : s + 20_000], count)
            # The score is summed in one order for a pair, wherever it is found.
            exact[s : s + 20_000] = np.einsum("ij,ij->i", queries[q].astype(np.float64), self.vectors(v))
        q, v = np.divmod(keys, count)
        order = np.lexsort((self.id[v], -exact, q))
        q, v, exact = q[order], v[order], exact[order]
        keep = (np.arange(len(q)) - np.searchsorted(q, q) < top) & (exact >= least[q])
        return q[keep], v[keep], exact[keep]


FOUND = "q long, c1 long, c2 long, id long, score double"


def _search(top: int, norm: float, shared):
    """Rows in the order of slice and kind, classes (0) before queries (1) -> the best classes of each query in a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, classes, asked, queries, waiting = None, [], None, [], 0

        def found():
            nonlocal asked, classes, queries, waiting
            if queries and (classes or asked):
                asked = asked or _Slice(classes, norm, shared.value)
                classes = []
                q, vectors, least = (np.concatenate(x) for x in zip(*queries, strict=True))
                who, rows, score = asked.search(vectors, least, top)
                for s in range(0, len(who), 100_000):
                    w, r = who[s : s + 100_000], rows[s : s + 100_000]
                    columns = [q[w], asked.c1[r], asked.c2[r], asked.id[r], score[s : s + 100_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["q", "c1", "c2", "id", "score"])
            queries, waiting = [], 0

        for batch in batches:
            place = batch.column("slice").to_numpy() * 2 + batch.column("kind").to_numpy()
            starts = np.flatnonzero(np.diff(place, prepend=-1)) if len(place) else []
            for s, e in zip(starts, [*starts[1:], len(place)], strict=True):
                part = batch.slice(s, e - s)
                if place[s] // 2 != here:
                    yield from found()
                    here, classes, asked = place[s] // 2, [], None
                vectors = _matrix(part.column("vector"))
                numbers = [np.array(part.column(x).to_numpy()) for x in ("c1", "c2", "id")]
                if place[s] % 2 == 0:
                    classes.append((*numbers, np.array(vectors)))
                else:
                    queries.append((numbers[2], np.array(vectors), part.column("least").to_numpy()))
                    waiting += len(vectors)
                    if waiting >= TOGETHER:
                        yield from found()
        yield from found()

    return run


def nearest(
    table: DataFrame, is_query, top: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, ``id_col``, score: the ``top`` nearest found for each query, nearest first.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but the query's own; nearness is
    the inner product in double precision, ties go to the smaller id. If there are no more than
    ``top`` candidates, all are returned.

    Rows with a null id, and vectors null, empty, zero or holding null or non-finite components take
    no part, nor do vectors whose length is not the commonest (the largest among equally common). Repeated
    vectors are candidates for each other; rows that share an id are one row if their vectors agree. Other
    columns are ignored, and an empty table gives an empty result.
    """
    spark = table.sparkSession
    rows = valid_vectors(table, id_col, vector_col)
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    common = lengths.first()
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    if common is None:
        return empty
    dim = common["n"]
    rows = rows.filter(F.size("vector") == dim).select(
        "id", "vector", F.xxhash64("vector").alias("c1"), F.xxhash64(F.lit(1), "vector").alias("c2")
    )
    classes = stored(rows.groupBy("c1", "c2").agg(F.min("id").alias("id"), F.any_value("vector").alias("vector")))
    ids = stored(rows.select("c1", "c2", "id").distinct())
    smallest = Window.partitionBy("c1", "c2").orderBy("id")
    members = ids.withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= top + 1)
    queries = ids.filter(is_query)
    norm2 = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, largest = classes.agg(F.count("*"), F.max(norm2)).first()
    norm = math.sqrt(largest) or 1.0
    asked = classes.join(queries.select("c1", "c2").distinct(), ["c1", "c2"], "left_semi")
    asked = stored(asked.select(F.monotonically_increasing_id().alias("q"), "c1", "c2", "vector"))
    slices = max(-(-total // SLICE_ROWS), min(SLICES, -(-total // LEAST_ROWS)))
    hashing = chosen(dim, _near(classes, norm, top), -(-total // slices), asked.count())
    dealt = classes.select(
        F.pmod("c1", F.lit(slices)).cast("int").alias("slice"), F.lit(0).alias("kind"), "c1", "c2", "id", "vector",
        F.lit(0.0).alias("least"),
    )

    def search(asked: DataFrame, low: int, high: int, hashing: Hashing | None) -> DataFrame:
        """FOUND: the best of each query in each of the slices from ``low`` to below ``high``."""
        passing = asked.select(
            F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("slice"), F.lit(1).alias("kind"), "c1", "c2",
            F.col("q").alias("id"), "vector", "least",
        )
        here = dealt.filter(F.col("slice").between(low, high - 1)).union(passing)
        here = here.repartitionById(high - low, F.col("slice") - low).sortWithinPartitions("slice", "kind")
        shared = spark.sparkContext.broadcast(hashing)  # tables * 2 * directions * dim numbers
        return here.mapInArrow(_search(top + 1, norm, shared), FOUND)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        return stored(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top + 1).drop("place"))

    small_batches(spark)
    free = F.lit(float("-inf"))
    found, done = None, 0
    while done < slices:
        more = min(slices, max(HEAD, 3 * done))
        if found is None:
            found = best(search(asked.withColumn("least", free), 0, more, hashing))
        else:
            least = found.groupBy(F.col("q").alias("of")).agg(F.count("*").alias("have"), F.min("score").alias("worst"))
            bound = F.when(F.col("have") > top, F.col("worst")).otherwise(free)
            bounded = asked.join(least, F.col("q") == F.col("of"), "left").withColumn("least", bound)
            found = best(found.union(search(bounded, done, more, hashing)))
        done = more

    # Too few found: compared with all classes.
    if hashing is not None:
        have = found.groupBy("q").agg(F.count("*").alias("have")).filter(F.col("have") >= min(top + 1, total))
        short = stored(asked.join(have, "q", "left_anti").withColumn("least", free))
        if not short.isEmpty():
            found = best(found.join(short.select("q"), "q", "left_anti").union(search(short, 0, slices, None)))
    # Members of a query's classes; more than can be wanted by the ids of the query's class are not joined with them.
    # A query leaves out its own id, which comes so often as it has vectors.
    of = Window.partitionBy("q")
    listed = (
        found.select("q", "c1", "c2", "score")
        .join(members.select("c1", "c2", "id"), ["c1", "c2"])
        .withColumn("nth", F.row_number().over(of.orderBy(F.desc("score"), "id")))
        .withColumn("times", F.count("*").over(Window.partitionBy("q", "id")))
        .withColumn("most", F.max("times").over(of))
        .filter(F.col("nth") <= top + F.col("most"))
        .select("q", "id", "score")
    )
    asking = asked.select("q", "c1", "c2").join(queries.withColumnRenamed("id", "query_id"), ["c1", "c2"]).select("q", "query_id")
    wanted = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        listed.join(asking, "q")
        .filter("query_id <> id")
        .withColumn("rank", F.row_number().over(wanted).cast("int"))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
