"""Centroid clustering with the dimensions dealt over shards.

A vector is cut into column blocks. A task of one block knows that block's slice of every centroid and
nothing else; it returns exact partial distances of its rows. The partial distances of a vector are
added, and the nearest centroid is taken from the sums. The assignment goes back to the blocks, and
each block makes its own slice of the new centroids from sums and counts that its tasks add up first, so
a cluster that holds nearly all rows is a few rows in the shuffle. All of it is integer arithmetic.

What leaves the executors is one centroid table a round: ``k`` times the number of dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.session import stored

CLUSTERS, ROUNDS, DIMENSIONS, BLOCK, SCALE = 16, 3, 64, 16, 64
#: Whole components from here on have squared distances that do not fit 64 bits.
LARGE = 2**26


def _sound(vector: Column, dimensions: int, scale: int) -> Column:
    """Whether a vector has the right length and only numbers whose distances can be computed."""
    each = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < F.lit(float(LARGE)))
    )
    return vector.isNotNull() & (F.size(vector) == dimensions) & F.coalesce(each, F.lit(False))


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """``row`` (a number of its own), ``id``, ``whole``: the vectors that take part, as integers."""
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    rows = rows.filter(_sound(F.col("vector"), dimensions, scale))
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", whole.alias("whole")))


def first_centroids(vectors: DataFrame, clusters: int) -> list[list[int]]:
    """The ``clusters`` vectors with the least hashes of their ids; equal ids by their components."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(name, 256).alias("draw"), "whole").orderBy("draw", "whole").limit(clusters)
    return [list(r.whole) for r in first.collect()]


def column_blocks(vectors: DataFrame, dimensions: int, block: int) -> DataFrame:
    """``row``, ``block``, ``slice``: every vector cut into its column blocks, stored block by block.

    The blocks lie one behind the other, so an Arrow batch belongs to one block but where two meet.
    """
    cut = F.array(*(
        F.struct(F.lit(b).alias("block"), F.slice("whole", b * block + 1, block).alias("slice"))
        for b in range(-(-dimensions // block))
    ))
    rows = vectors.select("row", F.inline(cut)).sortWithinPartitions("block")
    return stored(rows)


def _slices(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    blocks = batch.column("block").to_numpy()
    for b in np.unique(blocks).tolist():
        yield b, batch.filter(pa.array(blocks == b))


def partial_distances(blocks: DataFrame, centroids: list[list[int]], block: int) -> DataFrame:
    """``row``, ``d0``, ``d1``, ...: squared distances within one block to the slices of all centroids."""
    held = np.array(centroids, np.int64)
    names = [f"d{j}" for j in range(len(centroids))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, part in _by_block(batch):
                x = _slices(part.column("slice"))
                away = [((x - c) ** 2).sum(axis=1) for c in held[:, b * block : (b + 1) * block]]
                yield pa.RecordBatch.from_arrays([part.column("row"), *map(pa.array, away)], ["row", *names])

    return blocks.mapInArrow(run, ", ".join(["row long", *(f"{n} long" for n in names)]))


def nearest_centroid(partial: DataFrame) -> DataFrame:
    """``row``, ``cluster``, ``distance``: the blocks' distances added; ties go to the smaller number."""
    names = partial.columns[1:]
    added = partial.groupBy("row").agg(*(F.sum(n).alias(n) for n in names))
    # Fields compare in order, and so do equal distances by their cluster.
    each = [F.struct(F.col(n).alias("distance"), F.lit(j).alias("cluster")) for j, n in enumerate(names)]
    best = F.array_min(F.array(*each))
    return added.select("row", best.alias("best")).select("row", "best.cluster", "best.distance")


def moved(blocks: DataFrame, assigned: DataFrame, centroids: list[list[int]], block: int) -> list[list[int]]:
    """Every block's slice of the new centroids: floor(sum / count); an empty cluster stays where it is."""
    clusters = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in _by_block(batch):
                x, cluster = _slices(part.column("slice")), part.column("cluster").to_numpy()
                if b not in sums:
                    sums[b], counts[b] = np.zeros((clusters, x.shape[1]), np.int64), np.zeros(clusters, np.int64)
                np.add.at(sums[b], cluster, x)
                counts[b] += np.bincount(cluster, minlength=clusters)
        rows = [
            (b * block + d, c, int(sums[b][c, d]), int(counts[b][c]))
            for b in sums for c in np.flatnonzero(counts[b]).tolist() for d in range(sums[b].shape[1])
        ]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("dimension", "cluster", "total", "held"), r, strict=True)) for r in rows],
            pa.schema([("dimension", pa.int32()), ("cluster", pa.int32()), ("total", pa.int64()), ("held", pa.int64())]),
        )

    tasks = blocks.join(assigned.select("row", "cluster"), "row").select("block", "slice", "cluster")
    tasks = tasks.mapInArrow(run, "dimension int, cluster int, total long, held long")
    # Sums of many tasks may pass 64 bits; the quotient cannot.
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    added = tasks.groupBy("cluster", "dimension").agg(total.alias("total"), F.sum("held").alias("held"))
    new = [list(c) for c in centroids]
    for r in added.collect():  # at most one row for each component of each centroid
        new[r.cluster][r.dimension] = int(r.total) // r.held
    return new


def cluster_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    block: int = BLOCK,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each vector that takes part.

    A component x becomes floor(scale * x). The first centroids are the vectors with the least SHA-256 of
    ``1:<id>``; each round assigns every vector to the nearest centroid (squared distance, ties to the
    smaller number) and moves every non-empty centroid to floor(sum / count); after ``rounds`` rounds
    vectors are assigned once more. ``centroid_sha256`` is over the components joined by commas.

    Vectors that are null, have another length, or hold null, non-finite or huge components (2^26 or
    more after scaling, whose distances would not fit 64 bits) take no part. Rows that repeat an id are
    vectors of their own; a null id is hashed as ``1:``. Fewer vectors than ``clusters`` give as many
    centroids as there are vectors, and an empty table gives no rows. An inertia beyond 64 bits is null. Other
    columns are ignored.
    """
    vectors = whole_vectors(table, id_col, vector_col, dimensions, scale)
    centroids = first_centroids(vectors, clusters)
    if not centroids:
        schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return table.sparkSession.createDataFrame([], schema)
    blocks = column_blocks(vectors, dimensions, block)
    for _ in range(rounds):
        assigned = nearest_centroid(partial_distances(blocks, centroids, block))
        centroids = moved(blocks, stored(assigned), centroids, block)
    assigned = stored(nearest_centroid(partial_distances(blocks, centroids, block)))

    whole = F.col("distance").cast("decimal(38,0)")
    # One row for each cluster.
    totals = assigned.groupBy("cluster").agg(F.sum(whole).alias("total"))
    inertia = F.expr("try_cast(sum(total) over () as bigint)")
    totals = totals.select("cluster", F.expr("try_cast(total as bigint)").alias("cluster_inertia"), inertia.alias("inertia"))
    names = table.sparkSession.createDataFrame(
        [(j, ",".join(map(str, c))) for j, c in enumerate(centroids)], "cluster int, components string"
    ).select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    return (
        assigned.join(vectors.select("row", F.col("id").alias("vec_id")), "row")
        # Both have a row for each centroid.
        .join(F.broadcast(totals), "cluster")
        .join(F.broadcast(names), "cluster")
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )
