"""Clustering against plain Python: every distance, centroid and tie."""

import hashlib
import math

from ledgermill.llm.centroids import cluster_vectors


def by_hand(rows, dims=64, scale=64, clusters=16, rounds=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x * scale) < 2**26 for x in v):
            kept.append((i, [math.floor(scale * float(x)) for x in v]))
    draw = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [list(v) for _, v in draw[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = [j for _, j in assign()]
        for j in range(len(centroids)):
            members = [v for (_, v), k in zip(kept, own, strict=True) if k == j]
            if members:
                centroids[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    final = assign()
    inertia = [sum(d for d, k in final if k == j) for j in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i is not None, i or 0), j, d, inertia[j], sum(inertia), names[j]) for (i, _), (d, j) in zip(kept, final, strict=True)
    )


def found(df):
    return sorted(
        ((r.vec_id is not None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
        for r in df.collect()
    )


def test_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert found(cluster_vectors(table)) == by_hand([(r.vec_id, r.embedding) for r in table.collect()])


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, row string, cluster string, block int"
    make = lambda rows: spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], schema)
    few = [(i, [float((i * 7 + d * d) % 11 - 5) / 8 for d in range(4)]) for i in range(60)]
    odd = [
        (None, [0.5, -0.5, 0.25, 1.0]), (None, None), (7, few[7][1]), (7, few[7][1]), (100, []), (101, [1.0, 2.0, 3.0]),
        (102, [1.0, None, 3.0, 4.0]), (103, [float("nan")] * 4), (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [-1e30, 0.0, 0.0, 0.0]),
        (106, [0.0] * 4), (-3, [-0.001, 0.001, -1.0, 1.0]),
    ]
    for rows in (few + odd, odd, [(1, [1.0, 2.0, 3.0, 4.0])] * 40):
        for block in (1, 3, 4):
            got = found(cluster_vectors(make(rows), dimensions=4, block=block, clusters=5))
            assert got == by_hand(rows, dims=4, clusters=5)
    assert found(cluster_vectors(make(few), dimensions=4, clusters=0)) == []
    assert cluster_vectors(make([])).count() == 0
    assert cluster_vectors(make([(1, None)])).columns[0] == "vec_id"
