"""Nearest vectors: order, ties and recall against brute force."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgermill.llm import nearest as module
from ledgermill.llm.nearest import nearest


def brute(rows, top):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if q % 20 == 0:
            scores = sorted((-float(good[q] @ good[i]), i) for i in good if i != q)
            out[q] = [(i, -s) for s, i in scores[:top]]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    expected, got = brute(rows.items(), 20), by_query(nearest(table, F.col("id") % 20 == 0))
    assert set(got) == set(expected)
    hits = 0
    for q, found in got.items():
        assert len(found) == 20
        assert all(abs(s - float(np.dot(np.array(rows[q], float), np.array(rows[i], float)))) < 1e-12 for i, s in found)
        assert [(-s, i) for i, s in found] == sorted((-s, i) for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in expected[q]})
    assert hits / (20 * len(got)) >= 0.9


def test_odd_rows(spark):
    copy = [1.0, 2.0, 0.0]
    rows = [(0, copy), (20, copy), (40, [0.0, 0.0, 5.0])] + [(i, copy) for i in range(100, 140)]
    rows += [(1, None), (2, []), (60, [0.0, 0.0, 0.0]), (3, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]), (4, [float("inf"), 0.0, 1.0])]
    rows += [(5, [1.0, 1.0]), (None, copy), (6, [-3.0, 0.1, 0.2]), (7, [1e-3, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")
    rows = [(i, v) for i, v in rows if i != 5]
    expected, got = brute(rows, 20), by_query(nearest(frame, F.col("id") % 20 == 0))
    assert set(got) == {0, 20, 40, 100, 120}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in expected[q]]
    few = frame.filter("vec_id in (0, 20, 6)")
    assert [i for i, _ in by_query(nearest(few, F.col("id") % 20 == 0))[0]] == [20, 6]
    assert nearest(frame.filter("vec_id < 0"), F.col("id") % 20 == 0).count() == 0


def spread(count, dim=48, seed=7):
    vectors = np.random.default_rng(seed).standard_normal((count, dim))
    return (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)


def test_work_of_large_slices():
    """Of many vectors without any structure, a query's tables hold a small share, and the neighbours they promise."""
    rows, queries, near = 500_000, 800_000, 0.6
    hashing = module.chosen(64, near, rows, queries)
    assert hashing.tables * 0.5 * math.erfc(hashing.cut / 2) < 0.06
    asked = spread(2_000, 64)
    # Pairs of a query and a vector with the inner product ``near``.
    aside = spread(2_000, 64, seed=8)
    aside -= (aside * asked).sum(axis=1)[:, None] * asked
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    vectors = (near * asked + math.sqrt(1 - near * near) * aside).astype(np.float32)
    met, visited = np.zeros(len(asked), bool), 0
    for t in range(hashing.tables):
        cells, who = hashing.visits(asked, t)
        visited += len(who)
        met[who[cells == hashing.cells(vectors, np.zeros(len(vectors), np.float32), t)[who]]] = True
    assert abs(met.mean() - module.SUCCESS) < 0.02
    assert visited / len(asked) < 40 * hashing.tables


def test_tables_rounds_and_all_rows_agree(spark, monkeypatch):
    """Many slices in several rounds return little for a query, and what a whole comparison finds."""
    vectors = spread(6_000)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(module, "SLICE_ROWS", 400)
    monkeypatch.setattr(module, "HEAD", 3)
    monkeypatch.setattr(module, "TOGETHER", 70)
    whole = by_query(nearest(frame, F.col("id") % 20 == 0))
    expected = brute([(i, v.tolist()) for i, v in enumerate(vectors)], 20)
    assert {q: [i for i, _ in x] for q, x in whole.items()} == {q: [i for i, _ in x] for q, x in expected.items()}
    seen = []

    def tables(dim, near, rows, queries):
        seen.append((near, rows, queries))
        return module.Hashing(dim, 24, 4, 1.5)

    monkeypatch.setattr(module, "chosen", tables)
    hashed = by_query(nearest(frame, F.col("id") % 20 == 0))
    assert seen[0][1:] == (400, 300) and 0.2 < seen[0][0] < 0.5
    assert set(hashed) == set(expected) and all(len(x) == 20 for x in hashed.values())
    hits = sum(len({i for i, _ in x} & {i for i, _ in expected[q]}) for q, x in hashed.items())
    assert hits / (20 * len(expected)) > 0.95
    scores = {(q, i): s for q, x in expected.items() for i, s in x}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, x in hashed.items() for i, s in x if (q, i) in scores)


def test_slice_finds_exact_best_and_takes_a_bound():
    vectors, queries = spread(3_000), spread(50, seed=9)
    ids = np.arange(len(vectors))
    here = module._Slice([(ids, ids, ids, vectors)], 1.0, None)
    exact = queries.astype(float) @ vectors.astype(float).T
    best = np.sort(exact, axis=1)[:, ::-1]
    q, v, score = here.search(queries, np.full(len(queries), -np.inf), 21)
    assert set(Counter(q.tolist()).values()) == {21}
    assert np.abs(score - best[:, :21].ravel()).max() < 1e-12
    assert np.abs(exact[q, v] - score).max() < 1e-12
    q, v, score = here.search(queries, best[:, 4], 21)
    assert set(Counter(q.tolist()).values()) <= {4, 5} and len(q) > 4 * len(queries)


def test_tables_that_find_too_few_are_made_up_for(spark, monkeypatch):
    rows = [(i, v.tolist()) for i, v in enumerate(spread(500))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(module, "chosen", lambda dim, near, rows, queries: module.Hashing(dim, 1, 8, 50.0))
    expected, got = brute(rows, 20), by_query(nearest(frame, F.col("id") % 20 == 0))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in expected.items()}


def test_copies_and_an_id_with_several_vectors(spark):
    """A query's class has many copies, and its id has other vectors, which are no neighbours of its own."""
    rows = [(i, [1.0, float(i % 3)]) for i in range(600)] + [(0, [1.0, 1.5]), (0, [1.0, 0.5]), (20, [3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = by_query(nearest(frame.filter("vec_id > 20"), F.col("id") % 20 == 0))
    expected = brute([r for r in rows if r[0] > 20], 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in expected.items()}
    for q, x in by_query(nearest(frame.filter("vec_id < 40"), F.col("id") == 0)).items():
        assert len(x) == 20 and q not in {i for i, _ in x}
