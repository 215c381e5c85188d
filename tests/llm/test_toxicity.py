"""Segments against the recursive definition, and held-out accuracy."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.llm.toxicity import fit, held_out, maximal_segments, score_toxicity


def by_definition(scores):
    """The best segment, then the same to its left and right."""
    if not scores:
        return []
    best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    if best[0] <= 0:
        return []
    a = -best[2]
    b = a - best[1]
    return by_definition(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in by_definition(scores[b:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-60, 60), max_size=14))
def test_segments_are_the_maximal_ones(values):
    # Distinct tiny parts keep sums apart, so there is one answer.
    scores = [v + math.sqrt(i + 2) / 97 for i, v in enumerate(values)]
    assert [(a, b) for a, b, _ in maximal_segments(np.array(scores))] == by_definition(scores)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = score_toxicity(docs, fit(docs, labels))
    rows = scored.join(labels, "doc_id").filter(held_out("doc_id")).select("score", "toxic").collect()
    bad, good = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    above = sum(sum(x > y for y in good) + 0.5 * sum(x == y for y in good) for x in bad)
    assert above / (len(bad) * len(good)) > 0.95
    assert sum(x >= 0.3 for x in bad) > 0.9 * len(bad)
    assert sum(x >= 0.3 for x in good) < 0.04 * len(good)


def test_odd_rows(spark, texts_frame):
    plain = [(i, f"alpha beta gamma delta w{i % 7} x{i % 5}") for i in range(60)]
    rude = [(100 + i, f"alpha beta idiot gamma IDIOT! w{i % 7} idiot## x{i % 5}") for i in range(30)]
    odd = [(None, None), (200, None), (201, ""), (202, " \n\t"), (203, "### 123"), (204, "idiot " * 50_000), (204, "idiot " * 50_000)]
    docs = texts_frame(plain + rude + odd).withColumn("score", F.lit("x")).withColumn("label", F.lit("y"))
    labels = spark.createDataFrame(
        [(i, 0, 0) for i, _ in plain] + [(i, 0, 1) for i, _ in rude] + [(None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int"
    )
    rows = score_toxicity(docs, fit(docs, labels)).collect()
    assert len(rows) == docs.count()
    scores = {r.doc_id: r.score for r in rows}
    assert all(0 <= s <= 1 for s in scores.values())
    assert min(scores[i] for i, _ in rude) > max(scores[i] for i, _ in plain)
    assert scores[200] == scores[201] == scores[202] == scores[None] < scores[204]
    spans = next(r.passages for r in rows if r.doc_id == 100)
    assert [(p.start, p.end) for p in spans] and all(0 <= p.start < p.end <= 8 for p in spans)
    assert score_toxicity(docs.limit(0), fit(docs.limit(0), labels.limit(0))).count() == 0
