"""What travels to Python is bounded in bytes, and what the driver gets of it by rows."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import toxicity
from ledgermill.llm.decontaminate import find_leaks
from ledgermill.llm.minhash import near_duplicates
from ledgermill.llm.mixing import mix_sources
from ledgermill.session import BATCH, BATCH_SIZE


def leaks(docs):
    return find_leaks(docs, docs.select(F.col("doc_id").alias("item_id"), "text").limit(1))


def scored(docs):
    return toxicity.score_toxicity(docs, toxicity.Model({}, 1.0, 1.0, (0.0, 0.0)))


def fitted(docs):
    return toxicity.fit(docs, docs.select("doc_id", F.lit(1).alias("toxic")))


@pytest.mark.parametrize("operator", [scored, fitted, near_duplicates, leaks, mix_sources])
def test_batches_for_python_are_bounded_by_bytes(spark, conf, texts_frame, operator):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    conf(**{BATCH_SIZE.replace(".", "__"): "64m"})
    operator(texts_frame([(1, "some words of a text"), (2, None)]))
    wide = spark.range(0, 6000, 1, 1).select("id", F.expr("repeat('abcdefgh ', 400)").alias("text"))
    found = wide.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in found) == 6000
    assert max(r.bytes for r in found) <= 1.1 * BATCH


def test_a_smaller_batch_stays(spark, conf, texts_frame):
    conf(**{BATCH_SIZE.replace(".", "__"): "1m"})
    mix_sources(texts_frame([(1, "some words")]))
    assert spark.conf.get(BATCH_SIZE) == "1m"


def test_forms_travel_before_a_task_has_counted_all(monkeypatch):
    rows = [(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} shared", i % 2, i % 3 == 0) for i in range(100)]
    batch = pa.table({"text": [t for t, _, _ in rows], "half": [h for _, h, _ in rows], "label": [int(x) for _, _, x in rows]}).to_batches()[0]

    def sums():
        total, parts = Counter(), list(toxicity._form_counts([batch]))
        for part in parts:
            for r in part.to_pylist():
                total.update({(r["form"], side): r[side] for side in toxicity.SIDES})
        return total, max(len(set(p.column("form").to_pylist())) for p in parts), len(parts)

    whole, most, n = sums()
    monkeypatch.setattr(toxicity, "COUNTED", 20)
    parts, fewer, several = sums()
    assert whole == parts and n == 1 and several > 1 and fewer < most
    assert sum(whole["", side] for side in toxicity.SIDES) == 200
