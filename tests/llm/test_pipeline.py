"""Each stage on its own input against brute force; odd rows through all of them."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from test_decontaminate import verbatim
from test_minhash import brute

FOLDER = "/root/testdata/sf0.01"


def lines_left(rows):
    """rows: (doc_id, text) with distinct ids."""
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(d) >= 3}
    return {doc: "\n".join(x for x in (text or "").split("\n") if gone.get(key(x), doc) == doc) for doc, text in rows}


def targets(sizes):
    """Water-filled targets by source, by stopping one source after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        share = {s: weight[s] * rest / sum(weight[x] for x in names if x not in stopped) for s in names if s not in stopped}
        over = {s for s in share if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in stopped else share[s] for s in names}
        stopped |= over


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 1").collect()}
    fine = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 0").collect()}
    benchmark = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == len(docs.collect())
        assert set(after) <= set(before)
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "toxicity":
            assert len(toxic & set(after)) <= 0.5 * len(toxic)
            assert len(fine - set(after)) <= 0.1 * len(fine)
        elif name == "line dedup":
            assert {d: r.text for d, r in after.items()} == lines_left([(d, r.text) for d, r in before.items()])
            assert all(r.n_chars == len(r.text) and r.source == before[d].source for d, r in after.items())
        elif name == "near dedup":
            assert set(after) == {d for d, _, _, kept in brute([(d, r.text) for d, r in before.items()], 5, 80) if kept}
        elif name == "decontamination":
            leaked = {d for d, _ in verbatim([(d, r.text) for d, r in before.items()], benchmark)}
            assert not leaked & set(after)
            assert len(before) - len(leaked) - len(after) <= 2
        elif name == "mixing":
            words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for d, r in before.items()}
            sizes, taken = Counter(), Counter()
            for d, r in before.items():
                sizes[r.source] += words[d]
            wanted = targets(sizes)
            for d, r in after.items():
                assert (r.size, r.source_size, r.taken) == (words[d], sizes[r.source], r.copies * words[d]) and 1 <= r.copies <= 3
                assert abs(r.target - wanted[r.source]) < 1e-6
                taken[r.source] += r.taken
            assert sum(taken.values()) <= sum(sizes.values())
            assert all(abs(taken[s] - wanted[s]) <= max(words.values()) for s in sizes)


def test_odd_rows(spark, texts_frame, tmp_path):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, text), (3, text), (4, text + " end"), (None, text.upper() + " x y"), (5, "a line of more than twenty\nb"), (5, "c")]
    documents = texts_frame(rows).withColumn("row", F.lit(1)).withColumn("taken", F.lit("x"))
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # Without labels every document stays in the first stage. Then 3, 4 and the nameless one are a group, of which 3
    # stays once; both texts of 5 stay, and so do the texts without words, which the mix leaves out.
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path)).cache()
        kept[name] = sorted(((str(r.doc_id), r.text) for r in docs.collect()), key=str)
    assert kept["toxicity"] == sorted(((str(i), t) for i, t in rows), key=str)
    assert kept["line dedup"] == sorted(((str(i), t or "") for i, t in rows), key=str)
    assert kept["near dedup"] == [("1", ""), ("2", ""), ("3", text), ("5", "a line of more than twenty\nb"), ("5", "c")]
    assert kept["decontamination"] == kept["near dedup"]
    # Sources 0 and 2 hold 40 words and 7 + 1, their weights are 1 and 2: targets 24 and 24.
    assert {c: t for c, t in docs.dtypes if "taken" in c} == {"taken": "string", "mix_taken": "bigint"}
    assert set(docs.columns) >= {*documents.columns, "mix_size", "source_size", "target", "mix_taken", "copies"}
    by_text = {r.text: (r.doc_id, r.mix_size, r.source_size, r.mix_taken, r.copies, r.taken) for r in docs.collect()}
    assert by_text == {
        "a line of more than twenty\nb": (5, 7, 8, 21, 3, "x"), "c": (5, 1, 8, 3, 3, "x"),
    }
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_scorer_gets_texts_once(spark, texts_frame, tmp_path, monkeypatch):
    rows = [(1, "vile words"), (2, "kind words"), (2, "kind words"), (3, ""), (4, None), (None, "x")]
    # Names that the operator uses itself, and the text as the last column.
    documents = texts_frame(rows).withColumns({"row": F.lit("r"), "score": F.lit(9), "passages": F.lit(1.5)})
    documents = documents.select(*(c for c in documents.columns if c != "text"), "text")
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sent, score = [], corpus_pipeline.score_toxicity
    monkeypatch.setattr(corpus_pipeline, "score_toxicity", lambda rows, *a, **b: sent.append(rows) or score(rows, *a, **b))
    monkeypatch.setattr(corpus_pipeline, "TOXIC", 2)  # all rows stay
    left = corpus_pipeline.without_toxic(spark, documents, str(tmp_path))
    assert left.dtypes == documents.dtypes
    assert Counter(map(str, left.collect())) == Counter(map(str, documents.collect()))
    # The text is not in the struct of the other columns as well.
    assert re.findall(r"\btext:\w+", sent[0].schema.simpleString()) == ["text:string"]
