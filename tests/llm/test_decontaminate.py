"""Leaks against a plain comparison of every document with every item."""

import numpy as np
import pytest

from ledgermill.llm.decontaminate import benchmark_items, common_subsequence, find_leaks, normal_words


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, best[j] = best[j], old + 1 if x == y else max(best[j], best[j - 1])
    return best[-1]


def verbatim(docs, items):
    """Pairs whose item is a run of the document's words."""
    out = set()
    for d, text in docs:
        words = " " + " ".join(normal_words(text)) + " "
        out |= {(d, i) for i, t in items if normal_words(t) and f" {' '.join(normal_words(t))} " in words}
    return out


def test_common_subsequence():
    random = np.random.default_rng(1)
    for _ in range(300):
        a, b = (random.integers(0, 5, random.integers(0, 90)).tolist() for _ in range(2))
        assert common_subsequence(a, b) == lcs(a, b)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.001"])
def test_planted_passages(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    items = spark.read.parquet(f"/root/testdata/{folder}/benchmark.parquet")
    expected = verbatim([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    got = {(r.doc, r.item) for r in find_leaks(docs, items).collect()}
    assert expected <= got
    assert len(got - expected) <= 0.02 * len(expected) + 1


def test_paraphrases_and_odd_rows(spark, texts_frame):
    random = np.random.default_rng(5)
    words = [f"word{i}" for i in range(3000)]
    draw = lambda n: random.choice(words, n).tolist()
    items = [(i, draw(n)) for i, n in enumerate((15, 40, 60, 150))]
    docs, expected = [(1000 + i, " ".join(draw(200))) for i in range(60)], set()
    for i, item in items:
        changed = [w if k % 9 else "other" for k, w in enumerate(item)]
        for k, text in enumerate((item, changed, [w.upper() + "," for w in item])):
            docs.append((10 * i + k, " ".join(draw(37) + text + draw(53))))
            expected.add((10 * i + k, i))
    far = " ".join(draw(30_000) + items[1][1] + draw(30_000))
    docs += [(None, " ".join(items[0][1])), (500, None), (501, ""), (502, "... !!"), (503, far), (503, far)]
    expected |= {(None, 0), (503, 1)}
    bench = [(i, " ".join(t)) for i, t in items] + [(90, None), (91, ""), (92, "?"), (None, "just three words")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in bench], "item_id long, text string, doc int")
    rows = find_leaks(texts_frame(docs), bench).collect()
    assert {(r.doc, r.item) for r in rows} == expected
    assert len(rows) == len(expected)
    assert find_leaks(texts_frame([]), bench).count() == 0
    assert find_leaks(texts_frame(docs), bench.limit(0)).count() == 0


def test_item_in_a_third_of_all_rows(spark, texts_frame):
    """However often an item leaks, its words keep their weight; words that weigh nothing lead to it by their runs."""
    random = np.random.default_rng(8)
    words = [f"word{i}" for i in range(4000)]
    draw = lambda n: random.choice(words, n).tolist()
    items = [draw(25), "to be or not to be that is the question".split(), draw(30)]
    common = sorted(set(items[1]))
    filler = lambda n: [w for x in draw(n) for w in (x, str(random.choice(common)))]
    rows = []
    for i in range(300):
        own = items[0] if i % 3 == 0 else items[1] if i % 50 == 1 else items[2] if i == 2 else []
        rows.append((i, " ".join(filler(40 + i % 31) + own + filler(50))))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    expected = verbatim(rows, [(i, " ".join(x)) for i, x in enumerate(items)])
    assert len(expected) == 100 + 4 + 1
    got = {(r.doc, r.item) for r in find_leaks(texts_frame(rows), bench).collect()}
    assert expected <= got
    assert not {x for x in got - expected if x[1] != 1}


def halves(words, answer):
    """The first words and the last ones, half of all together and all of the answer."""
    return words[: max(0, -(-len(words) // 2) - answer)] + words[len(words) - answer :]


def test_verbatim_and_half_with_answer_lead_to_every_item(spark, texts_frame):
    random = np.random.default_rng(4)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(1500).collect()]
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    rows, expected = [], set()
    for i, text in bench.select("item_id", "text").collect():
        words = normal_words(text)
        numbers = {w: n for n, w in enumerate(words)}
        (item,) = benchmark_items([(i, text)], numbers)
        for part in (words, halves(words, len(item.answer))):
            host = docs[random.integers(len(docs))].split()
            at = random.integers(len(host) + 1)
            rows.append((len(rows), " ".join(host[:at] + part + host[at:])))
            expected.add((len(rows) - 1, i))
    rows += [(100_000 + i, text) for i, text in enumerate(docs)]
    got = {(r.doc, r.item) for r in find_leaks(texts_frame(rows), bench).collect()}
    assert expected <= got


def test_one_passage_of_a_long_item(spark, texts_frame):
    random = np.random.default_rng(9)
    words = [f"word{i}" for i in range(4000)]
    draw = lambda n: random.choice(words, n).tolist()
    item = draw(280)
    question, answer = draw(12), draw(6)
    text = " ".join(item) + ". " + " ".join(question) + "? " + " ".join(answer) + "."
    parts = [item[at : at + 60] for at in (0, 13, 70, 101, 217)] + [question + answer, item + question + answer]
    rows = [(i, " ".join(draw(45 + i) + part + draw(60))) for i, part in enumerate(parts)]
    rows += [(100 + i, " ".join(draw(150) + item[50 * i : 50 * i + 12] + draw(20))) for i in range(5)]
    bench = spark.createDataFrame([(1, text), (2, " ".join(draw(30)))], "item_id long, text string")
    got = {(r.doc, r.item) for r in find_leaks(texts_frame(rows), bench).collect()}
    assert got == {(i, 1) for i in range(len(parts))}
