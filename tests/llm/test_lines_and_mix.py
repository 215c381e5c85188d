"""Line dedup and mixing against plain Python, with odd rows."""

import hashlib
import time
from collections import Counter

from pyspark.sql import functions as F
from test_pipeline import lines_left, targets

from ledgermill.llm.line_dedup import drop_repeated_lines
from ledgermill.llm.mixing import mix_sources


def test_lines(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc: r for r in drop_repeated_lines(documents).collect()}
    assert {d: r.text for d, r in got.items()} == lines_left(rows)
    for d, text in rows:
        assert got[d].n_lines == text.count("\n") + 1
        assert got[d].n_dropped == got[d].n_lines - (got[d].text.count("\n") + 1 if got[d].text or got[d].n_dropped < got[d].n_lines else 0)


def test_odd_lines(texts_frame):
    hot, other = "The very common line of this corpus", "Ünïcode line that keeps its own CASE É"
    rows = [(i, f"\t{hot.upper() if i % 2 else hot} \nown {i}\n{other}\n{hot}") for i in range(400)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "x" * 19 + "\n" + "y" * 20), (504, "y" * 20), (505, f"{other.lower()}\n" + f"{'z' * 30}\n" * 70_000)]
    got = {r.doc: r for r in drop_repeated_lines(texts_frame(rows)).collect()}
    assert {d: r.text for d, r in got.items()} == lines_left(rows)
    assert got[500].n_lines == got[501].n_lines == 1 and got[502].n_lines == 3
    assert sum(map(int.bit_count, (w & (2**64 - 1) for w in got[505].keep.values()))) == 70_001
    # Rows that agree in id and text are one document; a null id is the smallest.
    twice = [(1, hot), (1, hot), (None, hot)]
    assert Counter((r.doc, r.text) for r in drop_repeated_lines(texts_frame(twice)).collect()) == Counter(twice)
    three = [(r.doc, r.text) for r in drop_repeated_lines(texts_frame([*twice, (2, hot)])).collect()]
    assert Counter(three) == Counter([(1, ""), (1, ""), (None, ""), (2, hot)])
    assert drop_repeated_lines(texts_frame([])).count() == 0


def test_time_grows_with_the_lines_of_a_text(texts_frame):
    """Twice the lines take about twice as long, not four or eight times."""

    def seconds(n):
        docs = texts_frame([(1, "\n".join(f"a line of its own, number {i}" for i in range(n)))])
        start = time.perf_counter()
        row = drop_repeated_lines(docs).select("n_lines", "n_dropped", F.length("text").alias("n")).first()
        assert (row.n_lines, row.n_dropped) == (n, 0)
        return time.perf_counter() - start

    seconds(1_000)
    assert seconds(160_000) < 3 * seconds(80_000) + 1


def mixed_by_hand(rows):
    """rows: (doc_id, source, size)."""
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    wanted, budget, sent, copies = targets(sizes), sum(sizes.values()), Counter(), []
    names = sorted(sizes, key=lambda s: (s is None, s))
    for d, s, n in sorted(rows, key=lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), str(r[0]), r[2])):
        sent[s] += n
        copies += [((sizes[s] * k + sent[s]) / wanted[s], names.index(s), hashlib.md5(str("" if d is None else d).encode()).hexdigest(), k, d, s, n) for k in range(3) if n]
    taken, reached = Counter(), 0
    for *_, d, s, n in sorted(copies, key=lambda c: c[:4]):
        reached += n
        if reached > budget:
            break
        taken[d, s, n] += n
    return Counter((d, n, sizes[s], wanted[s], taken[d, s, n]) for d, s, n in rows)


def test_mix(spark, documents):
    rows = [(r.doc_id, r.source, len(r.text.split())) for r in documents.collect()]
    got = Counter((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mix_sources(documents).collect())
    expected = mixed_by_hand(rows)
    assert {(r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got} == {(r[0], r[1], r[2], round(r[3], 6), r[4]) for r in expected}


def test_odd_mix(spark):
    schema = "doc_id long, text string, source string, size string, key int, target string"
    make = lambda rows: spark.createDataFrame([(i, t, s, "x", 1, "y") for i, t, s in rows], schema)
    rows = [(i, "w " * (i % 7), f"s{i % 4}") for i in range(300)] + [(900, None, "s0"), (901, "", None), (None, "a b", None), (902, "w " * 90_000, "big")]
    rows += [(903, " \t", "blank")]
    got = mix_sources(make(rows)).collect()
    assert len(got) == len(rows)
    by_hand = mixed_by_hand([(i, s, len((t or "").split())) for i, t, s in rows])
    assert {(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got} == {(r[0], r[1], r[2], round(r[3], 6), r[4]) for r in by_hand}
    assert all(r.taken <= 3 * r.size for r in got)
    assert [(r.target, r.taken) for r in mix_sources(make([(1, None, "a"), (2, "", None)])).collect()] == [(0.0, 0), (0.0, 0)]
    assert mix_sources(make([])).count() == 0
