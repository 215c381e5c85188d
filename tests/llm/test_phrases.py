"""Phrases against plain Python: counts, cuts, containment, order, and independence of the sample."""

import re
from collections import Counter, defaultdict

import pytest

from ledgermill.llm.phrases import collocations, scored

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, support, longest, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, times in f.items():
        some = {p: a for p, a in times.items() if len(p) > 1 and a >= support}
        best = []
        for p, a in some.items():
            inside = any(
                100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in some.items() if len(q) > len(p)
            )
            if not inside:
                score, k = min((1000 * a * n[lang] // (times[p[:k]] * times[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), times[p[:k]], times[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_given_texts(documents):
    rows = [(r.lang, r.text) for r in documents.collect()]
    for support, top in ((20, 2000), (40, 7)):
        expected = by_hand(rows, support, 5, top)
        assert expected and found(collocations(documents, support=support, top=top)) == expected


@pytest.mark.parametrize("sample", [0.0, 0.3, 1.0])
def test_odd_texts(spark, sample):
    schema = "doc_id long, text string, lang string, phrase string, f long, key array<int>"
    make = lambda rows: spark.createDataFrame([(1, t, lang, "x", 1, None) for lang, t in rows], schema)
    rows = [(None, "New York New\tYork  new york; NEW\x0byork, É É é É"), ("und", "new york! new york?new york a a a a a a a a")] * 3
    rows += [("x", None), ("x", ""), ("x", " \t\n"), ("", "a b c d e f " * 5), ("y", "a b c d e f " * 9_000), ("y", "long" * 30_000 + " " + "é" * 500)]
    rows += [("z", f"w{i % 3} \x00 ▁ w{i % 2}") for i in range(40)]
    # A word that is the name of its language.
    rows += [("en", "en to en es"), ("es", "en es es to")] * 8
    got = found(collocations(make(rows), support=6, sample=sample))
    assert got == by_hand(rows, 6, 5, 2000) and any(r[0] == "" for r in got) is False
    assert collocations(make([])).count() == 0 and collocations(make(rows[:2])).count() == 0


def test_many_blocks(documents, monkeypatch):
    rows = [(r.lang, r.text) for r in documents.collect()]
    monkeypatch.setattr("ledgermill.llm.phrases.BLOCK_WORDS", 500)  # in workers only where they are forked from here
    assert found(collocations(documents.repartition(13), support=30, sample=0.05)) == by_hand(rows, 30, 5, 2000)


def test_large_numbers(spark):
    big = 9 * 10**17
    phrases = spark.createDataFrame(
        [("e", "a", 1, big), ("e", "b", 1, big - 1), ("e", "a b", 2, big - 7)], "lang string, phrase string, length int, f long"
    )
    row = scored(phrases, spark.createDataFrame([("e", 10**14 - 1)], "lang string, n long")).first()
    assert row.score == 1000 * (big - 7) * (10**14 - 1) // (big * (big - 1))
