"""Lattice scores against sums over segmentations in plain Python, and held-out gain over the base."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from ledgermill.llm.lattice import START, Lattice, first_weights, lattice_scores, vocabulary

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def all_ways(word, known):
    """(probability, pieces) of every segmentation, by recursion."""
    if not word:
        return [(1.0, ())]
    return [
        (known[head] * p, (head, *rest))
        for m in range(1, len(word) + 1)
        for head in ((word[:m], 0), (word[:m], 1))
        if head in known
        for p, rest in all_ways(word[m:], known)
    ]


def test_all_segmentations():
    pieces, scores = [START, START + b"a", b"ab", b"b", b"aba", START + b"ab", "é".encode()], [-3.0, 0, -1, -5, -2, -4, -6]
    weights = first_weights(pieces, scores)
    assert abs(np.exp(weights).sum() - 1) < 1e-12
    known = {(p, 0): math.exp(w) for p, w in zip(pieces, weights, strict=False)}
    known |= {(bytes([b]), 1): math.exp(weights[len(pieces) + b]) for b in range(256) if b != 32}
    words = [b"a", b"ab", b"abab", b"aabba", "abéa".encode(), b"zz", b"abababab"]
    times = np.arange(1, len(words) + 1)
    lattice = Lattice(pieces, weights)
    got, used = lattice.log_probabilities(words), lattice.expected(words, times)
    expected = Counter()
    for word, value, n in zip(words, got, times, strict=True):
        ways = all_ways(START + word, known)
        total = sum(p for p, _ in ways)
        assert ways and abs(value - math.log(total)) < 1e-9
        for p, way in ways:
            for symbol in way:
                expected[symbol] += n * p / total
    for i, piece in enumerate(pieces):
        assert abs(used[i] - expected[piece, 0]) < 1e-9
    assert all(abs(used[len(pieces) + b] - expected[bytes([b]), 1]) < 1e-9 for b in range(256))


def base_by_hand(rows):
    tokens = {k: [*(t or "").encode().lower().split(), b""] for k, (_, t) in enumerate(rows)}
    train = Counter(w for k, (i, _) in enumerate(rows) if not held(i) for w in tokens[k])
    n, v = sum(train.values()), len(train)
    return n, [(len(tokens[k]), sum(train[w] > 0 for w in tokens[k]), sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens[k])) for k in tokens]


@pytest.mark.parametrize("frequent", [0, 300, 100_000])
def test_odd_rows(spark, frequent):
    schema = "doc_id long, text string, word string, c long, held boolean, row int, score string"
    make = lambda rows: spark.createDataFrame([(i, t, "x", 1, True, 2, "y") for i, t in rows], schema)
    rows = [(i, f"The cat {'sat ' * (i % 3)}on w{i} ▁x ünï 日本 \x00 Ö") for i in range(60)]
    rows += [(None, None), (70, ""), (71, " \t\n"), (72, "long" * 5_000 + " the"), (73, "the cat " * 20_000), (73, "the cat " * 20_000), (5, rows[5][1])]
    got = lattice_scores(make(rows), MODEL, rounds=1, frequent=frequent, kind_col="word" if frequent == 300 else None)
    n, by_hand = base_by_hand(rows)
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.collect())
    assert found == sorted((str(i), held(i), t, k, n, round(b, 6)) for (i, _), (t, k, b) in zip(rows, by_hand, strict=True))
    scores = {r.doc_id: r.score for r in got.collect()}
    assert scores[None] == scores[70] == scores[71] > scores[0] > scores[73] and all(map(math.isfinite, scores.values()))
    # Without rows, and without rows to learn from.
    assert lattice_scores(make([]), MODEL, rounds=1).count() == 0
    some = [i for i in range(50) if held(i)][:2]
    alone = lattice_scores(make([(i, "the cat") for i in some]), MODEL, rounds=1).collect()
    assert [(r.n_known, r.train_tokens, round(r.base_score, 9)) for r in alone] == [(0, 0, 0.0)] * 2


def test_scores_by_hand(spark):
    """Everything but the pieces' own sums and the re-estimation, which have tests above, in plain Python."""
    langs, texts = ["a", "b", None], ["the cat sat", "le chat ünï", "the the new xyzzy", "cat chat"]
    rows = [(i, texts[i * 7 % 4] + (f" w{i}" if i % 5 == 0 else ""), langs[i % 3]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.score for r in lattice_scores(docs, MODEL, kind_col="lang", rounds=1, frequent=3).collect()}
    pieces, scores = vocabulary(MODEL)
    train = [(t.encode().split() + [b""], lang) for i, t, lang in rows if not held(i)]
    words = sorted({w for t, _ in train for w in t if w})
    used = Lattice(pieces, first_weights(pieces, scores)).expected(words, np.ones(len(words))) + 0.1
    lattice = Lattice(pieces, np.log(used / used.sum()))
    counts = {lang: Counter(w for t, x in train if x == lang for w in t) for lang in langs}
    types = sum(map(len, counts.values()))

    def chance(word, lang):
        own, n = counts[lang], sum(counts[lang].values())
        alone = 0.0 if not word else math.exp(lattice.log_probabilities([word])[0])
        kinds = sum(word in c for c in counts.values())
        any_kind = max(kinds - 0.75, 0) / types + 0.75 * len(set().union(*counts.values())) / types * alone
        return max(own[word] - 0.75, 0) / n + 0.75 * len(own) / n * any_kind

    for i, t, _ in rows:
        each = [sum(x == lang for _, x in train) / len(train) * math.prod(chance(w, lang) for w in [*t.encode().split(), b""]) for lang in langs]
        assert abs(got[i] - math.log10(sum(each))) < 1e-9


def test_same_for_any_broadcast(documents):
    few, many = (
        {(r.doc_id): r for r in lattice_scores(documents, MODEL, kind_col="lang", frequent=f).collect()} for f in (50, 100_000)
    )
    assert set(few) == set(many)
    for k, r in few.items():
        assert (r.n_tokens, r.n_known) == (many[k].n_tokens, many[k].n_known)
        assert abs(r.score - many[k].score) < 1e-6 and abs(r.base_score - many[k].base_score) < 1e-6


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = lattice_scores(docs, MODEL, kind_col="lang").filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert out.s > out.b
    assert len(vocabulary(MODEL)[0]) > 30_000
