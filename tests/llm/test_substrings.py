"""Repeated strings against a count of all strings, and the suffix array against sorting."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import substrings
from ledgermill.llm.substrings import remove_repeats
from ledgermill.llm.suffixes import suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array(symbols):
    text = [*symbols, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for (doc, _), x in zip(rows, data, strict=True):
        gone = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - length + 1):
            if count[x[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(x, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((doc, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs, length):
    rows = remove_repeats(docs, length).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    return sorted(((r.doc, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


def test_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(documents, 400) == brute(rows, 400)


@pytest.mark.parametrize("together", [1000, 2])
def test_passages_in_many_contexts(texts_frame, monkeypatch, together):
    """Passages just below, at and above the length, with equal bytes around them or not, cut at any place."""
    monkeypatch.setattr(substrings, "TOGETHER", together)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 4000)
    random = np.random.default_rng(together)
    letters = np.array(list("abcdé "))
    draw = lambda n: "".join(random.choice(letters, n))
    passage, rows = draw(260), []
    for i in range(60):
        a, b = sorted(random.integers(0, len(passage) + 1, 2).tolist())
        rows.append((i, draw(random.integers(0, 120)) + passage[a:b] + draw(random.integers(0, 3)) + passage[: b - a] + draw(40)))
    assert found(texts_frame(rows), 100) == brute(rows, 100)


def test_odd_rows(texts_frame):
    random = np.random.default_rng(9)
    long = "".join(random.choice(list("abcdefgh "), 700_000))
    rows = [(1, None), (2, ""), (3, "a" * 399), (4, "b" * 3000), (5, "xy" * 900), (6, "xyz" * 150), (7, "é" * 250), (7, "é" * 250)]
    rows += [(None, "q" * 401), (8, long[:1500]), (9, "1" + long[200:900] + "2"), (9, long[599_000:601_000] + "\n" * 500)]
    assert found(texts_frame(rows), 400) == brute(rows, 400)
    got = {r.doc: (r.n_removed, r.n_spans) for r in remove_repeats(texts_frame([(1, long), (2, long[524_000:526_000])]), 400).collect()}
    assert got == {1: (2000, 1), 2: (2000, 1)}
    assert found(texts_frame([]), 400) == []
