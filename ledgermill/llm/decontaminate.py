"""Benchmark passages in documents: latent semantic retrieval, then common subsequences.

1. Every text becomes the places of the words that occur in the benchmark; no other word can
   add to a product with a benchmark passage. Words in more than a hundredth of all passages (and in more than 20,
   for in a few passages nothing is common) weigh nothing, the others by inverse passage frequency over all documents. Words in a copied run
   of an item are not counted, so an item cannot make its own words common by leaking often.
2. Randomised SVD of the TF-IDF matrix of all passages (blocks of 32 words of every document, and the
   benchmark's own): random vectors are multiplied by the matrix and its transpose in two passes over
   the documents, each task adding up its share; the Rayleigh-Ritz step is small.
3. Windows of 16, 24, 32, 48 and 64 words, starting at every eighth word that leads anything, are projected and
   compared with the benchmark passages of that length by cosine. Besides, whatever its words weigh,
   a stretch that holds some runs of three of an item's words is a candidate (runs of all its words, if
   it has fewer).
4. A candidate counts if the item's words are found in order around the window: nearly all, or
   half of the item and most of its answer, its last sentence. A long item counts as found too if that
   holds for one of its passages: runs of 56 words that overlap by half, or its question and answer.

The benchmark is worked off in slices of bounded size, so what is broadcast is bounded too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.words import texts
from ledgermill.session import small_batches, stored

#: Rank of the latent space, and random vectors beyond it.
RANK, MORE = 64, 8
#: Words of a passage, of a block, and blocks of a window.
PASSAGE, BLOCK, SCALES = 32, 8, (2, 3, 4, 6, 8)
#: Longest part of an item that is one passage, and least words of the question and answer of a longer one.
PART, TAIL = 56, 12
COMMON, COSINE = 0.01, 0.4
WHOLE, HALF, ANSWER = 0.75, 0.5, 0.75
#: Windows are compared in classes of the number of weighing words.
BINS = ((1, 3), (3, 5), (5, 7), (7, 10), (10, 14), (14, 1 << 30))
#: Share of a passage's weighing words that a window must hold; less than HALF, as windows cut items.
HELD = 0.4
#: Words of a run, and the share of a passage's runs that a stretch must hold.
RUN, RUNS = 3, 1 / 12
#: Words in a row that are taken for copied from an item.
COPY = 5
#: Items and words of a slice of the benchmark, about.
SLICE_ITEMS, SLICE_WORDS = 2_000, 1 << 17
#: Places that a task works on at once, words compared at once, and rows of a partial sum that travel together.
STEP, COMPARED, SUM_ROWS = 30_000, 1_000_000, 1024
#: Groups in which the tasks' partial sums are added up before these are added.
SUM_GROUPS = 32
#: An odd number; runs of words are told apart by a polynomial in it, modulo 2^64. A clash costs a comparison.
RUN_BASE, SLOT_BITS = 0x5851F42D4C957F2D, 20


def normal_word(word: bytes) -> str:
    text = word.decode("utf-8", "replace").lower()
    return text if text.isalnum() else "".join(c for c in text if c.isalnum())


def normal_words(text: str | None) -> list[str]:
    return [w for w in map(normal_word, (text or "").encode().split()) if w]


@dataclass(frozen=True)
class Item:
    name: object
    words: list[int]
    answer: list[int]
    tail: list[int]  # the answer and what stands before it


_LOWER = bytes(range(256)).lower()
#: ASCII characters that are neither blanks nor part of a word.
_DROPPED = bytes(c for c in range(128) if not chr(c).isalnum() and not bytes([c]).isspace())


def _terms(text: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """The number of each word of a text, -1 for words that the benchmark does not have."""
    words = text.translate(_LOWER, _DROPPED).split()
    own = np.fromiter(map(numbers.get, words, repeat(-1)), np.int32, len(words))
    if text.isascii():
        return own
    for i in np.flatnonzero(own < 0).tolist():
        if not words[i].isascii():
            form = normal_word(words[i]).encode()
            own[i] = numbers.get(form, -1) if form else -2
    return own[own != -2]


def _places(shared, size: int):
    """A row for each text, and a last one for each task: the terms ``held`` and the ``times`` they count for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, runs = shared.value
        numbers = {w.encode(): n for w, n in numbers.items()}
        counts, passages, kind = np.zeros(size, np.int64), 0, None
        for batch in batches:
            places, found, lengths = [], [], []
            for text in texts(batch, "text"):
                own = _terms(text, numbers)
                at = np.flatnonzero(own >= 0).astype(np.int32)
                places.append(np.diff(at, prepend=0))  # gaps are small numbers
                found.append(own[at])
                lengths.append(len(own))
            kind, nothing = batch.column("doc").type, [None] * len(places)
            out = [
                batch.column("doc"), batch.column("text_hash"), pa.array(places, INTS), pa.array(found, INTS),
                pa.array(lengths, pa.int64()), pa.array(nothing, INTS), pa.array(nothing, LONGS),
            ]
            out = pa.RecordBatch.from_arrays(out, PLACES)
            passages += sum(-(-n // PASSAGE) for n in lengths)
            _count(runs, out, counts)
            yield out
        if kind is not None:
            held = np.flatnonzero(counts)
            empty = [pa.array([None], k) for k in (kind, pa.int64(), INTS, INTS, pa.int64())]
            last = [pa.array([np.append(held, -1)], INTS), pa.array([np.append(counts[held], passages)], LONGS)]
            yield pa.RecordBatch.from_arrays([*empty, *last], PLACES)

    return run


INTS, LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
PLACES = ["doc", "text_hash", "gaps", "terms", "n_words", "held", "times"]


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, term) of about STEP places at once; rows are never cut."""
    gaps, terms = batch.column("gaps"), batch.column("terms")
    ends = terms.offsets.to_numpy().astype(np.int64)
    all_gaps, all_terms = gaps.flatten().to_numpy(), terms.flatten().to_numpy()
    ends = ends - ends[0]
    start = 0
    while start < len(terms):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + STEP, "right")) - 1)
        a, b = ends[start], ends[stop]
        row = np.repeat(np.arange(start, stop), np.diff(ends[start : stop + 1]))
        sums = np.concatenate(([0], np.cumsum(all_gaps[a:b], dtype=np.int64)))
        # Gaps add up from the row's own start.
        place = sums[1:] - sums[ends[row] - a]
        yield row, place, all_terms[a:b]
        start = stop


@dataclass(frozen=True)
class Runs:
    """Word runs of the passages, as sorted numbers; run i is in ``passage[start[i] : start[i + 1]]``."""

    lengths: tuple[int, ...]
    number: np.ndarray
    start: np.ndarray
    passage: np.ndarray
    words: np.ndarray  # of each passage
    needed: np.ndarray  # runs of each passage
    slots: np.ndarray  # by the first SLOT_BITS of a number, whether a passage may hold the run


def _numbers(term: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of ``length`` terms; runs of other lengths have other numbers."""
    n = max(0, len(term) - length + 1)
    out = np.zeros(n, np.int64)
    for i in range(length):
        out = out * RUN_BASE + term[i : i + n] + 1
    return out


def _slot(number: np.ndarray) -> np.ndarray:
    return (number >> (64 - SLOT_BITS)) & ((1 << SLOT_BITS) - 1)


def word_runs(passages: list[list[int]]) -> Runs:
    own = [np.unique(_numbers(np.array(x, np.int64), min(RUN, len(x)))) if x else np.empty(0, np.int64) for x in passages]
    number = np.concatenate([*own, np.empty(0, np.int64)])
    passage = np.repeat(np.arange(len(own)), [len(x) for x in own])
    order = np.argsort(number, kind="stable")
    names, start = np.unique(number[order], return_index=True)
    words = np.array([len(x) for x in passages])
    needed = np.maximum(1, (RUNS * (words - RUN + 1)).astype(int))
    lengths = tuple(sorted({min(RUN, len(x)) for x in passages if x}))
    slots = np.zeros(1 << SLOT_BITS, bool)
    slots[_slot(names)] = True
    return Runs(lengths, names, np.append(start, len(number)), passage[order], words, needed, slots)


def _run_places(runs: Runs, row: np.ndarray, term: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(index of its first word, place in ``runs.number``) of each run that a passage holds; other words are passed over."""
    at, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for length in lengths:
        number = _numbers(term, length)
        if len(number) and len(runs.number):
            own = np.flatnonzero(runs.slots[_slot(number)] & (row[: len(number)] == row[length - 1 :]))
            i = np.minimum(np.searchsorted(runs.number, number[own]), len(runs.number) - 1)
            same = runs.number[i] == number[own]
            at.append(own[same])
            found.append(i[same])
    return np.concatenate(at), np.concatenate(found)


def _copied(runs: Runs, row: np.ndarray, term: np.ndarray) -> np.ndarray:
    """Whether a word stands among COPY in a row whose runs all occur in the benchmark."""
    more = COPY - RUN
    hit = np.zeros(len(term) + more, bool)
    hit[_run_places(runs, row, term, (RUN,))[0]] = True
    first = np.logical_and.reduce([hit[i : i + len(term)] for i in range(more + 1)])
    out = np.zeros(len(term) + COPY, bool)
    for i in range(COPY):
        out[i : i + len(term)] |= first
    return out[: len(term)]


def _count(runs: Runs, batch: pa.RecordBatch, counts: np.ndarray) -> None:
    """Adds the passages that hold a term other than as a copy of an item."""
    size = len(counts)
    for row, place, term in _steps(batch):
        fresh = ~_copied(runs, row, term)
        row, place, term = row[fresh], place[fresh], term[fresh]
        where = _runs(row, place // PASSAGE)
        counts += np.bincount(np.unique(where * size + term) % size, minlength=size)


def _runs(row: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Numbers from 0 for each run of equal (row, part)."""
    if not len(row):
        return np.empty(0, np.int64)
    new = (np.diff(row) != 0) | (np.diff(part) != 0)
    return np.concatenate(([0], np.cumsum(new)))


def _gram(where: np.ndarray, term: np.ndarray, weight: np.ndarray, weighted: np.ndarray, out: np.ndarray) -> None:
    """Adds A'(A basis) of some passages, scaled to unit length, to ``out``; ``where`` ascends.

    ``weighted`` is the basis times the weights, in single precision; ``out`` adds up in double precision.
    """
    if not len(term):
        return
    starts = np.flatnonzero(np.diff(where, prepend=-1))
    # Term frequencies: equal terms of a passage are added before the norm.
    key = where.astype(np.int64) * len(weight) + term
    names, count = np.unique(key, return_counts=True)
    norm2 = np.bincount(names // len(weight), (weight[names % len(weight)] * count) ** 2, minlength=where[-1] + 1)
    rows = np.add.reduceat(weighted[term], starts, axis=0) / norm2[where[starts]][:, None].astype(np.float32)
    at = np.cumsum(np.diff(where, prepend=where[0]) != 0)
    order = np.argsort(term, kind="stable")
    sorted_terms = term[order]
    first = np.flatnonzero(np.diff(sorted_terms, prepend=-1))
    own = sorted_terms[first]
    out[own] += np.add.reduceat(rows[at[order]], first, axis=0) * weight[own][:, None]


def _products(shared):
    """Each task's share of A'(A basis), in pieces of SUM_ROWS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, basis = shared.value
        weighted, out = _weighted(weight, basis), np.zeros(basis.shape)
        for batch in batches:
            for row, place, term in _steps(batch):
                keep = weight[term] > 0
                row, place, term = row[keep], place[keep], term[keep]
                _gram(_runs(row, place // PASSAGE), term, weight, weighted, out)
        salt = TaskContext.get().partitionId()
        pieces = [out[i : i + SUM_ROWS].tobytes() for i in range(0, len(out), SUM_ROWS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(pieces)), pa.int32()), pa.array([salt] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())],
            ["piece", "salt", "part"],
        )

    return run


def _weighted(weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    return (basis * weight[:, None]).astype(np.float32)


def _added(table):
    """The sum of some tasks' pieces, in the tasks' order, so that reruns agree."""
    table = table.sort_by("salt")
    total = sum(np.frombuffer(x.as_py()) for x in table.column("part"))
    salt = pc.bit_wise_and(table.column("salt").slice(0, 1), SUM_GROUPS - 1)
    return pa.table({"piece": table.column("piece").slice(0, 1), "salt": salt.cast(pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})


def _gram_pass(places: DataFrame, items: list[Item], weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    shared = places.sparkSession.sparkContext.broadcast((weight, basis))  # a row for each word of the slice
    kind = "piece int, salt int, part binary"
    parts = places.select("gaps", "terms").mapInArrow(_products(shared), kind)
    parts = parts.groupBy("piece", F.col("salt").bitwiseAND(SUM_GROUPS - 1)).applyInArrow(_added, kind)
    parts = parts.groupBy("piece").applyInArrow(_added, kind)
    weighted, out = _weighted(weight, basis), np.zeros(basis.shape)
    for r in parts.toArrow().to_pylist():  # one row for SUM_ROWS terms
        a = r["piece"] * SUM_ROWS
        part = np.frombuffer(r["part"]).reshape(-1, basis.shape[1])
        out[a : a + len(part)] += part
    for item in items:
        term = np.array([t for t in item.words if weight[t] > 0], np.int32)
        place = np.array([i for i, t in enumerate(item.words) if weight[t] > 0], np.int64)
        _gram(_runs(np.zeros(len(term), int), place // PASSAGE), term, weight, weighted, out)
    return out


def latent_terms(places: DataFrame, items: list[Item], weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors of the passages' TF-IDF matrix (one row per term), by randomised SVD."""
    width = min(rank + MORE, len(weight))
    start = np.random.Generator(np.random.PCG64(3)).standard_normal((len(weight), width))
    basis, _ = np.linalg.qr(_gram_pass(places, items, weight, start))
    image = _gram_pass(places, items, weight, basis)
    small = basis.T @ image
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, np.argsort(values)[::-1][:rank]]


def common_subsequence(wanted: list[int], found: list[int]) -> int:
    """Length of the longest common subsequence, a machine word at a time."""
    if not wanted:
        return 0
    masks: dict[int, int] = {}
    for i, t in enumerate(wanted):
        masks[t] = masks.get(t, 0) | (1 << i)
    full = (1 << len(wanted)) - 1
    v = full
    for t in found:
        if t in masks:
            u = v & masks[t]
            v = ((v + u) | (v - u)) & full
    return len(wanted) - v.bit_count()


@dataclass(frozen=True)
class Index:
    items: list[Item]
    weight: np.ndarray
    latent: np.ndarray  # weighted rows of the singular vectors
    by_scale: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # blocks, unit vectors, passage, words needed
    targets: list[list[int]]  # the passages, then the items that are longer than one
    lengths: np.ndarray  # words of each target
    holds: np.ndarray  # bit ``target`` of row ``term``: whether the target holds the term
    whole: np.ndarray  # target of each passage's item, -1 if the passage is the item
    owner: list[int]  # item of each passage
    unit: np.ndarray  # vectors of the passages; 0 for one whose words weigh nothing
    runs: Runs


def passages_of(items: list[Item]) -> tuple[list[list[int]], list[int]]:
    """The passages of all items, and each one's item."""
    passages, owner = [], []
    for n, item in enumerate(items):
        last = max(0, len(item.words) - PART)
        # A copied run of PART words holds three quarters of a passage wherever it starts.
        own = [item.words[i : i + PART] for i in [*range(0, last, PART // 2), last]]
        if last and TAIL <= len(item.tail) < PART:
            own.append(item.tail)
        passages += own
        owner += [n] * len(own)
    return passages, owner


def _index(items: list[Item], passages: list[list[int]], owner: list[int], runs: Runs, weight: np.ndarray, latent: np.ndarray) -> Index:
    rows = latent * weight[:, None]
    held: dict[int, list] = {s: [] for s in SCALES}
    unit = np.zeros((len(passages), rows.shape[1]), np.float32)
    for n, part in enumerate(passages):
        vector = rows[part].sum(axis=0) if part else np.zeros(rows.shape[1])
        length = np.linalg.norm(vector)
        if length > 0:
            unit[n] = vector / length
            scale = next((s for s in SCALES if s * BLOCK >= len(part)), SCALES[-1])
            heavy = sum(weight[t] > 0 for t in part)
            held[scale].append((unit[n], n, max(1, int(HELD * heavy))))
    by_scale = []
    for s, h in held.items():
        h.sort(key=lambda x: x[2])
        if h:
            by_scale.append((s, np.array([x[0] for x in h], np.float32), np.array([x[1] for x in h]), np.array([x[2] for x in h])))
    long = [n for n, item in enumerate(items) if len(item.words) > PART]
    place = {n: len(passages) + i for i, n in enumerate(long)}
    targets = [*passages, *(items[n].words for n in long)]
    bits = np.zeros((len(weight), -(-len(targets) // 8)), np.uint8)
    for n, words in enumerate(targets):
        bits[list(set(words)), n >> 3] |= np.uint8(1 << (n & 7))
    lengths, whole = np.array([len(x) for x in targets]), np.array([place.get(n, -1) for n in owner])
    return Index(items, weight, rows.astype(np.float32), by_scale, targets, lengths, bits, whole, owner, unit, runs)


#: Rows, passages, cosines (NaN where not computed), first words and words after of windows.
Windows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _together(found: list[Windows]) -> Windows:
    kinds = (np.int64, np.int64, float, np.int64, np.int64)
    return tuple(np.concatenate([np.empty(0, k), *(f[i] for f in found)]) for i, k in enumerate(kinds))


def _by_runs(index: Index, row: np.ndarray, place: np.ndarray, term: np.ndarray) -> Windows:
    """The stretches that hold enough of a passage's runs."""
    runs = index.runs
    at, run = _run_places(runs, row, term, runs.lengths)
    if not len(at):
        return _together([])
    count = runs.start[run + 1] - runs.start[run]
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    passage = runs.passage[np.repeat(runs.start[run], count) + nth]
    at = np.repeat(at, count)
    span = int(place.max() + runs.words.max()) + 1
    key = np.sort(((row[at] - row[0]) * len(runs.words) + passage) * span + place[at])
    passage = key // span % len(runs.words)
    inside = np.searchsorted(key, key + runs.words[passage]) - np.arange(len(key))
    key = key[inside >= runs.needed[passage]]
    # One stretch for each block that such stretches start in.
    _, first = np.unique(key // span * span + key % span // BLOCK, return_index=True)
    pair, start = np.divmod(key[first], span)
    r, n = np.divmod(pair, len(runs.words))
    words = runs.words[n]
    return r + int(row[0]), n, np.full(len(n), np.nan), np.maximum(0, start - words), start + words


def _candidates(index: Index, row: np.ndarray, place: np.ndarray, term: np.ndarray) -> Windows:
    """The windows that are alike a passage."""
    if not len(row):
        return _together([])
    out: list[Windows] = []
    block = place // BLOCK
    span = int(block.max()) + max(SCALES) + 1
    block = (row - row[0]) * span + block
    first = np.flatnonzero(np.diff(block, prepend=-1))
    blocks = np.add.reduceat(index.latent[term], first, axis=0)
    sums = np.vstack([np.zeros(blocks.shape[1]), np.cumsum(blocks, axis=0, dtype=float)])
    first = np.append(first, len(block))
    for scale, vectors, passage, needed in index.by_scale:
        # Windows are some blocks in a row of those that have words.
        beyond = np.searchsorted(block[first[:-1]], block[first[:-1]] + scale)
        count = first[beyond] - first[:-1]
        for low, high in BINS:
            # Passages that need no more words than these windows have; ``needed`` ascends.
            few = int(np.searchsorted(needed, high))
            some = np.flatnonzero((count >= low) & (count < high)) if few else ()
            step = max(1, 2_000_000 // max(1, few))
            for i in range(0, len(some), step):
                here = some[i : i + step]
                window = (sums[beyond[here]] - sums[here]).astype(np.float32)
                window /= np.maximum(np.linalg.norm(window, axis=1), 1e-6)[:, None]
                cosine = window @ vectors[:few].T
                w, v = np.nonzero(cosine >= COSINE)
                enough = count[here[w]] >= needed[v]
                w, v = w[enough], v[enough]
                a = first[here[w]]
                at = place[a] // BLOCK * BLOCK
                out.append((row[a], passage[v], cosine[w, v].astype(float), at, at + scale * BLOCK))
    return _together(out)


def _stretches(index: Index, windows: Windows, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, passage, target, first and last place in ``row``, cosine, first word, word after) of what is compared with
    each target: a window with as much around it as the target may reach out of it, each once."""
    r, passage, cosine, start, stop = windows
    whole = np.flatnonzero(index.whole[passage] >= 0)
    both = np.concatenate([np.arange(len(r)), whole])
    target = np.concatenate([passage, index.whole[passage[whole]]])
    r, passage, cosine, start, stop = r[both], passage[both], cosine[both], start[both], stop[both]
    reach = np.maximum(BLOCK, index.lengths[target] - (stop - start) + BLOCK)
    start, stop = np.maximum(0, start - reach), stop + reach
    span = int(place.max()) + 2
    key = (row - row[0]) * span + place
    own = (r - row[0]) * span
    i, j = np.searchsorted(key, own + np.minimum(start, span - 1)), np.searchsorted(key, own + np.minimum(stop, span - 1))
    # Equal stretches are one, that with the highest known cosine.
    order = np.lexsort((stop, start, -np.nan_to_num(cosine, nan=-2.0), j, i, target, passage, r))
    columns = [x[order] for x in (r, passage, target, i, j, cosine, start, stop)]
    new = np.logical_or.reduce([np.diff(x, prepend=-1) != 0 for x in columns[:5]])
    return tuple(x[new] for x in columns)


def _shared_words(index: Index, target: np.ndarray, i: np.ndarray, j: np.ndarray, term: np.ndarray) -> np.ndarray:
    """How many of ``term[i:j]`` the target holds."""
    out = np.zeros(len(target), np.int64)
    ends = np.cumsum(j - i)
    a = 0
    while a < len(target):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + COMPARED, "right")))
        size = j[a:b] - i[a:b]
        which = np.repeat(np.arange(b - a), size)
        at = np.arange(len(which)) + np.repeat(i[a:b] - (ends[a:b] - size - done), size)
        n = target[a:b][which]
        hit = (index.holds[term[at], n >> 3] >> (n & 7).astype(np.uint8)) & 1
        out[a:b] = np.bincount(which, hit, minlength=b - a)
        a = b
    return out


def _leaks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            best: dict[tuple[int, int], tuple] = {}
            for row, place, term in _steps(batch):
                keep = index.weight[term] > 0
                windows = _together([_candidates(index, row[keep], place[keep], term[keep]), _by_runs(index, row, place, term)])
                if not len(windows[0]):
                    continue
                found = _stretches(index, windows, row, place)
                # With fewer of the target's words no common subsequence can be long enough.
                enough = _shared_words(index, *found[2:5], term) >= HALF * index.lengths[found[2]]
                for r, passage, target, i, j, cosine, start, stop in zip(*(x[enough].tolist() for x in found), strict=True):
                    n = index.owner[passage]
                    wanted, words = index.targets[target], term[i:j].tolist()
                    whole = common_subsequence(wanted, words) / max(1, len(wanted))
                    if whole < HALF:
                        continue
                    answer = common_subsequence(index.items[n].answer, words) / max(1, len(index.items[n].answer))
                    if whole >= WHOLE or answer >= ANSWER:
                        cosine = _cosine(index, words, passage) if math.isnan(cosine) else cosine
                        best[r, n] = max(best.get((r, n), ()), (whole, answer, cosine, start, stop))
            found = [(*pair, *values) for pair, values in best.items()]
            take = pa.array([f[0] for f in found], pa.int64())
            columns = list(zip(*found, strict=True)) if found else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(columns[1], pa.int64()),
                    *(pa.array(c, pa.float64()) for c in columns[2:5]),
                    *(pa.array(c, pa.int64()) for c in columns[5:7]),
                ],
                ["doc", "text_hash", "item", "lcs", "answer_lcs", "cosine", "first_word", "end_word"],
            )

    return run


def _cosine(index: Index, words: list[int], passage: int) -> float:
    vector = index.latent[words].sum(axis=0)
    return float(vector @ index.unit[passage] / max(np.linalg.norm(vector), 1e-6))


def benchmark_items(rows: list, numbers: dict[str, int]) -> list[Item]:
    out = []
    for name, text in rows:
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n", text or "") if normal_words(s)]
        last, before = "", ""
        while sentences and len(normal_words(last)) < 3:
            last = f"{sentences.pop()} {last}"
        while sentences and (not before or len(normal_words(f"{before} {last}")) < TAIL):
            before = f"{sentences.pop()} {before}"
        out.append(Item(name, *([numbers[w] for w in normal_words(x)] for x in (text, last, f"{before} {last}"))))
    return out


def _term_numbers(rows: list) -> dict[str, int]:
    return {w: i for i, w in enumerate(sorted({w for _, text in rows for w in normal_words(text)}))}


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row for each document and benchmark item found in it: ``doc``, ``text_hash``, ``item``,
    ``lcs`` and ``answer_lcs`` (shares of the item's and its answer's words found in order; of an item of more
    than PART words, ``lcs`` is the largest such share of the item or one of its passages),
    ``cosine``, ``first_word`` and ``end_word`` of the stretch.

    Words are compared lower-cased, by their letters and digits. Null, empty and wordless texts and items
    match nothing. Rows that share an id are documents of their own (``text_hash`` tells them apart);
    repeated rows give their result once, as do items that share an id. Null ids are kept as they are.
    Other columns are ignored; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    wanted = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).distinct()
    n_items, n_words = wanted.agg(F.count("*"), F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")))).first()
    slices = max(1, -(-n_items // SLICE_ITEMS), -(-(n_words or 0) // SLICE_WORDS))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(slices))
    out = None
    for i in range(slices):
        # About SLICE_ITEMS items or SLICE_WORDS words: the benchmark's own size never decides what one pass holds.
        rows = [tuple(r) for r in wanted.filter(part == i).orderBy("item", "text").collect()]
        found = _slice_leaks(spark, keyed, rows, kind, item_kind)
        out = found if out is None else out.union(found)
    score = F.struct("lcs", "answer_lcs", "cosine", F.col("first_word"), F.col("end_word"))
    best = out.groupBy("doc", "text_hash", "item").agg(F.max(score).alias("best"))
    return best.select("doc", "text_hash", "item", "best.*")


def _slice_leaks(spark, keyed: DataFrame, rows: list, kind: str, item_kind: str) -> DataFrame:
    found_kind = f"doc {kind}, text_hash long, item long, lcs double, answer_lcs double, cosine double, first_word long, end_word long"
    numbers = _term_numbers(rows)
    items = benchmark_items(rows, numbers)
    size = len(numbers)
    if not size:
        empty = spark.createDataFrame([], found_kind)
        return empty.withColumn("item", F.lit(None).cast(item_kind))
    passages, owner = passages_of(items)
    runs = word_runs(passages)
    shared = spark.sparkContext.broadcast((numbers, runs))  # words and runs of about SLICE_ITEMS items
    kinds = f"doc {kind}, text_hash long, gaps array<int>, terms array<int>, n_words long, held array<int>, times array<long>"
    stored_places = stored(keyed.mapInArrow(_places(shared, size), kinds))
    places = stored_places.filter("held is null")
    counted = stored_places.select(F.inline(F.arrays_zip("held", "times"))).groupBy("held").agg(F.sum("times").alias("n"))
    counts = {r["held"]: r["n"] for r in counted.collect()}  # a row for each word; -1 counts the passages
    total = counts.get(-1, 0) + sum(-(-len(x.words) // PASSAGE) for x in items)
    held = np.array([counts.get(t, 0) for t in range(size)], float)
    for item in items:
        for j in range(0, len(item.words), PASSAGE):
            held[list(set(item.words[j : j + PASSAGE]))] += 1
    # In a few passages nothing is common: a word counts as such from a handful of passages on.
    weight = np.where(held > max(COMMON * total, 20), 0.0, np.log((total + 1) / np.maximum(held, 1)))
    index = _index(items, passages, owner, runs, weight, latent_terms(places, items, weight))
    lookup = spark.sparkContext.broadcast(index)  # bounded like the words
    names = spark.createDataFrame([(n, x.name) for n, x in enumerate(items)], f"item long, name {item_kind}")
    found = places.select("doc", "text_hash", "gaps", "terms").mapInArrow(_leaks(lookup), found_kind)
    return found.join(F.broadcast(names), "item").select(
        "doc", "text_hash", F.col("name").alias("item"), "lcs", "answer_lcs", "cosine", "first_word", "end_word"
    )
