"""Repeated byte strings, found by suffix sorting of aligned fragments, removed from whole texts.

1. Every start of a ``length``-byte string belongs to the least of the 64-byte hashes in the string, so equal
   strings belong to equal 64 bytes at the same offset. Consecutive starts with one such anchor are a run,
   and the bytes from its first start to the end of its last string a fragment. Only runs whose
   anchor occurs again go on.
2. Equal fragments are one from here on; all starts of a fragment that occurs twice are repeated.
3. Anchors with several fragments are dealt to shards of bounded size. A shard's fragments are cut into cells of
   16 bytes that are aligned with the anchor, and their suffixes at cell bounds are sorted (see
   ``suffixes``). Neighbours in that order with a common prefix that, with equal bytes before it, gives ``length``
   bytes make starts repeated. An anchor with too many fragments for a shard is dealt over several, whose
   sorted strings are merged by a digest.
4. Marked starts go back to their documents, where the bytes that they cover are removed.

All steps compare bytes; hashes only bring together what is compared, but for equal fragments and the merge of
shards, which trust 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.suffixes import suffix_array
from ledgermill.llm.words import texts
from ledgermill.session import stored

KEY, CELL = 64, 16
#: Bytes of a text that are hashed at once, and bits of a hash that hold the place there.
CHUNK, PLACE_BITS = 1 << 19, 20
#: Fragments of one anchor that stay together, and bytes that a shard holds on average.
TOGETHER, SHARD_BYTES = 8_000, 1 << 20

_random = np.random.Generator(np.random.PCG64(77))
BYTE = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_random.integers(2**62, 2**63)) * 2 + 1


def _powers(base: int, count: int) -> np.ndarray:
    out, n = np.ones(count, np.uint64), 1
    while n < count:
        m = min(n, count - n)
        out[n : n + m] = out[:m] * np.uint64(pow(base, n, 1 << 64))
        n += m
    return out


POWER, INVERSE = _powers(BASE, CHUNK + 4096), _powers(pow(BASE, -1, 1 << 64), CHUNK + 4096)


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the KEY bytes from each place on."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * POWER[: len(data)], out=sums[1:])
    h = (sums[KEY:] - sums[:-KEY]) * INVERSE[: len(data) - KEY + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def runs(text: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first start, last start, place of the anchor, hash of the anchor), ascending, for all starts."""
    width = length - KEY + 1
    held = None
    for begin in range(0, max(0, len(text) - length + 1), CHUNK - length + 1):
        data = np.frombuffer(text, np.uint8, min(CHUNK, len(text) - begin), begin)
        h = _hashes(data)
        # The least hash, and the leftmost place among equals.
        low = np.uint64((1 << PLACE_BITS) - 1)
        packed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(packed) // width)
        grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
        grid[: len(packed)] = packed
        grid = grid.reshape(rows, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(packed) - width + 1
        least = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(least, prepend=-1))
        last = np.append(first[1:], count) - 1
        for a, b, at in zip((first + begin).tolist(), (last + begin).tolist(), least[first].tolist(), strict=True):
            if held and held[2] == at + begin:
                held = (held[0], b, held[2], held[3])  # a run that goes on in the next chunk
                continue
            if held:
                yield held
            held = (a, b, at + begin, int(h[at]))
    if held:
        yield held


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for i, text in enumerate(texts(batch, "text")):
                for a, b, at, h in runs(text, length):
                    for column, value in zip(out, (k1[i], k2[i], a, b, at, _signed(h)), strict=True):
                        column.append(value)
                if len(out[0]) > 200_000:
                    yield _longs(out, RUN)
                    out = [[], [], [], [], [], []]
            yield _longs(out, RUN)

    return run


RUN = ("k1", "k2", "a", "b", "at", "anchor")


def _longs(columns: list[list], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))


def _fragments(length: int):
    """Each run's fragment: its digest for every run, its bytes once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, int] = {}
            rows: list[tuple] = []
            held = 0
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for i, text in enumerate(texts(batch, "text")):
                for r in batch.column("runs")[i].as_py():
                    data = text[r["a"] : r["b"] + length]
                    d = xxhash.xxh3_128_intdigest(data + (r["at"] - r["a"]).to_bytes(8, "big"))
                    name = (r["anchor"], d)
                    new = name not in seen
                    seen[name] = 1
                    held += len(data) if new else 0
                    rows.append((k1[i], k2[i], r["a"], r["anchor"], _signed(d >> 64), _signed(d & ((1 << 64) - 1)), r["at"] - r["a"], r["b"] - r["a"] + 1, data if new else None))
                if held > 8 << 20 or len(rows) > 200_000:
                    yield _found(rows)
                    rows, held, seen = [], 0, {}
            yield _found(rows)

    return run


FOUND = ("k1", "k2", "a", "anchor", "d1", "d2", "lead", "starts")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
    arrays = [pa.array(c, pa.int64()) for c in columns[:8]]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[8], pa.binary())], [*FOUND, "data"])


def _marks(length: int):
    """A shard's fragments -> the runs of starts that are repeated in it, and, where its anchors go on in
    other shards, the digest of every different string."""

    def run(table):
        data = table.column("data").to_pylist()
        lead, starts = table.column("lead").to_numpy(), table.column("starts").to_numpy()
        copies, split = table.column("copies").to_numpy(), table.column("split").to_numpy()
        base = np.concatenate(([0], np.cumsum(starts)))
        marked = np.zeros(base[-1], bool)
        left: list[list] = [[], [], [], [], []]
        bound, owner, order = _sorted_bounds(data, lead)
        offset = np.concatenate(([0], np.cumsum([len(x) for x in data])))[:-1]
        whole = np.frombuffer(b"".join(data) + b"\0" * (length + CELL), np.uint8)
        lengths = np.array([len(x) for x in data])
        rest = lengths[owner] - bound
        fit = order[rest[order] >= length - CELL + 1]
        where = offset[owner[fit]] + bound[fit]
        common = _common(whole, where, rest[fit], length)
        # The 16 bytes before each bound, as two numbers.
        earlier = np.concatenate([np.zeros(CELL, np.uint8), whole])
        window = np.lib.stride_tricks.sliding_window_view(earlier, CELL)[where].copy()
        halves = window.view(">u8").astype(np.uint64)
        for g in range(CELL):
            start = bound[fit] - g
            ok = (start >= 0) & (start < starts[owner[fit]])
            if not ok.any():
                continue
            interval = np.cumsum(common < length - g)[ok]
            low = halves[ok, 1] & np.uint64((1 << 8 * min(g, 8)) - 1)
            high = halves[ok, 0] & np.uint64((1 << 8 * max(0, g - 8)) - 1)
            by = np.lexsort((low, high, interval))
            new = np.concatenate(([True], (np.diff(interval[by]) != 0) | (np.diff(low[by]) != 0) | (np.diff(high[by]) != 0)))
            classes = np.cumsum(new) - 1
            own, at = owner[fit][ok][by], start[ok][by]
            count = np.bincount(classes, copies[own])
            twice = count[classes] > 1
            marked[base[own[twice]] + at[twice]] = True
            lone = new & split[own].astype(bool)
            for i, s, c in zip(own[lone].tolist(), at[lone].tolist(), count[classes][lone].tolist(), strict=True):
                d = xxhash.xxh3_128_intdigest(data[i][s : s + length])
                for column, value in zip(left, (i, s, _signed(d >> 64), _signed(d & ((1 << 64) - 1)), int(c)), strict=True):
                    column.append(value)
        names = [table.column(c).to_numpy() for c in ("anchor", "d1", "d2")]
        rows = [(i, a, b, None, None, None) for i in range(len(data)) for a, b in _spans(marked[base[i] : base[i + 1]])]
        rows += [(i, s, s, x, y, c) for i, s, x, y, c in zip(*left, strict=True)]
        index = np.array([r[0] for r in rows], np.int64)
        columns = list(zip(*rows, strict=True))[1:] if rows else [[]] * 5
        arrays = [pa.array(n[index]) for n in names] + [pa.array(c, pa.int64()) for c in columns]
        return pa.Table.from_arrays(arrays, names=["anchor", "d1", "d2", "first", "last", "s1", "s2", "n"])

    return run


MARK = "anchor long, d1 long, d2 long, first long, last long, s1 long, s2 long, n long"


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _sorted_bounds(data: list[bytes], lead: np.ndarray):
    """Cell bounds (place, fragment) and the order of the suffixes there.

    The text to sort has a symbol for each cell, in byte order, a fragment's last and shorter cell before
    all that go on from it, and closes each fragment with a symbol of its own below all cells.
    """
    cells, sizes, bound, owner, n = [], [], [], [], len(data)
    for i, x in enumerate(data):
        first = int(lead[i]) % CELL
        at = np.arange(first, max(len(x), first + 1), CELL)
        cells.append(x[first:].ljust(len(at) * CELL, b"\0"))
        sizes.append(np.minimum(CELL, len(x) - at))
        bound.append(np.append(at, len(x)))
        owner.append(np.full(len(at) + 1, i))
    numbers = np.frombuffer(b"".join(cells), ">u8").reshape(-1, 2).astype(np.uint64)
    size = np.concatenate(sizes)
    by = np.lexsort((size, numbers[:, 1], numbers[:, 0]))
    new = (np.diff(numbers[by], axis=0) != 0).any(axis=1) | (np.diff(size[by]) != 0)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.concatenate(([0], np.cumsum(new))) + n
    text, at = [], 0
    for i, x in enumerate(sizes):
        text += rank[at : at + len(x)].tolist()
        text.append(n - 1 - i)
        at += len(x)
    order = np.array(suffix_array(text), np.int64)
    return np.concatenate(bound), np.concatenate(owner), order


def _common(whole: np.ndarray, where: np.ndarray, rest: np.ndarray, length: int) -> np.ndarray:
    """Common prefix, up to ``length`` and both ends, of each sorted suffix with the one before it."""
    out = np.zeros(len(where), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(whole, length)
    for i in range(1, len(where), 4096):
        j = min(len(where), i + 4096)
        differ = view[where[i:j]] != view[where[i - 1 : j - 1]]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        out[i:j] = np.minimum(first, np.minimum(rest[i:j], rest[i - 1 : j - 1]))
    return out


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, n_bytes, n_removed, n_spans, digests = [], [], [], [], []
            spans = batch.column("spans")
            for i, text in enumerate(texts(batch, "text")):
                parts, at, gone, count, reach = [], 0, 0, 0, -1
                for s in sorted((s["first"], s["last"]) for s in spans[i].as_py() or ()):
                    a, b = s[0], s[1] + length
                    if a > reach:
                        parts.append(text[at:a])
                        count += 1
                        gone += b - a
                    elif b > reach:
                        gone += b - reach
                    reach = max(reach, b)
                    at = reach
                parts.append(text[at:])
                kept = b"".join(parts)
                left.append(kept)
                n_bytes.append(len(text))
                n_removed.append(gone)
                n_spans.append(count)
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)),
                    pa.array(digests),
                    pa.array(left, pa.binary()),
                ],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, n_bytes, n_removed, n_spans, kept_sha256, ``kept`` (binary) for each row of ``docs``.

    Texts are UTF-8 bytes. Every byte covered by a string of ``length`` bytes that also starts at another
    place, in the same row or another, is removed; strings may overlap and are judged on the input.
    ``n_spans`` counts the maximal removed runs, ``kept`` is what remains, which may cut characters.

    Null and empty texts have no bytes. Repeated rows are each other's copies, so their long texts go as a whole;
    ids may be null or repeated. Other columns are ignored, and an empty table gives an empty result.
    """
    if length < KEY + CELL:
        raise ValueError(f"strings must have at least {KEY + CELL} bytes")
    doc, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        doc.alias("doc"), text.alias("text"), F.xxhash64(doc, text).alias("k1"), F.xxhash64(F.lit(1), doc, text).alias("k2")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in RUN)
    runs_found = stored(keyed.select("k1", "k2", "text").mapInArrow(_anchors(length), longs))
    # Stored, so that the join may split an anchor with very many runs.
    again = stored(runs_found.groupBy("anchor").count().filter("count > 1").select("anchor"))
    wanted = (
        runs_found.join(again, "anchor")
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("a", "b", "at", "anchor")).alias("runs"))
    )
    cut = keyed.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "runs")
    found = stored(cut.mapInArrow(_fragments(length), ", ".join(f"{c} long" for c in FOUND) + ", data binary"))
    name = ["anchor", "d1", "d2"]
    fragments = found.groupBy(*name).agg(
        F.count("*").alias("copies"), F.max("lead").alias("lead"), F.max("starts").alias("starts"), F.max("data").alias("data")
    )
    fragments = stored(fragments)
    several = fragments.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    # Equal fragments that no other fragment shares its anchor with need no comparison.
    whole = fragments.filter("copies > 1").select(*name, F.lit(0).cast("long").alias("first"), (F.col("starts") - 1).alias("last"))
    compared = fragments.join(several, "anchor")
    blocks = F.ceil(F.col("kinds") / TOGETHER).cast("int")
    total = compared.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = compared.withColumn("split", (blocks > 1).cast("int")).withColumn(
        "shard", F.pmod(F.xxhash64("anchor", F.pmod("d1", blocks)), F.lit(shards)).cast("int")
    )
    marks = stored(dealt.drop("kinds").groupBy("shard").applyInArrow(_marks(length), MARK))
    across = (
        marks.filter("n is not null").groupBy("s1", "s2").agg(F.sum("n").alias("all"), F.count("*").alias("held")).filter("held > 1")
    )
    merged = marks.filter("n is not null").join(across, ["s1", "s2"]).select(*name, "first", "last")
    inside = marks.filter("n is null").select(*name, "first", "last")
    starts = whole.union(inside).union(merged).distinct()
    spans = (
        found.select("k1", "k2", "a", *name)
        .distinct()
        .join(starts, name)
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct((F.col("a") + F.col("first")).alias("first"), (F.col("a") + F.col("last")).alias("last"))).alias("spans"))
    )
    texts_left = keyed.join(spans, ["k1", "k2"], "left").select("doc", "text", "spans")
    result = f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return texts_left.mapInArrow(_cut(length), result)
