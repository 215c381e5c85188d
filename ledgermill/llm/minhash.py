"""Near-duplicate documents by MinHash, banding, verified links and components.

1. Every text becomes its set of word shingles, one minimum for each of 128 universal hash functions,
   and 32 bands of four minima. Texts with the same set are one class from here on.
2. Rounds over the first bands: in each bucket the classes of other components than its centre's are
   compared with the centre, a member drawn by hash, first by signature, then on full sets. The links
   found are joined into components, so a group of near copies soon is one component.
3. What is left are buckets that hold more than one component. Shingles that only one document in such buckets
   has are in no intersection, which bounds a document's similarity with any other: whoever cannot reach the
   threshold has no links and leaves. The others are clustered by the buckets they share. In a cluster each
   document travels once with its set, or, in a large cluster, once to each pair of blocks; the tasks compare
   documents of different components by that bound, by signature and on full sets, and return only links that
   join two components of what they have seen, so fewer than a block has members.
4. Components of all links, by alternating large-star and small-star.

A pair with similarity 0.85 shares no bucket with probability (1 - 0.85^4)^32 < 1e-10, one with 0.80
with 5e-8. Signatures may agree six standard deviations less than expected (``least_agreement``), which
leaves out about one link in a hundred million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.components import connected_components
from ledgermill.llm.words import WordHashes, texts, words_of
from ledgermill.session import small_batches, stored, stored_by

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Bands of each round of stars. They make few components of large groups; what is left is compared in clusters
#: over all bands.
ROUNDS = ((0, 2), (2, 8))
#: Documents which cannot have links are taken out again as long as that takes out this share of the rest, for
#: others are then left with more shingles of their own. Stopping early costs comparisons, never a link.
FEWER = 0.1
#: Shingles of a block of a cluster, about.
BLOCK_SHINGLES = 200_000

_random = np.random.Generator(np.random.PCG64(20240229))
#: Multiply-shift: (a * x + b) mod 2^64 >> 32 is strongly universal for 32-bit x.
A = _random.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
B = _random.integers(0, 2**63, MINIMA, dtype=np.uint64)
ODD = _random.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_hashes = WordHashes()


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a text with fewer words is one shingle."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    own = _hashes.of(words)
    n = min(width, len(words))
    at = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        at += own[i : len(own) - n + 1 + i] * ODD[i]
    return np.unique(_stir(at))


def signature(shingles: np.ndarray) -> np.ndarray:
    x = shingles >> np.uint64(32)
    least = np.full(MINIMA, 2**32, np.uint64)
    for start in range(0, len(x), 2048):
        part = A[:, None] * x[None, start : start + 2048]
        part += B[:, None]
        np.minimum(least, (part >> np.uint64(32)).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    mixed = (least.reshape(BANDS, ROWS) * ODD[None, :ROWS]).sum(axis=1, dtype=np.uint64)
    return _stir(mixed + np.arange(BANDS, dtype=np.uint64) * ODD[15])


def _sketches(width: int, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, minima, bands = [], [], [], [], []
            for text in texts(batch, text_col):
                shingles = shingle_set(text, width)
                n.append(len(shingles))
                # The set as a whole, in two independent sums over its well-mixed members.
                one, two = shingles.sum(dtype=np.uint64), _stir(shingles * ODD[14]).sum(dtype=np.uint64)
                d1.append(one.view(np.int64))
                d2.append(two.view(np.int64))
                if len(shingles):
                    least = signature(shingles)
                    minima.append(least.astype(np.uint8).tobytes())
                    bands.append(band_keys(least).view(np.int64))
                else:
                    minima.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col).cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.array(minima, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "minima", "bands"],
            )

    return run


def _full_sets(width: int, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, width).view(np.int64) for text in texts(batch, text_col)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
            )

    return run


def least_agreement(percent: int) -> int:
    """Minima of 8 bits each that must agree before full sets are compared."""
    share = percent / 100
    return int(MINIMA * share - 6 * (MINIMA * share * (1 - share)) ** 0.5)


def _joining_links(percent: int):
    """For the documents of two blocks (or one): confirmed links, each of which joins two components."""
    least = least_agreement(percent)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, of, n, common, part = (table.column(c).to_numpy() for c in ("id", "component", "n", "common", "part"))
        minima = np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint8).reshape(-1, MINIMA)
        column = table.column("shingles").chunk(0)
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
        sets = [np.sort(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        _, root = np.unique(of, return_inverse=True)
        across = len(np.unique(part)) > 1
        left, right = [], []
        for i in range(len(ids)):
            most = np.minimum(common[i], common)
            able = (root != root[i]) & (100 * most >= percent * (n[i] + n - most))
            able[: i + 1] = False
            if across:
                able &= part != part[i]
            some = np.flatnonzero(able)
            for j in some[(minima[some] == minima[i]).sum(axis=1) >= least]:
                if root[i] == root[j]:
                    continue
                one, two = (sets[i], sets[j]) if n[i] < n[j] else (sets[j], sets[i])
                both = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
                if 100 * both >= percent * (n[i] + n[j] - both):
                    left.append(min(ids[i], ids[j]))
                    right.append(max(ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        return pa.table({"u": pa.array(left, pa.int64()), "v": pa.array(right, pa.int64())})

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("id").alias("u"), F.col("shingles").alias("s"))
    two = sets.select(F.col("id").alias("v"), F.col("shingles").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    whole = F.size("s") + F.size("t") - both
    return pairs.join(one, "u").join(two, "v").filter(100 * both >= percent * whole).select("u", "v").distinct()


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Words are runs outside [\\x20\\x09-\\x0D], A-Z lower-cased; a text's set holds its distinct shingles
    of ``width`` words, or its whole sequence if shorter. Two documents are linked when their sets
    share at least ``percent`` hundredths; ``component_id`` is the least id reachable over links, itself
    included, and ``kept`` says that it is the row's own.

    Null, empty and blank texts have an empty set and are linked with nothing. Rows that share an id
    are one document, which has the links of all their texts: they share its component. Rows without an id are linked with nothing; their
    component is null and they are kept. Other columns are ignored, and an empty table gives an
    empty result. ``percent`` must be 80 or more: the bands are laid out for that.
    """
    if percent < 80:
        raise ValueError("the bands find links of 80 percent and more")
    small_batches(docs.sparkSession)
    source = docs.select(id_col, text_col)
    kinds = "doc_id long, n_shingles long, d1 long, d2 long, minima binary, bands array<long>"
    sketched = stored(source.mapInArrow(_sketches(width, id_col, text_col), kinds))
    linked = sketched.filter("doc_id is not null and n_shingles > 0")
    classes = stored(
        linked.groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("id"), F.any_value("minima").alias("minima"), F.any_value("bands").alias("bands"))
    )
    marks = classes.select("id", "minima")
    entries = classes.select("id", F.posexplode("bands").alias("band", "key"))
    # The centre is drawn anew for each band, so a document meets several.
    # Stored, like the classes, so that joins may split what very many rows share.
    drawn = F.min(F.struct(F.xxhash64("id", "band").alias("draw"), F.col("id").alias("u")))
    centres = stored(entries.groupBy("band", "key").agg(drawn.alias("drawn"), F.count("*").alias("held")).filter("held > 1"))
    shared = stored(entries.join(centres, ["band", "key"]).select("band", "key", "held", "id", F.col("drawn.u").alias("u")))
    # Stored, so that Spark knows how few they are and need not shuffle the texts.
    sets = _sets_of(source, stored(shared.select("id").distinct()), width, id_col, text_col)
    nodes = _components(shared, marks, sets, percent).withColumnRenamed("node", "id")

    joined = (
        sketched.join(classes.select("d1", "d2", "n_shingles", "id"), ["d1", "d2", "n_shingles"], "left")
        .join(nodes, "id", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")))
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _components(shared: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components of all links between documents that share buckets; ``sets`` lies in buckets of id, so its joins by id
    move ids and not sets."""
    first = None
    for low, high in ROUNDS:
        stars = shared.filter((F.col("band") >= low) & (F.col("band") < high) & (F.col("id") != F.col("u")))
        stars = stars.select(F.least("id", "u").alias("u"), F.greatest("id", "u").alias("v")).distinct()
        # Stored, so that Spark knows how few they are and need not shuffle the sets.
        alike = stored(_alike(_apart(stars, first), marks, percent))
        found = stored(confirmed(alike, sets, percent))
        first = connected_components(found if first is None else _named(first).union(found))

    rest, before = stored(_mixed(shared.select("band", "key", "id"), first)), None
    while True:
        able = _linkable(sets.join(rest.select("id").distinct(), "id"), percent)
        rest = stored(_mixed(rest.select("band", "key", "id").join(able.select("id"), "id"), first))
        held = able.count()
        if held == 0 or before is not None and held > (1 - FEWER) * before:
            break
        before = held
    documents = able.join(marks, "id").join(sets.select("id", "shingles"), "id")
    found = stored(_between_components(rest, documents, percent))
    return connected_components(_named(first).union(found))


def _named(components: DataFrame) -> DataFrame:
    """Components as links of their members with their name."""
    return components.select(F.col("node").alias("u"), F.col("component").alias("v"))


def _apart(pairs: DataFrame, components: DataFrame | None) -> DataFrame:
    """Pairs that are not in one component yet."""
    if components is None:
        return pairs
    one = components.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    two = components.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    named = pairs.join(one, "u", "left").join(two, "v", "left")
    return named.filter(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")


def _alike(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures agree enough."""
    least = least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA) for c in ("x", "y")
            )
            keep = (x == y).sum(axis=1) >= least
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    one = marks.select(F.col("id").alias("u"), F.col("minima").alias("x"))
    two = marks.select(F.col("id").alias("v"), F.col("minima").alias("y"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "x", "y").mapInArrow(run, "u long, v long")


def _mixed(entries: DataFrame, components: DataFrame) -> DataFrame:
    """band, key, held, id, component in the buckets that hold more than one component."""
    named = entries.join(components.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    buckets = named.groupBy("band", "key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("held")
    )
    return named.join(buckets.filter("a <> b").select("band", "key", "held"), ["band", "key"])


def _linkable(sets: DataFrame, percent: int) -> DataFrame:
    """id, n, common: set size, and shingles that another document of ``sets`` has, where that allows a link."""
    alone = sets.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle")
    alone = alone.agg(F.min("id").alias("id"), F.count("*").alias("holders")).filter("holders = 1")
    own = alone.groupBy("id").agg(F.count("*").alias("own"))
    sizes = sets.select("id", "n").join(own, "id", "left")
    able = sizes.select("id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).cast("int").alias("common"))
    return stored(able.filter(100 * F.col("common") >= percent * F.col("n")))


def _sets_of(source: DataFrame, ids: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, shingles, n: full sets of the documents in ``ids`` and their sizes, in buckets of id."""
    wanted = ids.withColumnRenamed("id", id_col)
    some = source.join(wanted, id_col, "left_semi").select(id_col, text_col)
    sets = some.mapInArrow(_full_sets(width, id_col, text_col), "id long, shingles array<long>")
    # The size is a column of its own, so that who needs no more does not read sets.
    return stored_by(sets.withColumn("n", F.size("shingles")), "id")


def _between_components(rest: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """Links that join components of one cluster, from blocks and pairs of blocks.

    ``documents`` has id, n, common, minima and shingles. A cluster is what mixed buckets connect.
    """
    least = F.min("id").over(Window.partitionBy("band", "key"))
    edges = rest.select("id", least.alias("u")).filter("id <> u").select("u", F.col("id").alias("v"))
    clusters = connected_components(edges.distinct())
    own = rest.select("id", "component").distinct()
    placed = (
        documents.join(own, "id")
        .join(clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id", "left")
        .withColumn("cluster", F.coalesce("cluster", "id"))
    )
    sizes = placed.groupBy("cluster").agg(F.sum("n").alias("total"), F.min("component").alias("a"), F.max("component").alias("b"))
    parts = F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")
    sizes = sizes.filter("a <> b").select("cluster", parts.alias("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    sent = (
        placed.join(sizes, "cluster")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("other", other)
        .withColumn("i", F.least("part", "other"))
        .withColumn("j", F.greatest("part", "other"))
    )
    kept = ("cluster", "i", "j", "part", "id", "component", "n", "common", "minima", "shingles")
    return sent.select(*kept).groupBy("cluster", "i", "j").applyInArrow(_joining_links(percent), "u long, v long")
