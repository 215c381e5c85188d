"""Phrase collocations by Toivonen's sampling method, with exact counts.

1. A sample proposes: phrases that are frequent in it at a lowered support, found level by level.
2. One pass over all texts counts the proposals and their negative border: every word, and every phrase
   whose first and last sub-phrase are both proposed, proposed itself or not.
3. A phrase of the border that turns out to be frequent is a failure of the sample. Failures join the
   proposals, and an expansion pass counts what becomes reachable through them, and through what it reaches, and
   nothing else. Then no frequent phrase is left: the two parts of the shortest one not counted would
   be counted and frequent, so each would be proposed, a failure, or reached by the expansion, and so would be the phrase.
4. The frequent phrases get their words: nearly all from a share of the texts, the others from one more pass,
   so that a phrase is written down a few times and not once a block.

Sets of phrases travel as bitmaps of fixed size over phrase keys. Where two phrases share a bit, a phrase is
counted or named that need not be: more work, never a lost or wrong count. The border is never listed; it is
what the bitmap lets through. Tasks add up blocks of texts before anything is shuffled, so a very
common phrase is one row a block. Phrases are told apart by keys of 64 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.words import WordHashes, texts
from ledgermill.session import stored

LONGEST, SUPPORT, TOP = 5, 100, 2000
#: Share of the documents in the sample, and what its support is lowered to. Both change work only.
SAMPLE, LOWERED = 0.1, 0.5
#: The proposals' bitmap has 2^BITS bits.
BITS = 26
#: Words of a block that a task counts at once, and the part of the texts that is looked at first for names.
BLOCK_WORDS, NAMED_FIRST = 600_000, 16

_CUTS = b".,;:!?\n\x0b\x0c\r"
_FORM = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _CUTS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_CUTS)
)
_hashes = WordHashes()
_NOTHING, _CUT = (np.uint64(_hashes[w]) for w in (b"", b"\n"))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

#: A worker's bitmaps, by the name of their broadcast.
_bitmaps: dict[str, np.ndarray] = {}


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def pieces_and_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased; the words, with a line feed wherever a piece ends, and empty strings in between."""
    return text.translate(_FORM).replace(b"\n", b" \n ").split(b" ")


class Bitmap:
    """The set bits of a set of phrase keys, sent as words of 64 bits; workers unfold it once."""

    def __init__(self, spark, keys: DataFrame | None, before: "Bitmap | None" = None):
        at, bits = (before.at, before.bits) if before else (np.empty(0, np.int64), np.empty(0, np.uint64))
        if keys is not None:
            bit = F.shiftrightunsigned("key", 64 - BITS)
            some = keys.select(bit.alias("bit")).selectExpr("bit div 64 as at", "shiftleft(1L, cast(bit % 64 as int)) as bits")
            # At most 2^(BITS - 6) rows.
            new = some.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
            at = np.concatenate([at, new.column("at").to_numpy()])
            bits = np.concatenate([bits, new.column("bits").to_numpy().view(np.uint64)])
        self.at, self.bits = at, bits
        self.name = uuid.uuid4().hex
        self.shared = spark.sparkContext.broadcast((self.name, at, bits))


def _unfolded(shared) -> np.ndarray:
    name, at, bits = shared.value
    if name not in _bitmaps:
        while len(_bitmaps) > 1:
            _bitmaps.pop(next(iter(_bitmaps)))
        whole = np.zeros(1 << (BITS - 6), np.uint64)
        np.bitwise_or.at(whole, at, bits)
        _bitmaps[name] = whole
    return _bitmaps[name]


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys >> np.uint64(64 - BITS)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _levels(own: np.ndarray, seeds: np.ndarray, longest: int, bitmap: np.ndarray, old: np.ndarray | None = None):
    """For each length: positions and keys of the phrases that can be reached through ``bitmap``.

    With ``old``: of those which ``old`` does not reach, also the ones reached through such phrases.
    """
    words = own != _CUT
    keys = _stir(own ^ seeds)
    at = np.flatnonzero(words)
    if old is None:
        yield at, keys[at]
    alive, known = words & _has(bitmap, keys), None if old is None else words & _has(old, keys)
    for k in range(2, longest + 1):
        at = np.flatnonzero(alive[:-1] & alive[1:])
        if not len(at):
            return
        found = _stir(keys[at] * _M1 + own[at + k - 1] * _M2 + np.uint64(k))
        keys[at] = found
        alive = np.zeros(len(own), bool)
        alive[at] = _has(bitmap, found)
        if known is None:
            yield at, found
        else:
            new = ~(known[at] & known[at + 1])
            yield at[new], found[new]
            alive[at] |= new
            known = np.zeros(len(own), bool)
            known[at] = ~new & _has(old, found)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, keys, times) of the different keys, each by one of its places."""
    order = np.argsort(keys)
    own = keys[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.empty(0, np.int64)
    return order[first], own[first], np.diff(np.append(first, len(own)))


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x.encode(), 1) for x in langs], np.uint64)


def _of_all_words(langs: list[str]) -> np.ndarray:
    """The keys under which all words of a lang are counted."""
    return _stir(_seeds(langs) + _M1)


def _blocks(batches: Iterator[pa.RecordBatch], with_words: bool):
    """(own hashes, seeds, words, langs, ends) of blocks of whole texts, each text followed by a cut."""
    own, words, langs, held = [], [], [], 0

    def block():
        lengths = np.array([len(x) for x in own])
        return np.concatenate(own), np.repeat(_seeds(langs), lengths), words, langs, np.cumsum(lengths)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
            found = pieces_and_words(text)
            found.append(b"\n")
            if with_words:
                found = [w for w in found if w]
                words += found
            hashed = _hashes.of(found)
            hashed = hashed[hashed != _NOTHING]
            own.append(hashed)
            langs.append(lang)
            held += len(hashed)
            if held >= BLOCK_WORDS:
                yield block()
                own, words, langs, held = [], [], [], 0
    if own:
        yield block()


def counted(docs: DataFrame, proposed: Bitmap, before: Bitmap | None, longest: int) -> DataFrame:
    """``key``, ``f``: occurrences of what is reached; without ``before`` also of all words of each lang."""
    new, old = proposed.shared, before and before.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, former = _unfolded(new), None if old is None else _unfolded(old)
        for own, seeds, _, langs, ends in _blocks(batches, False):
            for k, (at, keys) in enumerate(_levels(own, seeds, longest, bitmap, former)):
                if k == 0 and former is None:
                    of = np.bincount(np.searchsorted(ends, at, "right"), minlength=len(langs))
                    yield pa.RecordBatch.from_arrays([pa.array(_of_all_words(langs).view(np.int64)), pa.array(of)], ["key", "f"])
                _, some, times = _distinct(keys)
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(times)], ["key", "f"])

    return docs.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def proposals(sample: DataFrame, support: int, longest: int) -> Bitmap:
    """The bitmap of what is frequent in the sample, level by level."""
    proposed = Bitmap(sample.sparkSession, None)
    while True:
        some = stored(counted(sample, proposed, None, longest).filter(F.col("f") >= support).select("key"))
        missed = _outside(some, proposed)
        if not missed.head(1):
            return proposed
        proposed = Bitmap(sample.sparkSession, missed, proposed)


def frequent_keys(docs: DataFrame, support: int, longest: int, proposed: Bitmap) -> DataFrame:
    """``key``, ``f`` of all phrases that occur ``support`` times or more."""
    found = stored(counted(docs, proposed, None, longest).filter(F.col("f") >= support))
    failures = _outside(found.select("key"), proposed)
    if not failures.head(1):
        return found
    wider = Bitmap(docs.sparkSession, failures, proposed)
    return found.union(stored(counted(docs, wider, proposed, longest).filter(F.col("f") >= support)))


def _outside(keys: DataFrame, proposed: Bitmap) -> DataFrame:
    """Keys whose bit is not set: failures of the border."""
    shared = proposed.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = _unfolded(shared)
        for batch in batches:
            yield batch.filter(pa.array(~_has(bitmap, batch.column("key").to_numpy().view(np.uint64))))

    return keys.mapInArrow(run, "key long")


def named(docs: DataFrame, walk: Bitmap, wanted: Bitmap, longest: int) -> DataFrame:
    """``key``, ``name`` (lang, phrase, length) of the keys in ``wanted``; length 0 is all words of a lang."""
    all_keys, few = walk.shared, wanted.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, asked = _unfolded(all_keys), _unfolded(few)
        for own, seeds, words, langs, ends in _blocks(batches, True):
            of = np.array(langs, object)
            held = sorted(set(langs))
            keys = _of_all_words(held)
            here = _has(asked, keys)
            yield _rows(keys[here], np.array(held, object)[here], [b""] * int(here.sum()), 0)
            for k, (at, found) in enumerate(_levels(own, seeds, longest, bitmap), 1):
                here = _has(asked, found)
                place, some, _ = _distinct(found[here])
                first = at[here][place]
                phrases = [b" ".join(words[i : i + k]) for i in first.tolist()]
                yield _rows(some, of[np.searchsorted(ends, first, "right")], phrases, k)

    rows = docs.mapInArrow(run, "key long, lang string, phrase string, length int")
    return stored(rows.groupBy("key").agg(F.min(F.struct("lang", "phrase", "length")).alias("name")))


def _rows(keys: np.ndarray, langs: np.ndarray, phrases: list[bytes], length: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys.view(np.int64)),
            pa.array(langs, pa.string()),
            # Cut at ASCII characters only, so still UTF-8.
            pa.array(phrases, pa.binary()).view(pa.string()),
            pa.array(np.full(len(phrases), length, np.int32)),
        ],
        ["key", "lang", "phrase", "length"],
    )


def drawn(docs: DataFrame, share: float, salt: int) -> DataFrame:
    """About this share of the rows, by a hash of their text, always the same ones."""
    return docs.filter(F.pmod(F.xxhash64("lang", "text", F.lit(salt)), F.lit(10_000)) < int(share * 10_000))


def frequent_phrases(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, sample: float = SAMPLE, lowered: float = LOWERED
) -> DataFrame:
    """lang, phrase, length, f of all phrases with f >= ``support``, and all words of a lang as length 0.

    ``docs`` has ``lang`` and ``text``.
    """
    spark = docs.sparkSession
    proposed = proposals(drawn(docs, sample, 3), max(2, int(support * sample * lowered)), longest)
    keys = frequent_keys(docs, support, longest, proposed)
    walk = Bitmap(spark, keys.select("key"))
    names = named(drawn(docs, 1 / NAMED_FIRST, 5), walk, walk, longest)
    rest = stored(keys.select("key").join(names, "key", "left_anti"))
    if rest.head(1):
        names = names.union(named(docs, walk, Bitmap(spark, rest), longest).join(rest, "key", "left_semi"))
    return stored(keys.join(names, "key").select("name.lang", "name.phrase", "name.length", "f"))


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of two words and more, by their lowest-scoring cut.

    ``phrases`` (lang, phrase, length, f) must hold all parts of its phrases. Products have 38 digits.
    """
    words, k = F.split("phrase", " "), F.col("k")
    cuts = (
        phrases.filter("length >= 2")
        .withColumnRenamed("f", "a")
        .select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), k).alias("left"), _part(F.col("w"), k + 1, F.size("w") - k).alias("right"))
    )
    known = phrases.select("lang", F.col("phrase").alias("part"), "f")
    ahead = known.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    behind = known.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    score = F.expr("1000 * cast(a as decimal(19,0)) * cast(n as decimal(15,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return (
        cuts.join(ahead, ["lang", "left"])
        .join(behind, ["lang", "right"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", "a", "n")
        .agg(best)
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    )


def covered(phrases: DataFrame, percent: int) -> DataFrame:
    """lang, phrase of those that lie in a longer phrase with ``percent`` hundredths of their occurrences.

    One word more is enough to look at: what is between a phrase and a longer one occurs at least as often as that.
    """
    words = F.split("phrase", " ")
    longer = phrases.filter("length >= 3").select("lang", words.alias("w"), "length", "f")
    less = F.col("length") - 1
    inner = longer.select("lang", "f", F.explode(F.array(_part(F.col("w"), F.lit(1), less), _part(F.col("w"), F.lit(2), less))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    both = phrases.select("lang", "phrase", "f").join(most, ["lang", "phrase"])
    return both.filter(100 * F.col("most") >= percent * F.col("f")).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int = TOP,
    cover: int = 100,
    sample: float = SAMPLE,
    lowered: float = LOWERED,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's best ``top`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased, texts are cut at ``.,;:!?`` and line ends into pieces, and pieces at blanks and tabs
    into words. n counts a lang's words, a a phrase's occurrences within pieces (overlaps included), at least
    ``support``; l and r those of the two parts of the cut with the lowest score floor(1000 a n / (l r)),
    ties to the earlier cut. Phrases inside a longer candidate with ``cover`` hundredths of their
    occurrences are dropped. Order: score and a descending, phrase by its bytes.

    A null lang is ``und``, also where rows say ``und``. Null and empty texts have no words. Repeated rows
    count as often as they occur; other columns are ignored, and an empty table, or one without frequent
    phrases, gives no rows. The result does not depend on ``sample`` and ``lowered``.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    found = frequent_phrases(rows, support, longest, sample, lowered)
    totals = found.filter("length = 0").select("lang", F.col("f").alias("n"))
    phrases = found.filter("length > 0")
    left = scored(phrases, totals).join(covered(phrases.filter("length >= 2"), cover), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
