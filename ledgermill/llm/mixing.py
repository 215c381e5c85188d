"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order. A copy's virtual finish time is the number of
words its source has sent up to and with it, divided by the source's target; further rounds
over the source go on from its end. All copies are ranged by finish time, and the mix is cut where
its words reach the budget: at that time every source is near its target.

No window holds a whole source or the whole corpus. Running sums inside a source are cut into
4096 slices by the leading digits of the shuffle key, with sums of whole slices added. For the
cut, copies are counted in slots of finish time; only the slot in which the budget ends is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.words import texts
from ledgermill.session import small_batches, stored

DIGITS = 3
#: Slots of finish time up to 2; beyond, the slots widen with the time.
SLOTS = 4096


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pa.array([len(text.split()) for text in texts(batch, "text")], pa.int64())
        yield batch.drop_columns(["text"]).append_column("size", size)


def source_targets(sized: DataFrame, rounds: int, weights: tuple[int, ...]) -> DataFrame:
    """One row per source: ``nth`` in code point order, ``source_size``, ``target``.

    The target shares are water-filled: sources in order of limit over weight stop at their limit as
    long as the rest, shared by weight, would give them more. Sums are exact decimals. The windows
    see one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy(F.col("limit") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(28,0)"
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    left = (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0))).cast(wide)
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("limit", F.col("source_size") * rounds)
        .withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("left", left)
        .withColumn("left_weight", left_weight)
        .withColumn("stops", F.col("weight") * F.col("left") > F.col("limit").cast(wide) * F.col("left_weight"))
    )
    free = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("limit"))).over(everything), F.lit(0))
    share = (F.col("weight") * rest).cast("double") / free.cast("double")
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(share)
    return filled.select("source", "nth", "source_size", target.alias("target"))


def _finish(turn: int) -> Column:
    return (F.col("source_size") * turn + F.col("sent")).cast("double") / F.col("target")


def _copies(queued: DataFrame, rounds: int) -> DataFrame:
    """One row per document and round, documents without words left out: they weigh nothing."""
    times = F.array(*(F.struct(_finish(i).alias("finish"), F.lit(i).alias("turn")) for i in range(rounds)))
    slot = F.when(F.col("finish") < 2, F.floor(F.col("finish") * SLOTS)).otherwise(
        2 * SLOTS + F.floor(F.log2("finish") * 64)
    )
    return (
        queued.filter("size > 0")
        .select("doc_id", "nth", "key", "size", F.explode(times).alias("copy"))
        .select("doc_id", "nth", "key", "size", "copy.*")
        .withColumn("slot", slot.cast("long"))
    )


def mix_sources(
    docs: DataFrame, rounds: int = 3, weights: tuple[int, ...] = (1, 2, 3), columns: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``docs``, and the named ``columns``.

    ``size`` is the number of words (null text: 0). Sources in code point order, null last, weigh
    ``weights`` in turn; the targets share the size of all documents, none over ``rounds`` times its
    source. ``taken`` is size times the copies that the mix holds, at most ``rounds``.

    The shuffled order is that of the MD5 of the id as text, then id and size, so reruns agree; rows that
    agree in all three are alike. Null ids are shuffled as an empty text. Without any word all
    targets and ``taken`` are 0; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    narrow = list(dict.fromkeys(["doc_id", "source", *columns]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*narrow).schema)
    sizes = docs.select(*narrow, "text").mapInArrow(_sizes, f"{kinds}, size long")
    sized = stored(sizes.withColumn("key", key))
    targets = stored(source_targets(sized, rounds, weights))
    named = sized.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source")))
    named = named.drop("own", *({"source"} - set(columns))).withColumn("slice", F.substring("key", 1, DIGITS))
    slices = (
        named.groupBy("nth", "slice")
        .agg(F.sum("size").alias("words"))
        .withColumn("earlier", F.sum("words").over(Window.partitionBy("nth").orderBy("slice")) - F.col("words"))
        .drop("words")
    )
    in_slice = Window.partitionBy("nth", "slice").orderBy("key", "doc_id", "size")
    sent = F.sum("size").over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
    queued = stored(
        named.withColumn("sent", sent)
        .join(slices, ["nth", "slice"])
        .withColumn("sent", F.col("sent") + F.col("earlier"))
        .drop("slice", "earlier")
    )
    last = _last_taken(queued, targets, rounds)
    if last is None:
        copies = F.lit(0)
    else:
        at = F.struct(*(F.lit(last[c]).alias(c) for c in ("finish", "nth", "key", "doc_id", "turn")))
        turns = (F.struct(_finish(i).alias("finish"), "nth", "key", "doc_id", F.lit(i).alias("turn")) for i in range(rounds))
        copies = sum((F.when(F.col("size") > 0, (x <= at).cast("int")).otherwise(0) for x in turns), F.lit(0))
    return queued.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), *columns
    )


def _last_taken(queued: DataFrame, targets: DataFrame, rounds: int):
    """The last copy, by finish time, up to which the words of all copies fit the budget."""
    budget = targets.agg(F.sum("source_size")).first()[0]
    if not budget:
        return None
    copies = _copies(queued, rounds)
    # At most 2 * SLOTS slots, and 64 for each doubling of the finish time.
    slots = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    sums = slots.withColumn("reached", F.sum("words").over(Window.orderBy("slot")))
    full = sums.filter(F.col("reached") >= budget).orderBy("slot").first()
    earlier = full["reached"] - full["words"]
    order = ("finish", "nth", "key", "doc_id", "turn")
    in_slot = Window.partitionBy("slot").orderBy(*order, "size").rowsBetween(Window.unboundedPreceding, 0)
    fits = (
        copies.filter(F.col("slot") == full["slot"])
        .withColumn("reached", F.sum("size").over(in_slot) + earlier)
        .filter(F.col("reached") <= budget)
    )
    inside = fits.orderBy(*(F.col(c).desc() for c in order)).first()
    if inside is not None:
        return inside
    return copies.filter(F.col("slot") < full["slot"]).orderBy(*(F.col(c).desc() for c in order)).first()
