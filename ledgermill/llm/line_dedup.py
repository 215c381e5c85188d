"""Line deduplication: hashed lines, range-partitioned and streamed in document order.

Every line long enough becomes a row (hash of its key, document, position). The rows are
range-partitioned by hash, and a hash that fills more than one range is cut further by a slice
of the documents. Sorted by hash, document and position, a stream over each slice needs only
the first documents of a hash: the first holder keeps its lines, and whether ``min_docs``
holders exist decides about the others. What stays is sent back as one bitmap per document.
No text is shuffled to find copies, and no hash is ever gathered in one task: at most
``min_docs`` documents of each slice survive the first stream.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICES = 64


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased and nothing else changed."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() is the fast way where every character is one byte.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, UPPER.lower())
    )


def is_long(line: Column, min_points: int) -> Column:
    return F.char_length(F.btrim(line, F.lit(BLANKS))) >= min_points


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def with_document_key(docs: DataFrame, id_col: str, text_col: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """``doc``, ``text`` and two hashes that name a document, so null and repeated ids can be joined.

    ``row`` holds the named ``columns``.
    """
    doc, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.struct(*columns).alias("row") if columns else F.lit(None).alias("row"),
        doc.alias("doc"),
        text.alias("text"),
        F.xxhash64(doc, text).alias("k1"),
        F.xxhash64(F.lit(1), doc, text).alias("k2"),
    )


def kept_lines(keyed: DataFrame, min_points: int, min_docs: int) -> DataFrame:
    """(k1, k2, pos) of the long lines that stay."""
    lines = keyed.select("doc", "k1", "k2", F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    key = line_key(F.col("line"))
    entries = lines.filter(is_long(F.col("line"), min_points)).select(
        F.xxhash64(key).alias("h1"),
        F.xxhash64(F.lit(1), key).alias("h2"),
        F.pmod("k1", F.lit(SLICES)).cast("int").alias("slice"),
        "doc", "k1", "k2", "pos",
    )
    order = (F.col("doc").desc_nulls_last(), "k1", "k2")
    in_slice = Window.partitionBy("h1", "h2", "slice").orderBy(*order)
    in_hash = Window.partitionBy("h1", "h2").orderBy(*order)
    return (
        entries.repartitionByRange("h1", "h2", "slice")
        .sortWithinPartitions("h1", "h2", "slice", *order, "pos")
        .withColumn("nth", F.dense_rank().over(in_slice))
        .filter(F.col("nth") <= min_docs)
        .withColumn("nth", F.dense_rank().over(in_hash))
        .filter(F.col("nth") <= min_docs)
        .withColumn("holders", F.max("nth").over(Window.partitionBy("h1", "h2")))
        .filter((F.col("nth") == 1) | (F.col("holders") < min_docs))
        .select("k1", "k2", "pos")
    )


def keep_bitmaps(keyed: DataFrame, min_points: int, min_docs: int) -> DataFrame:
    """k1, k2, ``words``: for each 64 lines that hold a kept long line, their number and its bits, in order."""
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    return (
        kept_lines(keyed, min_points, min_docs)
        .groupBy("k1", "k2", F.expr("cast(pos div 64 as int)").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_points: int = 20,
    min_docs: int = 3,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc``, ``text`` that is left, ``n_lines``, ``n_dropped``, ``keep``, ``row``.

    A text is split at line feeds. Lines whose key (see ``line_key``) has ``min_points`` code points
    or more and is held by ``min_docs`` documents or more leave every document but the one with
    the largest id; several such lines in that document all stay. ``keep`` is the document's bitmap
    of long lines that stay, 64 lines an entry, without entries that would be 0.

    Null and empty texts are one empty line. Rows that agree in id and text are one document, and
    each gets its result; rows that share an id only are documents ordered by a hash of the text.
    A null id counts as the smallest. ``row`` holds the named ``columns`` of ``docs`` as they are; other
    columns are ignored. An empty table gives an empty result.
    """
    keyed = with_document_key(docs, id_col, text_col, columns)
    bitmaps = keep_bitmaps(keyed, min_points, min_docs)
    lines = text_lines(F.col("text"))
    # One flag a line: the gaps between the words are filled with zeros, then the words are spelled out. What
    # a lambda names besides its own variables is a column, so nothing is computed anew for each line.
    gap = "words[i].word - if(i = 0, -1, words[i - 1].word) - 1"
    spread = f"concat(array_repeat(0L, cast({gap} as int)), array(words[i].bits))"
    dense = F.expr(f"if(size(words) > 0, flatten(transform(sequence(0, size(words) - 1), i -> {spread})), array())")
    flags = F.expr("flatten(transform(dense, w -> transform(sequence(0, 63), j -> (shiftright(w, j) & 1L) = 1L)))")
    left = F.zip_with(
        lines, flags, lambda line, kept: F.when(kept | (F.char_length(F.btrim(line, F.lit(BLANKS))) < min_points), line)
    )
    return (
        keyed.join(bitmaps, ["k1", "k2"], "left")
        .withColumn("dense", dense)
        # Flags may go on beyond the last line, and stop at the last kept long one.
        .select("doc", "row", "words", F.size(lines).alias("n"), F.slice(left, 1, F.size(lines)).alias("left"))
        .select(
            "doc",
            F.array_join("left", "\n").alias("text"),
            F.col("n").cast("long").alias("n_lines"),
            (F.col("n") - F.size(F.array_compact("left"))).cast("long").alias("n_dropped"),
            F.map_from_entries("words").alias("keep"),
            "row",
        )
    )
