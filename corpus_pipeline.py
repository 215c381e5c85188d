"""A training corpus out of raw documents: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.decontaminate import find_leaks
from ledgermill.llm.line_dedup import drop_repeated_lines
from ledgermill.llm.minhash import near_duplicates
from ledgermill.llm.mixing import mix_sources
from ledgermill.llm.queries import table
from ledgermill.llm.toxicity import fit, score_toxicity
from ledgermill.session import intermediate, remove, stored, stored_at

#: Score from which a document is rejected as toxic.
TOXIC = 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC, by a model of the labelled ones among them.

    Without a labelled document, nothing is known to be toxic and all documents stay.
    """
    model = fit(docs, table(spark, sf_dir, "labels"))
    if not model.fitted:
        return docs
    # The text is no part of ``row``: else Python would be sent every text twice.
    rows = docs.select("doc_id", "text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    clean = score_toxicity(rows, model, columns=("text", "row")).filter(F.col("score") < TOXIC)
    return clean.select(*("text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are kept elsewhere; ``n_chars`` is counted anew."""
    left = drop_repeated_lines(docs, columns=tuple(c for c in docs.columns if c != "text"))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return left.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id, null last.

    A document is its id and text: rows that agree in both are one, rows that share an id only are
    documents of their own. Only keys are joined with the documents, and texts are shuffled only where rows repeat.
    """
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    keyed = docs.select(key.alias("key"), F.col("doc_id").alias("doc"), "text", F.struct(*docs.columns).alias("row"))
    groups = near_duplicates(keyed.select("key", "text"), width=5, percent=80, id_col="key")
    groups = groups.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("group"), F.count("*").alias("n"))
    groups = stored(groups)
    names = keyed.select("key", "doc").distinct()
    order = F.struct(F.col("doc").isNull().alias("nameless"), "doc", "key")
    chosen = groups.join(names, "key").groupBy("group").agg(F.min(order).alias("first")).select("first.key")
    copies = stored(groups.join(chosen, "key", "left_anti").select("key"))
    repeated = stored(groups.filter("n > 1").select("key"))
    rest = keyed.select("key", "row").join(copies, "key", "left_anti")
    once = rest.join(repeated, "key", "left_anti")
    same = Window.partitionBy("key").orderBy(F.to_json("row"))
    first = rest.join(repeated, "key", "left_semi").withColumn("nth", F.row_number().over(same)).filter("nth = 1")
    return once.select("row.*").union(first.select("row.*"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage was found."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc", "text_hash").distinct()
    same = F.xxhash64(F.coalesce(docs["text"], F.lit(""))).eqNullSafe(leaks["text_hash"])
    return docs.join(leaks, same & docs["doc_id"].eqNullSafe(leaks["doc"]), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    Columns of the documents stay; a number whose name one of them has is called ``mix_`` and that name. The
    mix is computed on keys; texts are joined with it once.
    """
    parts = ("doc_id", "source", F.coalesce("text", F.lit("")))
    keys = ["k1", "k2"]
    keyed = docs.select(
        "doc_id", "source", "text", F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2"),
        F.struct(*docs.columns).alias("row"),
    )
    found = mix_sources(keyed.drop("row"), columns=tuple(keys))
    found = found.withColumn("copies", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int"))
    numbers = ("taken", "size", "source_size", "target", "copies")
    # Rows that agree in id, source and text have one key; each takes one entry.
    found = stored(found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*numbers))).alias("mixes")))
    rows = keyed.select("row", *keys)
    single = rows.join(found.filter("size(mixes) = 1 and mixes[0].taken > 0"), keys)
    several = rows.join(found.filter("size(mixes) > 1"), keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.to_json("row"))) - 1
    several = several.withColumn("nth", nth)
    taken = single.select("row", F.col("mixes")[0].alias("mix")).union(several.select("row", F.get("mixes", F.col("nth"))))
    names = {}
    for c in ("size", "source_size", "target", "taken", "copies"):
        name = c
        while name in docs.columns or name in names.values():
            name = f"mix_{name}"
        names[c] = name
    return taken.filter("mix.taken > 0").select("row.*", *(F.col(f"mix.{c}").alias(name) for c, name in names.items()))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]
#: Scores, signatures and latent vectors are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``; what a stage stores is removed when it is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with intermediate(spark):
            docs, path = stored_at(stage(spark, docs, sf_dir))
        if before:
            remove(spark, [before])
        before = path
    return docs
