"""Token counts by a two-tier lookup of pre-token lengths.

A text is cut at ASCII blanks. The tokenizer never joins what a blank parts, so a text has as
many tokens as its pieces together. Tier one is a broadcast table with the lengths of the
most frequent pieces of a sample; tier two is a cache in each worker, filled by the tokenizer itself
whenever a batch brings pieces that neither tier has. Pieces are never shuffled. The tables
only save work: any piece gets the length that the library gives it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.words import texts

BLANKS = r"[\x20\x09-\x0D]+"
#: Pieces of the broadcast table, and about how many documents they are counted in.
FREQUENT, SAMPLE_DOCS = 20_000, 2_000
#: Entries of a worker's table, the longest piece that is kept, and bytes of text looked up at once.
CACHE_PIECES, CACHE_BYTES, BLOCK_BYTES = 200_000, 48, 1 << 20

#: A worker's tokenizer and table, by broadcast.
_tiers: dict[str, tuple] = {}


def _lengths(tokenizer, pieces: list[bytes]) -> list[int]:
    found = tokenizer.encode_batch([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)
    return [len(x.ids) for x in found]


def _load(serialized: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(serialized)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _worker_tiers(shared) -> tuple:
    """Kept while the worker lives, for the next tasks of the same query."""
    name, serialized, common = shared.value
    if name not in _tiers:
        _tiers.clear()
        _tiers[name] = _load(serialized), dict(common)
    return _tiers[name]


def frequent_pieces(docs: DataFrame, text_col: str, count: int, sample_docs: int) -> list[bytes]:
    """The commonest short pieces of about ``sample_docs`` documents; at most ``count``."""
    total = docs.count()
    sample = docs.sample(min(1.0, sample_docs / max(total, 1)), seed=7)
    pieces = sample.select(F.explode(F.split(text_col, BLANKS)).alias("piece"))
    common = (
        pieces.filter((F.octet_length("piece") > 0) & (F.octet_length("piece") <= CACHE_BYTES))
        .groupBy("piece")
        .count()
        .orderBy(F.desc("count"), "piece")
        .limit(count)
    )
    return [row["piece"].encode() for row in common.collect()]


def count_tokens(
    docs: DataFrame,
    tokenizer_json: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` for each row of ``docs``.

    ``tokenizer_json`` is the serialized tokenizer (a ``tokenizers`` file's content); its normalizer
    and pre-tokenizer must not carry anything across a blank, and its special strings hold none. No
    begin, end or added special tokens are counted; special strings inside texts are what the
    library makes of them by default. Null and empty texts have 0 bytes and 0 tokens. Repeated rows
    and ids are counted row by row, a null id stays null, other columns are ignored, and an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    wanted = frequent_pieces(docs, text_col, frequent, sample_docs)
    common = dict(zip(wanted, _lengths(_load(tokenizer_json), wanted), strict=True))
    # Bounded by ``frequent`` pieces of CACHE_BYTES bytes and by the vocabulary file.
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, tokenizer_json, common))
    kind = docs.schema[id_col].dataType.simpleString()

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table = _worker_tiers(shared)
        for batch in batches:
            n_bytes, n_tokens, block, held = [], [], [], 0
            for text in texts(batch, text_col):
                n_bytes.append(len(text))
                block.append(text.split())
                held += len(text)
                if held >= BLOCK_BYTES:
                    n_tokens += _block(block, tokenizer, table, shared.value[2])
                    block, held = [], 0
            n_tokens += _block(block, tokenizer, table, shared.value[2])
            over = [n > limit for n in n_tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(over, pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(id_col, text_col).mapInArrow(counts, schema)


def _block(block: list[list[bytes]], tokenizer, table: dict[bytes, int], common: dict[bytes, int]) -> list[int]:
    """Tokens of each text of a block; what the worker's table lacks is encoded in one call."""
    found = [list(map(table.get, pieces)) for pieces in block]
    missing = {p for pieces, known in zip(block, found, strict=True) if None in known for p, n in zip(pieces, known, strict=True) if n is None}
    if not missing:
        return [sum(x) for x in found]
    order = list(missing)
    new = dict(zip(order, _lengths(tokenizer, order), strict=True))
    out = [
        sum(new[p] if n is None else n for p, n in zip(pieces, known, strict=True)) if None in known else sum(known)
        for pieces, known in zip(block, found, strict=True)
    ]
    if len(table) + len(new) > CACHE_PIECES:
        table.clear()
        table.update(common)
    table.update((p, n) for p, n in new.items() if len(p) <= CACHE_BYTES)
    return out
