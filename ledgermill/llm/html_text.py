"""Visible text of web pages, laid out as text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.render import visible_text


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col``, ``title``, ``text``, ``n_chars`` for each row of ``pages``.

    Tags that HTML implies are supplied, unseen and hidden elements left out, all other text is kept:
    paragraphs, headings, lists and tables apart by an empty line, other blocks on lines of their own, list
    items marked and indented, cells in aligned columns, preformatted text as it is. Null and empty pages have
    an empty title and text. Repeated rows give equal results, ids may be null or repeated, other columns are
    ignored, and an empty table gives an empty result.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [visible_text(html.as_py() or "") for html in batch.column(html_col)]
            titles, texts = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(titles, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, "title", "text", "n_chars"],
            )

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, title string, text string, n_chars long")
