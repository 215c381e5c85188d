"""Token counts against the library on whole texts."""

import public_tokenizers
from tokenizers import Tokenizer

from ledgermill.llm.token_counts import count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, limit):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((i, len((text or "").encode()), n, n > limit))
    return sorted(out, key=str)


def serialized():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


def test_equals_library(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = [tuple(r) for r in count_tokens(documents, serialized(), 500, frequent=300, sample_docs=50).collect()]
    assert sorted(got, key=str) == expected(rows, 500)


def test_odd_rows(texts_frame):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a<|endoftext|>b <|startoftext|>"), (5, "don't we'LL 'S it's"),
        (6, "café café ́x"), (7, "Ο ΣΟΦΟΣ ΣΑΣ x y\u0085z\x1cq"), (8, "x" * 70_000), (9, "ab " * 60_000),
        (9, "ab " * 60_000), (None, "null id"), (10, "漢字かな交じり文 123٣ ½ 🙂🙂"), (11, "\x00 \x7f ‍"), (12, "İstanbul ǅ ﬁ"),
    ]
    got = [tuple(r) for r in count_tokens(texts_frame(rows), serialized(), 5, frequent=3, sample_docs=2).collect()]
    assert sorted(got, key=str) == expected(rows, 5)
    assert count_tokens(texts_frame([]), serialized()).count() == 0
