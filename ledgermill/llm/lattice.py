"""Language-model scores from a lattice of subwords.

The pieces of an existing vocabulary, a sign for the start of a word and the 256 single bytes are the symbols of
a unigram model. A word's probability is the sum over all its segmentations, by forward recursion in log
space; a word that training texts hold has one more arc, from its start to its end, weighted by its
discounted count. No arc reaches over the start of a word, so a text's lattice falls apart at its words: its log
probability is the sum of its words' and the end's, and a word's lattice is computed once. Counts are kept for
each kind of text (language), and a text's probability is the sum over the kinds.

1. Tasks count the words of their blocks; the counts are added by word (``word_counts``).
2. The vocabulary's own scores, which are the order of its merges, give the first weights by Zipf's law. Each
   round computes, for every distinct word of the training texts, the expected number of times each piece is
   used (forward and backward), and takes these for the new weights (``fit``).
3. Each distinct word gets its log probabilities. The most frequent words are broadcast, up to a fixed number;
   texts are summed over these in one scan, and their other words are joined with the word table by word.

Words of one length are computed together: substrings are looked up by a rolling hash for all words of a group
at once. What passes the driver is the vocabulary's weights and the broadcast words.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.words import texts, words_of
from ledgermill.session import stored

#: Rounds of re-estimation, and what each symbol is taken to have occurred beforehand.
ROUNDS, PRIOR = 3, 0.1
#: Taken off each count of a word, and kinds of texts with counts of their own at most, besides the rest.
DISCOUNT, KINDS = 0.75, 8
#: Words that are broadcast at most, and the longest of them.
FREQUENT, WORD_BYTES = 100_000, 256
#: Words that a task counts or computes together, and cells of a group's lattice.
BLOCK_WORDS, CELLS = 200_000, 4_000_000
#: Buckets of counts for each doubling.
STEPS = 8

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_FILTER = 22
#: Stands for the start of a word, in which no blank occurs.
START = b" "

#: A worker's model or word table, by the name of its broadcast.
_held: dict[str, object] = {}


def _once(shared, make):
    """The unfolded broadcast, kept while the worker lives."""
    name = shared.value[0]
    if name not in _held:
        while len(_held) > 1:
            _held.pop(next(iter(_held)))
        _held[name] = make(*shared.value[1:])
    return _held[name]


def vocabulary(model: bytes) -> tuple[list[bytes], list[float]]:
    """Pieces as bytes, a leading START for a word's start, and their scores; of a sentencepiece model."""
    import sentencepiece

    tokens = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces, scores, sign = [], [], "▁"
    for i in range(tokens.get_piece_size()):
        piece = tokens.id_to_piece(i)
        if tokens.is_control(i) or tokens.is_unknown(i) or tokens.is_byte(i) or tokens.is_unused(i):
            continue
        if sign in piece[1:]:  # blanks in a row, of which texts have none
            continue
        pieces.append(START + piece[1:].encode() if piece.startswith(sign) else piece.encode())
        scores.append(tokens.get_score(i))
    return pieces, scores


def first_weights(pieces: list[bytes], scores: list[float]) -> np.ndarray:
    """Log weights of pieces and the 256 bytes, from the order of the scores."""
    rank = np.empty(len(scores))
    rank[np.lexsort((np.arange(len(scores)), -np.array(scores)))] = np.arange(len(scores))
    share = 1.0 / (np.concatenate([rank, np.full(256, 2.0 * len(scores))]) + 10.0)
    return np.log(share / share.sum())


def _hash(columns: np.ndarray) -> np.ndarray:
    """Of each row of bytes."""
    h = np.zeros(len(columns), np.uint64)
    for c in range(columns.shape[1]):
        h = (h + columns[:, c].astype(np.uint64) + np.uint64(1)) * _P
    return h


class Lattice:
    """The pieces by their hashes, and the recursions over groups of words of one length."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray):
        self.weights, self.n = weights, len(pieces)
        self.longest = max(map(len, pieces), default=1)
        keys = np.array([int(_hash(np.frombuffer(p, np.uint8)[None, :])[0]) for p in pieces], np.uint64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.filter = np.zeros(1 << _FILTER, bool)
        self.filter[self._slot(self.keys)] = True
        self.start = pieces.index(START) if START in pieces else -1

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys ^ (keys >> np.uint64(29))) * _Q >> np.uint64(64 - _FILTER)

    def arcs(self, chars: np.ndarray) -> tuple[list[np.ndarray], list[tuple]]:
        """Log weights by length and place, -inf where no piece fits, and the places (row, from, length, id)."""
        rows, size = chars.shape
        dense, places = [], []
        h = np.zeros((rows, size), np.uint64)
        for m in range(1, min(self.longest, size) + 1):
            h = (h[:, : size - m + 1] + chars[:, m - 1 :] + np.uint64(1)) * _P
            lp = np.full(h.shape, -np.inf)
            row, at = np.nonzero(self.filter[self._slot(h)])
            key = h[row, at]
            where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[where] == key
            row, at, piece = row[hit], at[hit], self.order[where[hit]]
            lp[row, at] = self.weights[piece]
            places.append((row, at, m, piece))
            if m == 1:
                # Every byte but the sign for a start can stand alone.
                alone = self.weights[self.n + chars.astype(np.int64)]
                alone[:, 0] = -np.inf if self.start >= 0 else alone[:, 0]
                lp = np.logaddexp(lp, alone)
                row, at = np.nonzero(alone > -np.inf)
                places.append((row, at, 1, self.n + chars[row, at].astype(np.int64)))
            dense.append(lp)
        return dense, places

    @staticmethod
    def _sum(parts: list[np.ndarray]) -> np.ndarray:
        x = np.stack(parts)
        most = x.max(axis=0)
        low = np.where(np.isfinite(most), most, 0.0)
        with np.errstate(divide="ignore"):
            return low + np.log(np.exp(x - low).sum(axis=0))

    def forward(self, dense: list[np.ndarray], rows: int, size: int) -> np.ndarray:
        alpha = np.zeros((size + 1, rows))
        for j in range(1, size + 1):
            alpha[j] = self._sum([alpha[j - m] + dense[m - 1][:, j - m] for m in range(1, min(j, len(dense)) + 1)])
        return alpha

    def backward(self, dense: list[np.ndarray], rows: int, size: int) -> np.ndarray:
        beta = np.zeros((size + 1, rows))
        for i in range(size - 1, -1, -1):
            beta[i] = self._sum([beta[i + m] + dense[m - 1][:, i] for m in range(1, min(size - i, len(dense)) + 1)])
        return beta

    def groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of words, their bytes with START) for words of one length, in groups of bounded size."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order])) + 1
        for some in np.split(order, cuts):
            if not len(some):
                continue
            size = int(sizes[some[0]]) + 1
            step = max(1, CELLS // (size * min(size, self.longest)))
            for i in range(0, len(some), step):
                part = some[i : i + step]
                chars = np.frombuffer(b"".join([START + words[k] for k in part.tolist()]), np.uint8)
                yield part, chars.reshape(len(part), size).astype(np.uint64)

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        for part, chars in self.groups(words):
            dense, _ = self.arcs(chars)
            out[part] = self.forward(dense, *chars.shape)[-1]
        return out

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """How often each symbol is used in ``times`` occurrences of the words, over all segmentations."""
        used = np.zeros(self.n + 256)
        for part, chars in self.groups(words):
            dense, places = self.arcs(chars)
            alpha, beta = self.forward(dense, *chars.shape), self.backward(dense, *chars.shape)
            for row, at, m, piece in places:
                share = np.exp(alpha[at, row] + self.weights[piece] + beta[at + m, row] - alpha[-1, row])
                used += np.bincount(piece, share * times[part[row]], minlength=len(used))
        return used


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, mod 7, is 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2


def kinds_of(docs: DataFrame, kind_col: str | None, most: int) -> tuple[list, Column]:
    """The commonest kinds, ``most`` at most, and the number of a row's kind; all others are one more."""
    if kind_col is None:
        return [], F.lit(0)
    # ``most`` rows.
    common = docs.groupBy(F.col(kind_col).cast("string").alias("k")).count().orderBy(F.desc("count"), "k").limit(most).collect()
    number = F.lit(len(common))
    for j, r in enumerate(common):
        number = F.when(F.col(kind_col).cast("string").eqNullSafe(F.lit(r.k)), j).otherwise(number)
    return [r.k for r in common], number


def word_counts(rows: DataFrame, kinds: int) -> DataFrame:
    """``word``, ``seen`` in all texts, ``c0``, ``c1``, ... in the training texts of each kind.

    The empty word is the end. ``rows`` has ``held``, ``kind`` and ``text``.
    """
    names = ["seen", *(f"c{j}" for j in range(kinds))]

    def counted(counts: list[Counter]) -> pa.RecordBatch:
        words = list(set().union(*counts))
        columns = [[one[w] for w in words] for one in counts]
        columns[0] = [sum(x) for x in zip(*columns, strict=True)]
        texts_column = pa.array(words, pa.binary()).view(pa.string())
        return pa.RecordBatch.from_arrays([texts_column, *(pa.array(c, pa.int64()) for c in columns)], ["word", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first counts what is held out.
        counts, size = [Counter() for _ in range(kinds + 1)], 0
        for batch in batches:
            number = zip(batch.column("held").to_pylist(), batch.column("kind").to_pylist(), strict=True)
            for (held, kind), text in zip(number, texts(batch, "text"), strict=True):
                words = words_of(text)
                own = counts[0 if held else kind + 1]
                own.update(words)
                own[b""] += 1
                size += len(words)
                if size >= 5 * BLOCK_WORDS:
                    yield counted(counts)
                    counts, size = [Counter() for _ in range(kinds + 1)], 0
        yield counted(counts)

    some = rows.mapInArrow(run, ", ".join(["word string", *(f"{n} long" for n in names)]))
    return some.groupBy("word").agg(*(F.sum(n).alias(n) for n in names))


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    some, held = [], 0
    for batch in batches:
        some.append(batch)
        held += batch.num_rows
        if held >= BLOCK_WORDS:
            yield some
            some, held = [], 0
    if some:
        yield some


def fit(words: DataFrame, pieces: list[bytes], scores: list[float], rounds: int = ROUNDS) -> np.ndarray:
    """Log weights of the symbols after ``rounds`` rounds over all words of the training texts, each once:
    pieces have to make up the words that were not seen, which are like the rare ones."""
    weights = first_weights(pieces, scores)
    known = words.filter("c > 0 and word <> ''").select("word")
    spark = words.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, pieces, weights))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, used = _once(shared, Lattice), np.zeros(0)
            for some in _word_blocks(batches):
                own = [w for b in some for w in b.column("word").cast(pa.binary()).to_pylist()]
                more = lattice.expected(own, np.ones(len(own)))
                used = used + more if len(used) else more
            at = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(used[at])], ["symbol", "used"])

        # At most a row for each symbol.
        found = known.mapInArrow(run, "symbol long, used double").groupBy("symbol").agg(F.sum("used").alias("used")).toArrow()
        used = np.full(len(weights), PRIOR)
        used[found.column("symbol").to_numpy()] += found.column("used").to_numpy()
        weights = np.log(used / used.sum())
    return weights


class Shares:
    """What each kind's counts give a word, and what they leave to its pieces.

    A count less ``DISCOUNT`` is the weight of the word as a whole. What is taken off is left to words of
    any kind, which are weighted by the number of kinds that hold them, less the same; what is taken off
    there is left to the pieces. All of it adds up to one.
    """

    def __init__(self, distinct: int, sizes: list[tuple[int, int]]):
        """``sizes``: tokens and distinct tokens of the training texts of each kind; ``distinct`` ones of all."""
        sizes = [(sum(v for _, v in sizes), distinct), *sizes]
        self.n = np.array([n for n, _ in sizes], float)
        self.left = np.array([DISCOUNT * v / n if n else 1.0 for n, v in sizes])

    def whole(self, counts: np.ndarray, of: int) -> np.ndarray:
        return np.maximum(counts - DISCOUNT, 0.0) / max(self.n[of], 1.0)

    def log10(self, by_kind: list[np.ndarray], lattice: np.ndarray) -> list[np.ndarray]:
        """For each kind; ``lattice`` holds natural logarithms, -inf for the end."""
        kinds = np.sum([c > 0 for c in by_kind], axis=0)
        with np.errstate(divide="ignore"):
            below = np.logaddexp(np.log(self.whole(kinds, 0)), lattice + math.log(self.left[0]))
            return [
                np.logaddexp(np.log(self.whole(own, j)), below + math.log(self.left[j])) / math.log(10.0)
                for j, own in enumerate(by_kind, 1)
            ]


def scored_words(words: DataFrame, kinds: int, pieces: list[bytes], weights: np.ndarray, shares: Shares) -> DataFrame:
    """word, seen, c, ``lp0``, ``lp1``, ...: log10 of the sum over all ways through the lattice, by kind."""
    shared = words.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, pieces, weights))
    names = [f"lp{j}" for j in range(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _once(shared, Lattice)
        for some in _word_blocks(batches):
            block = pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            own = block.column("word").cast(pa.binary()).to_pylist()
            natural = lattice.log_probabilities(own)
            natural[[i for i, w in enumerate(own) if not w]] = -np.inf
            lp = shares.log10([block.column(f"c{j}").to_numpy() for j in range(kinds)], natural)
            yield pa.RecordBatch.from_arrays(
                [*(block.column(n) for n in ("word", "seen", "c")), *map(pa.array, lp)], ["word", "seen", "c", *names]
            )

    return words.mapInArrow(run, ", ".join(["word string, seen long, c long", *(f"{n} double" for n in names)]))


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """The commonest words, whole buckets of counts, ``most`` at most."""
    step = F.floor(F.log2("seen") * STEPS).cast("int")
    short = words.filter(F.octet_length("word") <= WORD_BYTES).withColumn("step", step)
    # At most 64 * STEPS rows.
    held, low = 0, 64 * STEPS
    for r in sorted(short.groupBy("step").count().collect(), reverse=True):
        if (held := held + r["count"]) > most:
            break
        low = r.step
    return short.filter(F.col("step") >= low).drop("step")


def lattice_scores(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    kind_col: str | None = None,
    rounds: int = ROUNDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    ``model`` is the content of a sentencepiece file; only its pieces and their order are used. Texts are
    A-Z lower-cased; tokens are the words outside [\\x20\\x09-\\x0D] and one end. Rows whose id has a crc32 mod 7
    other than 2 train the model. ``base_score`` is log10 of the add-one unigram probability of the tokens;
    ``score`` is log10 of the sum of the probabilities of all ways through the text's lattice and of all kinds (the
    ``KINDS`` commonest values of ``kind_col`` and the rest; a row's own kind is no input of its score). Both
    are finite for any text, as single bytes fit everything.

    Null, empty and blank texts are their end. Rows that repeat an id or a text count each time; a null id counts as
    an empty text for the crc32, a null kind as a kind. Without training rows all counts are 0, and a text is made
    of pieces alone, its end counting as one half. Other columns are ignored, and an empty table gives no rows. A
    task needs about 300 bytes for each byte of the longest word.
    """
    named, number = kinds_of(docs, kind_col, KINDS)
    kinds = len(named) + 1
    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held"), number.alias("kind"), F.col(text_col).alias("text")
    )
    pieces, scores = vocabulary(model)
    names = [f"c{j}" for j in range(kinds)]
    counts = word_counts(rows.select("held", "kind", "text"), kinds).withColumn("c", sum(map(F.col, names)))
    counts = stored(counts)
    weights = fit(counts, pieces, scores, rounds)

    # Tokens and distinct tokens, of all and by kind; the ends are the texts of a kind.
    sizes = counts.agg(*(x for n in ("c", *names) for x in (F.sum(n), F.count_if(F.col(n) > 0)))).first()
    sizes = [(sizes[i] or 0, sizes[i + 1]) for i in range(0, len(sizes), 2)]
    shares = Shares(sizes[0][1], sizes[1:])
    words = stored(scored_words(counts, kinds, pieces, weights, shares))
    total, distinct = sizes[0]
    below = math.log10(total + distinct + 1)
    ends = counts.filter("word = ''").select("c", *names).first() or [0] * (kinds + 1)
    with np.errstate(divide="ignore"):
        prior = [math.log10(e / ends[0]) if e else -math.inf for e in ends[1:]] if ends[0] else [0.0] * kinds
        end = words.filter("word = ''").first()
        end_lp = [end[f"lp{j}"] if ends[0] and end else math.log10(0.5) for j in range(kinds)]
    used = [j for j in range(kinds) if prior[j] > -math.inf]
    if not ends[0]:
        used = [0]
    lps = [f"lp{j}" for j in used]

    # At most ``frequent`` words of WORD_BYTES bytes.
    common = frequent_words(words.filter("word <> ''"), frequent).select("word", "c", *lps).toArrow().combine_chunks()
    flat = [common.column(n).to_numpy() for n in ("c", *lps)]
    shared = docs.sparkSession.sparkContext.broadcast(
        (uuid.uuid4().hex, common.column("word").cast(pa.binary()).to_pylist(), flat[0], flat[1:])
    )
    ended = (int(ends[0] > 0), math.log10(ends[0] + 1) - below, [end_lp[j] for j in used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, base, lp = _once(shared, _tables)
        for batch in batches:
            tokens, knowns, bases, sums, missed = [], [], [], [[] for _ in lps], []
            for text in texts(batch, "text"):
                own = words_of(text)
                at = np.fromiter((table.get(w, -1) for w in own), np.int64, len(own))
                some = at[at >= 0]
                tokens.append(len(own) + 1)
                knowns.append(int(known[some].sum()) + ended[0])
                bases.append(float(base[some].sum()) - below * len(some) + ended[1])
                for j, column in enumerate(sums):
                    column.append(float(lp[j][some].sum()) + ended[2][j])
                out = Counter(w for w, i in zip(own, at.tolist(), strict=True) if i < 0) if len(some) < len(own) else {}
                missed.append(list(out.items()))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in missed])])
            rest = [x for one in missed for x in one]
            pairs = pa.StructArray.from_arrays(
                [pa.array([w for w, _ in rest], pa.binary()).view(pa.string()), pa.array([n for _, n in rest], pa.int64())],
                ["word", "times"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held"), pa.array(tokens, pa.int64()), pa.array(knowns, pa.int64()),
                    pa.array(bases, pa.float64()), *(pa.array(x, pa.float64()) for x in sums),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", *lps, "missed"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    doubles = ", ".join(f"{n} double" for n in ("base", *lps))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, {doubles}, missed array<struct<word:string,times:bigint>>"
    scanned = rows.select("doc_id", "held", "text").mapInArrow(run, schema)
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()))
    base = (F.log10(F.col("c") + 1) - F.lit(below)) * F.col("times")
    rest = (
        scanned.select("row", F.inline("missed"))
        .join(words.select("word", "c", *lps), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known2"),
            F.sum(base).alias("base2"),
            *(F.sum(F.col(n) * F.col("times")).alias(f"{n}_2") for n in lps),
        )
    )

    def plus(one: str, two: str) -> Column:
        return F.col(one) + F.coalesce(F.col(two), F.lit(0))

    each = F.array(*(plus(n, f"{n}_2") + F.lit(prior[j]) for n, j in zip(lps, used, strict=True)))
    # The largest one is taken out, so that the powers of the others do not vanish together.
    score = F.expr("array_max(each) + log10(aggregate(each, 0D, (sum, x) -> sum + pow(10D, x - array_max(each))))")
    return (
        scanned.drop("missed").join(rest, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens", plus("n_known", "known2").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"), plus("base", "base2").alias("base_score"), each.alias("each"),
        )
        .withColumn("score", score)
        .drop("each")
    )


def _tables(words: list[bytes], c: np.ndarray, lp: list[np.ndarray]) -> tuple:
    return {w: i for i, w in enumerate(words)}, c > 0, np.log10(c + 1.0), lp
