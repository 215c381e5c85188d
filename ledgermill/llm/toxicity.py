"""Toxic passages by maximum-scoring segments, aggregated by extreme-value calibration.

Model, fitted on a bounded sample of labelled rows: every word has a log-odds score, toxic against other
documents. The two-category Dirichlet prior of a word is centred on the estimate for its prefix one letter
shorter, down to prefixes of three letters and the overall share, so rare and unseen forms
of a stem have the stem's score.

A text's scores, less a drift, are scanned once (Ruzzo and Tompa) for all maximal scoring
segments. Karlin and Altschul's theory gives the law of such scores in documents without toxic
passages: lambda from the words' scores there, K from those documents' best segments. A toxic word that no clean text holds counts there as seen
less than once. The best ``r``
segments together are judged by the law of their sum; the largest evidence over ``r`` becomes a
probability through a logistic curve. Law and curve are fitted on the same sample, each half of it
scored with the words of the other half.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.words import texts, words_of
from ledgermill.session import small_batches, stored

#: Labelled rows that the model is fitted on, and forms of words that it may hold.
TRAIN_ROWS, MODEL_FORMS = 20_000, 300_000
#: Letters of the shortest and longest prefix; least count of a form; weight of its prior.
SHORT, LONG, LEAST, PRIOR = 3, 8, 3, 30.0
#: Occurrences of a word that count in one training text.
MOST = 4
#: Words that a task counts before their forms travel, and rows of the sample that the driver looks at together.
COUNTED, LOOKED = 100_000, 1_000
#: What a form must add to its prefix's score to be kept.
STEP = 0.1
#: Taken off each word's score, so that texts without toxic words drift down.
DRIFT = 1.0
#: Best segments that are judged together at most; expected number, in a clean text, of significant ones.
TOGETHER, EXPECT = 64, 0.05
CACHE_WORDS, CACHE_BYTES = 200_000, 64


def normal_form(word: bytes) -> str:
    """Lower-case letters only, so decorations and spacing signs don't hide a word."""
    text = word.decode("utf-8", "replace").lower()
    return text if text.isalpha() else "".join(c for c in text if c.isalpha())


def forms(form: str) -> list[str]:
    """The form's prefixes, shortest first, and the form itself marked with its end."""
    return [form[:n] for n in range(SHORT, min(LONG, len(form)) + 1)] + [form + "."]


class Scores(dict):
    """Word bytes -> score. The longest known form decides."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> float:
        value = -DRIFT
        form = normal_form(word)
        for one in reversed(forms(form)) if form else ():
            if one in self.known:
                value = self.known[one] - DRIFT
                break
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.float64, len(words))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in one pass over the runs of positive scores."""
    positive = scores > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], positive.view(np.int8), [0]))))
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    held: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, last with a lesser start
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        low, high = sums[start], sums[end]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((start, end, low, high, j))
                break
            start, low = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, high - low) for a, b, low, high, _ in held]


@dataclass(frozen=True)
class Model:
    known: dict[str, float]
    rate: float  # lambda
    size: float  # K
    curve: tuple[float, float]
    #: Whether there was a labelled row to learn from.
    fitted: bool = True

    def evidence(self, best: list[float], m: int) -> float:
        """-ln of the chance that a clean text of ``m`` words has segments as good, over the best ``r``."""
        most, total = 0.0, 0.0
        for r, s in enumerate(sorted(best, reverse=True)[:TOGETHER], 1):
            total += self.rate * s - math.log(self.size * m)
            if total <= 0:
                continue
            log_p = -total + (r - 1) * math.log(max(total, 1.0)) - math.lgamma(r + 1) - math.lgamma(r)
            most = max(most, -log_p - math.log(r * (r + 1)))  # the choice of r is paid for
        return most

    def feature(self, best: list[float], m: int) -> float:
        return math.log1p(self.evidence(best, m)) if m else 0.0

    def probability(self, best: list[float], m: int) -> float:
        a, b = self.curve
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * self.feature(best, m)))))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(labels: DataFrame, id_col: str, label_col: str, count: int) -> DataFrame:
    """(id, label) of at most ``count`` labelled ids that are not held out, in the order of a hash."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    return known.orderBy(F.xxhash64("id"), "id").limit(count)


SIDES = ("clean0", "toxic0", "clean1", "toxic1")


def _form_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(form, occurrences in clean and toxic texts of either half); a form may have several rows, which add up."""
    counts = [Counter() for _ in SIDES]
    for batch in batches:
        sides = zip(batch.column("half").to_pylist(), batch.column("label").to_pylist(), strict=True)
        for text, (half, label) in zip(texts(batch, "text"), sides, strict=True):
            seen = Counter(words_of(text))
            counts[2 * half + (label > 0)].update({word: min(n, MOST) for word, n in seen.items()})
            if sum(map(len, counts)) >= COUNTED:
                yield from _by_form(counts)
                counts = [Counter() for _ in SIDES]
    yield from _by_form(counts)


def _by_form(counts: list[Counter]) -> Iterator[pa.RecordBatch]:
    both: dict[str, list[int]] = {}
    for side, words in enumerate(counts):
        for word, n in words.items():
            form = normal_form(word)
            for one in forms(form) if form else ():
                both.setdefault(one, [0] * len(SIDES))[side] += n
            both.setdefault("", [0] * len(SIDES))[side] += n
    found = list(both)
    for i in range(0, len(found), 50_000):
        part = found[i : i + 50_000]
        sums = [pa.array([both[f][k] for f in part], pa.int64()) for k in range(len(SIDES))]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *sums], ["form", *SIDES])


def _word_scores(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log-odds of each form against the overall share; forms that add little to their prefix are left out.

    Going down from the overall share to a form, each prefix adds only the words that leave the
    form's path there, so every occurrence counts once.
    """
    clean, toxic = counts.get("", (0, 0))
    base = (toxic + 1) / (clean + toxic + 2)
    prior, kept, known = {}, {}, {}
    for form in sorted(counts, key=lambda f: (len(f.rstrip(".")), f.endswith("."), f)):
        if not form:
            continue
        parent = form[:-1][:LONG] if form.endswith(".") else form[:-1]
        while parent and parent not in prior:
            parent = parent[:-1]
        n, t = counts[form]
        here = prior.get(parent, base)
        if parent:
            pn, pt = counts[parent]
            here = (max(0, pt - t) + PRIOR * here) / (max(0, pn - n) + max(0, pt - t) + PRIOR)
        prior[form] = here
        share = (t + PRIOR * here) / (n + t + PRIOR)
        score = math.log(share / (1 - share)) - math.log(base / (1 - base))
        kept[form] = kept.get(parent, 0.0)
        if abs(score - kept[form]) >= STEP:
            kept[form] = known[form] = score
    return known


def _scan(shared):
    """(label, m, best segments, histogram of the scores) for each training text, by the other half's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [Scores(known) for known in shared.value]
        for batch in batches:
            m, best, bins, sizes = [], [], [], []
            for text, half in zip(texts(batch, "text"), batch.column("half").to_pylist(), strict=True):
                s = scores[1 - half].of(words_of(text))
                m.append(len(s))
                best.append(sorted((x[2] for x in maximal_segments(s)), reverse=True)[:TOGETHER])
                values, count = np.unique(np.round(s * 20), return_counts=True)
                bins.append(values.astype(int).tolist())
                sizes.append(count.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array(m, pa.int64()),
                    pa.array(best, pa.list_(pa.float64())),
                    pa.array(bins, pa.list_(pa.int64())),
                    pa.array(sizes, pa.list_(pa.int64())),
                ],
                ["label", "m", "best", "bins", "sizes"],
            )

    return run


def _rate(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum(p * exp(x * s)) = 1, for scores with a negative mean and a positive one."""
    if not len(values) or values.max() <= 0 or (values * counts).sum() >= 0:
        return 1.0
    p = counts / counts.sum()
    low, high = 0.0, 1.0
    while (p * np.exp(high * values)).sum() < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * values)).sum() < 1 else (low, middle)
    return high


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression by Newton's method, slightly ridged."""
    design = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(2), np.array([1e-3, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.clip(np.linalg.solve(slope, design.T @ (y - p) - ridge * w), -1, 1)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[0], max(0.0, w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAIN_ROWS,
) -> Model:
    """The model of at most ``rows`` labelled rows whose ids are not held out; copies of a text count once.

    Without labelled rows every word scores 0 and every text gets the probability 0.5.
    """
    small_batches(docs.sparkSession)
    sample = F.broadcast(training_rows(labels, id_col, label_col, rows))  # at most ``rows`` rows
    train = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(sample, "id")
    train = train.groupBy("text").agg(F.max("label").alias("label"))
    train = train.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    train = stored(train.select("text", "label", "half"))
    sums = [F.sum(side).alias(side) for side in SIDES]
    counted = train.mapInArrow(_form_counts, f"form string, {', '.join(f'{x} long' for x in SIDES)}").groupBy("form").agg(*sums)
    seen = sum(F.col(side) for side in SIDES)
    frequent = counted.filter((seen >= LEAST) | (F.col("form") == "")).orderBy(seen.desc(), "form").limit(MODEL_FORMS)
    counts = frequent.toArrow()  # in columns, as rows of Python objects take many times their bytes
    names, n = counts.column("form").to_pylist(), {side: counts.column(side).to_numpy() for side in SIDES}

    def scores(clean: np.ndarray, toxic: np.ndarray) -> dict[str, float]:
        return _word_scores(dict(zip(names, zip(clean.tolist(), toxic.tolist(), strict=True), strict=True)))

    halves = [scores(n[f"clean{h}"], n[f"toxic{h}"]) for h in (0, 1)]
    known = scores(n["clean0"] + n["clean1"], n["toxic0"] + n["toxic1"])
    shared = docs.sparkSession.sparkContext.broadcast(halves)  # at most MODEL_FORMS forms each
    looked = train.mapInArrow(_scan(shared), "label int, m long, best array<double>, bins array<long>, sizes array<long>")
    looked = looked.toArrow()  # one row for each of at most ``rows`` texts
    histogram: Counter = Counter()
    # One more clean word, dealt over the positive scores of toxic texts: where no clean text holds a toxic
    # word, lambda follows from how many clean words were seen without one.
    more: Counter = Counter()
    for r in _rows(looked):
        if r["label"] > 0:
            more.update({b: n for b, n in zip(r["bins"], r["sizes"], strict=True) if b > 0})
        elif r["m"]:
            histogram.update(dict(zip(r["bins"], r["sizes"], strict=True)))
    for b, n in more.items():
        histogram[b] += n / more.total()
    rate = _rate(np.array(list(histogram), float) / 20, np.array(list(histogram.values()), float))
    looked = looked.select(["label", "m", "best"])
    clean = [r["m"] * math.exp(-rate * (r["best"][0] if r["best"] else 0.0)) for r in _rows(looked) if r["label"] <= 0 and r["m"]]
    weight = sum(clean)
    law = Model(known, rate, len(clean) / weight if weight else 1.0, (0.0, 0.0))
    x = np.array([law.feature(r["best"], r["m"]) for r in _rows(looked)])
    toxic = np.array([float(r["label"] > 0) for r in _rows(looked.select(["label"]))])
    return Model(known, rate, law.size, _curve(x, toxic), looked.num_rows > 0)


def _rows(table: pa.Table) -> Iterator[dict]:
    """The rows of a table, few at a time as Python objects."""
    for batch in table.to_batches(max_chunksize=LOOKED):
        yield from batch.to_pylist()


RESULT = "score double, n_words long, passages array<struct<start:int,end:int,score:double,expect:double>>"


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, score (0 to 1), n_words, passages for each row of ``docs``, and the named ``columns``.

    ``passages`` holds every maximal segment whose like is expected EXPECT times or less in a clean text
    of that length: first word, word after the last, score, expected number. Only the text is looked
    at, all of it. Null, empty and blank texts have no words, no passages and the score of a text without
    evidence. Repeated rows are scored alike, null ids stay, an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MODEL_FORMS forms
    kept = list(dict.fromkeys([id_col, *columns]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scores = Scores(own.known)
        for batch in batches:
            out, m, passages = [], [], []
            for text in texts(batch, text_col):
                words = words_of(text)
                found = maximal_segments(scores.of(words))
                m.append(len(words))
                out.append(own.probability([s for _, _, s in found], len(words)))
                expect = [own.size * len(words) * math.exp(-own.rate * s) for _, _, s in found]
                passages.append([{"start": a, "end": b, "score": s, "expect": e} for (a, b, s), e in zip(found, expect, strict=True) if e <= EXPECT])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expect", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(out, pa.float64()), pa.array(m, pa.int64()), pa.array(passages, kind)],
                [*kept, "score", "n_words", "passages"],
            )

    return docs.select(*kept, *({text_col} - set(kept))).mapInArrow(run, f"{fields}, {RESULT}")
