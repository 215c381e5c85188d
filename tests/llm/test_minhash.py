"""Near duplicates against all pairs compared by brute force."""

import re
from itertools import combinations
from pathlib import Path
from random import Random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import minhash
from ledgermill.llm.minhash import near_duplicates
from ledgermill.session import intermediate, stored_by

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            least[y] = x
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(documents, width, percent):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = near_duplicates(documents, width, percent).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == brute(rows, width, percent)


def test_chain_of_edits_in_one_large_bucket(texts_frame):
    """Neighbours are linked, ends are not: one component, though most pairs of a bucket are no links."""
    base = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(60):
        words = list(base)
        for j in range(k):
            words[5 * j] = f"x{j}"
        rows.append((1000 - k, " ".join(words)))
    rows += [(2000 + i, f"lonely text number {i} of its own kind") for i in range(10)]
    got = {tuple(r) for r in near_duplicates(texts_frame(rows), 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_pages_of_one_template_below_the_threshold(texts_frame, monkeypatch):
    """No text is linked with another; the pair stage returns next to nothing, whatever the number of texts."""
    random = Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(240):
        words = list(base)
        for j in random.sample(range(120), 5):
            words[j] = f"x{i}of{j}"
        texts.append((i, " ".join(words)))
    texts += [(1000 + i, f"{' '.join(base)} tail{i}") for i in range(4)]
    seen = []

    def counted(*given):
        seen.append(minhash_links(*given))
        return seen[-1]

    minhash_links = minhash._between_components
    monkeypatch.setattr(minhash, "_between_components", counted)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 5_000)
    got = {tuple(r) for r in near_duplicates(texts_frame(texts), 3, 85).collect()}
    assert got == brute(texts, 3, 85)
    assert seen[0].count() <= len(texts)


def carriers_of_sets(df):
    """Exchanges of the plan whose rows hold whole sets, in joins that are not broadcast."""
    session = df.sparkSession
    before = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString().split("(initial plan")[0].splitlines()
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    deep = [len(re.match(r"[\s:|+-]*", line).group()) for line in plan]
    found = 0
    for i, line in enumerate(plan):
        below = next((j for j in range(i + 1, len(plan)) if deep[j] <= deep[i]), len(plan))
        nodes = plan[i + 1 : below]
        summed = any("Generate" in x or "Aggregate" in x for x in nodes)
        found += "Exchange" in line and not summed and any("FileScan" in x and "shingles" in x for x in nodes)
    return found


def test_rounds_join_full_sets_as_they_lie(spark, texts_frame, monkeypatch):
    """Only ids move in the joins that pick the sets of a round or of the pair stage."""
    random = Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for j in random.sample(range(120), 3):
            words[j] = f"x{i}of{j}"
        rows.append((i, " ".join(words)))
    tables = {t.name for t in spark.catalog.listTables()}
    picked, counts = minhash._linkable, []

    def seen(sets, percent):
        counts.append(carriers_of_sets(sets))
        return picked(sets, percent)

    monkeypatch.setattr(minhash, "_linkable", seen)
    assert {tuple(r) for r in near_duplicates(texts_frame(rows), 3, 85).collect()} == brute(rows, 3, 85)
    assert counts and set(counts) == {0}
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_stored_by_keeps_rows_and_leaves_no_name(spark):
    """Rows are whole, with null and repeated keys, the name is gone also after a failure, and ``intermediate`` removes the files."""
    rows = [(None, "a"), (1, "b"), (1, "b"), (2, None)]
    with intermediate(spark):
        found = stored_by(spark.createDataFrame(rows, "id long, t string"), "id")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)
        folder = Path(urlparse(found.inputFiles()[0]).path).parent
        assert folder.exists()
        broken = spark.range(3).select("id", F.raise_error(F.lit("broken")).cast("string").alias("t"))
        with pytest.raises(Exception, match="broken"):
            stored_by(broken, "id")
    assert not folder.exists()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stored_")]


def test_odd_rows(texts_frame):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\ttwo\x0b"), (8, "é É"), (9, "É É")]
    rows += [(10, long), (11, long + " end"), (11, long + " end")]
    got = sorted(tuple(r) for r in near_duplicates(texts_frame([*rows, (None, "one")]), 3, 85).collect() if r.doc_id is not None)
    assert sorted(set(got)) == sorted(brute(rows, 3, 85))
    assert len(got) == len(rows)
    nobody = [r for r in near_duplicates(texts_frame([(None, "one"), (4, "one")]), 3, 85).collect() if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in nobody] == [(None, True)]
    assert near_duplicates(texts_frame([]), 3, 85).count() == 0
