"""Near duplicates and repeated substrings against brute force."""

import hashlib
import random
import re

import pytest
from llm_rows import documents, texts

from seekframe.llm import neardup, substrings
from seekframe.llm.common import prepared
from seekframe.llm.components import LEAST_TASKS, components
from seekframe.llm.without import without


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_components(rows, k, num, den):
    sets = []
    for key, text in rows:
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((key, {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()))
    parent = {key: key for key, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and both * den >= (len(x) + len(y) - both) * num:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((key, len(s), root(key), root(key) == key) for key, s in sets)


@pytest.mark.parametrize(("k", "num"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, num):
    prepared(spark)
    rows = [r for r in texts() if r[0] is not None]
    found = neardup.link_components(documents(spark, rows), k, (num, 100)).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found)
    assert got == brute_components(rows, k, num, 100)


def test_chain_of_near_copies(spark):
    prepared(spark)
    rng = random.Random(3)
    base = [f"w{rng.randrange(9999)}" for _ in range(200)]
    rows = []
    for i in range(30):
        rows.append((1000 - i, " ".join(base)))
        base[rng.randrange(200)] = f"v{i}"
    got = neardup.link_components(documents(spark, rows), 5, (80, 100)).collect()
    assert sorted(tuple(r) for r in got) == brute_components(rows, 5, 80, 100)


def test_near_copies_below_the_least_similarity(spark, monkeypatch):
    """Copies of one text, most too far from each other: not all pairs are verified, and no link is lost."""
    prepared(spark)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        own = list(base)
        for place in rng.sample(range(200), rng.choice([2, 9, 11, 13])):
            own[place] = rng.choice([f"v{i}x{place}", f"y{place % 3}", "and"])
        rows.append((i, " ".join(own)))
        if i % 10 == 0:  # a twin of a copy, which has its own changes too
            own[rng.randrange(200)] = "twin"
            rows.append((1000 + i, " ".join(own)))
    rows.append((1010, "another text under the id of a twin " + " ".join(base[50:])))
    counted, verify = [], neardup.verified

    def verified(pairs, sets, least):
        counted.append(pairs.count())
        return verify(pairs, sets, least)

    monkeypatch.setattr(neardup, "verified", verified)
    found = neardup.link_components(documents(spark, rows[:-1]), 3, (85, 100)).collect()
    assert sorted(tuple(r) for r in found) == brute_components(rows[:-1], 3, 85, 100)
    assert sum(counted) < 12 * len(rows), counted
    # A repeated id has its sets each for itself: what was linked stays linked.
    alone = {r["doc_id"]: r["component_id"] for r in found}
    again = neardup.link_components(documents(spark, rows), 3, (85, 100)).collect()
    groups = {}
    for r in again:
        groups.setdefault(alone[r["doc_id"]], set()).add(r["component_id"])
    assert all(len(g) == 1 for g in groups.values())


def test_no_rows(spark):
    prepared(spark)
    assert neardup.link_components(documents(spark, [])).count() == 0
    assert substrings.deduplicated(documents(spark, [])).count() == 0


def test_row_without_id_stays(spark):
    prepared(spark)
    found = neardup.link_components(documents(spark, [(None, "a b c"), (1, "a b c d e f g")]), 3).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in found) == [("1", 5), ("None", 1)]


def test_star_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)]
    parent = {n: n for pair in links for n in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root(n) for n in parent if any(n in p and p[0] != p[1] for p in links)}


def brute_substrings(rows, window=50):
    first = {}
    for key, text in rows:
        w = words_of(text)
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            first[run] = min(first.get(run, key), key)
    out = []
    for key, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def test_substrings_equal_brute_force(spark):
    prepared(spark)
    rows = [r for r in texts() if r[0] is not None]
    # A passage that runs on over two documents, one that recurs within a document, and repeated words.
    line = [f"z{i}" for i in range(140)]
    rows += [(300, " ".join(line[:90])), (301, " ".join(line[30:])), (302, " ".join(line)), (303, " ".join(line[:60] * 3))]
    rows += [(304, "la " * 120), (305, "x " + "la " * 70), (306, "la " * 49)]
    found = substrings.deduplicated(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == brute_substrings(rows)


def test_without(spark):
    prepared(spark)
    docs = documents(spark)
    left = without(docs, spark.createDataFrame([(5,), (200,), (None,), (12345,)], "doc_id long"))
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(k) for k, _ in texts() if k not in (5, 200))


def test_components_of_few_links_are_few_tasks(spark):
    """Many partitions of the session do not become as many files a round."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = components(spark.createDataFrame(links, "a long, b long"))
        assert 0 < len(found.inputFiles()) <= LEAST_TASKS
        got = {r["node"]: r["component"] for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    least = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    while True:
        new = dict(least)
        for a, b in links:
            if a != b:
                new[a] = new[b] = min(new[a], new[b])
        if new == least:
            break
        least = new
    assert got == least
