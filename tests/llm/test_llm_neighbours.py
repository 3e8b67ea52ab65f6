"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.llm import neighbours
from seekframe.llm.common import prepared


def brute(rows, asked, k=10):
    good = sorted({(i, v) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(c is not None and np.isfinite(c) for c in v) and any(v)})
    x = np.array([v for _, v in good], np.float32).astype(float)
    ids = np.array([i for i, _ in good])
    out = {}
    for i, v in zip(ids, x):
        if asked(i):
            far = np.sqrt(((x - v) ** 2).sum(axis=1))
            out[int(i)] = [(int(ids[j]), float(far[j])) for j in np.lexsort((ids, far)) if ids[j] != i][:k]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8)) * 3
    given = [(i, tuple(map(float, (centres[i % 12] + rng.normal(size=8)).astype(np.float32)))) for i in range(1500)]
    hot = given[0][1]
    given += [(2000 + i, hot) for i in range(700)]
    bad = [(5000, None), (5100, (0.0,) * 8), (5200, (float("nan"),) + hot[1:]), (5300, hot[:5]), (5400, (None,) + hot[1:]), (None, hot)]
    return given + bad + given[:3]


def test_recall_and_scores(spark, rows):
    prepared(spark)
    frame = spark.createDataFrame([(i, list(v) if v else None, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, key int, query string")
    found = neighbours.neighbours(frame, F.pmod("id", F.lit(100)) == 0).collect()
    want = brute(rows, lambda i: i % 100 == 0)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    assert all(len(v) == 10 and v == sorted(v, key=lambda c: (c[1], c[0])) for v in got.values())
    held = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert held >= 0.9 * 10 * len(want)
    # Copies of one vector are found in the order of their ids.
    assert got[2000] == want[2000] and got[0] == want[0]
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(s - exact[q, i]) < 1e-12 for q, v in got.items() for i, s in v if (q, i) in exact)


def test_few_or_no_rows(spark):
    prepared(spark)
    kind = "vec_id long, embedding array<float>"
    assert neighbours.neighbours(spark.createDataFrame([], kind), F.col("id") >= 0).count() == 0
    found = neighbours.neighbours(spark.createDataFrame([(100, [1.0, 0.0]), (7, [0.0, 1.0]), (3, [0.0, 1.0])], kind), F.col("id") == 100)
    assert [(r["rank"], r["vec_id"]) for r in found.orderBy("rank").collect()] == [(1, 3), (2, 7)]
    alone = neighbours.neighbours(spark.createDataFrame([(100, [1.0, 0.0])], kind), F.col("id") == 100)
    assert alone.count() == 0


def test_all_leaves_are_exact():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6))
    tree = neighbours.Tree(x)
    assert sorted(tree.best_bins(x[0], tree.leaves)) == list(range(tree.leaves))
    assert len(set(tree.descend(x))) > 5
