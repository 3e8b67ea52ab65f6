"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from seekframe.llm.common import parked, prepared
from seekframe.session import shared_dir

VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("a", "e", "ou", "i") for c in ("n", "rt", "l", "s", "nd")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark):
    prepared(spark)
    rng = random.Random(12)
    items = [(i, prose(rng, 30)) for i in range(6)]
    clean = [(i, prose(rng, rng.randrange(40, 90))) for i in range(300)]
    toxic = [(400 + i, prose(rng, 30) + " zorkhead " + prose(rng, 9)) for i in range(80)]
    low = [(500 + i, " ".join(w for w in prose(rng, 20).split() for _ in range(7))) for i in range(60)]
    near = [(600 + i, clean[i][1] + " more") for i in range(20)] + [(620 + i, clean[i][1]) for i in range(20)]
    leaked = [(700 + i, prose(rng, 40) + " " + items[i][1] + " " + prose(rng, 20)) for i in range(6)]
    secret = [(800 + i, prose(rng, 40) + f" password = hunter{i}hunter") for i in range(5)]
    odd = [(900, None), (901, "")]
    rows = clean + toxic + low + near + leaked + secret + odd
    path = shared_dir(spark)
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(k, 0 if 500 <= k < 600 else 1, int(400 <= k < 500)) for k, _ in rows if k % 10 != 3]
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = parked(stage(spark, docs, folder))
        assert docs.columns == columns, name
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    clean = set(range(300))
    assert clean <= seen[0] and not seen[0] & set(range(400, 560))
    assert clean <= seen[1] and not seen[1] & set(range(600, 640)) and set(range(700, 706)) <= seen[1]
    assert seen[2] == seen[1] - set(range(700, 706))
    assert seen[3] == seen[2]
    assert docs.where(F.col("text").contains("hunter")).count() == 0
    assert docs.where(F.col("text").contains("[ASSIGN]")).count() == 5
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == seen[3]


def test_run(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_empty_tables(spark, folder):
    path = shared_dir(spark)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
