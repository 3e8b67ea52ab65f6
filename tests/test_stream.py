"""Change feeds, in batch and as a stream."""

import random

import pytest
from pyspark.sql import functions as F

from seekframe import SearchSpec, shared_dir
from seekframe.audit import Audit
from seekframe.operators.soft_delete import NoRowsError, delete_rows, force_delete_rows, restore_rows
from seekframe.streaming.changes import final_documents, with_actions
from seekframe.streaming.sync import apply_changes, sync_stream

ROW = "STRUCT<id: BIGINT, name: STRING, size: INT, deleted: TIMESTAMP>"
FEED = f"seq BIGINT, ts TIMESTAMP, op STRING, before {ROW}, after {ROW}"
SPEC = SearchSpec(
    "t", "id", ["name"], deleted="deleted", should_index=lambda c: c("size") > 2, language="simple"
)
SMALL = {"language": "simple", "buckets": 3}


def row(i, name="a", size=5, gone=False):
    import datetime as dt

    return (i, name, size, dt.datetime(2020, 1, 1) if gone else None)


def change(seq, op, before, after):
    import datetime as dt

    return (seq, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=seq // 2), op, before, after)


def actions(spark, spec, *changes):
    feed = spark.createDataFrame(list(changes), FEED)
    return [r["action"] for r in with_actions(feed, spec).orderBy("seq").collect()]


def test_save_actions(spark):
    assert actions(
        spark,
        SPEC,
        change(0, "insert", None, row(1)),
        change(1, "insert", None, row(1, size=1)),
        change(2, "update", row(1), row(1, "b")),
        change(3, "update", row(1), row(1, size=9)),
        change(4, "update", row(1), row(1, "b", size=1)),
        change(5, "update", row(1, size=1), row(1, "b", size=1)),
    ) == ["upsert", "delete", "upsert", "skip", "delete", "skip"]


def test_delete_actions(spark):
    changes = (
        change(0, "soft_delete", row(1), row(1, gone=True)),
        change(1, "soft_delete", row(1, size=1), row(1, size=1, gone=True)),
        change(2, "hard_delete", row(1, size=1), None),
        change(3, "restore", row(1, gone=True), row(1)),
        change(4, "restore", row(1, gone=True), row(1, size=1)),
    )
    assert actions(spark, SPEC, *changes) == ["delete", "skip", "delete", "upsert", "delete"]
    assert actions(spark, SPEC.with_(keep_deleted=True), *changes)[:2] == ["upsert", "skip"]
    assert actions(spark, SPEC.with_(deleted=None), *changes)[2] == "skip"


def test_relevant_fields(spark):
    spec = SPEC.with_(relevant=["size"])
    assert actions(
        spark, spec, change(0, "update", row(1), row(1, "b")), change(1, "update", row(1), row(1, size=6))
    ) == ["skip", "upsert"]


def random_feed(n, seed):
    """A feed with one key that takes a third of it, and the rows it ends in."""
    chance, live, feed = random.Random(seed), {}, []
    for seq in range(n):
        key = 0 if chance.random() < 0.34 else chance.randint(1, 25)
        old = live.get(key)
        new = row(key, chance.choice(["red ring", "blue", "red"]), chance.randint(1, 6))
        if old is None:
            op, old, after = "insert", None, new
        else:
            op = chance.choice(["update", "update", "soft_delete", "hard_delete", "restore"])
            after = new
            if op == "soft_delete":
                after = row(old[0], old[1], old[2], gone=True)
            elif op == "restore":
                after = row(old[0], old[1], old[2])
            elif op == "hard_delete":
                after = None
        feed.append(change(seq, op, old, after))
        if after is None:
            live.pop(key, None)
        else:
            live[key] = after
    return feed, live


def wanted(live, keep):
    rows = [r for r in live.values() if r[2] > 2 and (keep or r[3] is None)]
    return sorted((r[0], r[1], *([int(r[3] is not None)] if keep else [])) for r in rows)


def found(df, keep):
    flag = ["__soft_deleted"] if keep else []
    return sorted(tuple(r) for r in df.select("id", "name", *flag).collect())


@pytest.mark.parametrize("keep", [False, True])
def test_batch_and_stream_end_alike(spark, catalog, keep, tmp_path):
    feed, live = random_feed(240, 5)
    spec = SPEC.with_(keep_deleted=keep)
    frame = spark.createDataFrame(feed, FEED)
    if keep:
        # A kept row that stops being eligible while trashed is judged by its own change.
        assert found(final_documents(frame, spec), keep) == wanted(live, keep)
    else:
        assert found(final_documents(frame, spec), keep) == wanted(live, keep)
    folder = str(tmp_path / "feed")
    for part in range(3):
        spark.createDataFrame(feed[part * 80 : part * 80 + 80], FEED).coalesce(1).write.mode("append").json(folder)
    catalog.create("t", "id", **SMALL)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1)
    stream = stream.option("latestFirst", "false").json(folder)
    audit = Audit(spark, shared_dir(spark))
    checkpoint = shared_dir(spark)
    sync_stream(stream, catalog, "t", spec, checkpoint, audit=audit, compact_after=2).awaitTermination()
    index = catalog.open("t")
    assert found(index.docs(), keep) == wanted(live, keep)
    assert audit.counts().collect()[0]["operation"] == "sync"
    version = index.manifest.version
    sync_stream(stream, catalog, "t", spec, checkpoint).awaitTermination()
    assert catalog.open("t").manifest.version == version


def test_late_changes_lose(spark, catalog):
    """A change one batch late neither brings a removed document back nor replaces a newer one."""
    rows = [row(i, f"red w{i}") for i in range(4)]
    changes = [change(i, "insert", None, r) for i, r in enumerate(rows)]
    newer = [change(20, "update", rows[0], row(0, "blue", 3)), change(21, "hard_delete", rows[1], None)]
    late = [change(10, "update", rows[0], row(0, "old", 3)), change(11, "update", rows[1], row(1, "old", 3)), change(12, "update", rows[2], row(2, "new", 3))]
    index = catalog.create("a", "id", **SMALL)
    for n, part in enumerate((changes, newer, late)):
        index = apply_changes(index, spark.createDataFrame(part, FEED), SPEC, ("s", n))
    names = {r["id"]: r["name"] for r in index.docs().collect()}
    assert names == {0: "blue", 2: "new", 3: "red w3"}
    index = apply_changes(index.compact(), spark.createDataFrame([late[1]], FEED), SPEC)
    assert {r["id"] for r in index.docs().collect()} == {0, 2, 3}
    unordered = apply_changes(index, spark.createDataFrame(late[:1], FEED), SPEC, ordered=False)
    assert {r["id"]: r["name"] for r in unordered.docs().collect()}[0] == "old"


def test_import_equals_inserts(spark, catalog):
    rows = [row(i, f"red w{i}", i % 7) for i in range(30)]
    table = spark.createDataFrame(rows, ROW[7:-1].replace(":", ""))
    imported = catalog.create("a", "id", **SMALL).import_table(table, SPEC)
    inserts = spark.createDataFrame([change(i, "insert", None, r) for i, r in enumerate(rows)], FEED)
    synced = apply_changes(catalog.create("b", "id", **SMALL), inserts, SPEC)
    assert sorted(imported.docs().collect()) == sorted(synced.docs().collect())
    assert sorted(imported.terms().collect()) == sorted(synced.terms().collect())


def test_table_deletes_feed_an_index(spark, catalog):
    rows = [row(i, f"red w{i}") for i in range(6)]
    table = spark.createDataFrame(rows, ROW[7:-1].replace(":", ""))
    index = catalog.create("a", "id", **SMALL).import_table(table, SPEC)
    gone = delete_rows(table, SPEC, [1, 2], F.lit("2021-01-01").cast("timestamp"))
    assert gone.table.where("deleted IS NOT NULL").count() == 2
    index = apply_changes(index, gone.changes, SPEC)
    back = restore_rows(gone.table, SPEC, [2])
    index = apply_changes(index, back.changes, SPEC)
    hard = force_delete_rows(back.table, SPEC, [3])
    index = apply_changes(index, hard.changes, SPEC)
    assert sorted(r["id"] for r in index.docs().collect()) == [0, 2, 4, 5]
    assert hard.table.count() == 5
    with pytest.raises(NoRowsError):
        delete_rows(table, SPEC, [77], strict=True)
