"""Index maintenance: every state equals a fresh import of what it should hold."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe import IndexWriteError, SearchSpec, search, search_index
from seekframe.sources.index import Catalog, merge_documents, rejects

SCHEMA = "id BIGINT, name STRING, size INT"
SMALL = {"language": "simple", "buckets": 3}
WORDS = ["red", "blue", "ring", "bolt", "gear", "reddish"]


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(index):
    return {r["id"]: (r["name"], r["size"]) for r in index.docs().collect()}


def dictionary(index):
    return {r["term"]: r["df"] for r in index.terms().collect()}


def expected_terms(state):
    counts = {}
    for name, _ in state.values():
        for w in set((name or "").split()):
            counts[w] = counts.get(w, 0) + 1
    return counts


def test_random_operations(spark, catalog):
    chance = random.Random(3)
    index, state = catalog.create("t", "id", **SMALL), {}
    for step in range(6):
        kind = chance.choice(["write", "write", "delete", "compact", "create", "update"]) if step else "write"
        if kind in ("write", "create", "update"):
            keys = chance.sample(range(30), 10)
            rows = {k: (" ".join(chance.sample(WORDS, chance.randint(0, 3))), chance.randint(0, 9)) for k in keys}
            mode = "upsert" if kind == "write" else kind
            index = index.write(docs(spark, [(k, *v) for k, v in rows.items()]), mode=mode)
            for k, v in rows.items():
                if kind == "write" or (kind == "create") != (k in state):
                    state[k] = v
        elif kind == "delete":
            keys = chance.sample(range(30), 6)
            index = index.delete(keys)
            state = {k: v for k, v in state.items() if k not in keys}
        else:
            index = index.compact()
        assert content(index) == state
        assert dictionary(index) == expected_terms(state)
        assert index.manifest.n_docs == len(state)
        assert index.manifest.sum_len == sum(len(n.split()) for n, _ in state.values())
        found = {r["id"] for r in search_index(index, "red", prefix=False).keys().collect()}
        assert found == {k for k, (n, _) in state.items() if "red" in n.split()}


def test_upsert_is_idempotent(spark, catalog):
    index = catalog.create("t", "id", **SMALL)
    data = docs(spark, [(1, "red ring", 1), (2, "blue", 2)])
    once = index.write(data)
    twice = once.write(data)
    assert content(once) == content(twice) and dictionary(once) == dictionary(twice)
    assert once.manifest.last_commit["fingerprint"] == twice.manifest.last_commit["fingerprint"]


def test_emplace_keeps_missing_fields(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red ring", 1), (2, "blue", 2)]))
    partial = spark.createDataFrame([(1, 9), (3, 8)], "id BIGINT, size INT")
    assert content(index.write(partial, mode="emplace")) == {1: ("red ring", 9), 2: ("blue", 2), 3: (None, 8)}


def test_rejected_writes_leave_no_trace(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    for bad in ([(2, "a", 1), (2, "b", 1)], [(None, "a", 1)]):
        with pytest.raises(IndexWriteError):
            index.write(docs(spark, bad))
    with pytest.raises(IndexWriteError):
        index.write(spark.createDataFrame([(2, 1)], "id BIGINT, other INT"))
    assert content(catalog.open("t")) == {1: ("red", 1)}
    assert {r["reason"] for r in rejects(docs(spark, [(None, "a", 1), (2, "b", 1), (2, "c", 1)]), "id").collect()} == {
        "null key",
        "duplicate key",
    }


def test_declared_schema_casts_or_fails(spark, catalog):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("size", T.IntegerType())])
    index = catalog.create("t", "id", schema, **SMALL)
    index = index.write(spark.createDataFrame([(7, "12")], "id INT, size STRING"))
    assert [tuple(r) for r in index.docs().collect()] == [("7", 12)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        index.write(spark.createDataFrame([(8, "many")], "id INT, size STRING"))


def test_two_writers_cannot_both_win(spark, catalog):
    index = catalog.create("t", "id", **SMALL)
    index.write(docs(spark, [(1, "red", 1)]))
    # An upsert that comes second is made again on the version that won; others fail.
    assert index.write(docs(spark, [(2, "blue", 1)])).manifest.version == 2
    with pytest.raises(IndexWriteError):
        index.replace_all(docs(spark, [(3, "green", 1)]))
    with pytest.raises(IndexWriteError):
        index.write(docs(spark, [(1, "pink", 1)]), mode="create")
    assert content(catalog.open("t")) == {1: ("red", 1), 2: ("blue", 1)}


def test_settings_and_postings_change_in_one_version(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    changed = index.update_settings(searchable=["name"], sortable=["size"])
    assert changed.manifest.version == index.manifest.version + 1
    assert changed.manifest.searchable == ["name"] and changed.manifest.sortable == ["size"]


def test_pause_ends_when_its_block_raises(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    with pytest.raises(RuntimeError), index.paused() as held:
        assert held.write(docs(spark, [(2, "blue", 1)])).manifest.n_docs == 1
        raise RuntimeError
    assert not catalog.open("t").manifest.paused
    assert content(catalog.open("t").write(docs(spark, [(3, "green", 1)]))) == {1: ("red", 1), 3: ("green", 1)}


def test_readers_pin_a_version(spark, catalog):
    first = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    first.write(docs(spark, [(2, "blue", 1)])).compact().flush()
    assert content(first) == {1: ("red", 1)}
    assert content(first.refresh()) == {}
    assert content(first.at_version(2)) == {1: ("red", 1), 2: ("blue", 1)}


def test_vacuum_keeps_what_recent_versions_use(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    last = index.write(docs(spark, [(2, "blue", 1)])).compact()
    assert last.vacuum(keep=3) == []
    assert len(last.vacuum(keep=1)) == 2
    assert content(last) == {1: ("red", 1), 2: ("blue", 1)}


def test_merge_reads_small_segments_only(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(i, f"red w{i}", i) for i in range(300)]))
    big = index.manifest.segments[0]["id"]
    state = {i: (f"red w{i}", i) for i in range(300)}
    for step in range(4):
        rows = [(k, f"blue s{step}", step) for k in (step, step + 1, 400 + step)]
        index = index.write(docs(spark, rows))
        state |= {k: v for k, *v in ((r[0], r[1], r[2]) for r in rows)} | {r[0]: (r[1], r[2]) for r in rows}
    index = index.delete([7, 401])
    state = {k: v for k, v in state.items() if k not in (7, 401)}
    merged = index.merge(fan=3)
    assert big in [s["id"] for s in merged.manifest.segments] and len(merged.manifest.segments) < len(index.manifest.segments)
    whole = merged.compact()
    for at in (index, merged, whole):
        assert content(at) == state and dictionary(at) == expected_terms(state)
        assert {r["id"] for r in search_index(at, "blue", prefix=False).keys().collect()} == {k for k, (n, _) in state.items() if "blue" in n}
    assert whole.manifest.segments[0]["chunks"] == 0 and len(whole.manifest.segments) == 1
    with pytest.raises(IndexWriteError):
        merged.compact()  # its segments are gone by now


def test_commits_during_a_merge_hold(spark, catalog):
    """A merge that began before a delete and an upsert is published after them, and loses neither."""
    index = catalog.create("t", "id", **SMALL)
    for i in range(3):
        index = index.write(docs(spark, [(10 * i + k, f"red w{k}", i) for k in range(4)]))
    stale = catalog.open("t")
    index.delete([0, 11]).write(docs(spark, [(20, "gear", 9), (50, "gear", 9)]))
    merged = stale.compact()
    state = {10 * i + k: (f"red w{k}", i) for i in range(3) for k in range(4) if (i, k) not in ((0, 0), (1, 1))}
    state |= {20: ("gear", 9), 50: ("gear", 9)}
    assert content(merged) == state and dictionary(merged) == expected_terms(state)
    assert merged.manifest.n_docs == len(state)
    whole = merged.compact()
    assert content(whole) == state and dictionary(whole) == expected_terms(state)


def test_resume_wins_against_another_writer(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    held = index.pause()
    held.refresh().update_settings(filterable=["size"])
    assert not held.resume().manifest.paused and not catalog.open("t").manifest.paused


def test_bitmaps(spark):
    """Bits of ordinals far apart, in two rows of a chunk, on either way of joining."""
    from seekframe.sources.index.bitmaps import bitmaps, merged, without_void

    at = [0, 1, 63, 64, 32_767, 32_768, (5 << 33) + 7]
    rows = spark.createDataFrame([(s, o) for s in "ab" for o in [*at, 2, 65, (5 << 33) + 8]], "s string, o long")
    first = bitmaps(rows.where(F.col("o").isin(at[:3]) & (F.col("s") == "a")), "s", "o")
    second = bitmaps(rows.where(F.col("o").isin(at[3:]) & (F.col("s") == "a")), "s", "o")
    voids = merged(first.unionByName(second))
    want = sorted([("a", o) for o in (2, 65, (5 << 33) + 8)] + [("b", o) for o in [*at, 2, 65, (5 << 33) + 8]])
    for small in (True, False):
        assert sorted(tuple(r) for r in without_void(rows, voids, "s", "o", small).collect()) == want


def test_repeated_batch_changes_nothing(spark, catalog):
    index = catalog.create("t", "id", **SMALL)
    data = docs(spark, [(1, "red", 1)])
    first = index.commit(docs=data, batch=("s", 4))
    again = first.commit(docs=docs(spark, [(1, "blue", 1)]), batch=("s", 4))
    assert again.manifest.version == first.manifest.version and content(again) == {1: ("red", 1)}
    assert content(first.commit(docs=docs(spark, [(1, "blue", 1)]), batch=("s", 5))) == {1: ("blue", 1)}


def test_empty_writes_add_no_segment(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    after = index.commit(docs=docs(spark, []), delete_keys=docs(spark, []).select("id"), batch=("s", 0))
    assert after.manifest.segments == index.manifest.segments and after.manifest.batches == {"s": 0}
    assert content(after.replace_all(docs(spark, []))) == {}


def test_a_failed_first_write_declares_nothing(spark, catalog):
    index = catalog.create("t", "id", **SMALL)
    with pytest.raises(IndexWriteError):
        index.write(docs(spark, [(1, "a", 1), (1, "b", 1)]))
    other = spark.createDataFrame([(1, True)], "id BIGINT, flag BOOLEAN")
    assert index.write(other).schema.names == ["id", "flag"]


def test_pause_drops_changes(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)])).pause()
    index = index.commit(docs=docs(spark, [(2, "blue", 1)]), batch=("s", 0))
    assert content(index) == {1: ("red", 1)} and index.manifest.batches == {"s": 0}
    index = index.resume().commit(docs=docs(spark, [(3, "bolt", 1)]), batch=("s", 1))
    assert content(index) == {1: ("red", 1), 3: ("bolt", 1)}


def test_catalog(spark, catalog):
    catalog.create("a1", "id", **SMALL)
    catalog.create("a1", "id", **SMALL)
    catalog.create("b", "id", **SMALL)
    assert catalog.names() == ["a1", "b"]
    scoped = Catalog(spark, catalog._files.root, prefix="a")
    assert scoped.delete_all() == ["a1"]
    assert catalog.names() == ["b"]
    with pytest.raises(KeyError):
        catalog.open("a1")


def test_alias_moves_readers(spark, catalog):
    catalog.create("v1", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    catalog.create("v2", "id", **SMALL).write(docs(spark, [(2, "blue", 1)]))
    catalog.point("live", "v1")
    assert content(catalog.open("live")) == {1: ("red", 1)}
    catalog.point("live", "v2")
    assert content(catalog.open("live")) == {2: ("blue", 1)}


def test_settings(spark, catalog):
    index = catalog.create("t", "id", **SMALL).write(docs(spark, [(1, "red ring", 1), (2, "blue", 2)]))
    index = index.update_settings(filterable=["size"], sortable=["size"])
    assert search_index(index, "red").where("size", 1).total().first()[0] == 1
    with pytest.raises(ValueError):
        search_index(index, "red").where("name", "red").total()
    with pytest.raises(ValueError):
        search_index(index, "red").order_by("name").get()
    assert index.manifest.filterable == ["size", "__soft_deleted"]
    assert index.update_settings(searchable=[]).terms().count() == 0


def test_listeners_hear_commits(spark, catalog):
    heard = []
    listening = Catalog(spark, catalog._files.root, listeners=[heard.append])
    index = listening.create("t", "id", **SMALL).write(docs(spark, [(1, "red", 1)]))
    index.delete([1]).flush()
    assert [(h["operation"], h["count"]) for h in heard] == [("update", 1), ("delete", 1), ("flush", 0)]


def test_eligibility_applies_to_imports_only(spark, catalog):
    rows = docs(spark, [(1, "red", 1), (2, "blue", 5)])
    spec = SearchSpec("t", "id", ["name", "size"], should_index=lambda c: c("size") > 3)
    assert set(content(catalog.create("a", "id", **SMALL).import_table(rows, spec))) == {2}
    assert set(content(catalog.create("b", "id", **SMALL).write(rows))) == {1, 2}


def test_merge_modes(spark):
    live, new = docs(spark, [(1, "a", 1)]), docs(spark, [(1, "b", 2), (2, "c", 3)])
    keys = lambda mode: sorted(r["id"] for r in merge_documents(live, new, "id", mode).collect())
    assert (keys("upsert"), keys("create"), keys("update"), keys("emplace")) == ([1, 2], [2], [1], [1, 2])
    with pytest.raises(ValueError):
        keys("other")


@pytest.fixture(scope="module")
def pair(spark):
    """The same random documents as a table and as an index of many segments."""
    from seekframe import shared_dir

    chance = random.Random(11)
    rows = [(i, " ".join(chance.choice(WORDS) for _ in range(chance.randint(0, 7))), i % 5) for i in range(200)]
    index = Catalog(spark, shared_dir(spark)).create("p", "id", **SMALL)
    index = index.write(docs(spark, [(i, "bolt bolt", 0) for i, _, _ in rows]))
    index = index.write(docs(spark, rows[:120])).write(docs(spark, rows[120:])).delete([5, 6, 7])
    return docs(spark, [r for r in rows if r[0] not in (5, 6, 7)]).cache(), index


SPEC = SearchSpec("p", "id", ["name"], fulltext=["name"], language="simple")


@pytest.mark.parametrize(
    "query, mode",
    [
        ("red ring", "plain"),
        ("gear", "natural"),
        ("red blue", "natural"),
        ("red ring", "phrase"),
        ("bolt bolt", "phrase"),
        ('"red ring" -gear or bolt', "websearch"),
        ("-red", "websearch"),
        ("??", "plain"),
    ],
)
def test_scan_and_index_agree(pair, query, mode):
    table, index = pair
    scan = {r["id"] for r in search(table, SPEC.with_(mode=mode), query).order_by("id").get().collect()}
    found = {r["id"] for r in search_index(index, query, mode=mode, prefix=False).keys().collect()}
    assert found == scan


def test_scores_agree(pair):
    table, index = pair
    scan = search(table, SPEC, "red ring").get().select("id", F.round("_score", 9).alias("s")).collect()
    found = search_index(index, "red ring", prefix=False).raw().select("id", F.round("_score", 9).alias("s")).collect()
    assert scan == found and len(scan) > 10


def test_contains_finds_all_that_a_prefix_finds(pair):
    table, index = pair
    scan = {r["id"] for r in search(table, SPEC, "re").using("contains").get().collect()}
    assert {r["id"] for r in search_index(index, "re").keys().collect()} <= scan


def test_exact_words_come_first(pair):
    _, index = pair
    flags = [r["_exact"] for r in search_index(index, "red").raw().collect()]
    assert flags == sorted(flags, reverse=True) and set(flags) == {0, 1}


def test_documents_and_attributes(pair):
    _, index = pair
    full = search_index(index, "ring").take(4).documents()
    part = search_index(index, "ring", attributes=["size"]).take(4).documents()
    assert "name" in full.columns and "name" not in part.columns
    assert [r["id"] for r in full.collect()] == [r["id"] for r in part.collect()]
