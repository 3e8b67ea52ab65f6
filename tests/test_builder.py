from enum import Enum

import pytest
from pyspark.sql import functions as F

from seekframe import Matched, SearchSpec, register_strategy, search, search_index
from seekframe.plans import paging
from seekframe.sources.tables import contain, key_bounds, plan_ranges

SPEC = SearchSpec("t", "id", ["id", "name", "note"], deleted="deleted")


class Kind(Enum):
    A = "a"


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (1, "apple pie", "a", 1.5, None, True),
        (2, "Apple_tart", None, 2.0, None, False),
        (3, "100% juice", "b", None, "2020-01-01", None),
        (4, "back\\slash", "a", 4.0, None, True),
    ]
    return spark.createDataFrame(
        data, "id BIGINT, name STRING, note STRING, price DOUBLE, deleted STRING, ok BOOLEAN"
    )


def ids(df):
    return [r["id"] for r in df.collect()]


def test_builder_is_immutable(rows):
    base = search(rows, SPEC)
    base.where("id", 1).take(1).order_by("name")
    assert base.wheres == () and base.limit is None and base.orders == ()


def test_null_constraints(rows):
    found = search(rows, SPEC).with_trashed()
    assert ids(found.where("note", None).get()) == [2]
    assert ids(found.where("note", "!=", None).get()) == [4, 3, 1]
    assert ids(found.where("note", "!=", "a").get()) == [3]
    assert ids(found.where("price", ">", None).get()) == []


def test_typed_values(rows):
    found = search(rows, SPEC).with_trashed()
    assert ids(found.where("note", Kind.A).get()) == [4, 1]
    assert ids(found.where("ok", True).get()) == [4, 1]
    assert ids(found.where("ok", "false").get()) == [2]
    assert ids(found.where("id", "3").get()) == [3]
    assert ids(found.where("id", ">", 2.5).get()) == [4, 3]
    assert ids(found.where("id", 2**70).get()) == []
    assert ids(found.where_in("note", [Kind.A, None]).get()) == [4, 1]
    assert ids(found.where_not_in("note", ["b", None]).get()) == []


def test_last_in_list_wins(rows):
    found = search(rows, SPEC).where_in("id", [1]).where_in("id", [2, 4])
    assert ids(found.get()) == [4, 2]


def test_long_lists_become_joins(rows):
    long = list(range(2, 5000))
    found = search(rows, SPEC).with_trashed()
    assert ids(found.where_in("id", long).get()) == [4, 3, 2]
    assert ids(found.where_not_in("id", long).get()) == [1]
    assert "5000" not in found.where_in("id", long).get()._jdf.queryExecution().toString()


def test_not_in_frame_follows_sql(spark, rows):
    found = search(rows, SPEC).with_trashed()
    assert ids(found.where_not_in("note", spark.createDataFrame([("b",)], "v STRING")).get()) == [4, 1]
    assert ids(found.where_not_in("note", spark.createDataFrame([("b",), (None,)], "v STRING")).get()) == []
    assert ids(found.where_not_in("note", spark.createDataFrame([], "v STRING")).get()) == [4, 3, 2, 1]


def test_unknown_operator_and_column(rows):
    with pytest.raises(ValueError):
        search(rows, SPEC).where("id", "~", 1).get()
    with pytest.raises(ValueError):
        search(rows, SPEC).where("nothing", 1).get()
    with pytest.raises(ValueError):
        search(rows, SPEC.with_(document=["nothing"]))
    with pytest.raises(ValueError):
        search(rows, SPEC).using("nothing")


def test_like_patterns(rows):
    found = search(rows, SPEC).with_trashed()
    assert ids(search(rows, SPEC, "apple_").get()) == [2, 1]
    assert ids(search(rows, SPEC, "apple_", literal=True).get()) == [2]
    assert ids(search(rows, SPEC, "0%", literal=True).with_trashed().get()) == [3]
    assert ids(search(rows, SPEC, "k\\s").get()) == [4]
    assert ids(search(rows, SPEC, "slash\\").get()) == []
    assert ids(found.where("name", "like", "app%").get()) == [1]
    assert ids(found.where("name", "ilike", "app%").get()) == [2, 1]
    assert ids(found.where("name", "not like", "%e%").get()) == [4]


def test_key_and_text(rows):
    assert ids(search(rows, SPEC, "1").with_trashed().get()) == [3, 1]
    assert ids(search(rows, SPEC.with_(document=["id"]), "99999999999999999999").get()) == []


def test_strict_without_columns(rows):
    spec = SPEC.with_(document=["price"])
    assert ids(search(rows, spec, "x").get()) == [4, 2, 1]
    with pytest.raises(ValueError):
        search(rows, spec, "x", strict=True).get()


def test_trashed(rows):
    assert ids(search(rows, SPEC).get()) == [4, 2, 1]
    assert ids(search(rows, SPEC).with_trashed().get()) == [4, 3, 2, 1]
    assert ids(search(rows, SPEC).with_trashed().only_trashed().get()) == [3]


def test_order_folding(rows):
    found = search(rows, SPEC).with_trashed().order_by("price").order_by("note").order_by("price", "DOWN")
    assert ids(found.get()) == [4, 2, 1, 3]
    assert ids(search(rows, SPEC, sort=[("note", "asc")]).with_trashed().order_by("id").get()) == [2, 1, 4, 3]


def test_pages(rows):
    found = search(rows, SPEC).with_trashed()
    page = found.take(1).paginate(2, -3)
    assert ids(page.rows) == [4, 3]
    info = page.info.first().asDict()
    assert info == {
        "count": 2, "total_count": 4, "per_page": 2, "current_page": 1, "requested_page": 1, "page_count": 2,
        "has_prev_page": False, "has_next_page": True, "start": 1, "end": 2,
    }
    assert found.paginate().info.first()["per_page"] == 15
    empty = found.where("id", 99).paginate(2).info.first()
    assert (empty["page_count"], empty["start"], empty["end"]) == (1, 0, 0)


def test_simple_pages(rows):
    found = search(rows, SPEC).with_trashed()
    assert found.simple_paginate(3, 1).info.first()["has_next_page"]
    last = found.simple_paginate(3, 2)
    assert ids(last.rows) == [1] and not last.info.first()["has_next_page"]
    assert last.info.first()["total_count"] is None


def test_hook_changes_page_but_not_total(rows):
    found = search(rows, SPEC).using("contains").with_trashed()
    page = found.post_filter(lambda df: df.where("id <> 4")).paginate(2, 1)
    assert ids(page.rows) == [3]
    info = page.info.first()
    assert (info["count"], info["total_count"], info["end"]) == (1, 4, 1)


def test_deep_pages_equal_shallow_ones(spark, monkeypatch):
    many = spark.range(0, 5000, 1, 7).select("id", (F.col("id") % 3).alias("tied"))
    found = search(many, SearchSpec("many", "id", ["id"])).order_by("tied")
    want = ids(found.paginate(40, 50).rows)
    monkeypatch.setattr(paging, "DEEP_SKIP", 10)
    assert ids(found.paginate(40, 50).rows) == want
    assert ids(found.paginate(40, 500).rows) == []
    assert ids(found.paginate(1000, 5).rows) == ids(found.get())[4000:]


def test_a_hook_before_the_limit_of_a_contains_search(rows):
    found = search(rows, SPEC).using("contains").pre_filter(lambda df: df.where("id <> 4"))
    assert ids(found.take(1).get()) == [2]


def test_an_index_search_has_no_row_query(rows, catalog):
    index = catalog.create("t", "id", language="simple").write(rows.select("id", "name"))
    with pytest.raises(ValueError):
        search(rows, SPEC, "pie").within(index).pre_filter(lambda df: df).get()


def test_registered_strategy(rows):
    register_strategy("shortest", lambda s: Matched(s.source.where(F.length("name") < 11), [F.length("name").asc()]))
    assert ids(search(rows, SPEC).using("shortest").take(1).get()) == [1]


def test_key_descends_only_without_order(rows):
    assert ids(search(rows, SPEC).first()) == [4]
    assert ids(search(rows, SPEC).oldest("id").first()) == [1]


def test_ranges(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 700, 1201)], "id BIGINT")
    up = [(r["start"], r["end"]) for r in plan_ranges(df, "id", 500).orderBy("range_no").collect()]
    assert up == [(1, 500), (501, 1000), (1001, 1201)]
    down = [(r["start"], r["end"]) for r in plan_ranges(df, "id", 500, order="desc").orderBy("range_no").collect()]
    assert down == [(702, 1201), (202, 701), (1, 201)]
    assert plan_ranges(df, "id", 10, start=5, end=4).count() == 0
    assert plan_ranges(df.where("id < 0"), "id").count() == 0
    assert plan_ranges(df, "id", 1, start=1, end=25_000).agg(F.count("*"), F.max("end")).first()[:] == (25_000, 25_000)
    assert key_bounds(df, "id").first()[:] == (1, 1201)


def test_joined_search(spark):
    chirps = spark.createDataFrame([(1, "This chirp is searchable"), (2, "Other")], "id INT, content STRING")
    marks = spark.createDataFrame([(7, 1, "sample-label"), (8, 2, "other")], "id INT, chirp_id INT, label STRING")
    joined = contain(marks, chirps, marks["chirp_id"] == chirps["id"], "chirp")
    spec = SearchSpec("marks", "id", ["label", "chirp.content"])
    row = search(joined, spec, "chirp").get().collect()
    assert [(r["id"], r["chirp"]["content"]) for r in row] == [(7, "This chirp is searchable")]


def test_a_value_that_does_not_fit_equals_nothing(spark):
    """One value and a list of one are read alike."""
    rows = spark.createDataFrame([(1, 5), (2, None)], "id INT, size INT")
    spec = SearchSpec("t", "id", ["size"])
    assert search(rows, spec).where("size", "=", "abc").get().count() == 0 == search(rows, spec).where_in("size", ["abc"]).get().count()
    assert search(rows, spec).where("size", "!=", "abc").get().count() == 1 == search(rows, spec).where_not_in("size", ["abc"]).get().count()
    with pytest.raises(ValueError, match="ordered"):
        search(rows, spec).where("size", ">", "abc").get()


def test_highlight_from_the_index_alone(spark, catalog):
    docs = spark.createDataFrame([(1, "a red ring"), (2, "blue")], "id INT, name STRING")
    index = catalog.create("t", "id", language="simple", buckets=2).write(docs)
    found = search_index(index, "red", prefix=False, highlight=["name"])
    assert [r["_highlight"]["name"] for r in found.documents().collect()] == ["a <mark>red</mark> ring"]
    with pytest.raises(ValueError, match="highlight"):
        found.get()
