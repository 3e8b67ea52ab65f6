"""Result orders for the string "lar" over the 44 users."""

import pytest

from seekframe import SearchSpec, search

SPEC = SearchSpec("users", "id", ["id", "name", "email", "age"])
POSITION = [1, 11, 12, 39, 40, 41, 42, 43, 44, 20]
NEWEST = [44, 43, 42, 41, 40, 39, 20, 12, 11, 1]
FIRST_WORD = [11, 1, 44, 43, 42, 41, 40, 39, 20, 12]


def ids(df):
    return [r["id"] for r in df.collect()]


@pytest.fixture(scope="module")
def index(spark, users):
    from seekframe import Catalog, shared_dir

    created = Catalog(spark, shared_dir(spark)).create(
        "users", "id", language="simple", searchable=["name"], buckets=4
    )
    return created.import_table(users, SPEC)


@pytest.mark.parametrize("policy, want", [("position", POSITION), ("newest", NEWEST), ("first_word", FIRST_WORD)])
def test_index_orders(users, index, policy, want):
    found = search(users, SPEC, "lar", policy=policy).within(index)
    assert ids(found.take(10).get()) == want
    assert [r["id"] for r in found.take(10).keys().collect()] == want


@pytest.mark.parametrize("strategy", ["like", "contains"])
def test_scan_order_is_key_descending(users, strategy):
    assert ids(search(users, SPEC, "lar").using(strategy).take(10).get()) == NEWEST


def test_row_hook_after_the_limit(users, index):
    found = search(users, SPEC, "lar", policy="position").within(index).take(10)
    verified = found.post_filter(lambda df: df.where("email LIKE '%@verified.test'"))
    assert ids(verified.get()) == [1, 12, 40, 41, 42, 43, 44]
    assert ids(verified.keys()) == POSITION


def test_row_hook_before_the_limit(users):
    found = search(users, SPEC, "lar").take(3).pre_filter(lambda df: df.where("email LIKE '%@verified.test'"))
    assert ids(found.get()) == [44, 43, 42]


def test_pages(users, index):
    found = search(users, SPEC, "lar", policy="position").within(index)
    first, second = found.paginate(5, 1), found.paginate(5, 2)
    assert ids(first.rows) == POSITION[:5] and ids(second.rows) == POSITION[5:]
    info = second.info.first()
    assert (info["total_count"], info["page_count"], info["start"], info["end"]) == (10, 2, 6, 10)
    assert info["has_prev_page"] and not info["has_next_page"]


def test_stale_hits_fall_away(users, index):
    some = users.where("id <> 12")
    assert ids(search(some, SPEC, "lar", policy="position").within(index).take(10).get()) == [
        i for i in POSITION if i != 12
    ]


def test_sort_on_index_fields(users, index):
    found = search(users, SPEC, "lar").within(index).order_by("name").take(3).get()
    assert [r["name"] for r in found.collect()] == ["Amos Larson Sr.", "Dana Larson Sr.", "Dax Larkin"]


def test_unlimited_index_search_keeps_order(users, index):
    assert ids(search(users, SPEC, "lar", policy="position").within(index).get()) == POSITION


def test_cursor(users):
    assert [r["id"] for r in search(users, SPEC, "lar").cursor()] == NEWEST


def test_match_all(users, index):
    assert search(users, SPEC, "*").within(index).total().first()[0] == 44


@pytest.mark.parametrize(
    "constraints, want",
    [
        ([(">", 30)], ["Blake Torres"]),
        ([(">=", 30)], ["Blake Torres", "Alex Rivera"]),
        ([("<", 35)], ["Alex Rivera"]),
        ([("<=", 35)], ["Blake Torres", "Alex Rivera"]),
        ([("!=", 30)], ["Blake Torres"]),
        ([(">", 30), ("<", 40)], ["Blake Torres"]),
        ([(">", 20), ("<=", 30)], ["Alex Rivera"]),
    ],
)
@pytest.mark.parametrize("strategy", ["like", "contains"])
def test_comparisons(spark, strategy, constraints, want):
    two = spark.createDataFrame(
        [(1, "Alex Rivera", "a@x.test", 30), (2, "Blake Torres", "b@x.test", 35)],
        "id INT, name STRING, email STRING, age INT",
    )
    found = search(two, SPEC).using(strategy)
    for operator, value in constraints:
        found = found.where("age", operator, value)
    assert [r["name"] for r in found.get().collect()] == want
