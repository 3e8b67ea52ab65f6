from seekframe import SearchSpec, search, search_index, shared_dir
from seekframe.audit import Audit


def test_records(spark, catalog):
    rows = spark.createDataFrame([(i, f"red w{i}") for i in range(70)], "id BIGINT, name STRING")
    spec = SearchSpec("t", "id", ["name"])
    audit = Audit(spark, shared_dir(spark))
    assert audit.counts().count() == 0
    index = audit.write(lambda: catalog.create("t", "id", language="simple").write(rows))
    audit.write(lambda: index.delete([1, 2]))
    result = audit.search(search(rows, spec, "red").where("id", ">", 3).where_in("id", range(9)).order_by("id"))
    assert [r["id"] for r in result.collect()] == [4, 5, 6, 7, 8]
    audit.search(search(rows, spec, "red").take(60))
    audit.search(search_index(index, "red"))
    audit.paginate(search(rows, spec, "red"), 10, 2)
    first, second, third, page = audit.searches().orderBy("at").collect()
    assert (first["query"], first["index"], first["strategy"], first["found"]["total"]) == ("red", "t", "like", 5)
    assert first["found"]["keys"] == ["4", "5", "6", "7", "8"] and not first["found"]["cut"] and first["duration_ms"] > 0
    assert [tuple(f) for f in first["filters"]] == [("id", ">", "3"), ("id", "in", "0, 1, 2, 3, 4, 5, 6, 7, 8")]
    assert [tuple(o) for o in first["sorted"]] == [("id", "asc")]
    assert second["found"]["total"] == 60 and len(second["found"]["keys"]) == 50 and second["found"]["cut"]
    assert third["strategy"] == "index" and third["found"]["total"] == 70
    assert (page["operation"], tuple(page["shown"]), page["found"]["total"]) == ("paginate", (2, 10), 70)
    assert page["found"]["keys"][0] == "59"
    writes = audit.writes().orderBy("at").collect()
    assert [(w["operation"], *w["changed"]) for w in writes] == [("update", 70, 70, 0), ("delete", 2, 0, 2)]
    keys = {(r["segment"], r["op"], r["key"]) for r in audit.written_keys().collect()}
    assert len(keys) == 72 and {(writes[1]["segment"], "delete", k) for k in "12"} <= keys
    counts = {(r["index"], r["operation"]): r["n"] for r in audit.counts().collect()}
    assert counts == {("t", "search"): 3, ("t", "paginate"): 1, ("t", "update"): 1, ("t", "delete"): 1}
