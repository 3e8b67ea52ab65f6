"""Plans that must hold on a large cluster."""

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF_DIR
from seekframe import Catalog, search, search_index, shared_dir
from seekframe.operators.rank import Key, Order, top_per_group
from seekframe.plans import paging
from seekframe.sources.grams import GramTable, cutter
from seekframe.sources.index import store
from seekframe.sources.tables import by_keys, key_range, table
from seekframe.suite import QUERIES
from seekframe.suite.tables import DOCUMENTS, PART, documents_index


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    found = search(table(spark, SF_DIR, "part"), PART, "ring").where("p_size", ">", 10).where_in("p_type", ["PROMO"])
    shown = plan(found.keys())
    assert "GreaterThan(p_size,10)" in shown and "In(p_type, [PROMO])" in shown or "EqualTo(p_type,PROMO)" in shown
    assert "p_retailprice" not in shown.split("ReadSchema")[1]
    ranged = plan(key_range(table(spark, SF_DIR, "orders"), "o_orderkey", 5, 9))
    assert "GreaterThanOrEqual(o_orderkey,5)" in ranged and "LessThanOrEqual(o_orderkey,9)" in ranged


def test_a_page_is_a_top_k(spark):
    found = search(table(spark, SF_DIR, "part"), PART, "ring")
    assert "TakeOrderedAndProject" in plan(found.take(10).get())
    assert "TakeOrderedAndProject" in plan(found.paginate(10, 3).rows)
    assert "Exchange" not in plan(found.take(10).get())


def small_files(catalog, rows, **settings):
    """An index whose postings are many files."""
    index = catalog.create("small", "doc_id", language="simple", searchable=["text"], buckets=4, file_words=2_000, **settings)
    return index.write(rows.select("doc_id", "text", "lang", "n_chars"))


def test_an_import_of_many_files_hands_postings_out_unsorted(spark, monkeypatch):
    """More files than Spark hands rows out to directly: fewer, wider ranges cut into files, and no constants in the exchange."""
    asked, frame = [], type(spark.range(1))
    deal = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, n, *by: asked.append((n, df.columns)) or deal(df, n, *by))
    monkeypatch.setattr(store, "MOST_RANGES", 5, raising=False)
    rows = [(i, " ".join(f"w{(i * j) % 91}" for j in range(1, 30))) for i in range(60)]
    catalog = Catalog(spark, shared_dir(spark))
    index = catalog.create("many", "id", language="simple", file_words=100, buckets=2).write(spark.createDataFrame(rows, "id int, text string"))
    assert [n for n, _ in asked] == [5]
    assert not {"src", "gone", "tf", "field", "lead"} & set(asked[0][1])
    found = index.postings().withColumn("file", F.input_file_name())
    per_file = found.groupBy("file").agg(F.count("*").alias("n"), F.min(F.struct("term", "ord")).alias("a"), F.max(F.struct("term", "ord")).alias("b"))
    per_file = per_file.orderBy("a").collect()
    assert len(per_file) > 10 and all(f["n"] <= 100 for f in per_file)
    assert all(x["b"] < y["a"] for x, y in zip(per_file, per_file[1:]))
    places = {}
    for key, text in rows:
        for place, word in enumerate(text.split()):
            places.setdefault((word, key), []).append(place)
    got = {(r["term"], r["key"]): r for r in found.collect()}
    assert got.keys() == places.keys()
    assert all(r["tf"] == len(places[k]) == len(r["positions"]) and r["lead"] and r["gone"] == 0 and r["field"] == "text" for k, r in got.items())
    assert {r["src"] for r in got.values()} == {index.manifest.segments[0]["id"]}


def test_no_task_sorts_all_postings_of_an_import(spark, monkeypatch):
    """Postings that share a file by the setting are still sorted by as many tasks as they need."""
    monkeypatch.setattr(store, "TASK_WORDS", 100, raising=False)
    rows = spark.createDataFrame([(i, f"all w{i} v{i} u{i % 7}") for i in range(100)], "id int, text string")
    index = Catalog(spark, shared_dir(spark)).create("parts", "id", language="simple", buckets=2).write(rows)
    assert index.postings().select(F.input_file_name()).distinct().count() > 1
    assert index.postings().count() == 400


def test_postings_files_have_disjoint_ranges(spark, catalog):
    """A rare word opens one file, a one-letter prefix some, a very common word is split over several."""
    index = small_files(catalog, table(spark, SF_DIR, "documents"))
    segment = index.manifest.segments[0]["id"]
    terms = index.postings().select("term", "ord", F.input_file_name().alias("file"))
    ranges = terms.groupBy("file").agg(F.min(F.struct("term", "ord")).alias("a"), F.max(F.struct("term", "ord")).alias("b"))
    ranges = ranges.orderBy("a").collect()
    assert len(ranges) > 10 and all(x["b"] < y["a"] for x, y in zip(ranges, ranges[1:]))
    rare = index.terms().where("df = 1").first()["term"]
    common = index.terms().orderBy(F.desc("df")).first()["term"]
    assert len(index.posting_files(segment, [(rare, False)])) == 1
    assert len(index.posting_files(segment, [(common, False)])) >= 1
    assert len(index.posting_files(segment, [("q", True)])) < len(ranges) / 3
    opened = search_index(index, rare, prefix=False).keys().inputFiles()
    assert len([f for f in opened if "/postings/" in f]) == 1
    assert index.posting_files(segment, [("\U0002ffff", False)]) == []


def test_a_word_after_updates_moves_no_postings(spark, catalog):
    rows = table(spark, SF_DIR, "documents").where("doc_id is not null").dropDuplicates(["doc_id"])
    index = small_files(catalog, rows)
    for i in range(10):
        index = index.write(rows.where(F.col("doc_id") % 20 == i).select("doc_id", "text", "lang", "n_chars"))
    found = search_index(index, "the", prefix=False).take(10).raw()
    # Bitmaps are gathered and sent; what is joined to them stays where it is.
    main = plan(found)
    assert "SortMergeJoin" not in main and "ShuffledHashJoin" not in main and "BroadcastHashJoin" in main
    fresh = small_files(Catalog(spark, shared_dir(spark)), rows)
    want = search_index(fresh, "the", prefix=False).take(10).raw()
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.collect()]


def test_commits_read_no_old_text(spark, catalog):
    """What a commit reads of older documents: keys, places and terms, but no field."""
    index = small_files(catalog, table(spark, SF_DIR, "documents"))
    keys = spark.createDataFrame([(5, 1), (9, 1)], "key bigint, bucket int")
    read = plan(index._found(index._live_docs(), keys, 2, [0, 1]).select("doc_id", "__src", "__ord", "__len", F.col("__runs")["term"]))
    schema = read.split("ReadSchema: ")[1].split("\n")[0]
    assert "text" not in schema and "lang" not in schema and "positions" not in schema
    assert "In(doc_id, [5,9])" in read or "doc_id" in read.split("PushedFilters: [")[1].split("]")[0]


def test_declared_fields_join_no_documents(spark, catalog):
    rows = table(spark, SF_DIR, "documents")
    index = small_files(catalog, rows, filterable=["lang", "n_chars"], sortable=["n_chars"])
    for query in ("the", "the reed", '"the reed"'):
        found = search_index(index, query, prefix=False, mode="websearch").where("lang", "en").where("n_chars", ">", 50)
        found = found.order_by("n_chars").take(20).raw()
        assert "/docs/" not in " ".join(found.inputFiles()) and "Join" not in plan(found).split("Subquery")[0]
        plain = small_files(Catalog(spark, shared_dir(spark)), rows)
        want = search_index(plain, query, prefix=False, mode="websearch").where("lang", "en").where("n_chars", ">", 50)
        assert [r["doc_id"] for r in found.collect()] == [r["doc_id"] for r in want.order_by("n_chars").take(20).raw().collect()]


def test_one_word_in_one_field_moves_no_postings(spark):
    found = search_index(documents_index(spark, SF_DIR), "the", prefix=False).take(10).raw()
    main = plan(found).split("Subquery")[0]
    assert "TakeOrderedAndProject" in main and "Exchange" not in main


def test_no_query_multiplies_tables(spark):
    for name in ("bm25_topk", "index_bm25", "fulltext_web", "index_web", "hydrate_order", "where_not_in_frame"):
        shown = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown, name


def test_long_keys_are_a_semi_join(spark):
    orders = table(spark, SF_DIR, "orders")
    keys = table(spark, SF_DIR, "lineitem").select("l_orderkey")
    assert "LeftSemi" in plan(by_keys(orders, "o_orderkey", keys))


def test_a_group_of_most_rows_is_merged_before_it_moves(spark):
    """Half of all rows share one group: each task sends one row of it."""
    rows = spark.range(0, 40_000, 1, 8).select(
        "id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"), (F.col("id") % 97).alias("score")
    )
    best = top_per_group(rows, "g", "score", "id").where("g = 0").collect()
    want = rows.where("g = 0").orderBy(F.desc("score"), F.desc("id")).first()
    assert [tuple(r) for r in best] == [tuple(want)]
    assert "partial_max_by" in plan(top_per_group(rows, "g", "score", "id"))


def test_a_scan_with_stored_counts_reads_texts_once(spark):
    rows = table(spark, SF_DIR, "documents")
    found = search(rows, DOCUMENTS, "the reed", statistics=documents_index(spark, SF_DIR)).take(10).get()
    assert plan(found).count("documents.parquet") == 1


def test_deep_pages_are_selected_without_a_sort(spark, monkeypatch):
    """Any page equals the one cut from the whole order, with nulls, ties, descending keys and small samples."""
    monkeypatch.setattr(paging, "DEEP_SKIP", 50)
    monkeypatch.setattr(paging, "SAMPLE", 200)
    rows = spark.range(0, 3000, 1, 6).select(
        "id",
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40).alias("a"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 37 % 101).cast("double")).alias("b"),
    )
    for order in (
        Order([Key(F.col("a")), Key(F.col("b"), True), Key(F.col("id"), True)]),
        Order([Key(F.col("b"), True), Key(F.col("a") > 20), Key(F.col("id"))]),
    ):
        whole = [r["id"] for r in rows.orderBy(*order).collect()]
        for per_page, page in ((10, 7), (10, 150), (100, 30), (100, 31), (7, 400), (5, 900)):
            got = [r["id"] for r in paging.page_slice(rows, order, per_page, page).collect()]
            assert got == whole[(page - 1) * per_page : page * per_page], (per_page, page)
        left, skip = paging.selected(rows, order, 2000, 10)
        assert left.count() < 2500 and skip <= 2000
    # Rows that tie on everything: any rows of the right number.
    tied = paging.page_slice(rows, Order([Key(F.col("a"))]), 100, 25)
    places = [r["a"] for r in rows.orderBy(F.col("a").asc_nulls_first()).collect()]
    assert [r["a"] for r in tied.collect()] == places[2400:2500]


def test_grams_are_cut_once_for_a_block(spark):
    """Grams of a block leave its task once, not once for each row; those of odd letters are whole."""
    texts = ["abcd", "abcd", None, "ab", "x\x00\x00\x00", "a\U0001f600b\U0001f600", "bcde"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = shared_dir(spark)
    GramTable.build(docs, DOCUMENTS, path, block_bits=9)
    want = {t[i : i + 3] for t in map(lambda t: "null" if t is None else t, texts) for i in range(len(t) - 2)}
    got = spark.read.parquet(f"{path}/grams").collect()
    assert sorted(r["gram"] for r in got) == sorted(want)
    rows = [(7, b"abcd"), (7, b"bcd"), (8, b"bcd"), (8, b"")]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 2])], ["b", "t"]) for i in (0, 2)]
    assert [x for b in cutter()(batches) for x in zip(*(c.to_pylist() for c in b.columns))] == [(7, "abc"), (7, "bcd"), (8, "bcd")]


def test_grams_skip_blocks(spark):
    """A rare string reads few blocks and finds what a scan finds; odd strings lose nothing."""
    extra = [(10**9 + i, t) for i, t in enumerate(["zqxj here", "ZQXJ", None, "", "ab", "a\U0001f600b zq\U0001f600xj", "\u0130stanbul", "50%_off", "tab\tzqx"])]
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    grams = GramTable.build(docs, DOCUMENTS, shared_dir(spark), block_bits=3, row_group=1 << 16)
    assert grams.rows().count() == docs.count()
    for needle in ("zqxj", "ZQX", "zq\U0001f600xj", "\u0130stanbul", "stanbul", "50%_off", "ab", "null", "the", "b\tz", "nowhere at all"):
        want = {r["doc_id"] for r in search(docs, DOCUMENTS, needle).using("contains").get().collect()}
        assert {r["doc_id"] for r in search(grams.containing(needle), DOCUMENTS, needle).using("contains").get().collect()} == want, needle
    spec = DOCUMENTS.with_(fulltext=[])
    for pattern in ("z_xj", "zq%j", "50%_off", "%"):
        want = {r["doc_id"] for r in search(docs, spec, pattern).get().collect()}
        assert {r["doc_id"] for r in search(grams.like(pattern), spec, pattern).get().collect()} == want, pattern
    assert grams.containing("zqxj").count() < docs.count() / 5
    assert "In(__block" in plan(grams.containing("zqxj")) or "EqualTo(__block" in plan(grams.containing("zqxj"))


def _dealt(spark, monkeypatch, made):
    """The columns of each range exchange while an index is made, and the index."""
    asked, frame = [], type(spark.range(1))
    deal = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, n, *by: asked.append(df.schema) or deal(df, n, *by))
    return made(), asked


def test_postings_travel_packed(spark, monkeypatch):
    """One text for term and places, what belongs to the document once and first; all of it comes back, odd documents too."""
    monkeypatch.setattr(store, "TASK_WORDS", 5)
    texts = ["a b a. C! b", "", None, "\U0001f600 ä\U00020000x 7,7 ß", "a " * 200, "x.y.z. x"]
    rows = [(i, t, f"n {i}, {i}", None if i == 2 else i / 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id long, text string, note string, weight double")

    def made(fields, words):
        monkeypatch.setattr(store, "TASK_WORDS", words)
        index = Catalog(spark, shared_dir(spark)).create("p", "id", language="simple", searchable=fields, filterable=["note", "weight"], buckets=2)
        return index.write(docs)

    for fields in (["text"], ["text", "note"]):
        index, asked = _dealt(spark, monkeypatch, lambda: made(fields, 5))
        assert len(asked) == 1 and {"term", "positions", "first_rank", "key", "len", "_f_note"}.isdisjoint(asked[0].names)
        whole, none = _dealt(spark, monkeypatch, lambda: made(fields, 10**6))
        assert not none
        columns = [c for c in whole.postings().columns if c not in ("src", "ord", "seg")]
        assert index.postings().schema == whole.postings().schema
        assert index.postings().select(F.input_file_name()).distinct().count() > 1

        def told(of):
            return sorted(str(tuple(r)) for r in of.postings().select(columns).collect())

        assert told(index) == told(whole) and len(told(index)) > 10


def test_terms_move_once_with_short_names(spark, monkeypatch):
    """Counted terms are written straight from their aggregate, with a file's name and not its path."""
    hinted, frame = [], type(spark.range(1))
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, *how: hinted.append(df.columns) or hint(df, *how))
    rows = spark.createDataFrame([(i, f"all w{i} v{i} u{i % 7}") for i in range(50)], "id int, text string")
    index = Catalog(spark, shared_dir(spark)).create("t", "id", language="simple", buckets=2).write(rows)
    assert not [c for c in hinted if "term" in c]
    path = f"{index.path}/terms/seg={index.manifest.segments[0]['id']}"
    assert not [r for r in spark.read.parquet(path).select("file").distinct().collect() if "/" in r["file"]]


def test_a_file_is_found_by_any_field(spark, monkeypatch):
    """Files are cut between two fields' postings of one word: the later field is found as well."""
    monkeypatch.setattr(store, "MOST_RANGES", 1)
    rows = spark.createDataFrame([(i, "same", "same") for i in range(9)], "id int, a string, b string")
    index = Catalog(spark, shared_dir(spark)).create("f", "id", language="simple", file_words=3, buckets=2).write(rows)
    segment = index.manifest.segments[0]["id"]
    files = index.postings().select(F.input_file_name()).distinct().count()
    assert files > 3 and len(index.posting_files(segment, [("same", False)])) == files
    assert index.postings([("same", False)]).count() == 18
