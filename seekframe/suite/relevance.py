"""Relevance, ranking policies, and hits back to rows."""

from pyspark.sql import functions as F

from seekframe.operators.hydrate import hydrate
from seekframe.operators.rank import first_match, policy_order, scan_scores, top_per_group, with_position
from seekframe.plans.search import search, search_index
from seekframe.sources.tables import table
from seekframe.suite.registry import case
from seekframe.suite.tables import DOCUMENTS, WORDS_SQL, documents_index, new_catalog, texts

# BM25 of a set of words over all documents: doc_id, lang, source, score.
_BM25 = r"""
WITH t AS (SELECT doc_id, lang, source, {words} AS w FROM documents),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(w)) AS mean FROM t),
f AS (SELECT doc_id, lang, source, len(w) AS dl, u.term, len(list_filter(w, lambda x: x = u.term)) AS tf
      FROM t CROSS JOIN (SELECT unnest([{terms}]) AS term) u),
d AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM f WHERE tf > 0 GROUP BY term),
b AS (SELECT doc_id, lang, source, sum(CASE WHEN tf > 0 THEN
          ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / s.mean)) ELSE 0 END) AS score,
        min(tf) AS least
      FROM f JOIN d USING (term) CROSS JOIN s GROUP BY doc_id, lang, source)
"""


def _bm25(*terms: str) -> str:
    return _BM25.format(words=WORDS_SQL, terms=", ".join(f"'{t}'" for t in terms))


@case(
    "bm25_topk",
    _bm25("the", "reed")
    + "SELECT doc_id, round(score, 6) AS _score FROM b WHERE least > 0 ORDER BY score DESC, doc_id DESC LIMIT 10",
)
def bm25_topk(spark, folder):
    found = search(texts(spark, folder), DOCUMENTS, "the reed").take(10).get()
    return found.select("doc_id", F.round("_score", 6).alias("_score"))


@case(
    "bm25_statistics",
    _bm25("the", "reed")
    + "SELECT doc_id, round(score, 6) AS _score FROM b WHERE least > 0 ORDER BY score DESC, doc_id DESC LIMIT 10",
)
def bm25_statistics(spark, folder):
    """Rows of a scan, scored with the counts that an index of the same documents keeps."""
    stored = documents_index(spark, folder)
    found = search(texts(spark, folder), DOCUMENTS, "the reed", statistics=stored).take(10).get()
    return found.select("doc_id", F.round("_score", 6).alias("_score"))


@case("bm25_all", _bm25("of", "with", "una") + "SELECT doc_id, round(score, 6) AS _score FROM b WHERE score > 0")
def bm25_all(spark, folder):
    """Scores of every document that has any of the words."""
    df = texts(spark, folder)
    scored = scan_scores(df, df, F.col("text"), ["of", "with", "una"], "simple", matched_only=True)
    return scored.select("doc_id", F.round("_score", 6).alias("_score"))


@case(
    "index_bm25",
    _bm25("the", "reed")
    + "SELECT doc_id, round(score, 6) AS _score FROM b WHERE least > 0 ORDER BY score DESC, doc_id DESC LIMIT 10",
)
def index_bm25(spark, folder):
    found = search_index(documents_index(spark, folder), "the reed", prefix=False).take(10).raw()
    return found.select("doc_id", F.round("_score", 6).alias("_score"))


@case(
    "index_exact_first",
    rf"""WITH t AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
        s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(w)) AS mean FROM t),
        f AS (SELECT doc_id, len(w) AS dl, list_contains(w, 'reed') AS exact,
                     len(list_filter(w, lambda x: starts_with(x, 'reed'))) AS tf FROM t),
        d AS (SELECT CAST(count(*) AS DOUBLE) AS df FROM f WHERE tf > 0)
        SELECT doc_id, CAST(exact AS INT) AS _exact, round(score, 6) AS _score
        FROM (SELECT doc_id, exact, ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * tf * 2.2 /
                     (tf + 1.2 * (0.25 + 0.75 * dl / s.mean)) AS score
              FROM f CROSS JOIN s CROSS JOIN d WHERE tf > 0)
        ORDER BY exact DESC, score DESC, doc_id DESC LIMIT 60""",
)
def index_exact_first(spark, folder):
    found = search_index(documents_index(spark, folder), "reed").take(60).raw()
    return found.select("doc_id", "_exact", F.round("_score", 6).alias("_score"))


@case(
    "index_order",
    f"""SELECT doc_id, lang, n_chars FROM documents WHERE list_contains({WORDS_SQL}, 'the')
        ORDER BY lang ASC NULLS FIRST, n_chars DESC NULLS LAST, doc_id DESC LIMIT 20""",
)
def index_order(spark, folder):
    found = search_index(documents_index(spark, folder), "the", prefix=False)
    return found.order_by("lang").order_by_desc("n_chars").take(20).raw().select("doc_id", "lang", "n_chars")


_PLACES = r"""
WITH seg AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?\n]+')) AS s,
                    generate_subscripts(string_split_regex(text, '[.!?\n]+'), 1) - 1 AS brk FROM documents),
tok AS (SELECT doc_id, brk, unnest(regexp_extract_all(lower(s), '[\p{L}\p{N}]+')) AS term,
               generate_subscripts(regexp_extract_all(lower(s), '[\p{L}\p{N}]+'), 1) AS i FROM seg),
pos AS (SELECT doc_id, term, brk, row_number() OVER (PARTITION BY doc_id ORDER BY brk, i) - 1 AS p FROM tok),
hit AS (SELECT doc_id, min(p) AS _pos, min(p + 8 * brk) AS _rank_pos FROM pos WHERE starts_with(term, 'the') GROUP BY doc_id)
"""


@case("first_match", _PLACES + "SELECT doc_id, _pos, _rank_pos FROM hit")
def first_match_of(spark, folder):
    """Place of the first word that starts with the string, for every document."""
    hit = first_match(F.col("text"), "the")
    found = texts(spark, folder).select("doc_id", hit.alias("hit")).where("hit.pos IS NOT NULL")
    pos, rank_pos = F.col("hit.pos").cast("bigint"), F.col("hit.rank_pos").cast("bigint")
    return found.select("doc_id", pos.alias("_pos"), rank_pos.alias("_rank_pos"))


def _ranked(spark, folder, policy, n=30):
    found = search_index(documents_index(spark, folder), "the", policy=policy).take(n).raw()
    return with_position(found, policy_order(policy, "doc_id")).select("doc_id", "_position")


@case(
    "rank_position",
    _PLACES + "SELECT doc_id, row_number() OVER (ORDER BY _rank_pos, doc_id) AS _position FROM hit ORDER BY _rank_pos, doc_id LIMIT 30",
)
def rank_position(spark, folder):
    return _ranked(spark, folder, "position")


@case(
    "rank_newest",
    _PLACES + "SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS _position FROM hit ORDER BY doc_id DESC LIMIT 30",
)
def rank_newest(spark, folder):
    return _ranked(spark, folder, "newest")


@case(
    "rank_first_word",
    _PLACES
    + """SELECT doc_id, row_number() OVER (ORDER BY _pos = 0 DESC, doc_id DESC) AS _position FROM hit
         ORDER BY _pos = 0 DESC, doc_id DESC LIMIT 30""",
)
def rank_first_word(spark, folder):
    return _ranked(spark, folder, "first_word")


@case(
    "grouped_hits",
    _bm25("the", "reed")
    + """SELECT doc_id, source, round(score, 6) AS _score
         FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id DESC) AS r FROM b WHERE score > 0)
         WHERE r = 1""",
)
def grouped_hits(spark, folder):
    df = texts(spark, folder)
    scored = scan_scores(df, df, F.col("text"), ["the", "reed"], "simple", matched_only=True)
    best = top_per_group(scored.select("doc_id", "source", "_score"), "source", "_score", "doc_id")
    return best.select("doc_id", "source", F.round("_score", 6).alias("_score"))


@case(
    "upsert_latest",
    """SELECT user_id, event_id, value FROM
       (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def upsert_latest(spark, folder):
    """Latest version of each key."""
    df = table(spark, folder, "events").select("user_id", "event_id", "value", "ts")
    return top_per_group(df, "user_id", "ts", "event_id").select("user_id", "event_id", "value")


@case(
    "term_stats",
    f"""SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents)
        GROUP BY term""",
)
def term_stats(spark, folder):
    return documents_index(spark, folder).terms()


@case(
    "corpus_stats",
    f"SELECT count(*) AS n_docs, round(avg(len({WORDS_SQL})), 6) AS avg_len FROM documents",
)
def corpus_stats(spark, folder):
    return documents_index(spark, folder).stats().select("n_docs", F.round("avg_len", 6).alias("avg_len"))


@case(
    "hydrate",
    f"""SELECT doc_id, quality, toxic FROM labels WHERE doc_id IN
        (SELECT doc_id FROM documents WHERE list_contains({WORDS_SQL}, 'the'))""",
)
def hydrated(spark, folder):
    """Hits become rows of another table; hits that have no row there fall away."""
    hits = search_index(documents_index(spark, folder), "the", prefix=False).raw().select("doc_id")
    return hydrate(hits, table(spark, folder, "labels"), "doc_id")


@case(
    "hydrate_order",
    _bm25("the", "reed")
    + """SELECT doc_id, lang, row_number() OVER (ORDER BY score DESC, doc_id DESC) AS _position
         FROM b WHERE least > 0 ORDER BY score DESC, doc_id DESC LIMIT 25""",
)
def hydrate_order(spark, folder):
    found = search(texts(spark, folder), DOCUMENTS, "the reed", prefix=False).within(documents_index(spark, folder))
    return found.take(25).get().select("doc_id", "lang", "_position")


@case(
    "hydrate_meta",
    _bm25("of") + "SELECT doc_id, lang, round(score, 6) AS _score FROM b WHERE score > 0",
)
def hydrate_meta(spark, folder):
    """Score and other hit facts travel to the rows."""
    found = search(texts(spark, folder), DOCUMENTS, "of", prefix=False).within(documents_index(spark, folder))
    return found.get().select("doc_id", "lang", F.round("_score", 6).alias("_score"))


@case("hydrate_cast", "SELECT c_custkey, c_acctbal FROM customer WHERE contains(lower(c_mktsegment), 'build')")
def hydrate_cast(spark, folder):
    """The index holds text keys, the table numbers."""
    people = table(spark, folder, "customer")
    docs = people.select(F.col("c_custkey").cast("string").alias("id"), "c_mktsegment")
    index = new_catalog(spark).create("people", "id", language="simple").write(docs)
    hits = search_index(index, "build").raw()
    return hydrate(hits, people, "c_custkey", hit_key="id").select("c_custkey", "c_acctbal")
