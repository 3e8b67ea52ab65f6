"""Word search over whole document texts."""

from pyspark.sql import functions as F

from seekframe.functions.english import DOUBLE_KEPT, PUT_BACK, RUN, SHORT, STEPS, TIDIED, VOWEL, VOWEL_Y
from seekframe.functions.text import ANALYZERS, highlight, tokens
from seekframe.plans.search import search, search_index
from seekframe.suite.registry import case
from seekframe.suite.tables import DOCUMENTS, SPACED_SQL, WORDS_SQL, documents_index, new_catalog, texts

# The stop list of the english analyzer, as SQL, and its steps.
_STOPS = (
    "'a','an','and','are','as','at','be','but','by','for','if','in','into','is','it','no','not','of','on','or',"
    "'such','that','the','their','then','there','these','they','this','to','was','will','with'"
)
def _marked(x):
    return rf"regexp_replace({x}, '{VOWEL_Y}', '\1Y', 'g')"


def _measure(x):
    return f"len(regexp_extract_all({_marked(x)}, '{RUN}'))"


def _meets(x, need):
    if not need:
        return "true"
    return f"regexp_matches({_marked(x)}, '{VOWEL}')" if need == "v" else f"{_measure(x)} >= {need}"


def _tidy(x):
    back = " OR ".join(f"ends_with({x}, '{e}')" for e in PUT_BACK)
    double = f"length({x}) > 1 AND right({x}, 1) = left(right({x}, 2), 1) AND NOT contains('{DOUBLE_KEPT}', right({x}, 1))"
    short = f"{_measure(x)} = 1 AND regexp_matches({_marked(x)}, '{SHORT}')"
    return f"CASE WHEN {back} THEN {x} || 'e' WHEN {double} THEN left({x}, length({x}) - 1) WHEN {short} THEN {x} || 'e' ELSE {x} END"


def _step(number):
    cases = []
    for suffix, left, need in STEPS[number]:
        kept = f"left(x, length(x) - {len(suffix)})"
        new = _tidy(kept) if number == TIDIED and not left else f"{kept} || '{left}'"
        cases.append(f"WHEN ends_with(x, '{suffix}') THEN CASE WHEN {_meets(kept, need)} THEN {new} ELSE x END")
    return f"CASE WHEN length(w) < 3 THEN w {' '.join(cases)} ELSE x END"


_LESS = "left(x, length(x) - 1)"
_FINAL_E = f"""CASE WHEN length(w) >= 3 AND ends_with(x, 'e') AND ({_measure(_LESS)} > 1
    OR ({_measure(_LESS)} = 1 AND NOT regexp_matches({_marked(_LESS)}, '{SHORT}'))) THEN {_LESS} ELSE x END"""
# Every word of the documents that is no stop word, in its place, and its stem: ``u`` (doc_id, i, w) and ``stems`` (w, x).
_ENGLISH = f"""WITH t AS (SELECT doc_id, list_filter({WORDS_SQL}, lambda w: w NOT IN ({_STOPS})) AS ws FROM documents),
    u AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t),
    s0 AS (SELECT DISTINCT w, w AS x FROM u),
    """ + "".join(f"s{i + 1} AS (SELECT w, {_step(i)} AS x FROM s{i}),\n    " for i in range(len(STEPS))) + f"""stems AS (SELECT w, {_FINAL_E} AS x FROM s{len(STEPS)})
"""


def _found(spark, folder, query, mode, language="simple"):
    spec = DOCUMENTS.with_(mode=mode, language=language)
    return search(texts(spark, folder), spec, query).order_by("doc_id").get().select("doc_id", "lang")


@case("fulltext_and", f"SELECT doc_id, lang FROM documents WHERE list_has_all({WORDS_SQL}, ['the', 'reed'])")
def fulltext_and(spark, folder):
    return _found(spark, folder, "The reed!", "plain")


@case("fulltext_phrase", f"SELECT doc_id, lang FROM documents WHERE contains({SPACED_SQL}, ' of the ')")
def fulltext_phrase(spark, folder):
    return _found(spark, folder, "of the", "phrase")


@case(
    "fulltext_web",
    f"""SELECT doc_id, lang FROM documents
        WHERE (contains({SPACED_SQL}, ' on the ') AND contains({SPACED_SQL}, ' with ') AND NOT contains({SPACED_SQL}, ' and '))
           OR (contains({SPACED_SQL}, ' und ') AND NOT contains({SPACED_SQL}, ' der die '))""",
)
def fulltext_web(spark, folder):
    return _found(spark, folder, '"on the" with -and or und -"der die"', "websearch")


@case("fulltext_or", f"SELECT doc_id, lang FROM documents WHERE list_has_any({WORDS_SQL}, ['una', 'und'])")
def fulltext_or(spark, folder):
    return _found(spark, folder, "una und", "natural")


@case("fulltext_none", "SELECT doc_id, lang FROM documents WHERE false")
def fulltext_none(spark, folder):
    """A string without words matches nothing."""
    return _found(spark, folder, "?!", "plain")


@case(
    "fulltext_english",
    f"""{_ENGLISH} SELECT doc_id, lang FROM documents WHERE doc_id IN (
        SELECT doc_id FROM u JOIN stems USING (w) WHERE x IN ('reed', 'rest') GROUP BY doc_id HAVING count(DISTINCT x) = 2)""",
)
def fulltext_english(spark, folder):
    """Stop words are dropped from the string, and all forms of a word match."""
    return _found(spark, folder, "the reeds and rests", "plain", "english")


@case(
    "fulltext_two_columns",
    f"""SELECT doc_id FROM (SELECT doc_id, coalesce(text, '') || ' ' || coalesce(source, '') AS text FROM documents)
        WHERE list_has_all({WORDS_SQL}, ['src1', 'the'])""",
)
def fulltext_two_columns(spark, folder):
    """Words may be spread over the columns."""
    spec = DOCUMENTS.with_(document=["text", "source"], fulltext=["text", "source"])
    return search(texts(spark, folder), spec, "src1 the").order_by("doc_id").get().select("doc_id")


@case(
    "tokens",
    f"""SELECT doc_id, len(t) AS n, len(list_distinct(t)) AS n_distinct, md5(array_to_string(t, ' ')) AS fingerprint
        FROM (SELECT doc_id, {WORDS_SQL} AS t FROM documents)""",
)
def tokens_of(spark, folder):
    cut = texts(spark, folder).select("doc_id", tokens(F.col("text")).alias("t"))
    return cut.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"),
        F.md5(F.array_join("t", " ")).alias("fingerprint"),
    )


@case(
    "tokens_english",
    f"""{_ENGLISH} SELECT doc_id, len(ws) AS n, md5(coalesce(said, '')) AS fingerprint
        FROM t LEFT JOIN (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS said FROM u JOIN stems USING (w) GROUP BY doc_id) USING (doc_id)""",
)
def tokens_english(spark, folder):
    cut = texts(spark, folder).select("doc_id", tokens(F.col("text"), "english").alias("t"))
    return cut.select("doc_id", F.size("t").cast("bigint").alias("n"), F.md5(F.array_join("t", " ")).alias("fingerprint"))


@case(
    "index_english",
    f"""{_ENGLISH} SELECT doc_id FROM documents WHERE doc_id IN (
        SELECT doc_id FROM u JOIN stems USING (w) WHERE x IN ('rest', 'reed') GROUP BY doc_id)""",
)
def index_english(spark, folder):
    """An english index is searched by stems, whatever form the string has."""
    index = new_catalog(spark).create("stems", "doc_id", language="english", searchable=["text"], buckets=8, file_words=500_000)
    index = index.write(texts(spark, folder).select("doc_id", "text"))
    return search_index(index, "resting reeds", mode="natural", prefix=False).keys()


def _stem_sql(language):
    rules = ANALYZERS[language]
    cases = "".join(
        f" WHEN suffix(w, '{ending}') THEN left(w, length(w) - {len(ending)}) || '{left}'" for ending, left in rules.endings
    )
    return f"CASE WHEN length(w) < {rules.least} THEN w{cases} ELSE w END"


def _register_languages():
    for language in ("german", "spanish", "french"):
        stops = ", ".join(f"'{w}'" for w in ANALYZERS[language].stops)

        @case(
            f"tokens_{language}",
            f"""SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS fingerprint
                FROM (SELECT doc_id, list_transform(list_filter({WORDS_SQL}, lambda w: w NOT IN ({stops})), lambda w: {_stem_sql(language)}) AS t
                      FROM documents)""",
        )
        def tokens_of(spark, folder, language=language):
            cut = texts(spark, folder).select("doc_id", tokens(F.col("text"), language).alias("t"))
            return cut.select("doc_id", F.size("t").cast("bigint").alias("n"), F.md5(F.array_join("t", " ")).alias("fingerprint"))


_register_languages()


_MARKED = r"""array_to_string(list_transform(w, lambda x:
      regexp_replace(x, '(^|[^\p{L}\p{N}])(the|reed)($|[^\p{L}\p{N}])', '\1<mark>\2</mark>\3', 'gi')), ' ')"""


@case(
    "highlight",
    rf"""WITH d AS (SELECT doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS w FROM documents),
         h AS (SELECT doc_id, w, list_position(list_transform(w, lambda x:
                 regexp_matches(x, '(?i)(^|[^\p{{L}}\p{{N}}])(the|reed)($|[^\p{{L}}\p{{N}}])')), true) AS p FROM d),
         s AS (SELECT doc_id, CASE WHEN len(w) > 30 AND p > 0 THEN w[greatest(p - 4, 1):p + 4] ELSE w END AS w FROM h)
         SELECT doc_id, {_MARKED} AS _highlight FROM s""",
)
def highlighted(spark, folder):
    df = texts(spark, folder)
    return df.select("doc_id", highlight(F.col("text"), ["the", "reed"]).alias("_highlight"))


def _index_total(spark, folder, query, **options):
    return search_index(documents_index(spark, folder), query, **options).keys()


@case(
    "index_prefix",
    f"""SELECT doc_id FROM documents
        WHERE list_contains({WORDS_SQL}, 'the') AND len(list_filter({WORDS_SQL}, lambda w: starts_with(w, 'ree'))) > 0""",
)
def index_prefix(spark, folder):
    """The last word of the string may be the start of a word."""
    return _index_total(spark, folder, "the ree")


@case("index_match_all", "SELECT doc_id FROM documents")
def index_match_all(spark, folder):
    return _index_total(spark, folder, "*")


@case("index_phrase", f"SELECT doc_id FROM documents WHERE contains({SPACED_SQL}, ' on the ')")
def index_phrase(spark, folder):
    return _index_total(spark, folder, "on the", mode="phrase")


@case("index_any", f"SELECT doc_id FROM documents WHERE list_has_any({WORDS_SQL}, ['una', 'und'])")
def index_any(spark, folder):
    return _index_total(spark, folder, "una und", mode="natural", prefix=False)


@case(
    "index_web",
    f"""SELECT doc_id FROM documents WHERE NOT contains({SPACED_SQL}, ' the ')
        OR (contains({SPACED_SQL}, ' on the ') AND NOT contains({SPACED_SQL}, ' of '))""",
)
def index_web(spark, folder):
    """A group of nothing but exclusions matches documents without those words."""
    return _index_total(spark, folder, '-the or "on the" -of', mode="websearch")


@case("search_within", f"SELECT doc_id FROM documents WHERE list_contains({WORDS_SQL}, 'und')")
def search_within(spark, folder):
    """A table search answered by a named index."""
    index = documents_index(spark, folder)
    return search(texts(spark, folder), DOCUMENTS, "und", prefix=False).within(index).keys()


@case(
    "index_filter",
    f"""SELECT doc_id, n_chars FROM documents WHERE list_contains({WORDS_SQL}, 'the') AND lang = 'en' AND n_chars > 1000
        AND source NOT IN ('src1', 'src2')""",
)
def index_filter(spark, folder):
    index = documents_index(spark, folder)
    found = search_index(index, "the", prefix=False).where("lang", "en").where("n_chars", ">", 1000)
    return found.where_not_in("source", ["src1", "src2"]).raw().select("doc_id", "n_chars")
