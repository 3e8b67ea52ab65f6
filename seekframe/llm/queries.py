"""The registered queries of the operators, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm import binary, chat, decontamination, lexical, neardup, neighbours, packing, prefixes, quality, repair, secrets, substrings, warc
from seekframe.llm.common import parked, read
from seekframe.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Tokens over which a document is reported by the token counts.
TOKEN_LIMIT = 2048


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_pattern_packing")
def pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packing.pack_documents(read(spark, folder, "documents"))


@query("op6_prefix_counts")
def prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents, read from the stored prefix tables."""
    stored = parked(prefixes.prefix_tables(read(spark, folder, "documents")))
    return stored.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query("op8_seekable_ids")
def seekable_ids(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as binary ids and read back from the files."""
    docs = read(spark, folder, "documents")
    place = binary.ids_folder(spark)
    index = binary.write_ids(docs, place)
    return binary.summed(binary.read_ids(index, place))


#: The words of a text in SQL.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOW = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(
    "op3_tensored_minhash",
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_LOW} AS ws FROM documents),
    sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s
           FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) AS i FROM w)),
    size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
    way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, way.b FROM reach r JOIN way ON way.a = r.c),
    comp AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM comp LEFT JOIN size USING (doc_id)
""",
)
def tensored_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents, on three-word shingles at 0.85."""
    return neardup.link_components(read(spark, folder, "documents"), 3, (85, 100))


@query("op7_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents: base patterns and the randomness battery."""
    return secrets.report(secrets.scan(read(spark, folder, "documents")))


#: A conversation that says the template's own marks.
MARKS = r"\### Assistant: </turn> ok"

_PLAIN = r"""
    SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
           coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7::BIGINT, 0::BIGINT, 'user', '\### Assistant: </turn> ok'),
                     (-7::BIGINT, 1::BIGINT, 'assistant', '\### Assistant: </turn> ok')
"""


@query(
    "op10_prefix_targets",
    rf"""
    WITH plain AS ({_PLAIN}),
    sized AS (SELECT *, length(text) AS n FROM plain)
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(n) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(15 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
               + n + length(regexp_replace(text, '[^\\#<]', '', 'g')))::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one of marks, written as prefix-shared examples and read back."""
    given = read(spark, folder, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    marks = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKS).alias("text"),
    )
    stored = chat.turns(given.union(marks))
    made = parked(chat.examples(stored))
    return chat.digests(chat.read_back(stored, made))


@query(
    "op5_de_bruijn_substrings",
    f"""
    WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
    win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
    hit AS (SELECT doc_id, i FROM win JOIN (SELECT s, min(doc_id) AS f FROM win GROUP BY s) USING (s) WHERE f < doc_id),
    gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, range(50) r(k)),
    each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS left_words, count(*) AS n
             FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(left_words, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
""",
)
def de_bruijn_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of 50-word windows that earlier documents have."""
    return substrings.deduplicated(read(spark, folder, "documents"), text=False)


@query("op2_kmeans_tree_neighbours")
def kmeans_tree_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest other vectors of every hundredth one, among all."""
    return neighbours.neighbours(read(spark, folder, "embeddings"), F.pmod("id", F.lit(100)) == 0)


@query("op9_latent_decontamination")
def latent_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item that leaked into it."""
    return decontamination.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op4_empirical_bayes_quality")
def empirical_bayes_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the classifier keeps, with their posteriors; host is the source, path its language."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return quality.classified(docs, labels, F.col("source"), F.col("lang")).where("keep")


_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    "op11_blocked_multiplication",
    f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS ts FROM documents),
    facts AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
    item AS (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS ts FROM benchmark),
    asked AS (SELECT i, item_id, t, count(*) AS c FROM (SELECT i, item_id, unnest(ts) AS t FROM item) GROUP BY ALL),
    held AS (SELECT r, doc_id, t, n, count(*) AS tf
             FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
    weighed AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, facts GROUP BY t, n_docs),
    scored AS (SELECT i, item_id, r, doc_id,
                      sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
               FROM asked JOIN held USING (t) JOIN weighed USING (t), facts GROUP BY ALL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
    """,
)
def blocked_multiplication(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"), 10)


#: Base 32 of the hexadecimal digits ``h``, five bits at a time.
_BASE32 = """list_aggregate(list_transform(range(0, 160, 5), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((strpos('0123456789abcdef', h[i // 4 + 1]) - 1) * 16
        + coalesce(nullif(strpos('0123456789abcdef', h[i // 4 + 2]), 0), 1) - 1) // (1 << (3 - i % 4)) % 32]), 'string_agg', '')"""


@query(
    "op13_merged_captures",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload, row_number() OVER () AS r FROM pages),
    d AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS h,
                 row_number() OVER (PARTITION BY payload ORDER BY page_id NULLS LAST, r) AS nth,
                 first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id NULLS LAST, r) AS original FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN nth > 1 THEN original END AS refers_to
    FROM d
    """,
)
def merged_captures(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives and read back through the merged index of their captures."""
    place = shared_dir(spark)
    runs = warc.write_archives(warc.captures(read(spark, folder, "pages")), place)
    found = warc.read_archives(warc.merge_runs(spark, runs), place)
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(range(1, length(k) + 1), lambda i: [ord(k[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""
_STEPS = """(VALUES (0, '', 0), (0, 'I', 3), (0, 'II', 2), (1, '', 1), (1, 'I', 3), (1, 'II', 2),
                    (2, '', 2), (2, 'I', 3), (2, 'II', 2), (3, '', 3), (3, 'I', 2), (3, 'II', 3)) step(st, more, mid)"""
_EDITS = """(VALUES (0, 'D', 0), (1, 'D', 1), (2, 'D', 2), (3, 'D', 3), (0, 's', 1), (0, 'u', 3), (1, 'u', 3), (2, 'u', 3), (3, 'a', 2)) edit(mid, made, nxt)"""


@query(
    "op12_target_alignment",
    f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    kinds AS (SELECT *, {_CRC32} % 20 AS kind FROM keyed),
    placed AS (
        SELECT *, left(role, 1) AS letter, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
        FROM (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                     CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0)),
    marked AS (
        SELECT *, CASE WHEN said = '' THEN 1
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                       WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS mark,
               lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter AS pair
        FROM (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM placed)),
    facts AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (WHERE mark = 1) AS blank, count(*) FILTER (WHERE mark = 2) AS duplicate,
               count(*) FILTER (WHERE mark = 3) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM marked GROUP BY conv_id),
    walk(conv_id, i, st, best) AS (
        SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': ''}} FROM facts
        UNION ALL
        SELECT w.conv_id, m.i, edit.nxt, min({{
            'cost': w.best.cost + 2 * length(step.more)
                    + CASE WHEN edit.made = 'D' THEN 3 ELSE (CASE WHEN edit.made = m.letter THEN 0 ELSE 2 END) + (CASE WHEN m.mark = 3 THEN 1 ELSE 0 END) END,
            'audit': w.best.audit || step.more
                    || CASE WHEN edit.made = 'D' THEN 'D' WHEN edit.made = m.letter THEN 'K' ELSE 'R' END}})
        FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1
        JOIN {_STEPS} ON step.st = w.st
        JOIN {_EDITS} ON edit.mid = step.mid
        WHERE edit.made = 'D' OR (m.mark NOT IN (1, 2) AND (edit.made <> 's' OR m.letter = 's'))
        GROUP BY ALL),
    chosen AS (
        SELECT w.conv_id, min({{'cost': w.best.cost + 2 * length(more), 'audit': w.best.audit || more}}) AS best
        FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i
        JOIN (VALUES (0, ''), (1, 'II'), (2, ''), (3, 'I')) fin(st, more) ON fin.st = w.st GROUP BY w.conv_id),
    edits AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS j FROM chosen),
    made AS (
        SELECT *, count(*) FILTER (WHERE op <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
               count(*) FILTER (WHERE op <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS o
        FROM (SELECT conv_id, j, audit[j] AS op FROM edits)),
    turns AS (
        SELECT e.conv_id, e.j, e.op, e.o, m.role, m.text,
               max(CASE WHEN e.o = 1 AND e.op = 'K' AND m.letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
        FROM made e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i AND e.op <> 'I'),
    said AS (
        SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role WHEN (o - 1 - opened) % 2 = 0 THEN 'user' ELSE 'assistant' END
                                   || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS whole
        FROM turns WHERE op <> 'D' GROUP BY conv_id),
    every AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
           coalesce(c.best.cost, 0)::BIGINT AS cost, coalesce(c.best.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM every e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
)
def target_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged by a checksum of their rows' places, and repaired at the least cost."""
    given = read(spark, folder, "conversations")
    return repair.report(given, repair.damaged(given))
