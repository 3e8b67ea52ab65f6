"""Documents -> postings: which term stands where in which document.

A document is a row, so all of its terms are sorted and run-length grouped inside
the row by array functions, once, when it is written. Postings are these runs,
exploded; the one exchange of an index build lays them out by term range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.text import let, placed_tokens

LENGTH, RUNS, ORDINAL, SOURCE = "__len", "__runs", "__ord", "__src"
#: Stored values of declared fields, beside the postings.
STORED = "_f_"
RUN = "term string, field string, tf int, positions array<int>, first_rank int, lead boolean"
#: A posting on its way: the columns of its document, and its places and term as one text.
DOCUMENT, WORD = "__doc", "__word"


def bucket_of(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def _sorted_places(fields: Sequence[str], language: str) -> Column:
    per_field = [placed_tokens(F.col(name).cast("string"), language, name) for name in fields]
    return F.sort_array(F.concat(*per_field))


def _runs(places: Column) -> Column:
    """Sorted places -> one struct per (term, field)."""

    def before(i: Column) -> Column:
        return F.get(places, F.greatest(i - 1, F.lit(0)))

    def starts_run(i: Column) -> Column:
        here = F.get(places, i)
        return (i == 0) | (here["term"] != before(i)["term"]) | (here["field"] != before(i)["field"])

    def posting(start: Column, end: Column) -> Column:
        first = F.get(places, start)
        return F.struct(
            first["term"].alias("term"),
            first["field"].alias("field"),
            (end - start).cast("int").alias("tf"),
            F.transform(F.slice(places, start + 1, end - start), lambda p: p["pos"]).alias("positions"),
            first["rank_pos"].alias("first_rank"),
            # True on one posting per (term, document): counting it counts documents.
            ((start == 0) | (first["term"] != before(start)["term"])).alias("lead"),
        )

    size = F.size(places)
    begins = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), starts_run)).otherwise(
        F.array().cast("array<int>")
    )
    return let(
        begins, lambda b: F.zip_with(b, F.concat(F.slice(b, F.lit(2), F.size(b)), F.array(size)), posting)
    )


def document_runs(fields: Sequence[str], language: str) -> Column:
    """The postings of a document, one for each term and field."""
    if not fields:
        return F.lit(None).cast(f"array<struct<{RUN.replace(' ', ':').replace(',:', ',')}>>")
    return let(_sorted_places(fields, language), _runs)


def run_length(runs: Column) -> Column:
    """Words of a document, from its runs."""
    return F.aggregate(F.coalesce(runs["tf"], F.array().cast("array<int>")), F.lit(0), lambda n, tf: n + tf)


def build_postings(docs: DataFrame, key: str, flag: Column, stored: Sequence[str]) -> DataFrame:
    """term, key, field, tf, positions, first_rank, lead, len, gone, src, ord and the stored fields."""
    own = [F.col(f).alias(STORED + f) for f in stored]
    return docs.select(
        F.col(key).alias("key"),
        F.col(LENGTH).alias("len"),
        flag.cast("int").alias("gone"),
        F.col(SOURCE).alias("src"),
        F.col(ORDINAL).alias("ord"),
        *own,
        F.explode(RUNS).alias("p"),
    ).select("p.*", "key", "len", "gone", "src", "ord", *[STORED + f for f in stored])


def packed(postings: DataFrame) -> DataFrame:
    """Postings as an exchange moves them.

    What a posting has of its document comes first and together, so rows of one document that follow
    each other repeat it byte by byte; in a text a number is as long as its digits, not eight bytes.
    """
    moved = ("ord", "term", "positions", "first_rank", "field", "lead")
    # The first rank as its distance from the first place: sentence breaks before it alone.
    numbers = F.concat(F.array(F.col("first_rank") - F.get("positions", F.lit(0))), F.col("positions"))
    word = F.concat(F.concat_ws(",", numbers.cast("array<string>")), F.lit(" "), F.col("term"))
    own = F.struct(*[c for c in postings.columns if c not in moved]).alias(DOCUMENT)
    return postings.select("ord", own, *[c for c in ("field", "lead") if c in postings.columns], word.alias(WORD))


def packed_term() -> Column:
    """The term of a packed posting: all behind the first space."""
    word = F.col(WORD)
    return word.substr(F.instr(word, " ") + 1, F.length(word))


def unpacked(moved: DataFrame) -> DataFrame:
    """What ``packed`` was given; a posting without a term has neither places nor rank."""
    numbers = F.split(F.substring_index(WORD, " ", 1), ",").cast("array<int>")
    return moved.select(
        packed_term().alias("term"),
        F.slice(numbers, F.lit(2), F.size(numbers) - 1).alias("positions"),
        (F.get(numbers, F.lit(0)) + F.get(numbers, F.lit(1))).alias("first_rank"),
        f"{DOCUMENT}.*",
        *[c for c in moved.columns if c not in (DOCUMENT, WORD)],
    )
