"""Words, stems, rendering and full text against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from seekframe import SearchSpec, search
from seekframe.functions.render import render_text
from seekframe.functions.text import (
    BREAK_GAP,
    STOP_WORDS,
    highlight,
    placed_tokens,
    query_terms,
    stem,
    stem_literal,
    tokens,
    word_forms,
)
from seekframe.operators.match import parse_web
from seekframe.operators.rank import scan_scores

TEXTS = [
    "The Cats sat. On the mat!",
    "Été à la plage; naïve café_au-lait 42x",
    "cities and city, class classes bus buses",
    "",
    None,
    "lord of the rings.\nLord xx yy ring",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id INT, text STRING")


def py_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.mark.parametrize("language", ["simple", "english"])
def test_tokens(texts, language):
    got = {r["id"]: r["t"] for r in texts.select("id", tokens(F.col("text"), language).alias("t")).collect()}
    stops = STOP_WORDS if language == "english" else ()
    for i, text in enumerate(TEXTS):
        want = [stem_literal(w, language) for w in py_words(text) if w not in stops]
        assert (got[i] or []) == want


def test_places_and_breaks(texts):
    row = texts.where("id = 0").select(placed_tokens(F.col("text"), "english").alias("p")).first()["p"]
    assert [(p["term"], p["pos"], p["rank_pos"]) for p in row] == [
        ("cat", 1, 1), ("sat", 2, 2), ("mat", 5, 5 + BREAK_GAP),
    ]
    assert texts.where("id = 4").select(placed_tokens(F.col("text")).alias("p")).first()["p"] == []


def test_word_forms_invert_the_stemmer():
    words = ["city", "cities", "cat", "cats", "bus", "class", "tie", "ties", "as", "yes", "shoes", "status", "dies"]
    for w in words:
        assert w in word_forms(stem_literal(w, "english"), "english")


STEMMED = {
    "running": "run", "hoped": "hope", "hopping": "hop", "agreed": "agre", "feed": "feed", "ring": "ring", "ponies": "poni", "caresses": "caress",
    "relational": "relat", "relate": "relat", "conditional": "condition", "happily": "happi", "happy": "happi", "quickly": "quick",
    "organization": "organiz", "organizer": "organiz", "government": "govern", "toys": "toi", "bus": "bus", "yes": "ye", "by": "by",
}


def test_english_stems(spark):
    """The column, the single word and the forms of a stem agree, on known words and on made-up ones."""
    chance = random.Random(5)
    ends = ["", "s", "ed", "ing", "ly", "ational", "ization", "ness", "ful", "able", "ies", "ement", "e", "y", "ee", "yy"]
    made = {"".join(chance.choice("aeioubcdlsty") for _ in range(chance.randint(1, 6))) + chance.choice(ends) for _ in range(1500)}
    words = sorted({*STEMMED, *made, "été", "naïvely", "x1s", "日本s", ""})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["t"] for r in df.select("w", F.get(F.transform(F.array("w"), lambda w: stem(w, "english")), F.lit(0)).alias("t")).collect()}
    assert got == {w: stem_literal(w, "english") for w in words}
    assert {w: got[w] for w in STEMMED} == STEMMED
    assert all(w in word_forms(got[w], "english") for w in words[::7] if w)


def test_unknown_language(texts):
    with pytest.raises(ValueError):
        texts.select(tokens(F.col("text"), "klingon"))


def test_parse_web():
    assert parse_web('cat "big dog" -bird or fish -"x y"', "simple") == [
        [(False, [("cat", 0)]), (False, [("big", 0), ("dog", 1)]), (True, [("bird", 0)])],
        [(False, [("fish", 0)]), (True, [("x", 0), ("y", 1)])],
    ]


def _brute(words, query, mode, language):
    """Positions of query terms in a list of stemmed words."""
    terms = query_terms(query, language)
    if not terms:
        return False
    if mode == "plain":
        return all(t in words for t, _ in terms)
    if mode == "natural":
        return any(t in words for t, _ in terms)
    first = terms[0][1]
    return any(
        all(i + p - first < len(words) and words[i + p - first] == t for t, p in terms) for i in range(len(words))
    )


@pytest.mark.parametrize("language", ["simple", "english"])
@pytest.mark.parametrize("mode", ["plain", "natural", "phrase"])
def test_full_text_against_brute_force(spark, mode, language):
    chance = random.Random(7)
    vocabulary = ["cat", "cats", "Dog", "rest", "Resting", "rested", "restful", "the", "of", "city", "Cities", "x1", "été", "ca"]
    glue = [" ", ", ", "-", ". ", "\n", "_"]
    data = []
    for i in range(300):
        text = "".join(chance.choice(vocabulary) + chance.choice(glue) for _ in range(chance.randint(0, 9)))
        data.append((i, text))
    df = spark.createDataFrame(data, "id INT, text STRING").cache()
    spec = SearchSpec("d", "id", ["text"], fulltext=["text"], mode=mode, language=language)
    for query in ["cat dog", "the city", "cats of the dog", "Été", "ca", "x1 cat cat", "of", "city-cats", "resting", "rests cat"]:
        got = {r["id"] for r in search(df, spec, query).order_by("id").get().collect()}
        want = {i for i, t in data if _brute([stem_literal(w, language) for w in py_words(t)], query, mode, language)}
        assert got == want, (query, mode, language)


def test_scores_against_plain_python(spark):
    import math

    data = [(1, "a b a c"), (2, "b b"), (3, "c"), (4, "a a a a a a b d e f")]
    df = spark.createDataFrame(data, "id INT, text STRING")
    got = {r["id"]: r["_score"] for r in scan_scores(df, df, F.col("text"), ["a", "b"], "simple").collect()}
    cut = {i: t.split() for i, t in data}
    mean = sum(map(len, cut.values())) / 4
    for i, words in cut.items():
        want = 0.0
        for term in ("a", "b"):
            tf = words.count(term)
            df_ = sum(term in w for w in cut.values())
            if tf:
                want += math.log(1 + (4 - df_ + 0.5) / (df_ + 0.5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(words) / mean)
                )
        assert got[i] == pytest.approx(want, abs=1e-12)


def test_highlight(spark):
    def marked(text, terms, prefix=False):
        return spark.range(1).select(highlight(F.lit(text), terms, prefix).alias("h")).first()["h"]

    assert marked("The cat, the CAT and catalog", ["cat"]) == "The <mark>cat</mark>, the <mark>CAT</mark> and catalog"
    assert marked("a catalog", ["cat"], True) == "a <mark>catalog</mark>"
    long = " ".join(f"w{i}" for i in range(20)) + " cat " + " ".join(f"v{i}" for i in range(20))
    assert marked(long, ["cat"]) == "w16 w17 w18 w19 <mark>cat</mark> v0 v1 v2 v3"
    assert marked("nothing here", []) == "nothing here"


def test_rendering(spark):
    df = spark.sql(
        """SELECT true AS t, false AS f, 1.0D AS whole, 0.1D + 0.2D AS sum, 1e25D AS big, 1.5e-7D AS small, -0.5D AS neg,
           123456.789D AS plain, CAST(1.5 AS FLOAT) AS single, CAST(NULL AS STRING) AS missing, 12L AS long,
           DATE '2020-02-03' AS day, array('a', 'é/') AS list, CAST(0 AS DOUBLE) AS zero, CAST('NaN' AS DOUBLE) AS nan"""
    )
    shown = df.select(*[render_text(F.col(f.name), f.dataType, True).alias(f.name) for f in df.schema]).first().asDict()
    assert shown == {
        "t": "1", "f": "", "whole": "1", "sum": "0.3", "big": "1.0E+25", "small": "1.5E-7", "neg": "-0.5",
        "plain": "123456.789", "single": "1.5", "missing": "null", "long": "12", "day": '"2020-02-03"',
        "list": '["a","é/"]', "zero": "0", "nan": "NAN",
    }
