"""Words of a text: tokens, their positions, stems and marked excerpts."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekframe.functions.english import forms_of, stem_column, stem_word

# Fixed values.
LETTER = r"[\p{L}\p{N}]"
NO_WORD = r"[^\p{L}\p{N}]"
WORD = LETTER + "+"
HARD_BREAK = r"[.!?\n]+"
BREAK_GAP = 8
MARK_START = "<mark>"
MARK_END = "</mark>"
AFFIX_WORDS = 4
SNIPPET_WORDS = 30
# English words too common to search for: the short list that search libraries have long shared.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()


@dataclass(frozen=True)
class Stemmer:
    """The stem of a column of words, of one word, and all words of a stem."""

    column: Callable[[Column], Column]
    word: Callable[[str], str]
    forms: Callable[[str], Sequence[str]]


@dataclass(frozen=True)
class Analyzer:
    """How a language's words become terms: words to drop, and endings of which the first that fits is replaced.

    Words shorter than ``least`` letters stay as they are. A ``stemmer`` takes the place of endings.
    """

    stops: tuple[str, ...] = ()
    endings: tuple[tuple[str, str], ...] = ()
    least: int = 5
    stemmer: Stemmer | None = None


# The most frequent articles and prepositions, and the common endings of number, gender and case.
ANALYZERS: dict[str, Analyzer] = {
    "simple": Analyzer(),
    "english": Analyzer(tuple(STOP_WORDS), stemmer=Stemmer(stem_column, stem_word, forms_of)),
    "german": Analyzer(
        tuple("der die das den dem des ein eine einen einem einer und oder in im an am auf mit von zu zum ist nicht".split()),
        (("ungen", "ung"), ("heiten", "heit"), ("keiten", "keit"), ("ern", ""), ("en", ""), ("em", ""), ("er", ""),
         ("es", ""), ("e", ""), ("ss", "ss"), ("s", "")),
    ),
    "spanish": Analyzer(
        tuple("el la los las un una unos unas y o de del en a al con por para que es no se".split()),
        (("ciones", "ción"), ("mente", ""), ("as", ""), ("os", ""), ("es", ""), ("a", ""), ("o", ""), ("e", ""), ("s", "")),
    ),
    "french": Analyzer(
        tuple("le la les l un une des du de d et ou en à au aux dans par pour que qui est ne pas sur".split()),
        (("eaux", "eau"), ("aux", "al"), ("es", ""), ("e", ""), ("ss", "ss"), ("s", ""), ("x", "")),
    ),
}


def register_analyzer(language: str, analyzer: Analyzer) -> None:
    """Add a language, for scans and indexes alike."""
    ANALYZERS[language] = analyzer


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it many times inside ``fn``.

    A lambda argument is bound to its value; a projected column may be inlined
    again by the optimizer at every use, which is costly for token arrays.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def check_language(language: str) -> None:
    if language not in ANALYZERS:
        raise ValueError(f"unknown language {language!r}; use one of {tuple(ANALYZERS)}")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def stem(word: Column, language: str) -> Column:
    """The term of a word: its ending replaced by the language's rules."""
    rules = ANALYZERS[language]
    if rules.stemmer is not None:
        return rules.stemmer.column(word)
    if not rules.endings:
        return word
    result = F.when(F.length(word) < rules.least, word)
    for ending, left in rules.endings:
        cut = F.substring(word, F.lit(1), F.length(word) - len(ending))
        result = result.when(word.endswith(ending), word if ending == left else F.concat(cut, F.lit(left)))
    return result.otherwise(word)


def stem_literal(word: str, language: str) -> str:
    """The same rules for a word of the search string."""
    rules = ANALYZERS[language]
    if rules.stemmer is not None:
        return rules.stemmer.word(word)
    if len(word) >= rules.least:
        for ending, left in rules.endings:
            if word.endswith(ending):
                return word[: -len(ending)] + left
    return word


def is_stop_word(word: Column, language: str) -> Column:
    stops = ANALYZERS[language].stops
    return word.isin(*stops) if stops else F.lit(False)


def tokens(text: Column, language: str = "simple") -> Column:
    """Search terms of a text, in order, stop words dropped."""
    check_language(language)
    found = words(text)
    if language == "simple":
        return found
    kept = F.filter(found, lambda w: ~is_stop_word(w, language))
    return F.transform(kept, lambda w: stem(w, language))


def placed_tokens(text: Column, language: str = "simple", field: str | None = None) -> Column:
    """array<struct<term, pos, rank_pos>>, with ``field`` after the term when given.

    ``pos`` counts words; ``rank_pos`` adds a gap for every sentence break that
    comes before the word, so a word after a break ranks below one before it.
    """
    check_language(language)
    by_sentence = F.transform(
        F.split(F.coalesce(text, F.lit("")), HARD_BREAK),
        lambda s, i: F.transform(words(s), lambda w: F.struct(w.alias("term"), i.alias("brk"))),
    )
    named = [] if field is None else [F.lit(field).alias("field")]

    def place(t: Column, i: Column) -> Column:
        rank = i + F.lit(BREAK_GAP) * t["brk"]
        return F.struct(
            t["term"].alias("term"), *named, i.cast("int").alias("pos"), rank.cast("int").alias("rank_pos")
        )

    placed = F.transform(F.flatten(by_sentence), place)
    if language == "simple":
        return placed
    kept = F.filter(placed, lambda t: ~is_stop_word(t["term"], language))
    return F.transform(
        kept,
        lambda t: F.struct(
            stem(t["term"], language).alias("term"),
            *named,
            t["pos"].alias("pos"),
            t["rank_pos"].alias("rank_pos"),
        ),
    )


def query_words(query: str) -> list[str]:
    """Words of a search string, cut as ``words`` cuts a text."""
    return re.findall(r"[^\W_]+", query.lower())


def query_terms(query: str, language: str = "simple") -> list[tuple[str, int]]:
    """Terms of a search string with their places, stop words dropped."""
    check_language(language)
    stops = ANALYZERS[language].stops
    return [(stem_literal(w, language), i) for i, w in enumerate(query_words(query)) if w not in stops]


def word_forms(term: str, language: str) -> list[str]:
    """Every word whose stem is ``term``."""
    if (stemmer := ANALYZERS[language].stemmer) is not None:
        return list(stemmer.forms(term))
    endings = [(e, left) for e, left in ANALYZERS[language].endings if term.endswith(left)]
    forms = [term, *(term[: len(term) - len(left)] + e for e, left in endings)]
    return [w for w in dict.fromkeys(forms) if stem_literal(w, language) == term]


def stem_root(term: str, language: str) -> str:
    """The part all forms of a term share."""
    return os.path.commonprefix(word_forms(term, language)) or term


def _whole_word(forms: Sequence[str]) -> str:
    """One of some words. The letters come first and the look around them last, so
    that most places in a text fail at their first letter."""
    # What all forms begin with is looked for once.
    root = os.path.commonprefix(list(forms))
    rest = sorted((w[len(root) :] for w in forms), key=lambda w: (-len(w), w))
    body = re.escape(root) + ("(?:" + "|".join(map(re.escape, rest)) + ")" if len(forms) > 1 else "")
    return rf"{body}(?!{LETTER})(?<!{LETTER}{body})"


def phrase_pattern(phrase: Sequence[tuple[str, int]], language: str) -> str:
    """Regular expression of terms at given places, for a lower-case text.

    Words between two terms that are too common to count still take their place.
    """
    parts = []
    for i, (term, place) in enumerate(phrase):
        if i:
            parts.append(NO_WORD + "+" + f"(?:{WORD}{NO_WORD}+)" * (place - phrase[i - 1][1] - 1))
        parts.append(_whole_word(word_forms(term, language)))
    return "".join(parts)


def any_word(words: Sequence[str]) -> str:
    """Regular expression of one of some words, as a whole word of a lower-case text."""
    return _whole_word(sorted(words))


def any_pattern(terms: Sequence[str], language: str) -> str:
    """Regular expression of a text that has any of the terms."""
    return _whole_word(sorted({w for t in terms for w in word_forms(t, language)}))


def text_before(text: Column, pattern: str) -> Column:
    """The part of a text before the first match of a pattern; null without one."""
    head = F.regexp_extract(text, rf"(?s)^(.*?){pattern}", 1)
    return F.when(text.rlike(pattern), head)


def highlight(text: Column, terms: Sequence[str], prefix: bool = False) -> Column:
    """Mark the terms; a text over 30 words shrinks to the first marked word and
    four words on either side. Meant for the rows of one page."""
    if not terms:
        return text
    forms = sorted({t.lower() for t in terms}, key=lambda t: (-len(t), t))
    body = "(?:" + "|".join(re.escape(t) for t in forms) + ")"
    ending = f"{LETTER}*" if prefix else f"(?!{LETTER})"
    # The look at the letter before comes after the word, as in whole-word tests.
    pattern = rf"(?iu:{body}(?<!{LETTER}{body}){ending})"

    def excerpt(line: Column) -> Column:
        ws = F.split(line, " ")
        hit = F.size(F.split(text_before(line, pattern), " "))
        start = F.greatest(hit - AFFIX_WORDS, F.lit(1))
        near = F.array_join(F.slice(ws, start, hit - start + 1 + AFFIX_WORDS), " ")
        return F.when((F.size(ws) > SNIPPET_WORDS) & line.rlike(pattern), near).otherwise(line)

    short = let(F.trim(F.regexp_replace(text, r"\s+", " ")), excerpt)
    return F.regexp_replace(short, pattern, rf"{MARK_START}$0{MARK_END}")
