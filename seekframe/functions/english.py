"""English stems by measured suffix steps, as a column and for single words.

A step replaces the longest of its suffixes that a word has, if what is left of the
word meets the suffix's condition; no shorter one is tried. ``m`` counts the runs of
vowels that a consonant follows; a ``y`` is a vowel behind a letter other than a
vowel. Both forms, and the SQL of the suite, read the same table of steps.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plurals, past and progressive forms, and common derivations after the suffix
# steps that Porter published in 1980: suffix, what takes its place, and its condition.
# "v": a vowel is left; "1", "2": m is at least that.
STEPS: tuple[tuple[tuple[str, str, str], ...], ...] = (
    (("sses", "ss", ""), ("ies", "i", ""), ("ss", "ss", ""), ("us", "us", ""), ("s", "", "")),
    (("eed", "ee", "1"), ("ing", "", "v"), ("ed", "", "v")),
    (("y", "i", "v"),),
    (
        ("ational", "ate", "1"), ("ization", "ize", "1"), ("iveness", "ive", "1"), ("fulness", "ful", "1"), ("ousness", "ous", "1"),
        ("tional", "tion", "1"), ("biliti", "ble", "1"), ("iviti", "ive", "1"), ("aliti", "al", "1"), ("ation", "ate", "1"),
        ("alism", "al", "1"), ("ousli", "ous", "1"), ("entli", "ent", "1"), ("ement", "", "2"), ("ator", "ate", "1"), ("izer", "ize", "1"),
        ("ment", "", "2"), ("ness", "", "1"), ("able", "", "2"), ("ible", "", "2"), ("alli", "al", "1"), ("abli", "able", "1"),
        ("ful", "", "1"), ("li", "", "1"),
    ),
)
#: The step whose removals are tidied: an e is put back, or a doubled consonant becomes one.
TIDIED = 1
PUT_BACK = ("at", "bl", "iz")
LEAST = 3

VOWEL_Y = "([^aeiou])y"
RUN = "[aeiouY]+[^aeiouY]"
VOWEL = "[aeiouY]"
SHORT = "[^aeiouY][aeiouY][^aeiouYwxy]$"
DOUBLE_KEPT = "aeioulsz"


# ---- single words -------------------------------------------------------------


def _marked(word: str) -> str:
    return re.sub(VOWEL_Y, r"\1Y", word)


def _measure(word: str) -> int:
    return len(re.findall(RUN, _marked(word)))


def _meets(left: str, need: str) -> bool:
    return not need or (re.search(VOWEL, _marked(left)) is not None if need == "v" else _measure(left) >= int(need))


def _tidy(word: str) -> str:
    if word.endswith(PUT_BACK):
        return word + "e"
    if len(word) > 1 and word[-1] == word[-2] and word[-1] not in DOUBLE_KEPT:
        return word[:-1]
    return word + "e" if _measure(word) == 1 and re.search(SHORT, _marked(word)) else word


def _step(word: str, number: int) -> str:
    for suffix, left, need in STEPS[number]:
        if word.endswith(suffix):
            kept = word[: len(word) - len(suffix)]
            if not _meets(kept, need):
                return word
            return _tidy(kept) if number == TIDIED and not left else kept + left
    return word


def _without_e(word: str) -> str:
    if not word.endswith("e"):
        return word
    m = _measure(word[:-1])
    return word[:-1] if m > 1 or (m == 1 and not re.search(SHORT, _marked(word[:-1]))) else word


@lru_cache(maxsize=100_000)
def stem_word(word: str) -> str:
    if len(word) < LEAST:
        return word
    for number in range(len(STEPS)):
        word = _step(word, number)
    return _without_e(word)


@lru_cache(maxsize=1_000)
def forms_of(term: str) -> tuple[str, ...]:
    """Every word whose stem is ``term``: the steps undone one after another, and each word that comes out tried."""
    found = {term, term + "e"}
    for number in range(len(STEPS) - 1, -1, -1):
        undone = set()
        for word in found:
            for suffix, left, _ in STEPS[number]:
                if not word.endswith(left):
                    continue
                kept = word[: len(word) - len(left)]
                undone.add(kept + suffix)
                if number == TIDIED and not left:
                    undone |= {x + suffix for x in (kept[:-1] if kept.endswith("e") else kept, kept + kept[-1:])}
        found |= {w for w in undone if _step(w, number) in found}
    return tuple(sorted(w for w in found if stem_word(w) == term))


# ---- columns --------------------------------------------------------------------


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _marked_column(word: Column) -> Column:
    return F.regexp_replace(word, VOWEL_Y, "$1Y")


def _measure_column(word: Column) -> Column:
    return F.regexp_count(_marked_column(word), F.lit(RUN))


def _meets_column(left: Column, need: str) -> Column:
    if not need:
        return F.lit(True)
    return _marked_column(left).rlike(VOWEL) if need == "v" else _measure_column(left) >= int(need)


def _tidy_column(word: Column) -> Column:
    last = F.right(word, F.lit(1))
    double = (F.length(word) > 1) & (last == F.substring(word, F.length(word) - 1, F.lit(1))) & ~last.isin(*DOUBLE_KEPT)
    back = word.endswith(PUT_BACK[0])
    for ending in PUT_BACK[1:]:
        back = back | word.endswith(ending)
    shorter = F.substring(word, F.lit(1), F.length(word) - 1)
    short = (_measure_column(word) == 1) & _marked_column(word).rlike(SHORT)
    return F.when(back, F.concat(word, F.lit("e"))).when(double, shorter).when(short, F.concat(word, F.lit("e"))).otherwise(word)


def _replacing(left: str, need: str, tidied: bool) -> Callable[[Column], Column]:
    """What becomes of a word's rest; null if the rest does not meet the condition."""
    return lambda kept: F.when(_meets_column(kept, need), _tidy_column(kept) if tidied else F.concat(kept, F.lit(left)))


def _step_column(word: Column, number: int) -> Column:
    # Rules by the suffix's last letter first, so that most words fail at one comparison.
    by_last: dict[str, list] = {}
    for rule in STEPS[number]:
        by_last.setdefault(rule[0][-1], []).append(rule)
    out = None
    for last, rules in by_last.items():
        own = None
        for suffix, left, need in rules:
            kept = F.substring(word, F.lit(1), F.length(word) - len(suffix))
            value = F.coalesce(_let(kept, _replacing(left, need, number == TIDIED and not left)), word)
            hit = word.endswith(suffix)
            own = F.when(hit, value) if own is None else own.when(hit, value)
        hit = word.endswith(last)
        out = F.when(hit, own.otherwise(word)) if out is None else out.when(hit, own.otherwise(word))
    return out.otherwise(word)


def _stepping(number: int) -> Callable[[Column], Column]:
    return lambda word: _step_column(word, number)


def _without_e_column(word: Column) -> Column:
    def shorter(kept: Column) -> Column:
        m = _measure_column(kept)
        return F.when((m > 1) | ((m == 1) & ~_marked_column(kept).rlike(SHORT)), kept)

    kept = F.substring(word, F.lit(1), F.length(word) - 1)
    return F.when(word.endswith("e"), F.coalesce(_let(kept, shorter), word)).otherwise(word)


def stem_column(word: Column) -> Column:
    """The stem of a word; ``word`` is best the argument of a lambda, as it is used often."""
    made = word
    for number in range(len(STEPS)):
        made = _let(made, _stepping(number))
    return F.when(F.length(word) < LEAST, word).otherwise(_let(made, _without_e_column))
