"""Secret scans: fixed patterns, and a battery of randomness tests on other long strings.

The base patterns are taken as they are. Of the other strings of at least ``SHORTEST``
characters an encoding is inferred (hex, base 32, base 36, base 64), and three tests ask
whether its symbols look drawn at random: chi-squared for their uniformity over the alphabet,
the number of runs above and below the middle, and the correlation of neighbours; Fisher's sum
joins their p-values. Random strings have uniform p-values, others pile up near zero.

False discoveries are controlled per encoding and length class, since short strings prove
little: from all distinct candidates of the corpus, twice those above one half are the random
ones expected, and the least threshold is taken at which at most ``RATE`` of the accepted are
not random. A string counts once however often it is copied, as p-values of copies are not
independent; the threshold then holds for each occurrence. It is never so low that less than
``RATE`` random strings of the class are expected below it. Counts of classes and p-value bins
are all that reaches the driver.

A null or empty text has no spans; long texts are read whole; repeated rows give repeated
rows; an empty table gives no rows; other columns of the input are not read.
"""

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import batches, documents, parked

# The base kinds, their patterns and the least sizes of what they must match.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_SIZE, ACCESS_SIZE, HEX_SIZE = 6, 20, 24
BASE = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Characters of a candidate at least; share of accepted strings that may not be random.
SHORTEST, RATE = 20, 0.05
#: Bins of p-values, and upper ends of length classes.
BINS = 200
LENGTHS = (24, 32, 40, 64, 128)

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encoding -> its alphabet; the first that holds a string and of which it has letters and digits is inferred.
ALPHABETS = {
    "hex16": DIGITS + LOWER[:6],
    "HEX16": DIGITS + UPPER[:6],
    "base32": UPPER + DIGITS[2:8],
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
ENCODINGS = tuple(ALPHABETS)
PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}

SPAN = "struct<kind:string,start:long,end:long>"
FOUND = f"doc_id long, base array<{SPAN}>, more array<struct<kind:string,start:long,end:long,class:long,p:double,digest:binary>>"


def encoding_of(text: str) -> str | None:
    """The first encoding that could have made the string; None for words and numbers."""
    letters = set(text)
    if not letters & set(DIGITS) or not letters - set(DIGITS):
        return None
    if letters & set(UPPER) and letters & set(LOWER):
        names = ("base64", "base64url")
    else:
        names = ENCODINGS
    return next((n for n in names if letters <= PLACES[n].keys()), None)


def chi_tail(x: float, degrees: int) -> float:
    """Upper tail of chi-squared, by the cube-root normal approximation for odd degrees and exactly for even ones."""
    if x <= 0:
        return 1.0
    if degrees % 2 == 0:
        term = total = math.exp(-x / 2)
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return min(1.0, total)
    z = ((x / degrees) ** (1 / 3) - 1 + 2 / (9 * degrees)) / math.sqrt(2 / (9 * degrees))
    return normal_tail(z)


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(text: str, encoding: str) -> float:
    """Joint p-value of the battery if the symbols were drawn at random from the alphabet."""
    places = PLACES[encoding]
    x = np.fromiter((places[c] for c in text), float, len(text))
    n, size = len(x), len(places)
    # Classes of equal width with five symbols expected in each, where the length allows.
    classes = int(max(2, min(8, n // 5)))
    counts = np.bincount((x * classes // size).astype(int), minlength=classes)
    symbols = np.bincount((np.arange(size) * classes // size).astype(int), minlength=classes)
    expected = n * symbols / size
    uniform = chi_tail(float(((counts - expected) ** 2 / expected).sum()), classes - 1)
    # Digits and letters by their share of the alphabet: words have hardly a digit.
    digits = sum(c in DIGITS for c in text)
    share = sum(c in DIGITS for c in places) / size
    kinds = 2 * normal_tail(abs(digits - n * share) / math.sqrt(n * share * (1 - share)))
    high = x >= size / 2
    above = int(high.sum())
    below = n - above
    if above and below:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * above * below / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-12))
        order = 2 * normal_tail(abs(runs - mean) / spread)
    else:
        order = 0.0
    centred = x - x.mean()
    power = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    chain = 2 * normal_tail(abs(serial + 1 / n) * math.sqrt(n))
    ps = [max(min(p, 1.0), 1e-300) for p in (min(1.0, 2 * min(uniform, kinds)), order, chain)]
    return chi_tail(-2 * sum(map(math.log, ps)), 2 * len(ps))


def class_of(encoding: str, length: int) -> int:
    return ENCODINGS.index(encoding) * (len(LENGTHS) + 1) + sum(length > end for end in LENGTHS)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base patterns' matches in a whole text, by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_SIZE]
    for word, at in long_words(text):
        if "AKIA" in word:
            found += [("access", at + m.start(), at + m.end()) for m in ACCESS.finditer(word) if len(m[0]) >= ACCESS_SIZE]
        if len(word) >= HEX_SIZE:
            found += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(word) if len(m[0]) >= HEX_SIZE]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0]), s[2]))


def long_words(text: str) -> list[tuple[str, int]]:
    """Words in which an access key, a hex string or a candidate could be, and where they start."""
    out, at = [], 0
    for word in [w for w in text.split() if len(w) >= SHORTEST]:
        at = text.index(word, at)
        out.append((word, at))
        at += len(word)
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Long strings outside the base spans, with their class and joint p-value."""
    out = []
    for word, at in long_words(text):
        for m in _CANDIDATE.finditer(word):
            start, end = at + m.start(), at + m.end()
            if any(s < end and start < e for _, s, e in base):
                continue
            body = m[0].rstrip("=")
            encoding = encoding_of(body)
            if encoding:
                p = randomness(body, encoding)
                out.append({"kind": f"random_{encoding}", "start": start, "end": end, "class": class_of(encoding, len(body)), "p": p, "digest": xxhash.xxh3_128_digest(body.encode())})
    return out


def found(docs: DataFrame) -> DataFrame:
    """Base spans and tested candidates of every document."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        tested = pa.struct([*span, ("class", pa.int64()), ("p", pa.float64()), ("digest", pa.binary())])
        for keys, texts in batches(rows):
            base, more = [], []
            for text in texts:
                text = text.decode()
                own = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in own])
                more.append(candidates(text, own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(base, pa.list_(span)), pa.array(more, pa.list_(tested))],
                ["doc_id", "base", "more"],
            )

    return documents(docs).mapInArrow(run, FOUND)


def thresholds(tested: DataFrame, rate: float = RATE) -> dict[int, float]:
    """Class -> least accepted p-value, from the counts of all distinct candidates by class and bin."""
    # Each task first drops its own copies; what is left is dealt by the digest.
    distinct = tested.select(F.explode("more").alias("c")).select("c.class", "c.p", "c.digest").distinct()
    each = distinct.select("class", F.floor(F.col("p") * BINS).alias("bin"))
    counts: dict[int, np.ndarray] = {}
    for r in each.groupBy("class", F.least("bin", F.lit(BINS - 1)).alias("bin")).count().collect():
        counts.setdefault(r["class"], np.zeros(BINS))[r["bin"]] += r["count"]
    out = {}
    for name, n in counts.items():
        random = 2 * n[BINS // 2 :].sum()
        for i in range(BINS // 2 + 1):
            accepted = n[i:].sum()
            if random and accepted and 1 - random * (1 - i / BINS) / accepted <= rate:
                # Below the last value no random string of the class is expected: where a class passes whole, its plain words still fail.
                out[name] = max(i / BINS, rate / random)
                break
    return out


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id``, ``base`` spans and ``spans``, all spans by start, then kind, of every document."""
    tested = parked(found(docs))
    least = thresholds(tested, rate)
    pairs = [F.lit(x) for item in sorted(least.items()) for x in item]
    accepted = F.create_map(*pairs) if pairs else None
    more = F.col("more") if accepted is not None else F.slice("more", 1, 0)
    if accepted is not None:
        more = F.filter(more, lambda c: c["p"] >= F.coalesce(F.element_at(accepted, c["class"]), F.lit(2.0)))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return tested.select("doc_id", "base", in_order(F.concat("base", bare(more))).alias("spans"))


def in_order(spans: Column) -> Column:
    rank = lambda s: F.coalesce(F.array_position(F.array(*map(F.lit, BASE)), s["kind"]), F.lit(0))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.when(rank(s) > 0, rank(s)).otherwise(len(BASE) + 1).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(scanned: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of base spans, and all spans."""
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE]
    return scanned.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def cleaned(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows, columns as they are, with every span of ``text`` replaced and ``n_chars``, if there, counted anew.

    Rows are cleaned where they are read: the class thresholds come from a first pass over all
    rows, and each row is scanned again with them. A null text stays null.
    """
    least = thresholds(found(docs), rate)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else replaced(t, least) for t in texts], dtype=object)

    changed = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return changed.select(*(F.col(f"`{c}`") for c in docs.columns))


def replaced(text: str, least: dict[int, float]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    base = base_spans(text)
    more = [(c["kind"], c["start"], c["end"]) for c in candidates(text, base) if c["p"] >= least.get(c["class"], 2.0)]
    out, at = [], 0
    for kind, start, end in sorted(base + more, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
