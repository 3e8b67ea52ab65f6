"""Quality classifier by hierarchical empirical Bayes.

Two heads, low quality and toxic. A logistic regression on shape (repeats, capitals, signs,
tables) and on whole words, beginnings and ends of words gives a document's evidence, a
log-likelihood ratio. Grouped aggregation gives each host's and path's count of documents and
expected number of bad ones over the whole corpus; a host's rate is shrunk toward the global
one and a path's toward its host's, by strengths that the spread between sites gives. A
document's posterior is its evidence on its path's rate, taken without the document itself, and
documents with either posterior at one half or more are rejected.

Each head's word features and regression come from at most about ``LABELLED`` documents with
its label, chosen by a hash of their id; everything else covers all documents.

A null or empty text has shape zero and no words, and the evidence that follows; a null host or
path is a site of its own; several labels of a document count as the worst; null labels are not
used, and a document with one label counts for that head alone; a head without good or without
bad labels has no evidence and rejects nothing of its own; very long texts are read whole; repeated rows are scored each; an empty table gives no rows; further
columns are kept, whatever their names, by ``kept`` and not read otherwise.
"""

import bisect
import functools
import math
import operator
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import batches, forgetting, parked

#: Labelled documents that a head is fitted on at most.
LABELLED = 20_000
#: Word features of a head at most, least bad documents and log-likelihood gain of one, bins of a shape.
FEATURES, LEAST, SIGNIFICANT, BINS = 2048, 4, 13.0, 8
#: Each feature of a word starts with this share of its log-odds: few of a word's features are found alone.
SHARED = 3
HEADS = ("low", "toxic")
#: Words whose features a worker remembers.
KEPT = 60_000

_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.compile(r"[*%$&#@~^]{2,}|!!")
SHAPES = ("repeats", "capitals", "other", "bars", "signs", "same")
#: Words added to a text's count, so that shares of short texts stay low.
CALM = 10


def shape(text: str) -> list[float]:
    """What a text looks like, as shares of its words."""
    words = text.split()
    n = len(words) + CALM
    return [
        sum(map(operator.eq, words[1:], words)) / n,
        sum(map(str.isupper, words)) / n,
        (len(words) - sum(map(str.isalpha, words))) / n,
        words.count("|") / n,
        len(_SIGNS.findall(text)) / n,
        (len(words) - len(set(words))) / n / math.log(n),
    ]


def parts(word: str) -> list[str]:
    """A word, its beginnings and ends: features by which inflected forms are known."""
    n = len(word)
    return [
        "=" + word,
        *("<" + word[:i] for i in range(4, min(7, n + 1))),
        *(">" + word[-i:] for i in range(4, min(7, n + 1))),
    ]


@dataclass
class Head:
    """Bias, weight of each shape's bins, and of word features; ``prior`` is the global rate's logit.

    A head that was not fitted takes bad documents for rare and has no evidence.
    """

    prior: float = -10.0
    bias: float = -10.0
    shapes: np.ndarray = field(default_factory=lambda: np.zeros((len(SHAPES), BINS + 1)))
    words: dict[str, float] = field(default_factory=dict)


class Chosen:
    """Finds which of some word features a text has; most words fail at their first or last letters."""

    def __init__(self, features: Iterable[str]):
        self.features = frozenset(features)
        self.starts = {f[1:5] for f in self.features if f[0] in "<="}
        self.ends = {f[-4:] for f in self.features if f[0] == ">"}

    def of(self, text: str) -> set[str]:
        starts, ends = self.starts, self.ends
        some = [w for w in set(_WORD.findall(text.lower())) if w[:4] in starts or w[-4:] in ends]
        return self.features.intersection([p for w in some for p in parts(w)])


@dataclass
class Model:
    heads: dict[str, Head]
    edges: np.ndarray

    @functools.cached_property
    def chosen(self) -> Chosen:
        return Chosen(f for head in self.heads.values() for f in head.words)

    def __getstate__(self):
        return {"heads": self.heads, "edges": self.edges}

    def evidence(self, text: str) -> list[float]:
        """Log-likelihood ratio of each head."""
        bins = [bisect.bisect_right(e, x) for e, x in zip(self.edges, shape(text))]
        found = self.chosen.of(text)
        out = []
        for head in self.heads.values():
            total = head.bias + sum(float(w[b]) for w, b in zip(head.shapes, bins))
            out.append(total + sum(head.words.get(f, 0.0) for f in found) - head.prior)
        return out


def binned(shapes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, column, "right") for e, column in zip(edges, shapes.T)], axis=1)


def regression(
    rows: list[np.ndarray], start: np.ndarray, y: np.ndarray, rounds: int = 800, ridge: float = 0.05
) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on rows of present features, drawn toward ``start``."""
    size = len(start)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    own = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, first, second = np.r_[start, 0.0], np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for i in range(1, rounds + 1):
        z = np.bincount(own, w[flat], len(rows)) + w[-1]
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        slope = np.r_[np.bincount(flat, gap[own], size) + ridge * (w[:-1] - start), gap.sum()] / len(y)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.1 * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    return w


def _labelled(labels: DataFrame) -> DataFrame:
    """A document's bad labels: ``low`` and ``toxic``, 1, 0 or null."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (1 - F.min(F.col("quality").cast("int"))).alias("low"), F.max(F.col("toxic").cast("int")).alias("toxic")
    )


class _Parts(dict):
    """Word -> its features, kept by a worker."""

    def __missing__(self, word: str) -> list[str]:
        if len(self) >= KEPT:
            self.clear()
        found = self[word] = parts(word)
        return found


@functools.cache
def _parts() -> _Parts:
    return _Parts()


def features_of(text: str) -> set[str]:
    """All word features of a text."""
    return set().union(*map(_parts().__getitem__, set(_WORD.findall(text.lower()))))


#: Features that a task counts before it hands its counts on.
COUNTED = 400_000


def _feature_counts(sample: DataFrame) -> DataFrame:
    """``feature``, and of each head in how many documents with its label it is (``n_``), and in how many bad ones (``bad_``)."""
    names = ["feature", *(f"{c}_{h}" for h in HEADS for c in ("n", "bad"))]
    # Documents with all labels are counted once for all heads.
    kept = ["all", *names[1:]]

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        seen = list(set().union(*counts.values()))
        columns = [pa.array(seen, pa.string())]
        for c in names[1:]:
            shared = counts["all"] if c.startswith("n_") else {}
            columns.append(pa.array([counts[c].get(f, 0) + shared.get(f, 0) for f in seen], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names)

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {c: Counter() for c in kept}
        for batch in found:
            flags = [batch.column(h).to_pylist() for h in HEADS]
            for _, texts in batches([batch]):
                for text, *own in zip(texts, *flags):
                    seen = features_of(text.decode())
                    if None not in own:
                        counts["all"].update(seen)
                    for h, flag in zip(HEADS, own):
                        if flag is not None and None in own:
                            counts[f"n_{h}"].update(seen)
                        if flag:
                            counts[f"bad_{h}"].update(seen)
            if sum(len(counts[c]) for c in kept if not c.startswith("bad_")) > COUNTED:
                yield rows(counts)
                counts = {c: Counter() for c in kept}
        yield rows(counts)

    kind = "feature string, " + ", ".join(f"{c} long" for c in names[1:])
    return sample.mapInArrow(forgetting(run, _parts), kind).groupBy("feature").agg(*(F.sum(c).alias(c) for c in names[1:]))


def _significant(counts: DataFrame, head: str, n: int, bad: int) -> dict[str, float]:
    """Word features that bad documents have far more often than chance, and their log-odds."""
    each = counts.select("feature", F.col(f"n_{head}").alias("n"), F.col(f"bad_{head}").alias("bad"))
    each = each.where(F.col("bad") >= LEAST)
    share, own = bad / n, F.col("bad") / F.col("n")
    good = F.col("n") - F.col("bad")
    gain = F.col("bad") * F.log(own / share) + F.when(good > 0, good * F.log((1 - own) / (1 - share))).otherwise(0.0)
    some = each.where(own > share).withColumn("gain", gain).where(F.col("gain") >= SIGNIFICANT)
    odds = F.log((F.col("bad") + 0.5) / (bad + 1) / ((good + 0.5) / (n - bad + 1)))
    best = some.orderBy(F.desc("gain"), "feature").limit(FEATURES).select("feature", odds.alias("odds"))
    return {r["feature"]: r["odds"] for r in best.collect()}


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", labelled: int = LABELLED) -> Model:
    """Both heads' regressions, on a bounded sample of labelled documents."""
    known = parked(_labelled(labels))
    total = known.agg(*(F.count(h).alias(h) for h in HEADS)).first()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # A head's labels are bounded by their own number; documents are the same ones as far as they go.
    within = {h: place < int(min(1.0, labelled / max(1, total[h])) * (1 << 30)) for h in HEADS}
    chosen = known.select("doc_id", *(F.when(within[h], F.col(h)).alias(h) for h in HEADS)).where(" OR ".join(f"{h} IS NOT NULL" for h in HEADS))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The sample has a bounded number of rows of three numbers.
    sample = parked(own.join(F.broadcast(chosen), "doc_id"))
    sizes = sample.agg(*(F.count(h).alias(f"n_{h}") for h in HEADS), *(F.sum(h).alias(f"bad_{h}") for h in HEADS)).first()
    fitted = [h for h in HEADS if 0 < (sizes[f"bad_{h}"] or 0) < sizes[f"n_{h}"]]
    often = " OR ".join(f"bad_{h} >= {LEAST}" for h in HEADS)
    counts = parked(_feature_counts(sample).where(often)) if fitted else None
    features = {h: _significant(counts, h, sizes[f"n_{h}"], sizes[f"bad_{h}"]) for h in fitted}
    numbers = {h: {f: i for i, f in enumerate(features[h])} for h in fitted}
    chosen = Chosen(f for h in fitted for f in features[h])

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for _, texts in batches([batch]):
                shapes, rows = [], {h: [] for h in HEADS}
                for raw in texts:
                    own_text = raw.decode()
                    shapes.append(shape(own_text))
                    seen = chosen.of(own_text)
                    for h in HEADS:
                        rows[h].append([numbers[h][p] for p in seen & numbers[h].keys()] if h in numbers else [])
                columns = [batch.column(h).cast(pa.int64()) for h in HEADS]
                columns += [pa.array(shapes, pa.list_(pa.float64())), *(pa.array(rows[h], pa.list_(pa.int64())) for h in HEADS)]
                yield pa.RecordBatch.from_arrays(columns, [*HEADS, "shape", *(f"words_{h}" for h in HEADS)])

    kind = "low long, toxic long, shape array<double>, words_low array<long>, words_toxic array<long>"
    rows = sample.mapInArrow(run, kind).toPandas() if fitted else None
    heads = {h: Head() for h in HEADS}
    edges = np.zeros((len(SHAPES), BINS))
    if fitted:
        shapes = np.stack(rows["shape"].to_list())
        # Bounds between the values of bad documents and the high values of good ones.
        bad = (rows["low"] == 1).to_numpy() if "low" in fitted else np.ones(len(rows), bool)
        good = (rows["low"] == 0).to_numpy() if "low" in fitted else bad
        high = np.quantile(shapes[good], [0.9, 0.99, 0.999], axis=0)
        edges = np.sort(np.r_[np.quantile(shapes[bad], [0.5, 0.7, 0.75, 0.8, 0.9], axis=0), high], axis=0).T
        places = binned(shapes, edges) + np.arange(len(SHAPES)) * (BINS + 1)
    for h in fitted:
        has = rows[h].notna().to_numpy()
        y = rows[h].to_numpy(float)[has]
        base = len(SHAPES) * (BINS + 1)
        own_rows = [np.r_[p, base + np.asarray(w, np.int64)] for p, w in zip(places[has], rows[f"words_{h}"][has])]
        w = regression(own_rows, np.r_[np.zeros(base), np.asarray(list(features[h].values())) / SHARED], y)
        rate = (y.sum() + 0.5) / (len(y) + 1)
        words = {f: float(x) for f, x in zip(features[h], w[base:-1]) if abs(x) > 1e-3}
        heads[h] = Head(math.log(rate / (1 - rate)), float(w[-1]), w[:base].reshape(len(SHAPES), BINS + 1), words)
    return Model(heads, edges)


def _evidence(model: Model):
    @F.pandas_udf("low double, toxic double")
    def found(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.evidence(t or "") for t in texts], columns=list(HEADS))

    return found


def _site(column: Column) -> Column:
    """A site's name; null is one of its own."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _probability(evidence: Column, prior: float) -> Column:
    return 1 / (1 + F.exp(-(evidence + prior)))


def _strength(sites: DataFrame, head: str, mean: Column) -> Column:
    """Prior strength by moments: the fewer the differences between sites beyond chance, the larger."""
    noise = F.sum(mean * (1 - mean))
    spread = F.sum(F.col("n") * (F.col(head) / F.col("n") - mean) * (F.col(head) / F.col("n") - mean)) - noise
    between = F.greatest(spread / F.greatest(F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n"), F.lit(1.0)), F.lit(1e-9))
    return F.least(F.greatest(F.avg(mean * (1 - mean)) / between - 1, F.lit(1.0)), F.lit(1e6))


def sites(scored: DataFrame, model: Model) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """Counts of each path and its host, and each head's global rate and strengths.

    ``scored`` has ``host``, ``path`` and the evidence of each head.
    """
    p = [F.sum(_probability(F.col(h), model.heads[h].prior)).alias(h) for h in HEADS]
    paths = parked(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *p))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *(F.sum(h).alias(h) for h in HEADS))
    whole = hosts.agg(F.sum("n").alias("n"), *(F.sum(h).alias(h) for h in HEADS)).first()
    rates = {h: min(max((whole[h] or 0) / max(1, whole["n"] or 0), 1e-6), 1 - 1e-6) for h in HEADS}
    renamed = hosts.select("host", F.col("n").alias("host_n"), *(F.col(h).alias(f"host_{h}") for h in HEADS))
    both = paths.join(renamed, "host")
    found: dict[str, dict[str, float]] = {}
    for h in HEADS:
        at_hosts = hosts.agg(_strength(hosts, h, F.lit(rates[h])).alias("s")).first()["s"] or 1e6
        own = (F.col(f"host_{h}") + at_hosts * rates[h]) / (F.col("host_n") + at_hosts)
        at_paths = both.agg(_strength(both, h, own).alias("s")).first()["s"] or 1e6
        found[h] = {"rate": rates[h], "host": float(at_hosts), "path": float(at_paths)}
    return both, found


def posterior(head: str, evidence: Column, model: Model, strengths: dict[str, dict[str, float]], prefix: str = "") -> Column:
    """Posterior of a document from its evidence and its site's counts, without its own part in them."""
    s, p = strengths[head], _probability(evidence, model.heads[head].prior)
    column = lambda name: F.col(prefix + name)
    host = (F.greatest(column(f"host_{head}") - p, F.lit(0.0)) + s["host"] * s["rate"]) / (column("host_n") - 1 + s["host"])
    path = (F.greatest(column(head) - p, F.lit(0.0)) + s["path"] * host) / (column("n") - 1 + s["path"])
    path = F.least(F.greatest(path, F.lit(1e-9)), F.lit(1 - 1e-9))
    return 1 / (1 + F.exp(-(evidence + F.log(path / (1 - path)))))


def scored(docs: DataFrame, model: Model, host: Column, path: Column, text: str = "text") -> DataFrame:
    """Each row's ``doc_id``, sites and evidence, parked."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _site(host).alias("host"), _site(path).alias("path"), _evidence(model)(F.col(text)).alias("e"))
    return parked(own.select("doc_id", "host", "path", "e.low", "e.toxic"))


def classified(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """Every row's ``doc_id``, posteriors ``p_low`` and ``p_toxic``, and ``keep``."""
    model = fit(docs, labels)
    rows = scored(docs, model, host, path)
    places, strengths = sites(rows, model)
    renamed = places.select("host", "path", *(F.col(c).alias(f"site_{c}") for c in places.columns if c not in ("host", "path")))
    joined = rows.join(renamed, ["host", "path"])
    found = [posterior(h, F.col(h), model, strengths, "site_").alias(f"p_{h}") for h in HEADS]
    return joined.select("doc_id", *found).withColumn("keep", (F.col("p_low") < 0.5) & (F.col("p_toxic") < 0.5))


def kept(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """The rows that are not rejected, with their columns as they are.

    Texts are not shuffled for it unless the table of sites is too large to be sent around. A document
    without a text has the evidence of an empty one; repeated rows are judged each; the columns may have any names.
    """
    model = fit(docs, labels)
    # Written with their evidence: texts are looked at once.
    rows = parked(docs.select(*(F.col(f"`{c}`") for c in docs.columns), _site(host).alias("_q_host"), _site(path).alias("_q_path"), _evidence(model)(F.col("text")).alias("_q_e")))
    places, strengths = sites(rows.select(F.col("_q_host").alias("host"), F.col("_q_path").alias("path"), "_q_e.low", "_q_e.toxic"), model)
    renamed = places.select(*(F.col(c).alias(f"_q_{c}") for c in places.columns))
    joined = rows.join(renamed, ["_q_host", "_q_path"])
    good = [posterior(h, F.col(f"_q_e.{h}"), model, strengths, "_q_") < 0.5 for h in HEADS]
    return joined.where(good[0] & good[1]).select(*(F.col(f"`{c}`") for c in docs.columns))
