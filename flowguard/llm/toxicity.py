"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Lexicon: words and word beginnings (4 to 8 bytes) that occur clearly more often in toxic than in
other documents of a bounded labelled sample (occurrences, up to ``REPEATS`` a document), weighted
by log odds. Features per document: densities and
counts of lexicon words, their greatest weight, their share near a second person, second person,
capitals, shouted words, punctuation, and obfuscation (symbols or digits inside words, spaced-out
letters, words that hit the lexicon only after undoing the disguise).

Fit: the sample's documents get their features from the lexicon of the other folds (so no document
votes on its own words); trees are boosted on the logistic loss over binned features; out-of-fold
margins give an isotonic map to probabilities, weighted by the classes' shares among all labels. Only
dense features and term counts of the sample reach the driver, no text.

Scoring reads every whole text. Cases: null or empty texts have zero features and the score of a
text without any sign; without labels of both classes the score is the share of toxic labels (0.0
when there is none); repeated rows stay rows; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import ALNUM, NOT_SPACE, Words, mix, ready, rolling, slices, span_hashes, text_buffer
from flowguard.llm.common import _BYTE as BYTE_VALUES
from flowguard.llm.labelled import held_out, sample_ids

FOLDS = 5
PREFIXES = (4, 5, 6, 7, 8)
#: Occurrences of a term that count in one document.
REPEATS = 4
#: Terms that reach the driver at most, the most telling first.
LEXICON_TERMS = 5000
#: Weight from which a word counts as strong.
STRONG = 3.5
NEAR = 4

# fixed values: second-person words of several languages
SECOND_PERSON = "you your yours yourself yourselves u ur du dich dir dein deine deiner deinen ihr euch euer eure tu te toi ton ta tes vous votre vos usted ustedes vosotros tú ti tus tuyo".split()
# fixed values: digits and symbols that stand for letters
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

FEATURES = ["words", "weight_density", "strong_density", "strong_count", "greatest_weight", "any_density", "near_second", "second_density", "capitals", "shouted", "exclamation", "question", "symbols", "masked", "masked_hits", "spaced", "digits_inside"]


# ------------------------------------------------------------------------------------ features

_LEET = np.arange(256, dtype=np.uint8)
for _k, _v in LEET.items():
    _LEET[ord(_k)] = ord(_v)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def term_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(words, 1 + prefixes) hashes of each word and its beginnings (0: word not longer)."""
    total, down = rolling(BYTE_VALUES[low])
    out = np.zeros((len(start), 1 + len(PREFIXES)), np.uint64)
    out[:, 0] = span_hashes(low, start, end)
    for k, n in enumerate(PREFIXES, 1):
        longer = np.flatnonzero(end - start > n)
        s = start[longer]
        out[longer, k] = mix((total[s + n] - total[s]) * down[s] + np.uint64(1000 + n))
    return out


def word_weights(hashes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Greatest lexicon weight of a word's terms; ``terms`` ascending."""
    if not len(terms):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, weights[at], 0.0).max(1, initial=0.0)


_second: dict[str, np.ndarray] = {}


def second_person() -> np.ndarray:
    if "h" not in _second:
        w = Words(pa.array([" ".join(SECOND_PERSON)]), ALNUM)
        _second["h"] = np.unique(w.hashes())
    return _second["h"]


def features_of(texts: pa.Array, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    data, off = text_buffer(texts)
    n = len(off) - 1
    out = np.zeros((n, len(FEATURES)))
    w = Words(texts, ALNUM)
    count = np.maximum(w.count, 1)
    chars = np.maximum(np.diff(off), 1)
    per_doc = lambda doc, v=None: np.bincount(doc, v, n)
    h = term_hashes(w.low, w.start, w.end)
    weight = word_weights(h, terms, weights)
    strong = weight >= STRONG
    you = np.isin(h[:, 0], second_person())
    # a strong word with a second person at most NEAR words away in the same document
    before = np.concatenate([[0], np.cumsum(you)])
    here = np.arange(len(you))
    lo, hi = np.maximum(here - NEAR, w.first[:-1][w.doc]), np.minimum(here + NEAR + 1, w.first[1:][w.doc])
    close = strong & (before[hi] > before[lo])
    byte_doc = np.repeat(np.arange(n), np.diff(off))
    upper = _UPPER[data]
    up = np.concatenate([[0], np.cumsum(upper)])
    shouted = (up[w.end] - up[w.start] == w.end - w.start) & (w.end - w.start >= 3)
    out[:, 0] = np.log1p(w.count)
    out[:, 1] = per_doc(w.doc, weight) / count
    out[:, 2] = per_doc(w.doc, strong) / count
    out[:, 3] = np.log1p(per_doc(w.doc, strong))
    np.maximum.at(out[:, 4], w.doc, weight)
    out[:, 5] = per_doc(w.doc, weight > 0) / count
    out[:, 6] = per_doc(w.doc, close) / count
    out[:, 7] = per_doc(w.doc, you) / count
    out[:, 8] = per_doc(byte_doc, upper) / chars
    out[:, 9] = per_doc(w.doc, shouted) / count
    out[:, 10] = per_doc(byte_doc, data == 33) / chars
    out[:, 11] = per_doc(byte_doc, data == 63) / chars
    out[:, 12] = per_doc(byte_doc, _SYMBOL[data]) / chars
    single = w.end - w.start == 1
    run = single & np.append(single[1:], False) & np.append(single[2:], [False, False])[: len(single)] if len(single) else single
    out[:, 15] = per_doc(w.doc, run) / count
    # disguised words: tokens between spaces with a symbol or digit inside, undone
    t = Words(texts, NOT_SPACE)
    odd = np.concatenate([[0], np.cumsum(_SYMBOL[t.low] | ((t.low >= 48) & (t.low <= 57)))])
    letters = (t.end - t.start) - (odd[t.end] - odd[t.start])
    s, e = t.start.copy(), t.end.copy()
    for _ in range(3):  # punctuation around a word isn't inside it
        s = np.where((s < e) & _SYMBOL[t.low[np.minimum(s, len(t.low) - 1)]] & (t.low[np.minimum(s, len(t.low) - 1)] != 64) & (t.low[np.minimum(s, len(t.low) - 1)] != 36), s + 1, s) if len(s) else s
        e = np.where((s < e) & _SYMBOL[t.low[np.maximum(e - 1, 0)]], e - 1, e) if len(e) else e
    inside = (odd[e] - odd[s] > 0) & (letters >= 2)
    out[:, 13] = per_doc(t.doc, inside) / count
    digit = np.concatenate([[0], np.cumsum((t.low >= 48) & (t.low <= 57))])
    out[:, 16] = per_doc(t.doc, (digit[e] > digit[s]) & (letters >= 2)) / count
    pick = np.flatnonzero(inside)
    if len(pick):
        plain = _LEET[t.low]
        keep = ~_SYMBOL[plain]
        place = np.concatenate([[0], np.cumsum(keep)])
        undone = plain[keep]
        weight2 = word_weights(term_hashes(undone, place[s[pick]], place[e[pick]]), terms, weights)
        out[:, 14] = per_doc(t.doc[pick], weight2 >= STRONG) / count
    return out


# --------------------------------------------------------------------------------- boosted trees


@dataclass
class Trees:
    """Complete binary trees of equal depth: split feature and threshold per inner node, leaf values."""

    base: float = 0.0
    depth: int = 3
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    leaf: list = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 80, rate: float = 0.15, depth: int = 3, bins: int = 48, penalty: float = 1.0) -> Trees:
    """Newton boosting on the logistic loss with quantile bins."""
    p = min(max(np.average(y, weights=w), 1e-3), 1 - 1e-3)
    model = Trees(float(np.log(p / (1 - p))), depth)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    width = bins + 1
    flat = binned + np.arange(x.shape[1]) * width
    margin = np.full(len(x), model.base)
    inner = 2**depth - 1
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = w * (q - y), w * np.maximum(q * (1 - q), 1e-6)
        node = np.zeros(len(x), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for k in range(inner):
            own = np.flatnonzero(node == k)
            if len(own) > 3:
                size = x.shape[1] * width
                gs = np.bincount(flat[own].ravel(), np.repeat(g[own], x.shape[1]), size).reshape(-1, width).cumsum(1)
                hs = np.bincount(flat[own].ravel(), np.repeat(h[own], x.shape[1]), size).reshape(-1, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
                gain[(hs < 1e-3) | (ht - hs < 1e-3)] = 0
                for f, c in enumerate(cuts):
                    gain[f, len(c) :] = 0
                f, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[f, b] > 1e-6:
                    feature[k], cut[k] = f, cuts[f][b]
            go = x[own, feature[k]] > cut[k]
            node[own] = 2 * k + 1 + go
        slot = node - inner
        leaf = -rate * np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + penalty)
        margin += leaf[slot]
        model.feature.append(feature)
        model.cut.append(cut)
        model.leaf.append(leaf)
    return model


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, probability), both ascending; between knots the map
    is linear, so different scores of one pool stay in order."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # weight, weighted mean of y, weighted mean of score
    for s, t, v in zip(score[order], y[order], w[order], strict=True):
        pools.append([v, t, s])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            b, a = pools.pop(), pools.pop()
            total = a[0] + b[0]
            pools.append([total, (a[0] * a[1] + b[0] * b[1]) / total, (a[0] * a[2] + b[0] * b[2]) / total])
    return np.array([p[2] for p in pools]), np.array([p[1] for p in pools])


@dataclass
class Model:
    terms: np.ndarray
    weights: np.ndarray
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    prior: float = 0.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.prior)
        m = self.trees.margin(x)
        p = np.interp(m, *self.knots)
        # a hair of the uncalibrated probability, so that scores beyond the last knots stay ordered
        return np.clip(0.998 * p + 0.002 / (1 + np.exp(-m)), 0, 1)


# ------------------------------------------------------------------------------------------ fit


def term_counts(sample: DataFrame) -> DataFrame:
    """``term``, occurrences per fold and class (``f0_0`` ... ``f4_1``, up to REPEATS a document) and
    toxic documents (``docs``) of ``sample(text, y, fold)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column(0), ALNUM)
                h = term_hashes(w.low, w.start, w.end)
                doc = np.repeat(w.doc, h.shape[1])
                h = h.ravel()
                doc, h = doc[h != 0], h[h != 0]
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
                at = np.flatnonzero(new)
                times = np.minimum(np.diff(np.append(at, len(h))), REPEATS)
                group = (part.column(1).to_numpy() + 2 * part.column(2).to_numpy())[doc[new]]
                yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(group.astype(np.int32)), pa.array(times.astype(np.int32))], ["term", "grp", "n"])

    rows = sample.select("text", F.col("y").cast("int"), F.col("fold").cast("int")).mapInArrow(run, "term long, grp int, n int")
    each = [F.sum(F.when(F.col("grp") == 2 * f + y, F.col("n")).otherwise(0)).alias(f"f{f}_{y}") for f in range(FOLDS) for y in (0, 1)]
    return rows.groupBy("term").agg(*each, F.count_if(F.col("grp") % 2 == 1).alias("docs"))


def lexicon(count: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which terms are in, and their weights. count: (terms, 2) occurrences per class; size: (2,)
    documents per class."""
    other, toxic = count[:, 0] / max(size[0], 1), count[:, 1] / max(size[1], 1)
    expected = other * size[1]
    z = (count[:, 1] - expected) / np.sqrt(count[:, 1] + expected * max(size[1], 1) / max(size[0], 1) + 1e-9)
    weight = np.log((count[:, 1] + 0.5) / (size[1] + 1)) - np.log((count[:, 0] + 0.5) / (size[0] + 1))
    return (count[:, 1] >= 3) & (toxic > 0) & (weight >= 1.5) & (z >= 1.3 * np.sqrt(np.log(max(size[1], 3)))), weight


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    ready(spark)
    none = np.zeros(0, np.uint64)
    one = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    total = {r.y: r["count"] for r in one.groupBy("y").count().collect()}
    prior = total.get(1, 0) / max(sum(total.values()), 1)
    if not total.get(0) or not total.get(1):
        return Model(none, np.zeros(0), None, (none, none), prior)
    ids = sample_ids(labels, "toxic").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(FOLDS)).cast("int"))
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").persist()  # twice the sample bound of ids
    sizes = np.zeros((FOLDS, 2))
    for r in sample.groupBy("fold", "y").count().collect():
        sizes[r.fold, r.y] = r["count"]
    toxic, other = (sum(F.col(f"f{f}_{y}") for f in range(FOLDS)) for y in (1, 0))
    odds = (toxic + 0.5) / (other + 0.5)
    counts = term_counts(sample).where(F.col("docs") >= 3).orderBy(F.desc(odds * F.sqrt(toxic)), "term").limit(LEXICON_TERMS).collect()
    term = np.array([r.term for r in counts], np.int64).view(np.uint64)
    table = np.array([[[r[f"f{f}_{y}"] for y in (0, 1)] for f in range(FOLDS)] for r in counts], float).reshape(-1, FOLDS, 2)
    books = []
    for f in [*range(FOLDS), None]:  # without fold f; at last with all
        rest = [g for g in range(FOLDS) if g != f]
        use, weight = lexicon(table[:, rest].sum(1), sizes[rest].sum(0))
        order = np.argsort(term[use])
        books.append((term[use][order], weight[use][order]))
    shared = spark.sparkContext.broadcast(books)  # six lexicons of at most LEXICON_TERMS terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fold = part.column(2).to_numpy()
                x = np.zeros((part.num_rows, len(FEATURES)))
                for f in np.unique(fold):
                    own = np.flatnonzero(fold == f)
                    x[own] = features_of(part.column(0).take(pa.array(own)), *shared.value[f])
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([rows, part.column(1), part.column(2)], ["x", "y", "fold"])

    rows = sample.select("text", F.col("y").cast("int"), "fold").mapInArrow(run, "x array<double>, y int, fold int").collect()
    sample.unpersist()
    rows = sorted(rows, key=lambda r: (r.fold, r.y, r.x))
    x, y, fold = np.array([r.x for r in rows]), np.array([r.y for r in rows], float), np.array([r.fold for r in rows])
    if len(set(y)) < 2:
        return Model(none, np.zeros(0), None, (none, none), prior)
    share = np.array([np.mean(y == 0), np.mean(y == 1)])
    w = np.where(y == 1, prior / share[1], (1 - prior) / share[0])
    margin = np.zeros(len(y))
    for f in range(FOLDS):
        rest, own = fold != f, fold == f
        if own.any():
            margin[own] = boost(x[rest], y[rest], w[rest]).margin(x[own]) if len(set(y[rest])) == 2 else 0.0
    return Model(*books[-1], boost(x, y, w), isotonic(margin, y, w), prior)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` per row, from the whole text."""
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)  # at most LEXICON_TERMS terms and 80 small trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                x = features_of(part.column(1), m.terms, m.weights)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(m.probability(x))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learned from ``labels.toxic`` of rows that aren't
    held out."""
    return score_documents(docs, fit(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text isn't predicted toxic; columns as given."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = features_of(part.column(part.schema.get_field_index("text")), model.value.terms, model.value.weights)
                yield part.filter(pa.array(model.value.probability(x) < threshold))

    return docs.mapInArrow(run, docs.schema)
