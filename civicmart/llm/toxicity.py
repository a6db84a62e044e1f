"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed as toxic; unlabelled text is a sample of all documents, whatever
they are. Linear classifiers in numpy minimise the class-prior-corrected risk
prior * P[loss(+)] + max(0, U[loss(-)] - prior * P[loss(-)]). Features are whether a document holds a word, or a
word with a certain beginning; they are chosen by how differently positives and unlabelled text hold
them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.columns import PLAIN, Spans, flat, fold, sample, send, slices, words
from civicmart.session import cut

FOLDS, HELD_FOLD = 5, 0
#: Bounds of the two training samples.
POSITIVES, UNLABELLED = 4000, 12_000
#: Features, the least share (and number) of positives that hold one, and the least share of toxic documents
#: among those that hold it (prior times its share of positives over its share of unlabelled text).
FEATURES, SUPPORT, FEWEST, TELLING = 1024, 0.005, 3, 0.5
#: Share of the positives that a feature must explain beyond those before it.
ADDED = 0.0015
#: Features that so many positives hold, and that are so telling, stay even if others explain the same documents.
OFTEN, SURE = 0.03, 0.9
#: Lengths in bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
CLASSIFIERS = 3
STEPS, RATE, SHRINK = 300, 0.1, 1e-5


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All features of all texts, repeats included: the text's number and a 64-bit feature."""
    data, offsets = flat(texts)
    out, starts, before, _ = words(data, offsets, PLAIN)
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    spans = Spans(out)
    first, end = starts[:-1], starts[1:]
    features, of = [spans.of(first, end)], [text]
    for n in BEGINNINGS:
        long = end - first > n
        features.append(spans.of(first[long], first[long] + n, n))
        of.append(text[long])
    return np.concatenate(of), np.concatenate(features).view(np.int64)


def samples(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> DataFrame:
    """`text`, `p` and `u`: bounded samples by the order of a hash of the id, the same on every run.

    Null ids and null labels take no part; a document with several labels is positive if one of them says so.
    """
    chosen = fold("doc_id", FOLDS) != HELD_FOLD
    some = lambda df, n: sample(df.select("doc_id").dropna().distinct(), n, "doc_id")
    p = some(labels.filter(chosen & (F.col("toxic") == 1)), positives).select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u"))
    u = some(docs.filter(chosen), unlabelled).select("doc_id", F.lit(0).alias("p"), F.lit(1).alias("u"))
    ids = p.union(u).groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.groupBy("text").agg(F.max("p").alias("p"), F.max("u").alias("u"))  # copies of a text count once


def choose_features(drawn: DataFrame, prior: float, features: int, support: float) -> np.ndarray:
    """The features that positives hold more often than unlabelled text, the clearest ones, sorted."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                text, feature = word_features(part.column("text"))
                order = np.lexsort((feature, text))
                text, feature = text[order], feature[order]
                once = np.append(True, (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])) if len(text) else np.empty(0, bool)
                text, feature = text[once], feature[once]
                u, where = np.unique(feature, return_inverse=True)
                counts = [np.bincount(where, part.column(c).to_numpy()[text], len(u)).astype(np.int64) for c in ("p", "u")]
                yield pa.RecordBatch.from_arrays([pa.array(u), *map(pa.array, counts)], names=["feature", "p", "u"])

    n_p, n_u = drawn.agg(F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("u"), F.lit(0))).first()
    if not n_p or not n_u:
        return np.empty(0, np.int64)
    counts = drawn.mapInArrow(run, "feature bigint, p bigint, u bigint").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    pooled = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    distance = F.abs(F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(pooled * (1 - pooled))
    best = counts.filter((F.col("p") >= max(FEWEST, support * n_p)) & (prior * F.col("p") / n_p >= TELLING * F.col("u") / n_u)).orderBy(distance.desc(), "feature").select("feature").limit(features)
    return np.sort(np.array([r[0] for r in best.collect()], np.int64))


class Held:
    """Which of the chosen features each text holds."""

    def __init__(self, chosen: np.ndarray):
        self.chosen = chosen
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[chosen & 0xFFFF] = True

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of text and place of the feature, each once."""
        text, feature = word_features(texts)
        near = self.maybe[feature & 0xFFFF]
        text, feature = text[near], feature[near]
        size = max(len(self.chosen), 1)
        at = np.minimum(np.searchsorted(self.chosen, feature), size - 1)
        exact = self.chosen[at] == feature if len(self.chosen) else np.zeros(0, bool)
        pairs = np.unique(text[exact] * size + at[exact])
        return pairs // size, pairs % size


def covering(p: np.ndarray, u: np.ndarray, prior: float, fewest: float) -> np.ndarray:
    """Places of the features that explain the positives: each adds the most positives not yet explained, weighed by
    how telling it is. Words that merely come along in copies of a toxic document add none and are left out unless they are frequent and sure."""
    share = prior * p.mean(0) / np.maximum(u.mean(0), 1e-9)
    telling = np.clip(2 * np.minimum(share, 1) - 1, 0, 1)
    open_, taken = np.ones(len(p), bool), []
    while open_.any():
        new = p[open_].sum(0)
        best = int(np.argmax(new * telling)) if len(new) else 0
        if not len(new) or new[best] * telling[best] <= 0 or new[best] < fewest:
            break
        taken.append(best)
        open_ &= p[:, best] == 0
    often = np.flatnonzero((p.mean(0) >= OFTEN) & (share >= SURE)) if len(p) else []
    return np.unique(np.array([*taken, *often], np.int64))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, shrink: float = SHRINK) -> np.ndarray:
    """Weights (the last is the constant) of a linear classifier under the non-negative risk, by Adam."""
    w = np.zeros(p.shape[1] + 1, np.float32)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        at_p, at_u = sigmoid(p @ w[:-1] + w[-1]), sigmoid(u @ w[:-1] + w[-1])
        # logistic loss: +: -log s, gradient s - 1;  -: -log(1 - s), gradient s
        negative = -np.log1p(-np.minimum(at_u, 1 - 1e-7)).mean() + prior * np.log1p(-np.minimum(at_p, 1 - 1e-7)).mean()
        g_p, g_u = prior * (at_p - 1) / len(p), at_u / len(u)
        if negative >= 0:
            g_p = g_p - prior * at_p / len(p)
        else:  # the corrected part may not fall below zero: step back on it alone
            g_p, g_u = prior * at_p / len(p), -g_u
        g = np.append(g_p @ p + g_u @ u, g_p.sum() + g_u.sum()).astype(np.float32)
        g[:-1] += shrink * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES,
    support: float = SUPPORT, classifiers: int = CLASSIFIERS,
) -> tuple[np.ndarray, np.ndarray]:
    """The chosen features (sorted) and one row of weights per classifier. Each leaves out another part of the unlabelled sample."""
    own = labels.filter(fold("doc_id", FOLDS) != HELD_FOLD)
    prior = float(own.agg(F.coalesce(F.avg((F.col("toxic") == 1).cast("double")), F.lit(0.0))).first()[0])
    prior = min(max(prior, 1e-3), 0.9)
    drawn = cut(samples(docs, labels, positives, unlabelled), "toxicity-sample")
    chosen = choose_features(drawn, prior, features, support)
    held = send(docs.sparkSession, Held(chosen))

    def run(batches):
        found = held()
        for batch in batches:
            for part in slices(batch):
                text, at = found.of(part.column("text"))
                bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("p"), part.column("u"), lists], names=["p", "u", "held"])

    table = drawn.mapInArrow(run, "p int, u int, held array<int>").toArrow()
    lists = table.column("held").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    x = np.zeros((table.num_rows, len(chosen)), np.float32)
    sizes = np.diff(lists.offsets.to_numpy()) if table.num_rows else np.empty(0, np.int64)
    x[np.repeat(np.arange(len(x)), sizes), lists.flatten().to_numpy()] = 1
    is_p, is_u = (table.column(c).to_numpy() == 1 for c in ("p", "u"))
    if not is_p.any() or not is_u.any():
        return chosen, np.append(np.zeros(len(chosen)), np.log(prior / (1 - prior)))[None, :]
    kept = covering(x[is_p], x[is_u], prior, max(FEWEST, ADDED * is_p.sum()))
    chosen, p, u = chosen[kept], x[is_p][:, kept], x[is_u][:, kept]
    parts = np.random.default_rng(7).integers(0, classifiers, len(u)) if len(u) >= 10 * classifiers > 10 else np.full(len(u), -1)
    return chosen, np.stack([fit(p, u[parts != k], prior) for k in range(classifiers)])


def scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of `docs`.

    Learns from rows outside the held fold (a null id counts as the empty text). Null and empty texts
    hold no features and get the score of such text; repeated rows get the same score; other columns
    are not looked at. Without positives or unlabelled text every score is the class prior.
    """
    chosen, weights = train(docs, labels, **settings)
    model = send(docs.sparkSession, (Held(chosen), weights))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        found, w = model()
        for batch in batches:
            for part in slices(batch):
                text, at = found.of(part.column("text"))
                each = [sigmoid(np.bincount(text, row[at], part.num_rows) + row[-1]) for row in w.astype(float)]
                score = np.mean(each, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select("doc_id", "text", (fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """`docs` without the rows whose text is predicted toxic; all columns stay as they are."""
    chosen, weights = train(docs, labels, **settings)
    model = send(docs.sparkSession, (Held(chosen), weights))
    others = F.struct("doc_id", *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])

    def run(batches):
        found, w = model()
        for batch in batches:
            for part in slices(batch):
                text, at = found.of(part.column("text"))
                each = [sigmoid(np.bincount(text, row[at], part.num_rows) + row[-1]) for row in w.astype(float)]
                yield part.filter(pa.array(np.mean(each, axis=0) < 0.5))

    boxed = docs.select("text", others.alias("_row"))
    kept = boxed.mapInArrow(run, boxed.schema)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
