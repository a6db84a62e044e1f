"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded (its make-up of characters and words, then a
learned layer); gated attention weighs the passages, and a logistic unit scores the weighted
representation. All weights are learned together from document labels alone, in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.columns import BLANK, LOWER, Spans, flat, fold, sample, send, slices, words

FOLDS, HELD_FOLD = 3, 1
#: Bound of the labelled training sample.
LABELLED = 6000
#: Words per passage.
PASSAGE = 64
HIDDEN, ATTENTION = 24, 12
EPOCHS, BAGS, RATE, SHRINK = 25, 128, 0.01, 1e-4

#: Kinds of bytes whose shares describe a passage; what is not named is of the last kind.
KINDS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\v\f\r", bytes(range(128, 256)), b".", b",", b"!", b"?",
    b"|", b"#", b"$", b"%", b"&", b"*", b"-_", b"'\"", b"()[]{}", b"<>=/\\", b":;", b"@+~^`",
]
KIND = np.full(256, len(KINDS), np.uint8)
for _k, _chars in enumerate(KINDS):
    KIND[np.frombuffer(_chars, np.uint8)] = _k
WIDTH = len(KINDS) + 1 + 6


def passages(texts: pa.Array, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """The description of every passage, and the number of passages before each text.

    Passages are runs of `size` words of the whole text; a text without words is one passage.
    """
    data, offsets = flat(texts)
    _, starts, before, at = words(data, offsets, BLANK)
    n_words = np.diff(before)
    n_passages = np.maximum(1, -(-n_words // size))
    ahead = np.concatenate([[0], np.cumsum(n_passages)])
    text = np.repeat(np.arange(len(n_words)), n_passages)
    nth = np.arange(ahead[-1]) - ahead[text]
    first_word = before[text] + nth * size
    begin = np.where(nth == 0, offsets[text], at[np.minimum(first_word, max(len(at) - 1, 0))] if len(at) else offsets[text])
    end = np.append(begin[1:], data.size)
    of_byte = np.repeat(np.arange(len(begin)), end - begin)
    kinds = len(KINDS) + 1
    out = np.zeros((len(begin), WIDTH), np.float32)
    out[:, :kinds] = np.bincount(of_byte * kinds + KIND[data], minlength=len(begin) * kinds).reshape(-1, kinds) / np.maximum(end - begin, 1)[:, None]
    if len(at):
        of_word = ahead[np.repeat(np.arange(len(n_words)), n_words)] + (np.arange(len(at)) - np.repeat(before[:-1], n_words)) // size
        n = np.maximum(np.bincount(of_word, minlength=len(begin)), 1)
        flat_words = LOWER[data[BLANK[data]]]
        h = Spans(flat_words).of(starts[:-1], starts[1:])
        same = np.zeros(len(at), bool)
        same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
        order = np.lexsort((h, of_word))
        fresh = np.append(True, (h[order][1:] != h[order][:-1]) | (of_word[order][1:] != of_word[order][:-1]))
        length = np.diff(starts)
        head = KIND[data[at]] == 1
        tail = KIND[data[at + length - 1]] >= 6
        for k, values in enumerate([same, head, tail, length / 10]):
            out[:, kinds + k] = np.bincount(of_word, values, len(begin)) / n
        out[:, kinds + 4] = np.bincount(of_word[order][fresh], minlength=len(begin)) / n
        out[:, kinds + 5] = np.log1p(np.bincount(of_word, minlength=len(begin))) / 4
    return out, ahead


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """Encoder, gated attention and score of bags of described passages."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        start = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.mean, self.scale = mean, scale
        self.w = [start(WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32), start(HIDDEN, ATTENTION), start(HIDDEN, ATTENTION), start(ATTENTION, 1)[:, 0], start(HIDDEN, 1)[:, 0], np.zeros(1, np.float32)]

    def forward(self, x: np.ndarray, ahead: np.ndarray) -> tuple:
        encode, shift, value, gate, weigh, out, constant = self.w
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ encode + shift)
        t, g = np.tanh(h @ value), sigmoid(h @ gate)
        a = (t * g) @ weigh
        first, size = ahead[:-1], np.diff(ahead)
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, first), size))
        a = a / np.repeat(np.add.reduceat(a, first), size)
        z = np.add.reduceat(h * a[:, None], first)
        return x, h, t, g, a, z, sigmoid(z @ out + constant[0])

    def scores(self, x: np.ndarray, ahead: np.ndarray) -> np.ndarray:
        return self.forward(x, ahead)[-1].astype(float) if len(ahead) > 1 else np.empty(0)

    def gradients(self, x: np.ndarray, ahead: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        encode, shift, value, gate, weigh, out, constant = self.w
        x, h, t, g, a, z, p = self.forward(x, ahead)
        first, size = ahead[:-1], np.diff(ahead)
        d_p = ((p - y) / len(y)).astype(np.float32)
        d_z = np.repeat(d_p[:, None] * out, size, axis=0)
        d_a = (d_z * h).sum(1)
        d_a = a * (d_a - np.repeat(np.add.reduceat(a * d_a, first), size))  # softmax within a bag
        d_tg = d_a[:, None] * weigh
        d_t, d_g = d_tg * g * (1 - t * t), d_tg * t * g * (1 - g)
        d_h = (d_z * a[:, None] + d_t @ value.T + d_g @ gate.T) * (1 - h * h)
        return [x.T @ d_h, d_h.sum(0), h.T @ d_t, h.T @ d_g, (t * g).T @ d_a, z.T @ d_p, d_p.sum(keepdims=True)]

    def fit(self, x: np.ndarray, ahead: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> None:
        rng = np.random.default_rng(11)
        m, v, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        size = np.diff(ahead)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BAGS):
                bags = order[at : at + BAGS]
                rows = np.concatenate([np.arange(ahead[b], ahead[b + 1]) for b in bags])
                grads = self.gradients(x[rows], np.concatenate([[0], np.cumsum(size[bags])]), y[bags])
                step += 1
                for k, g in enumerate(grads):
                    g = g + SHRINK * self.w[k] if self.w[k].ndim > 1 else g
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = (self.w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, epochs: int = EPOCHS) -> Attention:
    """A model of at most `labelled` labelled documents outside the held fold, chosen by a hash of the id.

    Null ids and null labels take no part; of several labels of a document the least counts.
    """
    own = labels.filter((fold("doc_id", FOLDS) != HELD_FOLD) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = own.groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    known = sample(known, labelled, "doc_id")
    drawn = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "y")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                x, ahead = passages(part.column("text"))
                held = [x[a:b].tobytes() for a, b in zip(ahead[:-1], ahead[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(held, pa.binary())], names=["doc_id", "y", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    table = drawn.mapInArrow(run, f"doc_id {kind}, y int, x binary").toArrow()
    if not table.num_rows:
        return Attention(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32))
    table = table.sort_by([("doc_id", "ascending"), ("x", "ascending")])  # the same order on every run
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in table.column("x").to_pylist()]
    x = np.concatenate(bags)
    ahead = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = Attention(x.mean(0), x.std(0) + 0.01)
    model.fit(x, ahead, table.column("y").to_numpy().astype(np.float32), epochs)
    return model


def scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of `docs`.

    Null texts count as empty; an empty text is one empty passage and gets that score; repeated rows
    get the same score; a null id counts as the empty text when folds are drawn; other columns are not
    looked at. Without labels the scores are those of an untrained model.
    """
    model = send(docs.sparkSession, train(docs, labels, **settings))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        made = model()
        for batch in batches:
            for part in slices(batch):
                score = made.scores(*passages(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select("doc_id", "text", (fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
