"""Scores of documents by masked pseudo-likelihood.

A small network in NumPy predicts each token from a window on both sides of it; a document's score is the sum of the
conditional log-probabilities of all its tokens. Words (A-Z in lower case) are hashed to ``CLASSES * CLASSES`` tokens,
so no vocabulary is gathered and rare words count like all others. The hidden layer is a tanh of the window's embeddings
with a weight per place; the output predicts the two digits of a token's number one after the other, the second given
the first.

Training goes through all documents ``ROUNDS`` times. A round sends the present parameters to all tasks; each task takes
steps over every token of its own documents, and returns its parameters as rows of ``CHUNK`` values weighted by its tokens. Spark sums them by position, so what is gathered grows
with the corpus, no task holds more than a chunk of all, and only the mean, of fixed size, reaches the driver.

The mean over tasks depends on how the input is split, so scores of runs on differently split input differ slightly.

Null text and text without words have no tokens, a score of 0 and a null mean. A window reaches over a text's ends to a
token of its own. Rows are scored one by one, so null and repeated ids change nothing. An empty corpus leaves the initial
parameters. Other columns are passed on; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.words import Words, slices

CLASSES = 64
WIDTH = 16
#: Places of the window, relative to the token.
PLACES = (-2, -1, 1, 2)
ROUNDS = 2
#: Every token is trained in every round. A caller may thin them out for a trial; no query does.
STRIDE = 1
BATCH = 512
RATE = 0.1
CHUNK = 64
END = CLASSES * CLASSES  # the token beyond a text's ends


@dataclass
class Network:
    """Parameters: embeddings, weights per place, hidden bias, digit embeddings, and the two output layers."""

    embed: np.ndarray
    place: np.ndarray
    bias: np.ndarray
    digit: np.ndarray
    out1: np.ndarray
    out2: np.ndarray

    @classmethod
    def initial(cls, seed: int = 0) -> Network:
        random = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) * 0.1).astype(np.float32)

        return cls(
            small(END + 1, WIDTH), 1 + small(len(PLACES), WIDTH), np.zeros(WIDTH, np.float32), small(CLASSES, WIDTH),
            small(WIDTH + 1, CLASSES), small(WIDTH + 1, CLASSES),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.place, self.bias, self.digit, self.out1, self.out2]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> Network:
        out, at = [], 0
        for a in cls.initial().arrays():
            out.append(values[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return cls(*out)

    def forward(self, window: np.ndarray, first: np.ndarray) -> tuple:
        seen = self.embed[window]  # tokens x places x width
        hidden = np.tanh(sum(seen[:, k] * weights for k, weights in enumerate(self.place)) + self.bias)
        second = np.tanh(hidden + self.digit[first])
        return seen, hidden, second, _log_softmax(hidden, self.out1), _log_softmax(second, self.out2)

    def log_probability(self, window: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The sum of both digits' log-probabilities per token."""
        first, last = np.divmod(token, CLASSES)
        total = np.repeat(self.bias[None], len(token), 0)
        for k, weights in enumerate(self.place):
            total += (self.embed * weights).take(window[:, k], 0)
        hidden = np.tanh(total, out=total)
        second = np.tanh(hidden + self.digit[first])
        return _one_log_softmax(hidden, self.out1, first) + _one_log_softmax(second, self.out2, last)

    def step(self, window: np.ndarray, token: np.ndarray, squares: list[np.ndarray], rate: float) -> None:
        """One step of the mean negative log-probability; ``squares`` are the sums that scale each parameter's rate."""
        first, last = np.divmod(token, CLASSES)
        n, places = len(token), len(PLACES)
        seen = self.embed.take(window.ravel(), 0).reshape(n, places * WIDTH)
        across = np.zeros((places, WIDTH, WIDTH), np.float32)  # the weights per place, as a matrix that also adds the places up
        across[:, np.arange(WIDTH), np.arange(WIDTH)] = self.place
        across = across.reshape(places * WIDTH, WIDTH)
        hidden, second = np.ones((n, WIDTH + 1), np.float32), np.ones((n, WIDTH + 1), np.float32)
        np.tanh(seen @ across + self.bias, out=hidden[:, :-1])
        np.tanh(hidden[:, :-1] + self.digit.take(first, 0), out=second[:, :-1])
        to_out1, to_hidden = _layer_gradients(hidden, self.out1, first)
        to_out2, inner = _layer_gradients(second, self.out2, last)
        inner *= 1 - second[:, :-1] ** 2
        outer = (to_hidden + inner) * (1 - hidden[:, :-1] ** 2)
        grads = [
            _sums(window.ravel(), (outer @ across.T).reshape(-1, WIDTH), len(self.embed)),
            np.einsum("nkj,nj->kj", seen.reshape(n, places, WIDTH), outer), outer.sum(0), _sums(first, inner, CLASSES), to_out1, to_out2,
        ]
        for values, grad, square in zip(self.arrays(), grads, squares, strict=True):
            scale = grad * grad
            square += scale
            np.add(square, np.float32(1e-6), out=scale)
            np.sqrt(scale, out=scale)
            np.divide(grad, scale, out=grad)
            grad *= np.float32(rate)
            values -= grad


def _layer_gradients(rows: np.ndarray, layer: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the mean negative log-probability of the chosen columns, by the layer and by the rows but their last one.

    The last component of each row is 1, for the layer's bias. Odds are weighed on the narrow side of the products: a row's
    gradient by its outputs is (odds - sum of odds * chosen) / (n * sum of odds).
    """
    odds = rows @ layer
    if np.abs(layer).sum(0).max() > 60:  # rows are within one, so exponents are below this sum
        odds -= odds.max(1, keepdims=True)
    np.exp(odds, out=odds)
    total = odds @ np.ones(CLASSES, np.float32)
    odds[np.arange(len(rows)), chosen] -= total
    weight = (1 / (len(rows) * total))[:, None]
    return (rows * weight).T @ odds, (odds @ layer[:-1].T) * weight


def _sums(numbers: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """The sum of the rows of each number below ``count``. Two components are added as one complex number."""
    half = WIDTH // 2
    out = np.zeros(count * half, np.complex64)
    at = (numbers * half)[:, None] + np.arange(half)
    np.add.at(out, at.ravel(), np.ascontiguousarray(rows, np.float32).view(np.complex64).ravel())
    return out.view(np.float32).reshape(count, WIDTH)


def _log_softmax(rows: np.ndarray, layer: np.ndarray) -> np.ndarray:
    x = rows @ layer[:-1] + layer[-1]
    x -= x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _one_log_softmax(rows: np.ndarray, layer: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """As ``_log_softmax``, but only of the chosen column of each row."""
    x = rows @ layer[:-1] + layer[-1]
    if np.abs(layer).sum(0).max() > 80:  # inputs are within one, so exponents are below this sum
        x -= x.max(1, keepdims=True)
    picked = x[np.arange(len(x)), chosen].astype(np.float64)
    return picked - np.log(np.exp(x, out=x).sum(1))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token of each word of a slice of texts, and the offset of each text's first one."""
    words = Words(texts, lower=True)
    return (words.hash % np.uint64(END)).astype(np.int64), words.offset


def windows_of(tokens: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """The tokens around each token, END beyond its text."""
    n = np.diff(offset)
    begin, end = np.repeat(offset[:-1], n), np.repeat(offset[1:], n)
    out = np.full((len(tokens), len(PLACES)), END, np.int64)
    at = np.arange(len(tokens))
    for k, p in enumerate(PLACES):
        inside = (at + p >= begin) & (at + p < end)
        out[inside, k] = tokens[at[inside] + p]
    return out


def train(docs: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE, seed: int = 0) -> Network:
    """A network trained on all texts of ``docs``, on every ``stride``-th token in each round: on all of them by default."""
    spark = docs.sparkSession
    net = Network.initial(seed)
    size = len(net.flat())
    fields = [f"v{i}" for i in range(CHUNK)]
    schema = ", ".join(["chunk int", "weight double", *[f"{f} double" for f in fields]])
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(net.flat())
        rate, offset = RATE / (1 + number), number

        def run(batches: Iterable[pa.RecordBatch], sent=sent, rate=rate, offset=offset) -> Iterator[pa.RecordBatch]:
            own = Network.from_flat(sent.value)
            squares = [np.zeros_like(a) for a in own.arrays()]
            count = 0
            random = np.random.default_rng(offset)
            for batch in batches:
                for first, last in slices(batch.column(0)):
                    tokens, at = tokens_of(batch.column(0).slice(first, last - first))
                    windows = windows_of(tokens, at)
                    place = np.arange(len(tokens)) - np.repeat(at[:-1], np.diff(at))
                    chosen = random.permutation(np.flatnonzero(place % stride == offset % stride))
                    windows, tokens = windows.take(chosen, 0), tokens.take(chosen)
                    for i in range(0, len(chosen), BATCH):
                        own.step(windows[i : i + BATCH], tokens[i : i + BATCH], squares, rate)
                    count += len(chosen)
            if count:
                values = np.zeros(-(-size // CHUNK) * CHUNK)
                values[:size] = own.flat()
                rows = values.reshape(-1, CHUNK) * count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(np.full(len(rows), float(count))), *map(pa.array, rows.T.copy())],
                    names=["chunk", "weight", *fields],
                )

        summed = docs.select("text").mapInArrow(run, schema).groupBy("chunk").agg(
            F.sum("weight").alias("weight"), *[F.sum(f).alias(f) for f in fields]
        )
        # as many rows as the network has chunks, whatever the corpus
        mean = summed.select("chunk", *[(F.col(f) / F.col("weight")).alias(f) for f in fields]).toPandas()
        if len(mean):
            net = Network.from_flat(mean.sort_values("chunk")[fields].to_numpy().ravel()[:size])
        sent.destroy()
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``n_tokens``, ``log_likelihood`` and ``mean_log_likelihood`` of each whole text."""
    added = {"n_tokens": T.LongType(), "log_likelihood": T.DoubleType(), "mean_log_likelihood": T.DoubleType()}
    docs = docs.drop(*added)
    sent = docs.sparkSession.sparkContext.broadcast(net.flat())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.from_flat(sent.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for first, last in slices(texts):
                tokens, at = tokens_of(texts.slice(first, last - first))
                windows = windows_of(tokens, at)
                sums = np.zeros(len(tokens) + 1)
                for i in range(0, len(tokens), 8192):
                    sums[i + 1 : i + 8193] = own.log_probability(windows[i : i + 8192], tokens[i : i + 8192])
                n = np.diff(at)
                owner = np.repeat(np.arange(len(n)), n)
                total = np.bincount(owner, sums[1:], minlength=len(n))
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, last - first).columns, pa.array(n.astype(np.int64)), pa.array(total), mean],
                    names=[*batch.schema.names, *added],
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in added.items()]]))
