"""Quality scores from random-indexing word vectors and a two-layer network.

A term is a word in lower case without punctuation around it, or the shape of a token: runs of upper
case, lower case and digits become one letter each, other characters stay, and a token that repeats
the one before it has a shape of its own. Terms share ``WORDS`` rows for words and ``SHAPES`` for
shapes by a hash, so that every term has a row however many there are. Every row has a sparse random
index vector; the vector of a row is the sum of the index vectors of the tokens around it, over all
its occurrences in all documents, brought to length one. The sums are taken per task, as whole
numbers, and added up by blocks of rows; labels play no part in them. A document is the mean
of its word vectors and the mean of its shape vectors, over all its tokens. A network with one hidden
layer, learned from a bounded sample of labelled rows, gives a logit, which is divided by a
temperature fitted on a part of the sample that the network did not see, and shifted from the
sample's share of the classes to that of all labelled rows that may be learned from.

Null and empty texts are scored like a document without tokens. With no labelled rows of both
classes every score is the share of class 1, or 0.5 if there is none. Alike rows count in the vectors
as often as they occur.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewright.llm.common import fresh, small_batches
from stagewright.llm.training import calibrate, held_out, labelled_texts, sigmoid

MODULUS, REMAINDER = 3, 1
#: Rows of each class that are learned from at most, and the longest in characters if there are enough.
PER, MOST_CHARS = 1500, 20000
#: Rows that words and shapes share by a hash; more rows cost memory and shuffle, not passes.
WORDS, SHAPES = (1 << 16) - 1, (1 << 12) - 1
WIDTH, ONES, AROUND = 64, 6, 2
#: Rows of a block of sums, and how many tasks' sums are added up at a time.
BLOCK, TOGETHER = 1 << 10, (16, 4096)
HIDDEN, ROUNDS, BATCH, RATE, DECAY = 32, 60, 128, 0.003, 1e-4
#: Tokens that a worker remembers, and tokens whose surroundings are summed at a time.
REMEMBERED, PIECE = 300_000, 1 << 13
_EDGES = re.compile(r"^\W+|\W+$")
_RUNS = re.compile(r"([^\W\d_]+)|(\d+)|(.)\3*", re.S)


def word_of(token: str) -> str:
    return _EDGES.sub("", token).lower()


def _run_shape(match: re.Match) -> str:
    letters, digits, other = match.groups()
    if letters:
        first, rest = letters[0], letters[1:]
        after = "A" if rest.isupper() else "a" if rest.islower() else "x"
        return ("A" if first.isupper() else "a") + (after if rest else "")
    return "0" if digits else other


def shape_of(token: str) -> str:
    return _RUNS.sub(_run_shape, token)


class _Masks(dict):
    """What a character is to a shape, for ``str.translate``: tokens of one mask have one shape."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        if c.isalnum() and not re.match(r"\d", c):
            cased = "A" if c.isupper() else "a" if c.islower() else c if c.istitle() else "o"
            self[code] = ord(cased)
        else:
            self[code] = ord("0") if c.isalnum() else code
        return self[code]


def number_of(term: str, rows: int) -> int:
    """The row of a term, from 1; row 0 is for no term."""
    return 1 + xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass")) % rows if term else 0


def index_vectors(rows: int, seed: int) -> np.ndarray:
    """A few entries of +1 and -1 for each row but the first, the same wherever they are drawn."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, WIDTH), np.int8)
    places = rng.random((rows, WIDTH)).argpartition(ONES, axis=1)[:, :ONES]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int8), places.shape), axis=1)
    out[0] = 0
    return out


@dataclass
class Model:
    #: Vectors by row: of words, and of shapes, those of repeated tokens after the others.
    vectors: list[np.ndarray]
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    shift: float


class Tokens:
    """Word and shape rows of texts, remembering tokens it has seen, and the shapes of masks."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.words, self.shapes = array("H"), array("H")
        self.masks, self.shape_rows = _Masks(), {}

    def _new(self, token: str) -> None:
        self.known[token] = len(self.known)
        word = token.lower() if token.isalnum() else word_of(token)
        self.words.append(number_of(word, WORDS))
        mask = token.translate(self.masks)
        shape = self.shape_rows.get(mask)
        if shape is None:
            if len(self.shape_rows) > REMEMBERED:
                self.shape_rows.clear()
            shape = self.shape_rows[mask] = number_of(shape_of(token), SHAPES)
        self.shapes.append(shape)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        tokens = text.split()
        if len(self.known) > REMEMBERED:
            self.known, self.words, self.shapes = {}, array("H"), array("H")
        for token in set(tokens).difference(self.known):
            self._new(token)
        ids = np.fromiter(map(self.known.__getitem__, tokens), np.int32, len(tokens))
        words, shapes = (np.array(np.frombuffer(rows, np.uint16)[ids] if len(ids) else [], np.uint16) for rows in (self.words, self.shapes))
        if len(ids) > 1:
            shapes[1:] += np.uint16(SHAPES + 1) * (ids[1:] == ids[:-1])
        return words, shapes


class Sums:
    """The index vectors around every occurrence, added up by row."""

    def __init__(self):
        self.of_word, self.of_shape = index_vectors(WORDS + 1, 1), index_vectors(2 * (SHAPES + 1), 2)
        self.words, self.shapes = (np.zeros(x.shape, np.int32) for x in (self.of_word, self.of_shape))

    def add(self, words: np.ndarray, shapes: np.ndarray) -> None:
        """The tokens of documents that have ``AROUND`` tokens of row 0 between them."""
        for at in range(0, len(words), PIECE):
            low, here = max(0, at - AROUND), slice(at, at + PIECE)
            near = slice(low, at + PIECE + AROUND)
            own = self.of_word[words[near]] + self.of_shape[shapes[near]]
            around = np.zeros_like(own)
            for d in range(1, AROUND + 1):
                around[d:] += own[:-d]
                around[:-d] += own[d:]
            around = around[at - low : at - low + PIECE]
            for sums, rows in ((self.words, words[here]), (self.shapes, shapes[here])):
                order = np.argsort(rows, kind="stable")
                sorted_ = rows[order]
                starts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
                sums[sorted_[starts]] += np.add.reduceat(around[order], starts, axis=0, dtype=np.int32)

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of both tables one after the other, without those of zeros only."""
        both = np.concatenate((self.words, self.shapes))
        for at in range(0, len(both), BLOCK):
            if both[at : at + BLOCK].any():
                yield at // BLOCK, both[at : at + BLOCK]


def _joined(documents: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gap = np.zeros(AROUND, np.uint16)
    return tuple(np.concatenate([x for d in documents for x in (d[half], gap)]) for half in (0, 1))


def _unit(sums: np.ndarray) -> list[np.ndarray]:
    """The vectors of both tables, brought to length one; none for no word."""
    vectors = sums.astype(np.float64)
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9)
    words, shapes = np.split(vectors.astype(np.float32), [WORDS + 1])
    # Row 0 also has what is next to the ends of documents.
    words[0] = shapes[0] = 0
    return [words, shapes]


def vectors_of(docs: DataFrame, text: str = "text") -> list[np.ndarray]:
    """The vectors of all rows, from all documents; their size does not grow with the table."""
    block, size = BLOCK, (WORDS + 1 + 2 * (SHAPES + 1), WIDTH)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, sums = Tokens(), Sums()
        for batch in batches:
            documents = [tokens(x) for x in batch.column(0).to_pylist() if x]
            if documents:
                sums.add(*_joined(documents))
        found = list(sums.blocks())
        way = TaskContext.get().partitionId()
        yield pa.record_batch({
            "block": pa.array([n for n, _ in found], pa.int32()),
            "way": pa.array([way] * len(found), pa.int32()),
            "sums": pa.array([x.astype(np.int64).tobytes() for _, x in found], pa.binary()),
        })

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(each, "block int, way int, sums binary")
    for together in TOGETHER:
        parts = _added(parts.withColumn("way", F.expr(f"way - pmod(way, {together})")), "block", "way")
    merged = _added(parts, "block").toArrow().to_pylist()
    whole = np.zeros(size, np.int64)
    for row in merged:
        own = np.frombuffer(row["sums"], np.int64).reshape(-1, WIDTH)
        whole[row["block"] * block : row["block"] * block + len(own)] = own
    return _unit(whole)


def _added(parts: DataFrame, *keys: str) -> DataFrame:
    """Sums of one key added up, a row at a time as they come sorted."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def finished() -> Iterator[pa.RecordBatch]:
            if now is not None:
                yield pa.record_batch({
                    "block": pa.array([now[0]], pa.int32()), "way": pa.array([now[1]], pa.int32()),
                    "sums": pa.array([sums.tobytes()], pa.binary()),
                })

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["block"], row["way"] if "way" in keys else 0)
                own = np.frombuffer(row["sums"], np.int64)
                if key == now:
                    sums += own
                else:
                    yield from finished()
                    now, sums = key, own.copy()
        yield from finished()

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(each, parts.schema)


def _pooled(model_vectors: list[np.ndarray], document: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.zeros(2 * WIDTH)
    for half, (vectors, numbers) in enumerate(zip(model_vectors, document, strict=True)):
        if len(numbers):
            used, counts = np.unique(numbers, return_counts=True)
            out[half * WIDTH : (half + 1) * WIDTH] = counts.astype(np.float32) @ vectors[used] / len(numbers)
    return out


def _logits(layers: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2


def _train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    rng = np.random.default_rng(0)
    layers = [
        rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]),
        np.zeros(HIDDEN),
        rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN),
        np.zeros(1),
    ]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            hidden = np.tanh(x[rows] @ layers[0] + layers[1])
            error = (sigmoid(hidden @ layers[2] + layers[3]) - y[rows]) / len(rows)
            inner = error[:, None] * layers[2] * (1 - hidden * hidden)
            slopes = [
                x[rows].T @ inner + DECAY * layers[0],
                inner.sum(axis=0),
                hidden.T @ error + DECAY * layers[2],
                error.sum(keepdims=True),
            ]
            step += 1
            for p, g, a, b in zip(layers, slopes, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return layers


def learn(vectors: list[np.ndarray], texts: list[str], labels: list[int], share: float) -> Model:
    """A model from texts of both classes; ``share`` is the share of class 1 among all labels."""
    tokens = Tokens()
    x = np.array([_pooled(vectors, tokens(text)) for text in texts])
    y = np.array(labels, np.float64)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - mean) / spread
    # Every fifth row fits the temperature.
    aside = np.arange(len(x)) % 5 == 4
    layers = _train(x[~aside], y[~aside])
    temperature = calibrate(_logits(layers, x[aside]), y[aside])
    ours = y.mean()
    shift = np.log(share / (1 - share)) - np.log(ours / (1 - ours))
    return Model(vectors, mean, spread, layers, temperature, float(shift))


def scores(model: Model, tokens: Tokens, texts: list[str]) -> np.ndarray:
    x = np.array([_pooled(model.vectors, tokens(text)) for text in texts])
    logits = _logits(model.layers, (x - model.mean) / model.spread)
    return sigmoid(logits / model.temperature + model.shift)


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    per: int = PER,
    most_chars: int = MOST_CHARS,
) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``; columns so named are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    texts, y, share = labelled_texts(
        docs, labels, label, modulus=modulus, remainder=remainder, per=per, most_chars=most_chars, doc_id=doc_id, text=text
    )
    both = len(set(y)) == 2
    model = spark.sparkContext.broadcast(learn(vectors_of(docs, text), texts, y, share) if both else None)

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        learned = model.value
        tokens = Tokens()
        for batch in batches:
            bodies = [x or "" for x in batch]
            yield pd.Series(scores(learned, tokens, bodies) if learned else np.full(len(bodies), share))

    (found,) = fresh(docs, "found")
    plain = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    return docs.withColumn(found, each(F.col(text))).select(
        *[F.col(f"`{c}`") for c in plain],
        held_out(F.col(doc_id), modulus, remainder).alias("held_out"),
        F.col(found).alias("score"),
        (F.col(found) >= 0.5).cast("int").alias("predicted"),
    )
