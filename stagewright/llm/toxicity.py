"""Toxicity scores of all overlapping windows by a bidirectional gated recurrent network in numpy.

The input of a token is a learned vector of its word (lower case, no punctuation around it) beside
the mean of learned vectors of its character 3- and 4-grams, hashed, with marks at both ends; so a
word that was never seen is still read by its characters. One network reads a window of tokens
forwards, one backwards; attention over both gives a mean of their states, and a linear unit the
window's logit. Windows are ``WINDOW`` tokens long and start every ``STRIDE`` tokens, over the whole
text. A document is as toxic as its most toxic window.

Labels are of documents, so learning treats a document as toxic if some window is: the odds of its
windows are added up. The logit of a document is divided by a temperature fitted on a part of the
sample that was not learned from, and shifted from the sample's share of the classes to that of all
labelled rows that may be learned from.

Null texts and texts without a token score 0. With no labelled texts of both classes every score is
the share of class 1, or 0.5 if there is none.
"""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewright.llm.common import fresh, slices, small_batches
from stagewright.llm.training import calibrate, held_out, labelled_texts, sigmoid

MODULUS, REMAINDER = 5, 0
#: Rows of each class that are learned from at most, and the longest in characters if there are enough.
PER, MOST_CHARS = 1000, 6000
WINDOW, STRIDE = 32, 16
WORDS, LEAST = 20000, 5
#: Buckets of character n-grams (a power of two), and the widths of the layers.
BUCKETS, WORD_WIDTH, CHAR_WIDTH, STATE, ATTENTION = 1 << 14, 8, 16, 8, 8
STEPS, BATCH, RATE = 450, 24, 0.01
#: Tokens that a worker remembers, and windows that are scored and learned from at a time.
REMEMBERED, TOGETHER, LEARNED = 200_000, 1024, 4096
_LOG = logging.getLogger(__name__)
_EDGES = re.compile(r"^\W+|\W+$")


def word_of(token: str) -> str:
    return _EDGES.sub("", token).lower() or token


def gram_sums(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of the words, and how many each word has."""
    bodies = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(b) for b in bodies])
    flat = np.frombuffer(b"".join(bodies) + b"\0\0\0", np.uint8).astype(np.uint32)
    ends = np.repeat(np.cumsum(sizes), sizes)
    n = int(sizes.sum())
    keys = flat[:n] | flat[1 : n + 1] << 8 | flat[2 : n + 2] << 16
    keys = np.stack((keys, keys | flat[3 : n + 3] << 24), axis=1)
    # A multiplier each, so that a 3-gram is not taken for a 4-gram that ends in byte 0.
    factors, bits = np.array([2654435761, 2246822519], np.uint32), BUCKETS.bit_length() - 1
    hashed = (keys * factors) >> np.uint32(32 - bits)
    at = np.arange(n)
    whole = np.stack((at + 3 <= ends, at + 4 <= ends), axis=1)
    counts = np.add.reduceat(whole.sum(axis=1), np.cumsum(sizes) - sizes)
    return hashed[whole].astype(np.int64), counts


@dataclass
class Model:
    words: dict[str, int]
    weights: dict[str, np.ndarray]
    temperature: float = 1.0
    shift: float = 0.0


def initial(words: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(0)
    draw = lambda *shape, scale: (scale * rng.standard_normal(shape)).astype(np.float32)
    width, both = WORD_WIDTH + CHAR_WIDTH, 2 * STATE
    return {
        "word": draw(words + 1, WORD_WIDTH, scale=0.1),
        "char": draw(BUCKETS, CHAR_WIDTH, scale=0.3),
        "into": draw(width, 3 * both, scale=width**-0.5),
        "bias": np.zeros(3 * both, np.float32),
        "again": draw(both, 3 * both, scale=STATE**-0.5) * _apart(),
        "look": draw(both, ATTENTION, scale=both**-0.5),
        "lean": np.zeros(ATTENTION, np.float32),
        "value": draw(ATTENTION, scale=1.0),
        "out": draw(both, scale=both**-0.5),
        "end": np.array([-3.0], np.float32),
    }


def _apart() -> np.ndarray:
    """Ones where a state of one direction meets a gate of the same direction."""
    forward = np.arange(2 * STATE) < STATE
    return np.tile(forward[:, None] == forward[None, :], (1, 3)).astype(np.float32)


def inputs(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Input vectors of words; also their numbers, n-gram buckets and counts, for learning."""
    numbers = np.array([model.words.get(w, 0) for w in words], np.int64)
    grams, counts = gram_sums(words)
    starts = np.cumsum(counts) - counts
    chars = np.add.reduceat(model.weights["char"][grams], starts, axis=0) / counts[:, None]
    return np.hstack((model.weights["word"][numbers], chars)).astype(np.float32), numbers, grams, counts


def gate_inputs(weights: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What tokens give to the update gate, the reset gate and the new state, for each direction."""
    table = (x @ weights["into"] + weights["bias"]).reshape(-1, 3, 2, STATE)
    return np.ascontiguousarray(table[:, :, 0]), np.ascontiguousarray(table[:, :, 1])


def run(
    weights: dict[str, np.ndarray],
    ahead: np.ndarray,
    behind: np.ndarray,
    grid: np.ndarray,
    real: np.ndarray | None,
    keep: list | None = None,
):
    """Logits of windows, the columns of ``grid``: places of their tokens in ``ahead`` and ``behind``.

    ``real`` marks true tokens where not all are. ``keep`` collects what the way back needs.
    """
    steps, n = grid.shape
    both = 2 * STATE
    h = np.zeros((n, both), np.float32)
    states = np.empty((steps, n, both), np.float32)
    gates = np.empty((n, 3, both), np.float32)
    again = weights["again"]
    for s in range(steps):
        back = steps - 1 - s
        gates[:, :, :STATE] = ahead[grid[s]]
        gates[:, :, STATE:] = behind[grid[back]]
        q = (h @ again).reshape(n, 3, both)
        update, reset = np.moveaxis(0.5 + 0.5 * np.tanh(0.5 * (gates[:, :2] + q[:, :2])), 1, 0)
        new = np.tanh(gates[:, 2] + reset * q[:, 2])
        now = new + update * (h - new)
        on = None
        if real is not None:
            on = np.repeat(np.stack((real[s], real[back]), axis=1), STATE, axis=1).astype(np.float32)
            now = h + on * (now - h)
        if keep is not None:
            keep.append((h, update, reset, new, q[:, 2], on))
        h = now
        states[s, :, :STATE] = h[:, :STATE]
        states[back, :, STATE:] = h[:, STATE:]
    looked = np.tanh(states @ weights["look"] + weights["lean"])
    drawn = looked @ weights["value"]
    if real is not None:
        drawn = np.where(real, drawn, -np.inf)
    drawn = np.exp(drawn - drawn.max(axis=0))
    share = drawn / drawn.sum(axis=0)
    pooled = np.einsum("tn,tnd->nd", share, states)
    return pooled @ weights["out"] + weights["end"], (states, looked, share, pooled)


def slopes(weights: dict[str, np.ndarray], tokens: int, grid: np.ndarray, keep: list, seen: tuple, error: np.ndarray):
    """Slopes of the weights and of the tokens' gate inputs for the slopes ``error`` of the logits."""
    states, looked, share, pooled = seen
    steps, n = grid.shape
    out = {"out": pooled.T @ error, "end": error.sum(keepdims=True)}
    d_pooled = error[:, None] * weights["out"]
    d_share = np.einsum("nd,tnd->tn", d_pooled, states)
    d_drawn = share * (d_share - (share * d_share).sum(axis=0))
    out["value"] = np.einsum("tn,tnk->k", d_drawn, looked)
    d_look = d_drawn[:, :, None] * weights["value"] * (1 - looked * looked)
    out["look"] = np.einsum("tnd,tnk->dk", states, d_look, optimize=True)
    out["lean"] = d_look.sum(axis=(0, 1))
    d_states = share[:, :, None] * d_pooled + d_look @ weights["look"].T
    again = weights["again"]
    d_again = np.zeros_like(again)
    d_gates = np.empty((2, steps, n, 3, STATE), np.float32)
    dh = np.zeros((n, 2 * STATE), np.float32)
    for s in range(steps - 1, -1, -1):
        back = steps - 1 - s
        h, update, reset, new, q, on = keep[s]
        dh[:, :STATE] += d_states[s, :, :STATE]
        dh[:, STATE:] += d_states[back, :, STATE:]
        d_now = dh if on is None else on * dh
        d_before = d_now * update if on is None else (1 - on) * dh + d_now * update
        d_update = d_now * (h - new) * update * (1 - update)
        d_new = d_now * (1 - update) * (1 - new * new)
        d_reset = d_new * q * reset * (1 - reset)
        own = np.stack((d_update, d_reset, d_new), axis=1)
        d_gates[0, s], d_gates[1, back] = own[:, :, :STATE], own[:, :, STATE:]
        dq = np.hstack((d_update, d_reset, d_new * reset))
        d_again += h.T @ dq
        dh = d_before + dq @ again.T
    out["again"] = d_again * _apart()
    # Summed per token, in order of tokens.
    order = np.argsort(grid, axis=None, kind="stable")
    places, first = np.unique(grid.ravel()[order], return_index=True)
    d_rows = np.zeros((tokens, 3, 2, STATE), np.float32)
    for way in range(2):
        d_rows[places, :, way] = np.add.reduceat(d_gates[way].reshape(-1, 3, STATE)[order], first, axis=0)
    return out, d_rows.reshape(tokens, -1)


def windows(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the windows over so many tokens; the last one reaches the end."""
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.arange(1 + max(0, -(-(size - WINDOW) // STRIDE))) * STRIDE
    return starts, np.minimum(WINDOW, size - starts)


def _grid(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    real = np.arange(WINDOW)[:, None] < sizes
    grid = flat[np.where(real, starts + np.arange(WINDOW)[:, None], starts)]
    return grid, None if real.all() else real


def _learn_batch(model: Model, texts: list[list[str]], y: np.ndarray) -> dict:
    """Slopes of one batch of documents, given as their words."""
    vocabulary = list(dict.fromkeys(w for words in texts for w in words))
    place = {w: i for i, w in enumerate(vocabulary)}
    x, numbers, grams, counts = inputs(model, vocabulary)
    weights = model.weights
    ahead, behind = gate_inputs(weights, x)
    starts, sizes, owners, at = [], [], [], 0
    for i, words in enumerate(texts):
        own, size = windows(len(words))
        starts.append(own + at)
        sizes.append(size)
        owners.append(np.full(len(own), i))
        at += len(words)
    flat = np.array([place[w] for words in texts for w in words], np.int64)
    owner = np.concatenate(owners)
    starts, sizes = np.concatenate(starts), np.concatenate(sizes)
    parts = [slice(a, a + LEARNED) for a in range(0, len(starts), LEARNED)]

    def part_of(part: slice, keep: list | None):
        grid, real = _grid(flat, starts[part], sizes[part])
        return grid, *run(weights, ahead, behind, grid, real, keep)

    # More windows than fit go in parts, once for the odds and once more for the slopes.
    keep: list = []
    done = [part_of(part, keep if len(parts) == 1 else None)[: 3 if len(parts) == 1 else 2] for part in parts]
    logits = np.concatenate([x[1] for x in done])
    # A document's odds are the sum of its windows' odds.
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    most = np.maximum.reduceat(logits, first)
    odds = np.exp(logits - np.repeat(most, np.diff(first, append=len(owner))))
    total = np.add.reduceat(odds, first)
    whole = sigmoid(most + np.log(total))
    runs = np.diff(first, append=len(owner))
    error = (np.repeat((whole - y) / len(y) / total, runs) * odds).astype(np.float32)
    out: dict = {}
    d_rows = 0
    for part in parts:
        if len(parts) > 1:
            keep = []
            grid, _, seen = part_of(part, keep)
        else:
            grid, _, seen = done[0]
        found, rows = slopes(weights, len(x), grid, keep, seen, error[part])
        out = {name: out[name] + found[name] for name in found} if out else found
        d_rows = d_rows + rows
    out["into"], out["bias"] = x.T @ d_rows, d_rows.sum(axis=0)
    dx = d_rows @ weights["into"].T
    out["word"] = np.zeros_like(weights["word"])
    np.add.at(out["word"], numbers, dx[:, :WORD_WIDTH])
    out["char"] = np.zeros_like(weights["char"])
    np.add.at(out["char"], grams, np.repeat(dx[:, WORD_WIDTH:] / counts[:, None], counts, axis=0))
    return out


def learn(texts: list[str], labels: list[int], share: float) -> Model:
    """A model from texts of both classes; ``share`` is the share of class 1 among all labels."""
    documents = [[word_of(t) for t in text.split()] for text in texts]
    counts = Counter(w for words in documents for w in set(words))
    ranked = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:WORDS]
    vocabulary = {w: i + 1 for i, w in enumerate(w for w, n in ranked if n >= LEAST)}
    model = Model(vocabulary, initial(len(vocabulary)))
    y = np.array(labels, np.float64)
    filled = np.array([i for i, words in enumerate(documents) if words], np.int64)
    # Every sixth row fits the temperature, unless the others lack a class without it.
    aside, own = filled[5::6], np.delete(filled, np.arange(5, len(filled), 6))
    if len(set(y[own])) < 2:
        aside, own = filled[:0], filled
    rng = np.random.default_rng(1)
    first = {k: np.zeros_like(w) for k, w in model.weights.items()}
    second = {k: np.zeros_like(w) for k, w in model.weights.items()}
    # A batch has ``BATCH`` documents, or fewer if they are long.
    weight_of = np.array([max(MOST_CHARS, len(text)) for text in texts])
    limit = BATCH * MOST_CHARS
    rounds = -(-STEPS // max(1, -(-int(weight_of[own].sum()) // limit)))
    batches = []
    for order in (rng.permutation(own) for _ in range(rounds)):
        batches += [order[a:b] for a, b in slices(weight_of[order].tolist(), limit)]
    for step, some in enumerate(batches, 1):
        found = _learn_batch(model, [documents[i] for i in some], y[some])
        size = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in found.values()))
        rate = RATE * (1 - step / (len(batches) + 1))
        for name, weight in model.weights.items():
            g = found[name] * min(1.0, 1 / (size + 1e-9))
            a, b = first[name], second[name]
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            weight -= (rate / (1 - 0.9**step)) * a / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    scorer = Scorer(model)
    model.temperature = calibrate(scorer.logits([texts[i] for i in aside]), y[aside])
    ours = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model.shift = float(np.log(share / (1 - share)) - np.log(ours / (1 - ours)))
    return model


class Scorer:
    """Scores texts, remembering the inputs of tokens it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ahead, self.behind = (np.zeros((1024, 3, STATE), np.float32) for _ in range(2))

    def _places(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        new = list(set(tokens).difference(known))
        if new:
            x = inputs(self.model, [word_of(t) for t in new])[0]
            at = len(known)
            while at + len(new) > len(self.ahead):
                self.ahead = np.concatenate((self.ahead, np.zeros_like(self.ahead)))
                self.behind = np.concatenate((self.behind, np.zeros_like(self.behind)))
            own = slice(at, at + len(new))
            self.ahead[own], self.behind[own] = gate_inputs(self.model.weights, x)
            known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))

    def logits(self, texts: list[str]) -> np.ndarray:
        """The highest window logit of every text, minus infinity where there is no token."""
        if len(self.known) > REMEMBERED:
            self._forget()
        out = np.full(len(texts), -np.inf)
        tokens, starts, sizes, owners = [], [], [], []
        for i, text in enumerate(texts):
            own = text.split()
            first, size = windows(len(own))
            starts.append(first + len(tokens))
            sizes.append(size)
            owners.append(np.full(len(first), i))
            tokens += own
        if not tokens:
            return out
        flat, start = self._places(tokens), np.concatenate(starts)
        size, owner = np.concatenate(sizes), np.concatenate(owners)
        # Whole windows need no marks; short ones, the last of each text, go together.
        order = np.argsort(size < WINDOW, kind="stable")
        whole = int((size == WINDOW).sum())
        for a, b in ((0, whole), (whole, len(order))):
            for c in range(a, b, TOGETHER):
                some = order[c : min(b, c + TOGETHER)]
                grid, real = _grid(flat, start[some], size[some])
                np.maximum.at(out, owner[some], run(self.model.weights, self.ahead, self.behind, grid, real)[0])
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        logits = self.logits(texts)
        found = sigmoid(logits / self.model.temperature + self.model.shift)
        return np.where(np.isfinite(logits), found, 0.0)


def scorer_of(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str,
    text: str,
    label: str,
    modulus: int,
    remainder: int,
    per: int,
    most_chars: int,
) -> tuple[Callable[[Column], Column], bool]:
    """Learns from the labelled rows; gives what scores a text column, and whether it has learned."""
    spark = docs.sparkSession
    small_batches(spark)
    bounds = {"modulus": modulus, "remainder": remainder, "per": per, "most_chars": most_chars}
    texts, y, share = labelled_texts(docs, labels, label, doc_id=doc_id, text=text, **bounds)
    learned = len({label for body, label in zip(texts, y, strict=True) if body.split()}) == 2
    model = spark.sparkContext.broadcast(learn(texts, y, share) if learned else None)

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model.value) if model.value else None
        for batch in batches:
            bodies = [x or "" for x in batch]
            yield pd.Series(scorer.scores(bodies) if scorer else np.full(len(bodies), share))

    return each, learned


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    per: int = PER,
    most_chars: int = MOST_CHARS,
) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``; columns so named are replaced."""
    bounds = {"modulus": modulus, "remainder": remainder, "per": per, "most_chars": most_chars}
    each, _ = scorer_of(docs, labels, doc_id=doc_id, text=text, label=label, **bounds)
    (found,) = fresh(docs, "found")
    plain = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    return docs.withColumn(found, each(F.col(text))).select(
        *[F.col(f"`{c}`") for c in plain],
        held_out(F.col(doc_id), modulus, remainder).alias("held_out"),
        F.col(found).alias("score"),
        (F.col(found) >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.5,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    per: int = PER,
    most_chars: int = MOST_CHARS,
) -> DataFrame:
    """The documents, with their own columns, that score below ``threshold``.

    Where the texts that may be learned from are not of both classes, there is no model: nothing is
    known to be toxic, every document stays, and a warning says so.
    """
    bounds = {"modulus": modulus, "remainder": remainder, "per": per, "most_chars": most_chars}
    each, learned = scorer_of(docs, labels, doc_id=doc_id, text=text, label=label, **bounds)
    if not learned:
        _LOG.warning("no texts of both classes to learn from: every document is kept, toxic ones too")
        return docs
    return docs.filter(each(F.col(text)) < threshold)
