"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a one-pass Viterbi search.

The pieces of a vocabulary, spaces for its word mark, are the patterns of an automaton over bytes.
At every position of a text the automaton's state is the longest pattern suffix read so far, and its
output links lead through all pieces that end there, longest first; each relaxes the best score of
that position from the position where it starts. A byte piece is one more, always there. Of equal
scores the longer last piece wins, and a byte piece loses. Decoding joins the bytes of the pieces.

A space is put before the text and taken off again, as the vocabulary's word mark asks for; nothing
else is normalized, so decoding gives back every text exactly, a literal word mark included: that
comes as byte pieces. Null texts have null pieces; empty texts have none.

The best pieces of a text are those of its stretches wherever no piece can cross the cut. If no
piece has a space after another character, texts are cut before runs of spaces, and around line
breaks and tabs that no piece holds. Distinct stretches of a batch are then searched in step, one
byte of all of them at a time, and remembered for the batches to come.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright.llm.common import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Scores below this mark pieces that are not meant to be chosen; they do not set the byte score.
UNLIKELY = -1e8
#: How far the score of a byte piece is below the least likely piece.
BYTE_PENALTY = 10.0
#: Stretches that a worker remembers, and bytes that are searched in step.
REMEMBERED, STEP_BYTES = 300_000, 1 << 19
#: With fewer stretches left than this, a search in step costs more than one by one.
FEW = 12


@dataclass
class Vocabulary:
    """Pieces as bytes by id, and the automaton over them; state 0 is the root."""

    pieces: list[bytes]
    byte_ids: np.ndarray
    byte_score: float
    #: Sorted keys state * 256 + byte of the trie's edges, and where they lead.
    edges: np.ndarray
    leads: np.ndarray
    fail: np.ndarray
    #: The piece that ends in a state: its length (0: none), score and id; the next state with one.
    length: np.ndarray
    score: np.ndarray
    piece: np.ndarray
    link: np.ndarray
    cuts: bytes


def build(pieces: list[tuple[int, bytes, float]], byte_ids: list[int]) -> Vocabulary:
    """The automaton of (id, bytes, score) pieces; ``byte_ids`` are the ids of the 256 byte pieces."""
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary needs a piece for each byte")
    children: list[dict[int, int]] = [{}]
    ends: dict[int, tuple[int, float, int]] = {}
    for number, body, score in pieces:
        state = 0
        for byte in body:
            if byte not in children[state]:
                children[state][byte] = len(children)
                children.append({})
            state = children[state][byte]
        if body and (state not in ends or ends[state][1] < score):
            ends[state] = (len(body), score, number)
    fail, link = [0] * len(children), [0] * len(children)
    queue = list(children[0].values())
    for state in queue:
        for byte, child in children[state].items():
            back = fail[state]
            while back and byte not in children[back]:
                back = fail[back]
            fail[child] = children[back].get(byte, 0)
            link[child] = fail[child] if fail[child] in ends else link[fail[child]]
            queue.append(child)
    edges = sorted((state * 256 + byte, child) for state, own in enumerate(children) for byte, child in own.items())
    table = [ends.get(state, (0, 0.0, 0)) for state in range(len(children))]
    least = min([score for _, _, score in pieces if score > UNLIKELY], default=0.0)
    joined = {byte for _, body, _ in pieces for byte in body}
    by_id = max([number for number, _, _ in pieces] + byte_ids) + 1
    bodies = [b""] * by_id
    for number, body, _ in pieces:
        bodies[number] = body
    for byte, number in enumerate(byte_ids):
        bodies[number] = bytes([byte])
    inner = any(b" " in body.lstrip(b" ") for _, body, _ in pieces)
    return Vocabulary(
        pieces=bodies,
        byte_ids=np.array(byte_ids, np.int32),
        byte_score=least - BYTE_PENALTY,
        edges=np.array([key for key, _ in edges], np.int64),
        leads=np.array([child for _, child in edges], np.int64),
        fail=np.array(fail, np.int64),
        length=np.array([x[0] for x in table], np.int64),
        score=np.array([x[1] for x in table], np.float64),
        piece=np.array([x[2] for x in table], np.int32),
        link=np.array(link, np.int64),
        cuts=b"" if inner else bytes([32, *(byte for byte in b"\n\t" if byte not in joined)]),
    )


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file; read on the driver and sent along."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    bytes_at = {model.id_to_piece(i): i for i in range(size) if model.is_byte(i)}
    byte_ids = [bytes_at[name] for b in range(256) if (name := f"<0x{b:02X}>") in bytes_at]
    plain = [
        (i, model.id_to_piece(i).replace(MARK, " ").encode(), float(model.get_score(i)))
        for i in range(size)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    return build(plain, byte_ids)


def _next(v: Vocabulary, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    out = np.zeros(len(states), np.int64)
    open_, now = np.arange(len(states)), states
    while len(open_):
        keys = now * 256 + bytes_[open_]
        at = np.minimum(np.searchsorted(v.edges, keys), len(v.edges) - 1)
        hit = v.edges[at] == keys
        out[open_[hit]] = v.leads[at[hit]]
        again = ~hit & (now > 0)
        open_, now = open_[again], v.fail[now[again]]
    return out


def _search_one(v: Vocabulary, body: bytes) -> list[int]:
    """The same search for one stretch, in plain steps."""
    edges = v.edges
    best = [0.0] * (len(body) + 1)
    back: list[tuple[int, int]] = [(0, 0)] * (len(body) + 1)
    state = 0
    for t, byte in enumerate(body):
        while True:
            key = state * 256 + byte
            at = int(np.searchsorted(edges, key))
            if at < len(edges) and edges[at] == key:
                state = int(v.leads[at])
                break
            if not state:
                break
            state = int(v.fail[state])
        top, step = -np.inf, (0, 0)
        ending = state if v.length[state] else int(v.link[state])
        while ending:
            n = int(v.length[ending])
            score = best[t + 1 - n] + float(v.score[ending])
            if score > top:
                top, step = score, (int(v.piece[ending]), n)
            ending = int(v.link[ending])
        if best[t] + v.byte_score > top:
            top, step = best[t] + v.byte_score, (int(v.byte_ids[byte]), 1)
        best[t + 1], back[t + 1] = top, step
    out, t = [], len(body)
    while t:
        number, n = back[t]
        out.append(number)
        t -= n
    return out[::-1]


def search(v: Vocabulary, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The best pieces of every stretch: how many each has, and all of them one after the other."""
    counts = np.zeros(len(bodies), np.int64)
    found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(bodies)
    order = sorted(range(len(bodies)), key=lambda i: -len(bodies[i]))
    at = 0
    while at < len(order):
        longest = max(1, len(bodies[order[at]]))
        some = order[at : at + max(1, STEP_BYTES // longest)]
        at += len(some)
        if len(some) < FEW:
            for i in some:
                found[i] = np.array(_search_one(v, bodies[i]), np.int32)
            continue
        for i, pieces in zip(some, _in_step(v, [bodies[i] for i in some]), strict=True):
            found[i] = pieces
    for i, pieces in enumerate(found):
        counts[i] = len(pieces)
    return counts, np.concatenate([*found, np.zeros(0, np.int32)])


def _in_step(v: Vocabulary, bodies: list[bytes]) -> list[np.ndarray]:
    """Stretches in order of length, longest first, one byte of all of them at a time."""
    sizes = np.array([len(b) for b in bodies])
    width = int(sizes[0])
    grid = np.zeros((width, len(bodies)), np.int64)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    owner = np.repeat(np.arange(len(bodies)), sizes)
    grid[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), owner] = flat
    best = np.full((width + 1, len(bodies)), -np.inf)
    best[0] = 0
    piece = np.zeros((width + 1, len(bodies)), np.int32)
    step = np.zeros((width + 1, len(bodies)), np.int32)
    states = np.zeros(len(bodies), np.int64)
    for t in range(width):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        states[:n] = _next(v, states[:n], grid[t, :n])
        ending = np.where(v.length[states[:n]] > 0, states[:n], v.link[states[:n]])
        rows = np.flatnonzero(ending)
        ending = ending[rows]
        while len(rows):
            length = v.length[ending]
            scores = best[t + 1 - length, rows] + v.score[ending]
            better = scores > best[t + 1, rows]
            put = rows[better]
            best[t + 1, put] = scores[better]
            piece[t + 1, put] = v.piece[ending[better]]
            step[t + 1, put] = length[better]
            ending = v.link[ending]
            more = ending > 0
            rows, ending = rows[more], ending[more]
        scores = best[t, :n] + v.byte_score
        put = np.flatnonzero(scores > best[t + 1, :n])
        best[t + 1, put] = scores[put]
        piece[t + 1, put] = v.byte_ids[grid[t, put]]
        step[t + 1, put] = 1
    at, rows = sizes.copy(), np.flatnonzero(sizes)
    chosen, places = [], []
    while len(rows):
        chosen.append(piece[at[rows], rows])
        places.append(rows)
        at[rows] -= step[at[rows], rows]
        rows = rows[at[rows] > 0]
    if not chosen:
        return [np.zeros(0, np.int32) for _ in bodies]
    # Found from the end: turned around, then brought together by stretch.
    chosen, places = np.concatenate(chosen[::-1]), np.concatenate(places[::-1])
    chosen = chosen[np.argsort(places, kind="stable")]
    return np.split(chosen, np.cumsum(np.bincount(places, minlength=len(bodies)))[:-1])


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes batches of texts, remembering stretches it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._forget()
        cuts = vocabulary.cuts
        if not cuts:
            self.pattern = None
        else:
            other = b"".join(re.escape(bytes([c])) for c in cuts[1:])
            inside = b"[^ " + other + b"]"
            alone = b"|[" + other + b"]+" if other else b""
            self.pattern = re.compile(b" +" + inside + b"*|" + inside + b"+" + alone)

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes, self.pieces = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self._forget()
        split = self.pattern.findall if self.pattern else lambda body: [body]
        parts = [split(b" " + x.encode("utf-8", "surrogatepass")) if x else [] for x in texts]
        known = self.known
        new = list(dict.fromkeys(w for words in parts for w in words if w not in known))
        if new:
            counts, pieces = search(self.v, new)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.sizes = np.concatenate((self.sizes, counts))
            self.pieces = np.concatenate((self.pieces, pieces))
        starts = np.cumsum(self.sizes) - self.sizes
        out = []
        for words in parts:
            at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            out.append(self.pieces[_gather(starts[at], self.sizes[at])])
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.sizes = np.array([len(p) for p in vocabulary.pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(vocabulary.pieces), np.uint8)

    def decode(self, pieces: np.ndarray) -> str:
        at = np.asarray(pieces, np.int64)
        body = self.bytes[_gather(self.starts[at], self.sizes[at])].tobytes()
        return body.removeprefix(b" ").decode("utf-8", "replace")


def encode(spark: SparkSession, text: Column, vocabulary: Vocabulary) -> Column:
    """The piece ids of a text column, as an array of integers."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("array<int>")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(sent.value)
        for batch in batches:
            done = encoder.encode([x or "" for x in batch])
            yield pd.Series([None if x is None else ids for x, ids in zip(batch, done, strict=True)], dtype=object)

    return each(text)


def decode(spark: SparkSession, pieces: Column, vocabulary: Vocabulary) -> Column:
    """The text of a column of piece ids; ids without a piece and nulls in it stand for nothing."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)
    known = F.filter(pieces, lambda x: (x >= 0) & (x < len(vocabulary.pieces)))

    @F.pandas_udf("string")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(sent.value)
        for batch in batches:
            yield pd.Series([None if x is None else decoder.decode(x) for x in batch], dtype=object)

    return each(known)


def with_pieces(
    docs: DataFrame, *, text: str = "text", column: str = "pieces", vocabulary: Vocabulary | None = None
) -> DataFrame:
    """The documents with their piece ids in ``column``, which is replaced if there is one."""
    spark = docs.sparkSession
    plain = [F.col(f"`{c}`") for c in docs.columns if c.lower() != column.lower()]
    return docs.select(*plain, encode(spark, F.col(text), vocabulary or load()).alias(column))
