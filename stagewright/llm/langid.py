"""Language identification by prediction by partial matching over bytes.

Each language has its own tree of byte contexts of up to ``ORDER`` bytes with the counts of what
followed them. A byte costs what its longest known context says: its count over the context's total
plus its number of different bytes; a byte new to the context costs an escape, that number over the
same sum, and is then coded by the context one byte shorter, down to all 256 bytes alike. The counts
are frozen after learning, so the cost of any byte in any context is a table entry and a text's code
length is an exact sum. The language with the shortest code wins, equal ones by name.

A tree is learned in a task of its language, from a bounded sample: ``PER`` texts of each language,
of ``MOST_BYTES`` at most or longer ones where these are too few. Each order of a tree keeps its
``CONTEXTS`` commonest contexts, and fewer where the languages are so many that all trees
together would have more than ``ALL_CONTEXTS`` of an order; a longer context falls back to its
suffix. The ``LANGUAGES`` commonest values of the language column are learned. So what the driver
holds and sends grows neither with the rows nor with the number of values.

Every text is scored whole. Null texts and texts without a letter are ``und`` with score 0, and so is
everything if there is nothing to learn from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewright.llm.common import fresh, small_batches
from stagewright.llm.training import held_out, sampled

ORDER, CONTEXTS, ALL_CONTEXTS, LANGUAGES = 3, 16384, 1 << 17, 512
PER, MOST_BYTES = 400, 32768
MODULUS, REMAINDER = 5, 0
UNKNOWN = "und"
#: Letters, and a few other word characters that ``str.isalpha`` tells apart.
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes that are scored at a time; a longer text goes in pieces with the context before them.
_PIECE = 1 << 20


def has_letter(text: str) -> bool:
    return any(match[0].isalpha() for match in _LETTER.finditer(text))


@dataclass
class Tree:
    """A language's contexts as nodes, the root first and then order by order.

    ``classes`` numbers the bytes that were learned, 0 is any other. ``longer`` has a table for each
    order: the node of a context of one byte less, and the class of the byte before it, give
    the longer node, or the same one if it is not kept. ``costs`` are bits by node and class.
    """

    classes: np.ndarray
    firsts: np.ndarray
    longer: list[np.ndarray]
    costs: np.ndarray

    def packed(self) -> dict[str, bytes]:
        longer = b"".join(table.tobytes() for table in self.longer)
        return {"classes": self.classes.tobytes(), "firsts": self.firsts.tobytes(), "longer": longer, "costs": self.costs.tobytes()}

    @classmethod
    def of(cls, packed: dict[str, bytes]) -> Tree:
        classes, firsts = (np.frombuffer(packed[name], np.int32) for name in ("classes", "firsts"))
        size = int(classes.max()) + 1
        flat = np.frombuffer(packed["longer"], np.int32).reshape(-1, size)
        cuts = np.cumsum(np.diff(firsts)[:-1])
        costs = np.frombuffer(packed["costs"], np.float32).reshape(-1, size)
        return cls(classes, firsts, np.split(flat, cuts[:-1]) if len(cuts) else [], costs)

    def nodes(self, classes: np.ndarray) -> np.ndarray:
        """The node of the longest kept context before each class of a run, as far as it is in the run."""
        out = np.zeros(len(classes), np.int32)
        for k, table in enumerate(self.longer):
            # What can be longer is of order k and whole.
            before = np.zeros(len(classes), np.int32)
            before[k + 1 :] = classes[: -(k + 1)]
            at = np.flatnonzero(out >= self.firsts[k]) if k else np.arange(len(out))
            out[at] = table[out[at] - self.firsts[k], before[at]]
        return out

    def bits(self, classes: np.ndarray) -> np.ndarray:
        """The cost of every class of a run in its context."""
        return self.costs[self.nodes(classes), classes]


def _counts(classes: np.ndarray, size: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Context-and-byte keys of an order with their counts; runs that hold class 0 do not count."""
    n = len(classes) - order
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, whole = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(order + 1):
        part = classes[i : i + n]
        keys = keys * size + part
        whole &= part > 0
    return np.unique(keys[whole], return_counts=True)


def learn(texts: list[bytes], order: int = ORDER, contexts: int = CONTEXTS) -> Tree:
    """The tree of one language."""
    pad = b"\0" * order
    raw = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    # Byte 0 separates the texts, so it is never learned.
    seen = sorted(set(np.unique(raw).tolist()) - {0})
    classes = np.zeros(256, np.int32)
    classes[seen] = np.arange(1, len(seen) + 1)
    size = len(seen) + 1
    below, costs, longer = np.full((1, size), 1 / 256), [], []
    known, first, firsts = np.zeros(1, np.int64), 0, [0]
    for k in range(order + 1):
        key, count = _counts(classes[raw].astype(np.int64), size, k)
        of_context, which = np.unique(key // size, return_inverse=True)
        if k:
            total = np.bincount(which, count, len(of_context))
            # A tree: a context stays only if its suffix has stayed.
            suffix = of_context % size ** (k - 1)
            at = np.minimum(np.searchsorted(known, suffix), len(known) - 1)
            stay = known[at] == suffix
            common = np.lexsort((of_context, -total))
            common = np.sort(common[stay[common]][:contexts])
            of_context, at = of_context[common], at[common]
        else:
            of_context, at = np.zeros(1, np.int64), np.zeros(1, np.int64)
        n = np.zeros((len(of_context), size))
        place = np.minimum(np.searchsorted(of_context, key // size), max(0, len(of_context) - 1))
        here = of_context[place] == key // size if len(of_context) else np.zeros(len(key), bool)
        n[place[here], (key % size)[here]] = count[here]
        sums, different = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        lower = below[at]
        with np.errstate(invalid="ignore", divide="ignore"):
            below = np.where(sums == 0, lower, np.where(n > 0, n, different * lower) / (sums + different))
        costs.append((-np.log2(below)).astype(np.float32))
        if k:
            # From the node of the suffix, by the byte before it.
            table = np.repeat(np.arange(firsts[-2], firsts[-1], dtype=np.int32)[:, None], size, axis=1)
            table[at, of_context // size ** (k - 1)] = first + np.arange(len(of_context))
            longer.append(table)
        known, first = of_context, first + len(of_context)
        firsts.append(first)
    return Tree(classes, np.array(firsts, np.int32), longer, np.concatenate(costs))


def code_lengths(trees: list[Tree], texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """Bits of every text in every language."""
    out = np.zeros((len(texts), len(trees)))
    waiting: list[tuple[int, bytes, bytes]] = []

    def count() -> None:
        raw = np.frombuffer(b"".join(x for _, lead, piece in waiting for x in (lead, piece)), np.uint8)
        # Each piece comes after its lead, which is context only.
        sizes = np.array([len(piece) for _, _, piece in waiting])
        ends = np.cumsum(sizes + order)
        spans = np.stack((ends - sizes, ends), axis=1).ravel()
        numbers = [number for number, _, _ in waiting]
        for j, tree in enumerate(trees):
            bits = np.append(tree.bits(tree.classes[raw]), np.float32(0))
            np.add.at(out[:, j], numbers, np.add.reduceat(bits, spans, dtype=np.float64)[::2])
        waiting.clear()

    total = 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), _PIECE):
            # Byte 0 stands before a text, as it does in learning.
            lead = text[max(0, at - order) : at].rjust(order, b"\0")
            waiting.append((number, lead, text[at : at + _PIECE]))
            total += len(waiting[-1][2])
            if total >= _PIECE:
                count()
                total = 0
    if waiting:
        count()
    return out


def sample(
    docs: DataFrame,
    *,
    doc_id: str,
    text: str,
    lang: str,
    modulus: int,
    remainder: int,
    per: int,
    most_bytes: int,
    languages: int = LANGUAGES,
) -> tuple[DataFrame | None, int]:
    """Rows ``stratum, text`` with at most ``per`` texts of each language, and how many languages.

    The commonest languages are learned, equal ones by name. Texts are drawn from those of up to
    ``most_bytes``; a language with fewer of these is filled up with longer texts, up to ``per *
    most_bytes`` in all. A hash of the id thins each language to about one and a half times ``per``
    rows before any is brought together.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.col(lang).cast("string").alias("stratum"),
        F.col(text).alias("text"),
        F.octet_length(F.col(text)).cast("long").alias("size"),
    ).filter(~held_out(F.col(doc_id), modulus, remainder) & F.col("stratum").isNotNull() & F.col("size").isNotNull())
    counts = rows.groupBy("stratum").count().orderBy(F.desc("count"), "stratum").limit(languages)
    names = [row.stratum for row in counts.collect()]
    if not names:
        return None, 0
    return sampled(rows.filter(F.col("stratum").isin(names)), per, most_bytes).select("stratum", "text"), len(names)


_PACKED = ("classes", "firsts", "longer", "costs")


def learned(rows: DataFrame, contexts: int) -> dict[str, Tree]:
    """The tree of every language, each learned by the task that has its sample."""

    def each(table: pa.Table) -> pa.Table:
        tree = learn(table["text"].to_pylist(), contexts=contexts)
        arrays = {name: pa.array([value], pa.binary()) for name, value in tree.packed().items()}
        return pa.table({"stratum": table["stratum"].slice(0, 1), **arrays})

    schema = ", ".join(["stratum string", *(f"{name} binary" for name in _PACKED)])
    bodies = rows.select("stratum", F.col("text").cast("binary").alias("text"))
    found = bodies.groupBy("stratum").applyInArrow(each, schema).toArrow().to_pylist()
    return {row["stratum"]: Tree.of(row) for row in sorted(found, key=lambda r: r["stratum"])}


def identify(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    per: int = PER,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """The documents with ``held_out``, ``lang_pred``, ``score`` and ``code_bits``.

    ``score`` is the chance of the language if all learned ones are alike beforehand, and
    ``code_bits`` the length of its code. Columns of these names are replaced.
    """
    small_batches(docs.sparkSession)
    options = {"modulus": modulus, "remainder": remainder, "per": per, "most_bytes": most_bytes}
    rows, number = sample(docs, doc_id=doc_id, text=text, lang=lang, **options)
    trees = learned(rows, min(CONTEXTS, ALL_CONTEXTS // number)) if number else {}
    model = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("lang_pred string, score double, code_bits double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, trees = list(model.value), list(model.value.values())
        for batch in batches:
            bodies = [x or "" for x in batch]
            out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "code_bits": np.nan}, index=range(len(bodies)))
            known = [i for i, body in enumerate(bodies) if has_letter(body)]
            if trees and known:
                bits = code_lengths(trees, [bodies[i].encode("utf-8", "surrogatepass") for i in known])
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(known)), best]
                out.loc[known, "lang_pred"] = [names[j] for j in best]
                out.loc[known, "score"] = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
                out.loc[known, "code_bits"] = least
            yield out

    (found,) = fresh(docs, "found")
    plain = [c for c in docs.columns if c.lower() not in ("held_out", "lang_pred", "score", "code_bits")]
    return docs.withColumn(found, predict(F.col(text))).select(
        *[F.col(f"`{c}`") for c in plain],
        held_out(F.col(doc_id), modulus, remainder).alias("held_out"),
        F.col(f"{found}.lang_pred").alias("lang_pred"),
        F.col(f"{found}.score").alias("score"),
        F.nanvl(F.col(f"{found}.code_bits"), F.lit(None)).alias("code_bits"),
    )
