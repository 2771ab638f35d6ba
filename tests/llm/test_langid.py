"""Code lengths by a plain coder, letters, ties and many languages."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from stagewright.llm import langid

DOCS = "doc_id long, text string, lang string"


def plain_tree(texts, order, contexts):
    """The kept contexts of each order with the counts of what followed them."""
    followed = defaultdict(Counter)
    for text in texts:
        for i, byte in enumerate(text):
            for k in range(order + 1):
                context = text[i - k : i] if i >= k else None
                if context is not None and len(context) == k and 0 not in context and byte:
                    followed[context][byte] += 1
    kept = {b"": followed[b""]}
    for k in range(1, order + 1):
        those = [c for c in followed if len(c) == k and c[1:] in kept]
        those.sort(key=lambda c: (-followed[c].total(), c))
        kept |= {c: followed[c] for c in those[:contexts]}
    return kept


def plain_bits(kept, text, order):
    out = 0.0
    for i, byte in enumerate(text):
        context = next(text[i - k : i] for k in range(min(order, i), -1, -1) if text[i - k : i] in kept)
        chance = 1.0
        while True:
            counts = kept[context]
            total, different = counts.total(), len(counts)
            if total and counts[byte]:
                chance *= counts[byte] / (total + different)
                break
            if total:
                chance *= different / (total + different)
            if not context:
                chance /= 256
                break
            context = context[1:]
        out -= math.log2(chance)
    return out


@pytest.mark.parametrize("contexts", [3, 40, 10_000])
def test_code_lengths_against_a_plain_coder(contexts):
    rng = random.Random(contexts)
    alphabets = [b"ab ", b"abc\xc3\xa9", bytes(range(1, 40))]
    learned = [[bytes(rng.choices(a, k=rng.randint(0, 60))) for _ in range(20)] for a in alphabets]
    texts = [bytes(rng.choices(a + b"\xff", k=rng.randint(0, 80))) for a in alphabets for _ in range(5)] + [b"", b"a", b"\0\0a"]
    trees = [langid.learn(own, contexts=contexts) for own in learned]
    want = [[plain_bits(plain_tree(own, langid.ORDER, contexts), t, langid.ORDER) for own in learned] for t in texts]
    assert np.allclose(langid.code_lengths(trees, texts), want, rtol=1e-5, atol=1e-4)
    again = [langid.Tree.of(tree.packed()) for tree in trees]
    assert np.array_equal(langid.code_lengths(again, texts), langid.code_lengths(trees, texts))
    assert all(len(t.costs) <= 1 + 3 * contexts for t in trees)


def test_letters():
    assert not any(map(langid.has_letter, ["", "12 _ ...", "²½①Ⅷ", "\U0001f642", "٣"]))
    assert all(map(langid.has_letter, ["a", "²é", "1日", "Ⅷx"]))


def test_texts_without_letters_and_ties(spark):
    some = [(i, "same words here", lang) for i, lang in ((i // 2, "ba"[i % 2]) for i in range(40))]
    some += [(100 + i, t, None) for i, t in enumerate(["²½①Ⅷ", None, "", "same words"])]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(some, DOCS)).collect()}
    assert [got[100 + i].lang_pred for i in range(4)] == ["und", "und", "und", "a"]
    # Languages that learned alike share the score, and the first name wins.
    assert got[103].score == pytest.approx(0.5)


def test_many_languages_share_a_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "ALL_CONTEXTS", 400)
    rng = random.Random(1)
    letters = [bytes([97 + i % 26, 97 + (i * 7 + 3) % 26, 97 + (i // 26 * 5 + i * 5 + 11) % 26]).decode() for i in range(40)]
    some = [(i, " ".join("".join(rng.choices(letters[i % 40], k=4)) for _ in range(30)), f"l{i % 40:02d}") for i in range(1200)]
    docs = spark.createDataFrame(some, DOCS)
    rows, number = langid.sample(docs, doc_id="doc_id", text="text", lang="lang", modulus=5, remainder=0, per=50, most_bytes=4000)
    trees = langid.learned(rows, 10)
    assert number == 40 and all(len(t.costs) <= 31 for t in trees.values())
    got = langid.identify(docs).filter("held_out").join(docs.select("doc_id", F.col("lang").alias("own")), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.9
    few, two = langid.sample(docs, doc_id="doc_id", text="text", lang="lang", modulus=5, remainder=0, per=5, most_bytes=4000, languages=2)
    assert two == 2 and few.select("stratum").distinct().count() == 2
