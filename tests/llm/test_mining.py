"""Phrases, divergences and licenses: brute force, and the odd cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from stagewright.llm import divergence, licenses, passages, phrases
from stagewright.llm.queries import ORACLES, QUERIES
from workload.compare import connect, same

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "A b. a B, a b! a\tb c", "en", "a"),
    (3, "A b. a B, a b! a\tb c", "en", "a"),
    (None, "a b a b a b", None, None),
    (4, " \t\n\x0b ", "en", "b"),
    (5, "12 34 ... \U0001f642 日本語 日本語 日本語", "xx", "b"),
    (6, "the and of " * 20000, "en", "hot"),
    (7, "the and of " * 3 + "x" * 100_000, "en", "hot"),
]


def frame(spark, some=ODD, columns=DOCS):
    return spark.createDataFrame(some, columns).repartition(3)


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_phrases(some, support, top, covered=80):
    n, f = Counter(), Counter()
    for _, text, lang, _ in some:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in (1, 2, 3, 4):
                f.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    often = {g: a for g, a in f.items() if len(g) > 2 and a >= support}
    gone = set()
    for g, a in often.items():
        for m in range(2, len(g) - 1):
            for i in range(1, len(g) - m + 1):
                part = (g[0], *g[i : i + m])
                if 100 * a >= covered * f[part]:
                    gone.add(part)
    out = defaultdict(list)
    for g, a in often.items():
        if g in gone:
            continue
        cuts = []
        for k in range(1, len(g) - 1):
            left, right = f[g[: k + 1]], f[(g[0], *g[k + 1 :])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out[g[0]].append((-score, -a, " ".join(g[1:]), left, right))
    return {
        (lang, rank, phrase, -a, left, right, n[lang], -score)
        for lang, own in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own, key=lambda x: (x[0], x[1], x[2].encode()))[:top], 1)
    }


@pytest.mark.parametrize("shard", [40, 400, 1 << 22])
def test_phrases_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
    rng = random.Random(shard)
    words = ["a", "B", "é", "dd", "E", "日本"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "\t", ", ", "\n"]) for _ in range(rng.randint(0, 60)))
    some = [(i, text(), rng.choice(["en", "en", "xx", None, "und"]), None) for i in range(60)]
    got = {tuple(r) for r in phrases.top_phrases(frame(spark, some), support=5, top=40).collect()}
    assert got == brute_phrases(some, 5, 40)


def test_phrases_of_odd_rows(spark):
    got = {tuple(r) for r in phrases.top_phrases(frame(spark), support=3, top=50).collect()}
    assert got == brute_phrases(ODD, 3, 50) and len(got) == 5
    assert phrases.top_phrases(frame(spark, [])).count() == 0
    assert phrases.top_phrases(frame(spark, ODD[:2])).count() == 0


def test_phrases_with_clashing_columns(spark):
    docs = frame(spark).select("*", *[F.lit(1).alias(c) for c in ("h", "h1", "a", "n", "word", "rank", "m")])
    assert {tuple(r) for r in phrases.top_phrases(docs, support=3).collect()} == brute_phrases(ODD, 3, 2000)


def test_filters_hold_what_they_were_given(spark):
    rng = np.random.default_rng(3)
    held, other = (rng.integers(1, 1 << 62, (2, 3000)) for _ in range(2))
    table = spark.createDataFrame(list(zip(*held.tolist())), "h1 long, h2 long")
    bits = phrases.filter_of(table, ["h1", "h2"])
    assert bits.has(list(held)).all() and bits.has(list(other)).mean() < 0.02
    assert not phrases.filter_of(table.limit(0), ["h1"]).has([held[0]]).any()


def test_transducers_number_their_terms():
    rng = random.Random(5)
    terms = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 7))) for _ in range(400)} | {b"a" * 5000})
    machine = divergence.build(terms)
    others = [t + b"x" for t in terms] + [b"c" * 9, b"", b"zz"]
    assert machine.ordinals(terms).tolist() == list(range(len(terms)))
    assert (machine.ordinals(others) == -1).all()
    # No two states accept the same endings: as few states as there can be.
    short = terms[: terms.index(b"a" * 5000)] + terms[terms.index(b"a" * 5000) + 1 :]
    endings = {frozenset(t[len(p) :] for t in short if t.startswith(p)) for t in short for p in (t[:i] for i in range(len(t) + 1))}
    assert len(divergence.build(short).final) == len(endings)


def test_shares_are_exact():
    for total, kept in ((0, 1), (10**13, 5 * 10**8), (7 * 10**15, 3)):
        counts = [0, 1, 12345, min(total, 9 * 10**12), total]
        want = [1 + 10**9 * (c + 1) // (total + kept) for c in counts]
        assert divergence.share(np.array(counts), total, kept).tolist() == want


def brute_divergences(some, least=3, top=200):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))) for _, text, lang, source in some]
    out = set()
    for lang in {r[0] for r in rows}:
        docs = Counter(t for r in rows if r[0] == lang for t in set(r[2]))
        kept = sorted((t for t, n in docs.items() if n >= least), key=str.encode)
        counts = {s: Counter() for own, s, _ in rows if own == lang}
        for own, source, terms in rows:
            if own == lang:
                counts[source].update(t for t in terms if docs[t] >= least)
        share = lambda c, k=kept: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(k)) for t in k}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out |= {(lang, s, part, i, -v, r) for r, (v, i) in enumerate(ranked, 1) if part == "pair" or r <= top}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_divergences_against_brute_force(spark, monkeypatch, small):
    if small:
        # Many blocks, tiles, rounds and partial counts.
        for name, value in {"BLOCK": 3, "TILE": 2, "ROUND_BYTES": 2000, "KEPT_COUNTS": 20, "SPREAD": 2}.items():
            monkeypatch.setattr(divergence, name, value)
    rng = random.Random(8)
    words = ["ab", "ABC", "é", "b", "ba", "日本", "zz9zz", "c-d"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(0, 30)))
    some = [(i, text(), rng.choice(["en", "en", None, "xx"]), rng.choice(["s1", "s2", "hot", "hot", None, "é"])) for i in range(60)]
    some += [(1, "only once", "rare", "s1"), (2, None, "rare", "s2"), *ODD]
    got = [tuple(r) for r in divergence.audit(frame(spark, some), top=4).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_divergences(some, top=4)


def test_divergences_over_several_blocks_against_sql(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 256)
    monkeypatch.setattr(divergence, "TILE", 7)
    ok, detail = same(QUERIES["op12_divergence"](spark, SMALL), connect(SMALL), ORACLES["op12_divergence"])
    assert ok, detail


def test_divergences_of_nothing(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    docs = frame(spark).select("*", *[F.lit(1).alias(c) for c in ("term", "n", "block", "total", "item", "no")])
    assert {tuple(r) for r in divergence.audit(docs).collect()} == brute_divergences(ODD)


def least_edits(words, body):
    """The fewest edits of any place in the body that starts after a space and ends before one."""
    row = [0 if body[j - 1 : j] == " " else 10**6 for j in range(len(body) + 1)]
    for c in words:
        new = [row[0] + 1]
        for j in range(1, len(body) + 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != body[j - 1])))
        row = new
    return min((d for j, d in enumerate(row) if body[j : j + 1] == " "), default=10**6)


def test_notices_against_edit_distances():
    rng = random.Random(2)
    search = licenses.Search(licenses.BASE + licenses.NOTICES)
    caught = 0
    for turn in range(250):
        notice = rng.choice(licenses.NOTICES)
        letters = list(notice.words)
        for _ in range(rng.randint(0, notice.edits + 2)):
            at = rng.randrange(len(letters))
            letters[at] = rng.choice(["", "q", letters[at] + "z", letters[at]])
        around = " ".join(rng.choices(["the", "license", "under", "licensed", "mit", "x1"], k=rng.randint(0, 8)))
        body = f" {around} {''.join(letters)} {around} ".replace("  ", " ")
        found = search(body)
        least = least_edits(notice.words, body)
        mine = [f for f in found if search.notices[f.notice] == notice]
        if least <= notice.edits:
            # It is there, or a nearer notice lies over it.
            assert min((f.edits for f in mine), default=None) == least or any(f.edits < least for f in found)
            caught += bool(mine)
        else:
            assert not mine
        words = body.split()
        for f in found:
            part = " ".join(words[f.start : f.end])
            assert least_edits(search.notices[f.notice].words, f" {part} ") == f.edits
    assert caught > 150


def test_licenses_of_odd_rows(spark):
    text = "Licensed under the Apache Licence, Version 2.0. MIT License; mit-license CC BY-NC 4.0 ccby"
    many = "released undr the mit license " * 3000
    some = [*ODD, (8, text, None, None), (8, text, None, None), (9, many, None, None), (10, "ÀGNU general public license", None, None)]
    docs = frame(spark, some).select("*", F.lit("x").alias("found"), F.lit("y").alias("scan"), F.lit("z").alias("Score"))
    got = licenses.with_licenses(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "scan", "n_words", "found", "score"]
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in some)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_words, by_id[1].found, by_id[1].score) == (0, [], 0.0)
    assert by_id[8].n_words == 18
    assert [(f.label, f.start, f.end, f.edits) for f in by_id[8].found] == [
        ("apache", 0, 8, 1), ("mit", 8, 10, 0), ("mit", 10, 12, 0), ("cc-by", 12, 14, 0)
    ]
    assert by_id[8].score == 1.0
    nine = Counter((f.notice < 4, f.edits) for f in by_id[9].found)
    assert nine == {(True, 0): 3000, (False, 1): 3000}
    assert by_id[10].found == []
    assert licenses.with_licenses(frame(spark, [])).count() == 0


def test_base_phrases_of_the_table(spark):
    base = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op13_licenses"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts)
    for r in got:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(texts[r.doc_id]))
        places = [(i, label) for i in range(len(words)) for p, label in base.items() if words[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert bool(r.labels) == (r.score > 0)


@pytest.mark.parametrize("equal", [True, False])
def test_a_pair_of_runs_is_decided_by_its_suffixes_and_not_by_its_hashes(equal):
    rng = np.random.default_rng(3)
    one, other = (rng.integers(97, 123, 260).astype(np.uint8).tobytes() for _ in range(2))
    bodies = [one, one if equal else other, one[:230]]
    group = pd.DataFrame({
        "g1": 0, "g2": 0, "ranges": 0, "h": 5, "c": [7, 7, 8], "n": [2, 2, 1], "second": [0, 1, 0],
        "low": [100, 900, 40], "id": [1, 2, 3], "row": [11, 12, 13], "body": bodies,
    })
    got = passages._compare(200)(pd.concat([group, group]))
    found = set(zip(got["m1"], got["m2"], got["id"], got["row"], got["first"], got["last"], strict=True))
    alone = (0, -1, 3, 13, 40, 270)
    # The third run repeats the first, which is repeated in as far as the third or its equal has it.
    assert found == {alone, (5, -2, 7, 2, 0, 260 if equal else 230)}
