"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from stagewright.llm import (
    components,
    kdsearch,
    langid,
    mixing,
    passages,
    pieces,
    projected,
    quality,
    secrets,
    simhash,
    toxicity,
    training,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the and of " * 20000
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "plain words that say nothing much", "en", "a", 33),
    (3, "plain words that say nothing much", "en", "a", 33),
    (None, "plain words that say nothing much", None, None, 33),
    (4, " \t\n\x0b ", "en", "b", 5),
    (5, "12 34 ... \U0001f642 日本語", "xx", "b", 14),
    (6, LONG, "en", "hot", len(LONG)),
    (7, "ein Satz mit dem und der", "de", "hot", 24),
]
CLASHES = "row long, place long, found string, id long, blob string, spans string, cuts string, done string"


def frame(spark, some=ODD):
    return spark.createDataFrame(some, DOCS).repartition(3)


def clashing(spark):
    return frame(spark).select(
        "*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASHES.split(", ")]
    )


def labels(spark, some=()):
    return spark.createDataFrame(list(some), "doc_id long, quality int, toxic int")


KEPT = {
    "mix": lambda s, d: mixing.mix(d),
    "near": lambda s, d: simhash.keep_one(d),
    "mask": lambda s, d: secrets.redact(d, secrets.scan(d)),
    "toxic": lambda s, d: toxicity.without_toxic(d, labels(s)),
}
ADDED = {
    "plan": lambda s, d: mixing.plan(d, whole=True),
    "spans": lambda s, d: secrets.findings(d, secrets.scan(d)),
    "lang": lambda s, d: langid.identify(d),
    "quality": lambda s, d: quality.score(d, labels(s)),
    "toxicity": lambda s, d: toxicity.score(d, labels(s)),
    "pieces": lambda s, d: pieces.with_pieces(d),
    "passages": lambda s, d: passages.without_repeats(d),
}


@pytest.mark.parametrize("name", [*KEPT, *ADDED])
def test_empty_table(spark, name):
    assert (KEPT | ADDED)[name](spark, frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", ADDED)
def test_one_row_per_row_with_clashing_columns(spark, name):
    docs = clashing(spark)
    got = ADDED[name](spark, docs)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in ODD)
    assert len({c.lower() for c in got.columns}) == len(got.columns)


@pytest.mark.parametrize("name", KEPT)
def test_filters_keep_the_columns(spark, name):
    docs = clashing(spark)
    got = KEPT[name](spark, docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} <= {r[0] for r in ODD}


def test_near_copies_keep_one_of_alike_rows(spark):
    got = simhash.keep_one(frame(spark)).collect()
    # Texts without words are alike; an id goes before none.
    assert Counter(r.doc_id for r in got) == {1: 1, 3: 1, 5: 1, 6: 1, 7: 1}


def test_simhash_of_null_ids_and_short_texts(spark):
    got = simhash.clusters(frame(spark)).collect()
    by_text = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert by_text[1, 0] == by_text[2, 0] == by_text[4, 0] == 1
    assert {r.component_id for r in got if r.doc_id is None} == {3}
    alone = simhash.clusters(frame(spark, [(None, "a b", None, None, 3)])).collect()
    assert [r.component_id for r in alone] == [None]


@pytest.mark.parametrize("paired", [1, 4, 10_000])
def test_links_join_what_brute_force_joins(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(paired)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for b in base for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    roots = {r.node: r.root for r in components.components(links).collect()}
    want = {v: v for v in signed}

    def top(v):
        while want[v] != v:
            v = want[v]
        return v

    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                want[y] = x
    assert {v: roots.get(v, v) for v in signed} == {v: top(v) for v in signed}
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 2 for r in links.collect())


def test_components_of_chains_and_nothing(spark):
    chain = [(i, i + 1) for i in range(300)] + [(500, 1000), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 500: 500, 1000: 500}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_secret_kinds_and_places(spark):
    key, run = "AKIA" + "Q7" * 8, "0123456789abcdef01234567"
    texts = [
        f'é API_KEY = "{key}" x',
        "token=short; token=abcdef",
        f"secret: {run}, {run}{run}",
        'token="token\' = abcdefgh',
        "AKIAAKIA123 0123456789abcdef",
    ]
    docs = frame(spark, [(i, t, None, None, len(t)) for i, t in enumerate(texts)])
    got = {r.doc_id: r.spans for r in secrets.findings(docs, secrets.scan(docs)).collect()}
    said = {i: [(s.kind, texts[i][s.start : s.end]) for s in spans or ()] for i, spans in got.items()}
    assert said[0] == [("assign", f'API_KEY = "{key}'), ("access", key)]
    assert said[1] == [("assign", "token=abcdef")]
    assert said[2] == [("assign", f"secret: {run}"), ("hex", run), ("hex", run + run)]
    # The failed match used up the second word.
    assert said[3] == [] and said[4] == []
    masked = {r.doc_id: r for r in secrets.redact(docs, secrets.scan(docs)).collect()}
    assert masked[0].text == f'é {secrets.MASK}" x' and masked[0].n_chars == len(masked[0].text)
    assert masked[2].text == f"{secrets.MASK}, {secrets.MASK}"
    assert masked[4].text == texts[4]


def test_ledger_scans_unseen_pairs_only(spark):
    first = frame(spark, [(1, "token=abcdef", None, None, 12), (2, "token=abcdef", None, None, 12)])
    ledger = secrets.scan(first)
    assert ledger.count() == 3 and ledger.select("blob").distinct().count() == 1
    more = first.union(frame(spark, [(3, "x", None, None, 1)]))
    assert secrets.scan(more, ledger=ledger).count() == 3
    newer = tuple(
        secrets.Rule(r.kind, r.version + (r.kind == "hex"), r.pattern, r.group, r.least) for r in secrets.RULES
    )
    again = secrets.scan(first, ledger=ledger, rules=newer).collect()
    assert [(r.kind, r.version) for r in again] == [("hex", 2)]
    found = secrets.findings(more, ledger).collect()
    assert {r.doc_id: len(r.spans or ()) for r in found} == {1: 1, 2: 1, 3: 0}


def test_secrets_of_alike_rows_keep_their_places(spark):
    named, unnamed = "a password=hunter22 b token=abcdef", "x secret: 12345678 y token=ghijkl"
    some = [(n, named, None, None, len(named)) for n in (1, 1, 2)]
    some += [(None, unnamed, None, None, len(unnamed))] * 3 + [(3, unnamed + "!", None, None, 0)] * 2
    docs = frame(spark, some)
    want = {
        text: [(text.index(a), text.index(a) + len(a)) for a in matches]
        for text, matches in (
            (named, ("password=hunter22", "token=abcdef")),
            (unnamed, ("secret: 12345678", "token=ghijkl")),
            (unnamed + "!", ("secret: 12345678", "token=ghijkl")),
        )
    }
    ledger = secrets.scan(docs)
    got = secrets.findings(docs, ledger).collect()
    assert len(got) == len(some)
    assert all([(s.start, s.end) for s in r.spans] == want[r.text] for r in got)
    masked = Counter(r.text for r in secrets.redact(docs, ledger).collect())
    assert masked == {"a [SECRET] b [SECRET]": 3, "x [SECRET] y [SECRET]": 3, "x [SECRET] y [SECRET]!": 2}


def test_words_are_counted_as_the_pattern_finds_them(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", " a  b\x0bc ", "w w", "\x1ca\x85b\xa0c", "\U0001f642 \x00 é", LONG]
    found = spark.createDataFrame([(x,) for x in texts], "text string").select(
        mixing.word_count(F.col("text")).alias("n"), F.regexp_count("text", F.lit(mixing.WORD)).alias("m")
    )
    assert [r.n for r in found.collect()] == [None, 0, 0, 3, 2, 1, 3, 60000]
    assert all(r.n == r.m for r in found.collect())


def test_mix_of_a_hot_source_lands_near_its_target(spark):
    rng = random.Random(3)
    some = [(i, "w " * rng.randint(0, 60), None, "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(4000)]
    docs = frame(spark, some)
    drawn = mixing.plan(docs).collect()
    total = sum(r.mix_size for r in drawn)
    assert sum(r.mix_copies * r.mix_size for r in drawn) == pytest.approx(1.5 * total, rel=0.01)
    assert max(r.mix_copies for r in drawn) <= 2
    assert sorted(map(str, drawn)) == sorted(map(str, mixing.plan(docs).collect()))
    mixed = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert mixed == Counter({r.doc_id: r.mix_copies for r in drawn if r.mix_copies})


def vectors(spark, some):
    return spark.createDataFrame(some, "vec_id long, embedding array<double>")


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    some = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0]), (None, [1.0, 0.0]), (7, []), (8, [1.0])]
    table = vectors(spark, some)
    assert [r.vec_id for r in kdsearch.top_k(table).orderBy("rank").collect()] == [1, 6]
    got = projected.nearest(table).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1)]
    assert got[0].score == pytest.approx(0.5**0.5)
    assert kdsearch.top_k(vectors(spark, [])).count() == projected.nearest(vectors(spark, [])).count() == 0


def test_equal_vectors_tie_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr("stagewright.llm.vectors.SHARD_ROWS", 50)
    table = vectors(spark, [(i, [0.25, 0.5, -0.125]) for i in range(300)]).repartition(4)
    for search in (kdsearch.top_k, projected.nearest):
        got = search(table).filter("query_id = 50").orderBy("rank").collect()
        assert [r.vec_id for r in got] == [0, 1, 2, 3, 4]


def test_chi_square_quantile():
    assert projected.chi_square(15.507313, 8) == pytest.approx(0.95, abs=1e-6)
    assert projected.quantile(0.95, 8) == pytest.approx(15.507313, abs=1e-5)


def test_code_lengths_add_up(monkeypatch):
    trees = [langid.learn([b"abab abab"] * 3), langid.learn([b"cdcd cdcd"] * 3)]
    text = b"abcd \xff ab" * 50
    whole = langid.code_lengths(trees, [text, b"", b"abab"])
    monkeypatch.setattr(langid, "_PIECE", 7)
    assert np.allclose(langid.code_lengths(trees, [text, b"", b"abab"]), whole)
    assert (whole[1] == 0).all() and whole[2].argmin() == 0
    # Frozen chances of all bytes after a context add up to one.
    for tree in trees:
        unseen = 256 - (tree.costs.shape[1] - 1)
        sums = np.exp2(-tree.costs[:, 1:]).sum(axis=1) + unseen * np.exp2(-tree.costs[:, 0])
        assert (sums <= 1 + 1e-5).all()


def test_languages_without_letters_and_without_learning(spark):
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(frame(spark)).filter("doc_id in (1, 2, 4)").collect()}
    assert got == {(1, "und", 0.0), (2, "und", 0.0), (4, "und", 0.0)}
    bare = frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(bare).collect()} == {("und", 0.0)}


def free_ids(spark, modulus, remainder, n):
    out = spark.range(20 * n).filter(~toxicity.held_out(F.col("id"), modulus, remainder)).limit(n)
    return [r.id for r in out.collect()]


def test_samples_are_drawn_from_texts_that_fit(spark):
    ids = free_ids(spark, 5, 0, 80)
    # Class 1 has few short texts among many long ones, class 0 long ones only.
    texts = {i: ("s" if n < 5 else "l" * 500) + str(n) if n < 40 else "w" * (n + 60) for n, i in enumerate(ids)}
    # A text that is too long by itself does not stand in for one that fits.
    texts |= dict.fromkeys(ids[50:], "w" * 251)
    docs = frame(spark, [(i, t, None, None, 0) for i, t in texts.items()])
    known = labels(spark, [(i, None, int(n < 40)) for n, i in enumerate(ids)])
    options = {"modulus": 5, "remainder": 0, "per": 5, "most_chars": 50}
    got, y, share = training.labelled_texts(docs, known, "toxic", **options)
    assert {t for t, label in zip(got, y, strict=True) if label} == {texts[i] for i in ids[:5]}
    # As many whole texts as stay within 250 characters.
    long = [len(t) for t, label in zip(got, y, strict=True) if not label]
    assert len(long) == 2 and all(100 <= n < 110 for n in long)
    assert share == 0.5


def test_languages_of_long_texts_are_learned(spark):
    ids = free_ids(spark, 5, 0, 60)
    some = [(i, ("ab " if n < 4 else "ba " * 60) + str(n), "few", None, 0) for n, i in enumerate(ids[:40])]
    some += [(i, "cd " * 40 + str(n), "long", None, 0) for n, i in enumerate(ids[40:])]
    options = {"doc_id": "doc_id", "text": "text", "lang": "lang", "modulus": 5, "remainder": 0}
    rows, number = langid.sample(frame(spark, some), per=4, most_bytes=100, **options)
    found = {"few": [], "long": []}
    for row in rows.collect():
        found[row.stratum].append(row.text.encode())
    assert number == 2
    assert {t[:3] for t in found["few"]} == {b"ab "} and len(found["few"]) == 4
    assert 1 <= len(found["long"]) <= 3 and all(len(t) > 100 for t in found["long"])


def test_long_documents_are_learned_from_in_parts(monkeypatch):
    rng = random.Random(4)
    words = [[rng.choice("abcdefgh") * 2 for _ in range(n)] for n in (700, 3, 90)]
    y = np.array([1.0, 0, 1])
    model = toxicity.Model({"aa": 1, "bb": 2}, toxicity.initial(2))
    whole = toxicity._learn_batch(model, words, y)
    monkeypatch.setattr(toxicity, "LEARNED", 4)
    parts = toxicity._learn_batch(model, words, y)
    assert all(np.allclose(whole[k], parts[k], rtol=1e-3, atol=1e-6) for k in whole)


def test_pieces_of_odd_texts():
    vocabulary = pieces.load()
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    texts = ["", " ", "  a  b ", "▁x ▁▁", "é\n\n\tq  ", "日本語 テキスト\U0001f642", "x" * 3000, "\0 a", " "]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert decoder.decode(ids) == text
    words = [b" hello", b" world" * 30, b"\xe2\x96\x81", b"x"]
    counts, flat = pieces.search(vocabulary, words * 6)
    assert flat.tolist() == [i for w in words * 6 for i in pieces._search_one(vocabulary, w)]
    assert counts.tolist()[:4] == [len(pieces._search_one(vocabulary, w)) for w in words]


def test_pieces_that_cross_words_are_not_cut():
    own = [(0, b"a", -1.0), (1, b"b", -1.0), (2, b" ", -1.0), (3, b"a b", -0.5)]
    vocabulary = pieces.build(own, list(range(10, 266)))
    assert vocabulary.cuts == b""
    assert pieces.Encoder(vocabulary).encode(["a b"])[0].tolist() == [2, 3]


def test_gradients_of_the_network():
    model = toxicity.Model({"aa": 1, "bb": 2}, {k: v.astype(np.float64) for k, v in toxicity.initial(2).items()})
    docs = [["aa", "bb", "cc"] * 15, ["bb", "dd"], ["ee", "aa", "x"] * 3]
    y = np.array([1.0, 0, 1])

    def loss():
        total = []
        for words in docs:
            names = list(dict.fromkeys(words))
            gates = toxicity.gate_inputs(model.weights, toxicity.inputs(model, names)[0].astype(np.float64))
            flat = np.array([names.index(w) for w in words])
            grid, real = toxicity._grid(flat, *toxicity.windows(len(words)))
            logits = toxicity.run(model.weights, *gates, grid, real)[0]
            total.append(np.log(np.exp(logits.astype(np.float64)).sum()))
        p = toxicity.sigmoid(np.array(total))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    found = toxicity._learn_batch(model, docs, y)
    for name, weight in model.weights.items():
        at = np.unravel_index(np.abs(found[name]).argmax(), weight.shape)
        middle, step = weight[at], 1e-2
        weight[at] = middle + step
        more = loss()
        weight[at] = middle - step
        less = loss()
        weight[at] = middle
        assert (more - less) / (2 * step) == pytest.approx(float(found[name][at]), rel=0.02, abs=2e-6)


@pytest.mark.parametrize("size", [0, 1, 31, 32, 33, 48, 49, 1000])
def test_windows_cover_every_token(size):
    starts, sizes = toxicity.windows(size)
    assert set(range(size)) == {i for s, n in zip(starts, sizes, strict=True) for i in range(s, s + n)}
    assert all(n <= toxicity.WINDOW for n in sizes)


@pytest.mark.parametrize("length", [64, 200])
def test_suffix_arrays_find_repeated_windows(length):
    rng = random.Random(length)
    draw = lambda letters, n: bytes(rng.choice(letters) for _ in range(n))
    bodies = [draw(b"ab", rng.randint(0, 900)) for _ in range(25)]
    core = draw(b"abcdef", 700)
    bodies += [b[:200] + core[rng.randint(0, 300) : rng.randint(300, 700)] + b[-100:] for b in bodies]
    bodies += [b"z" * 600, bytes(500)]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    for flags, b in zip(passages.repeated_windows(bodies, length), bodies, strict=True):
        assert list(flags) == [seen[b[i : i + length]] > 1 for i in range(max(0, len(b) - length + 1))]


def test_suffix_order_is_the_suffix_array():
    rng = random.Random(1)
    runs = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(12)]
    flat = b"".join(runs)
    sizes = np.array([len(r) for r in runs])
    starts = np.cumsum(sizes) - sizes
    ends = np.repeat(starts + sizes, sizes)
    words = np.array([int.from_bytes(flat[i : min(i + 8, e)].ljust(8, b"\0"), "big") for i, e in enumerate(ends)], np.uint64)
    order, rank = passages.suffix_order(words, ends, np.repeat(np.arange(12), sizes))
    suffixes = [flat[i:e] for i, e in enumerate(ends)]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    assert (order[rank] == np.arange(len(flat))).all()


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(2)
    body = bytes(rng.choice(b"abcdef ") for _ in range(5000))
    whole = passages.anchors([body])
    monkeypatch.setattr(passages, "_PIECE", 700)
    cut = passages.anchors([body])
    spread = lambda found: {i: h for low, high, h in zip(*found[1:4], strict=True) for i in range(low, high + 1)}
    assert spread(whole) == spread(cut) and len(spread(whole)) == len(body) - 199


@pytest.mark.parametrize(("runs", "size"), [(8192, 1 << 20), (20, 4000)])
def test_passages_in_many_shards(spark, monkeypatch, runs, size):
    monkeypatch.setattr(passages, "SHARD_RUNS", runs)
    monkeypatch.setattr(passages, "SHARD_BYTES", size)
    rng = random.Random(5)
    draw = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    core = draw(500)
    some = [
        (i, draw(rng.randint(0, 500)) + (core[rng.randint(0, 150) : rng.randint(350, 500)] if i % 2 else "") + draw(rng.randint(0, 400)))
        for i in range(120)
    ]
    some += [(200, None), (201, ""), (None, some[3][1]), (None, some[3][1]), (5, some[7][1]), (300, "x" * 3000), (302, "x" * 199), (302, "x" * 199)]
    bodies = [(t or "").encode() for _, t in some]
    seen = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    want = Counter()
    for (number, _), b in zip(some, bodies, strict=True):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        want[number, int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()] += 1
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    got = passages.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in got) == want


@pytest.mark.parametrize("flip", [0, 1])
def test_every_document_stays_without_a_model(spark, caplog, flip):
    docs = frame(spark, [(i, f"words of text {i}", None, None, 0) for i in range(40)])
    out = docs.select("doc_id", toxicity.held_out(F.col("doc_id"), toxicity.MODULUS, toxicity.REMAINDER).alias("o"))
    held = {r.doc_id: r.o for r in out.collect()}
    assert len(set(held.values())) == 2
    # One class is held out or of other documents, or its texts have no words.
    known = [(i, None, int(o) ^ flip) for i, o in held.items()] + [(100, None, 1 ^ flip)]
    assert toxicity.without_toxic(docs, labels(spark, known)).count() == 40
    assert "every document is kept" in caplog.text
    blank = frame(spark, [(i, f"words {i}" if o else " " * (i % 2) + "x" * (i % 2), None, None, 0) for i, o in held.items()])
    assert toxicity.without_toxic(blank, labels(spark, [(i, None, i % 2 ^ flip) for i in held])).count() == 40


def test_the_temperature_does_not_take_the_only_row_of_a_class():
    texts = [f"plain words {i}" for i in range(5)] + ["vile vile vile"]
    model = toxicity.learn(texts, [0] * 5 + [1], 1 / 6)
    found = toxicity.Scorer(model).scores(texts)
    assert found[5] > 0.5 > found[:5].max()


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    frame(spark).write.parquet(f"{folder}/documents.parquet")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
    done = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in done} <= {1, 3, 5, 6, 7}
    assert all(r.n_pieces == len(r.pieces or ()) for r in done)


def test_pipeline_masks_drops_and_repeats(spark):
    folder = "/root/testdata/sf0.001"
    done = corpus_pipeline.run(spark, folder).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "simhash_near_dedup",
        "secret_scans",
        "mix_sources",
        "sentencepiece",
    ]
    decoder = pieces.Decoder(pieces.load())
    assert done and all(decoder.decode(r.pieces) == r.text and r.n_chars == len(r.text) for r in done)
    kept = spark.createDataFrame([(r.doc_id, r.text) for r in done], "doc_id long, text string").distinct()
    assert secrets.scan(kept).filter("size(spans) > 0").count() == 0
    assert simhash.keep_one(kept).count() == kept.count()


def test_own_columns_that_are_named_like_helpers(spark):
    docs = frame(spark).select("*", F.col("doc_id").alias("mix_size"), F.lit("x").alias("own_mix_size"), F.lit(1).alias("__id"), F.lit(2).alias("__row"))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert all(r.mix_size == r.doc_id and r.own_mix_size == "x" for r in mixed.collect())
    by_other_name = mixing.mix(docs.withColumnRenamed("doc_id", "mix_id"), doc_id="mix_id")
    assert Counter(r.mix_id for r in by_other_name.collect()) == Counter(r.doc_id for r in mixed.collect())
    got = passages.without_repeats(docs)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in ODD)


@pytest.mark.parametrize("heavy", [1, 10, 1 << 40])
def test_runs_of_any_commonness_are_found(spark, monkeypatch, heavy):
    monkeypatch.setattr(passages, "HEAVY", heavy)
    rng = random.Random(6)
    blocks = ["".join(rng.choices("abcdefgh ", k=260)) for _ in range(4)]
    texts = [rng.choice(blocks)[rng.randint(0, 20) :] + "".join(rng.choices("xyz", k=30)) + rng.choice(blocks) for _ in range(60)]
    docs = frame(spark, [(i, t, None, None, len(t)) for i, t in enumerate(texts)])
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for r in passages.without_repeats(docs).collect():
        gone = {j for i in range(len(texts[r.doc_id]) - 199) if seen[texts[r.doc_id][i : i + 200]] > 1 for j in range(i, i + 200)}
        assert r.n_removed == len(gone)
