"""The registered queries: against their SQL, or against brute force over the whole small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from stagewright.llm import kdsearch, pieces, projected, simhash
from stagewright.llm.queries import ORACLES, QUERIES
from workload.compare import connect, same

SMALL = "/root/testdata/sf0.001"


def rows(spark, name, folder=SMALL):
    return spark.read.parquet(f"{folder}/{name}.parquet").collect()


def test_thirteen_operators():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    ok, detail = same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert ok, detail


def test_simhash_against_brute_force(spark):
    docs = rows(spark, "documents")

    def fingerprint(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for blank in "\t\n\v\f\r":
            words = words.replace(blank, " ")
        words = [w for w in words.split(" ") if w]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    prints = {d.doc_id: fingerprint(d.text) for d in docs}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {(i, f"{prints[i]:016x}", find(i)) for i in prints}
    assert {tuple(r) for r in QUERIES["op6_simhash"](spark, SMALL).collect()} == want


def test_nearest_scores_ranks_and_recall(spark):
    table = {r.vec_id: np.array(r.embedding, float) for r in rows(spark, "embeddings")}
    found = defaultdict(list)
    for r in QUERIES["op5_nearest"](spark, SMALL).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r)
    assert set(found) == {i for i in table if i % projected.EVERY == 0}
    hits = 0
    for query, got in found.items():
        v = table[query]
        cosine = {i: x @ v / (np.linalg.norm(x) * np.linalg.norm(v)) for i, x in table.items() if i != query}
        best = sorted(cosine, key=lambda i: (-cosine[i], i))[:5]
        assert [r.rank for r in got] == [1, 2, 3, 4, 5]
        assert all(abs(cosine[r.vec_id] - r.score) < 1e-12 for r in got)
        assert [r.score for r in got] == sorted((r.score for r in got), reverse=True)
        hits += len({r.vec_id for r in got} & set(best))
    assert hits >= 0.9 * 5 * len(found)


def test_exact_topk_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr("stagewright.llm.vectors.SHARD_ROWS", 60)
    monkeypatch.setattr("stagewright.llm.vectors.QUERY_ROWS", 3)
    ok, detail = same(QUERIES["op3_exact_topk"](spark, SMALL), connect(SMALL), ORACLES["op3_exact_topk"])
    assert ok, detail


def test_pieces_against_brute_force(spark):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=pieces.MODEL)
    vocabulary = pieces.load()
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
    table = {
        model.id_to_piece(i).replace("▁", " ").encode(): (i, model.get_score(i))
        for i in range(model.get_piece_size())
        if not special(i)
    }
    longest = max(map(len, table))

    def best(text):
        body = b" " + text.encode() if text else b""
        score, back = [0.0] + [-1e300] * len(body), [None] * (len(body) + 1)
        for t in range(1, len(body) + 1):
            for n in range(min(longest, t), 0, -1):
                piece = table.get(body[t - n : t])
                if piece and score[t - n] + piece[1] > score[t]:
                    score[t], back[t] = score[t - n] + piece[1], (piece[0], n)
            if score[t - 1] + vocabulary.byte_score > score[t]:
                score[t] = score[t - 1] + vocabulary.byte_score
                back[t] = (int(vocabulary.byte_ids[body[t - 1]]), 1)
        out, t = [], len(body)
        while t:
            out.append(back[t][0])
            t -= back[t][1]
        return out[::-1]

    texts = {d.doc_id: d.text for d in rows(spark, "documents")}
    got = QUERIES["op8_pieces"](spark, SMALL).collect()
    assert len(got) == len(texts) and all(r.exact for r in got)
    for r in got:
        assert r.n_pieces == len(r.pieces)
        assert r.pieces == best(texts[r.doc_id])


def test_suffix_dedup_against_brute_force(spark):
    bodies = {d.doc_id: d.text.encode() for d in rows(spark, "documents")}
    seen = Counter(b[i : i + 200] for b in bodies.values() for i in range(len(b) - 199))
    want = set()
    for number, body in bodies.items():
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - 199):
            if seen[body[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = hashlib.sha256(np.frombuffer(body, np.uint8)[~gone].tobytes()).hexdigest()
        want.add((number, len(body), int(gone.sum()), spans, kept))
    assert any(w[2] for w in want)
    assert {tuple(r) for r in QUERIES["op10_suffix_dedup"](spark, SMALL).collect()} == want


@pytest.mark.parametrize(
    ("name", "label", "modulus", "remainder", "least"),
    [("op1_toxicity", "toxic", 5, 0, 0.85), ("op4_quality", "quality", 3, 1, 0.97)],
)
def test_held_out_accuracy(spark, name, label, modulus, remainder, least):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}
    assert set(got) == {d.doc_id for d in rows(spark, "documents", folder)}
    for number, r in got.items():
        assert r.held_out == (zlib.crc32(str(number).encode()) % modulus == remainder)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [x for x in rows(spark, "labels", folder) if got[x.doc_id].held_out]
    right = np.mean([got[x.doc_id].predicted == x[label] for x in held])
    assert right >= least


def test_held_out_languages(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op2_language"](spark, sf_dir).collect()}
    held = [d for d in rows(spark, "documents", sf_dir) if got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_masks_cover_every_pair_within_the_radius():
    found = [m & (1 << 64) - 1 for m in simhash.masks()]
    assert len(found) == 7
    for i in range(64):
        for j in range(i, 64):
            differ = 1 << i | 1 << j
            assert any(m & differ == 0 for m in found)


def test_large_values_are_compared_in_whole_numbers(spark):
    rows_ = [(0, [3e16, 1.0]), (1, [3e16, 2.0]), (2, [3e16, 3.0]), (3, [1.0, 1.0])]
    table = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    got = kdsearch.top_k(table).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3]
