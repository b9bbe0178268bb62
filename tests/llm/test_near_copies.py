"""Fingerprints, vectors and groups of links against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from helpers import collected, documents, odd_texts

import corpus_pipeline
from clubflow.llm import embedding_dedup, simhash_dedup
from clubflow.llm.common import components


def union(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in h) > len(h))


def test_simhash_matches_all_pairs(spark):
    rows = sorted(odd_texts())
    got = collected(simhash_dedup.near_duplicates(documents(spark, rows)))
    prints = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = union(len(rows), pairs)
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {
        rows[i][0]: (f"{prints[i]:016x}", rows[root[i]][0]) for i in range(len(rows))
    }


def test_the_stage_keeps_the_first_document_of_each_group(spark):
    rows = sorted(odd_texts(2))
    prints = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = union(len(rows), pairs)
    kept = corpus_pipeline.simhash_stage(spark, documents(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted({rows[r][0] for r in root})


def test_fingerprints_a_few_bits_apart_are_all_found(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                v ^= 1 << b
            values.add(v)
    values |= {0, 1, 3, 7, 2**64 - 1, 2**63}
    values = sorted(values, key=lambda v: v - 2**64 if v >> 63 else v)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    edges = simhash_dedup.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()
    at = {s: i for i, s in enumerate(signed)}
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    assert len(pairs) > 100
    assert union(len(values), [(at[e.a], at[e.b]) for e in edges]) == union(len(values), pairs)
    assert all((e.a ^ e.b) != 0 for e in edges)


@pytest.mark.parametrize("blocks,part", [(6, 40), (9, None), (12, None), (12, 25)])
def test_links_do_not_depend_on_blocks_and_parts(spark, blocks, part):
    """Many fingerprints in a few cells: few ones, so that cells of any number of blocks are large."""
    rng = random.Random(blocks)
    values = sorted({sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(500)} | {2**63, 2**64 - 1})
    signed = [v - 2**64 if v >> 63 else v for v in values]
    edges = simhash_dedup.links(spark.createDataFrame([(s,) for s in signed], "fp long"), blocks=blocks, part=part).collect()
    at = {s: i for i, s in enumerate(signed)}
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    assert union(len(values), [(at[e.a], at[e.b]) for e in edges]) == union(len(values), pairs)


def test_blocks_follow_the_number_of_fingerprints():
    found = [simhash_dedup.blocks_for(10**k) for k in range(13)]
    assert found == sorted(found) and found[0] == 6 and found[-1] == 12 and len(set(found)) > 4


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)]
    pairs = chain + star + [(7, 7), (3, 2), (2, 3)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {500: 500} | {i: 500 for i in range(501, 540)} | {2: 2, 3: 2}
    assert got == want


def test_components_do_not_return_unfinished(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(chain, rounds=1)


def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(12):
        center = rng.normal(size=16)
        rows += [(center + rng.normal(size=16) * rng.choice([0.1, 0.25, 0.4])) for _ in range(12)]
    rows = [r.astype(np.float32).tolist() for r in rows]
    rows += [rows[0], rows[0], [2 * x for x in rows[5]], [0.0] * 16, [-0.0] * 16, None, []]
    rows += [[None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    return [(1000 - 3 * i, v, i % 2) for i, v in enumerate(rows)]


@pytest.mark.parametrize("tile", [2048, 10])
def test_embeddings_match_all_pairs(spark, tile):
    rows = sorted(vectors(), key=lambda r: r[0])
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = collected(embedding_dedup.near_duplicates(table, tile=tile), "vec_id")

    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = []
    for i, (_, a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if good(a) and good(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                    pairs.append((i, j))
    root = union(len(rows), pairs)
    for i, (name, _, _) in enumerate(rows):
        n = sum(i in p for p in pairs)
        want = (n, rows[root[i]][0], root[i] == i)
        assert (got[name].n_links, got[name].component_id, got[name].kept) == want
    assert len(pairs) > 200


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 64))
    x[200:] = x[:200] + rng.normal(size=(200, 64)) * rng.uniform(0.1, 0.8, (200, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j, again = embedding_dedup.tile_links(x, x, 0.9)
    want = np.argwhere(x @ x.T >= 0.9)
    assert sorted(zip(i, j)) == sorted(map(tuple, want))
    assert again < len(want)


def test_wide_codes_are_summed_exactly():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-127, 128, (3, 5000)).astype(np.int8), rng.integers(-127, 128, (4, 5000)).astype(np.int8)
    assert (embedding_dedup.code_product(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicates(none).count() == 0
    docs = documents(spark, [(1, "a")]).where("doc_id > 5")
    assert simhash_dedup.near_duplicates(docs).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert [(r.n_links, r.kept) for r in embedding_dedup.near_duplicates(odd).collect()] == [(0, True)] * 2


@pytest.mark.parametrize("kind", ["double", "float"])
def test_vectors_whose_squares_overflow_or_vanish(spark, kind):
    rows = [(1, [1e-200, 0.0]), (2, [2e-200, 0.0]), (3, [1e200, 1e200]), (4, [2e200, 2e200]), (5, [0.0, 1.0]), (6, [5e-324, 5e-324]), (7, [0.0, 0.0])]
    if kind == "float":
        rows = [(i, [x ** (0.18 if x else 1) for x in v]) for i, v in rows]  # within the range of single precision
    table = spark.createDataFrame(rows, f"vec_id int, embedding array<{kind}>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    # the least double is zero in single precision
    n, own = (2, (2, 3)) if kind == "double" else (1, (0, 6))
    assert got == {1: (1, 1), 2: (1, 1), 3: (n, 3), 4: (n, 3), 5: (0, 5), 6: own, 7: (0, 7)}
