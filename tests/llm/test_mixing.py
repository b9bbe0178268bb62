"""Source mixing against a plain version with sorting."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from clubflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Targets by repeated sharing, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in free)) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: Fraction(most * sizes[s]) for s in above}


def plain_mix(rows):
    """(doc_id, size, source_size, target, taken) of every row, sorting each source by hash."""
    measured = []
    for doc, text, source in rows:
        h = hashlib.md5(f"{'' if doc is None else doc}:{text or ''}".encode()).hexdigest()
        measured.append((doc, source, len(WORD.findall(text or "")), int(h[:15], 16)))
    sizes = defaultdict(int)
    for _, source, size, _ in measured:
        sizes[source] += size
    target = plain_targets(sizes)
    out = []
    for doc, source, size, h in measured:
        goal = int(target[source] + Fraction(1, 2))
        times, need = divmod(goal, sizes[source]) if sizes[source] else (0, 0)
        below = sum(s for _, o, s, k in measured if o == source and k < h)
        same = sum(s for _, o, s, k in measured if o == source and k == h)
        part = size if below + same <= need else max(0, size * (need - below) // same if below < need else 0)
        out.append((doc, size, sizes[source], float(target[source]), times * size + part))
    return sorted(out, key=str)


def table(spark, rows):
    full = [(d, t, s, 1, "x", 2, 3, 4) for d, t, s in rows]
    kinds = "doc_id long, text string, source string, size int, hash string, part int, target int, `of` int"
    return spark.createDataFrame(full, kinds).repartition(3)


def odd_rows(seed: int):
    rng = random.Random(seed)
    rows = [(None, None, None), (1, "a b", None), (2, None, "é"), (3, "", "é"), (4, " \t\n", "z"), (5, "x\x1cy \x0bq", "\U0001f600")]
    rows += [(6, "same row twice", "b")] * 5 + [(7, "w " * 3000, "b")]
    for i in range(200):
        source = rng.choice(["a"] * 6 + ["b", "c", "d", None, "￿", "\U00010000"])
        rows.append((10 + i, "\n".join(rng.choices(["u", "vv", "www"], k=rng.randint(0, 60))), source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_matches_plain_version(spark, seed):
    rows = odd_rows(seed)
    got = sorted((tuple(r) for r in mixing.mix(table(spark, rows)).collect()), key=str)
    want = plain_mix(rows)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    taken, size, target = defaultdict(int), {}, {}
    source = {d: s for d, _, s in rows}
    for doc, n, own, aim, t in got:
        assert 0 <= t <= 3 * n
        taken[source[doc]] += t
        size[source[doc]], target[source[doc]] = own, aim
    for s in taken:  # only rows of one hash share words, rounded down
        assert target[s] - 6 <= taken[s] <= target[s] + 0.5


def test_many_equal_rows_share_what_is_missing(spark):
    rows = [(1, "a b c d", "s")] * 40 + [(2, "q " * 500, "t")]
    got = mixing.mix(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_mix(rows)


def test_one_long_document_of_a_source_is_cut(spark):
    rows = [(1, "w " * 1000, "a"), (2, "v " * 1000, "b")]
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(table(spark, rows)).collect()} == {1: 667, 2: 1333}


def test_mixed_gives_the_copies_with_all_columns(spark):
    rows = odd_rows(3)
    docs = table(spark, rows)
    taken = defaultdict(int)
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    texts = defaultdict(set)
    for d, t, _ in rows:
        texts[d].add(t)
    for r in mixed.collect():
        found = WORD.findall(r["text"])
        assert found == WORD.findall(next(t for t in texts[r["doc_id"]]))[: len(found)]
        words[r["doc_id"]] += len(found)
    assert dict(words) == {d: t for d, t in taken.items() if t}


def test_reruns_agree_however_the_rows_are_dealt_out(spark):
    docs = table(spark, odd_rows(4))
    first = sorted(map(str, mixing.mix(docs).collect()))
    assert first == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_no_rows_and_no_words(spark):
    assert mixing.mix(table(spark, [(1, "a", "s")]).limit(0)).collect() == []
    assert [tuple(r) for r in mixing.mix(table(spark, [(1, None, "s")])).collect()] == [(1, 0, 0, 0.0, 0)]


def test_int_ids_and_other_weights(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (2, "d e f", "t")], "doc_id int, text string, source string")
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, weights=(5, 1)).collect()}
    assert got == {1: 5, 2: 1}
