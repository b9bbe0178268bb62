"""Conversation repair against a search through all edits, and against a plain row-by-row programme."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from clubflow.llm import conversation_repair as cr

GOOD = re.compile(r"(s?(ua)+)?")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def marked(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        rest = text.strip(BLANK)
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def all_edits(rows):
    """The cheapest audit and its conversation, from every way to edit a few rows."""
    choices = []
    for role, text, fault in rows:
        own = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            own += [("K", more, (role, text)), ("R", 3 + more, ("user", text)), ("R", 3 + more, ("assistant", text))]
        choices.append(own)
    gaps = [[], [("I", 3, ("user", ""))], [("I", 3, ("assistant", ""))]] + [
        [("I", 3, (a, "")), ("I", 3, (b, ""))] for a, b in (("user", "assistant"), ("assistant", "user"))
    ]
    best = None
    for own in itertools.product(*choices):
        for empty in itertools.product(gaps, repeat=len(rows) + 1):
            steps = [*empty[0]]
            for edit, gap in zip(own, empty[1:]):
                steps += [edit, *gap]
            cost = sum(s[1] for s in steps)
            if best and cost > best[0]:
                continue
            kept = [s[2] for s in steps if s[2]]
            if not GOOD.fullmatch("".join(r[:1] or "?" for r, _ in kept)):
                continue
            this = cost, "".join(s[0] for s in steps), kept
            best = min(best, this, key=lambda b: b[:2]) if best else this
    return best


def plain(rows):
    """The same, row by row with whole strings: state -> (cost, audit, kept)."""
    move = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    reach = {"": (0, "", ())}

    def better(to, q, offer):
        if q not in to or offer[:2] < to[q][:2]:
            to[q] = offer

    def with_empty(reach):
        out = dict(reach)
        for _ in range(2):
            for p, (c, e, k) in list(out.items()):
                for role in ("user", "assistant"):
                    if (p, role[0]) in move:
                        better(out, move[p, role[0]], (c + 3, e + "I", (k, (role, ""))))
        return out

    for role, text, fault in rows:
        new: dict = {}
        # every prefix that ends in empty rows, also the dearer ones: they can tie again later
        before = {p: [v] for p, v in reach.items()}
        for _ in range(2):
            for p, offers in list(before.items()):
                for c, e, k in list(offers):
                    for name in ("user", "assistant"):
                        if (p, name[0]) in move and not e.endswith("II"):
                            before.setdefault(move[p, name[0]], []).append((c + 3, e + "I", (k, (name, ""))))
        for p, offers in before.items():
            for c, e, k in offers:
                better(new, p, (c + 4, e + "D", k))
                if fault not in ("blank", "duplicate"):
                    c += 3 * (fault == "truncated")
                    if (p, role[:1]) in move:
                        better(new, move[p, role[:1]], (c, e + "K", (k, (role, text))))
                    for name in ("user", "assistant"):
                        if (p, name[0]) in move:
                            better(new, move[p, name[0]], (c + 3, e + "R", (k, (name, text))))
        reach = new
    ends = [v for p, v in with_empty(reach).items() if p in ("", "a")]
    cost, audit, chain = min(ends, key=lambda v: v[:2])
    kept = []
    while chain:
        chain, row = chain
        kept.append(row)
    return cost, audit, kept[::-1]


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def want_row(conv, rows, solve=plain):
    rows = sorted(rows, key=order)
    m = marked([(r, t) for _, r, t in rows])
    cost, audit, kept = solve(m)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for r, _, _ in m]
    return (
        conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[sum(f == n for _, _, f in m) for n in cr.FAULTS],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


def table(spark, rows, parts=3):
    full = [(c, t, r, x, 1, "k", 2, "b", 3) for c, t, r, x in rows]
    kinds = "conv_id long, turn long, role string, text string, part int, kind string, copies int, said string, fault int"
    return spark.createDataFrame(full, kinds).repartition(parts)


def compare(spark, rows, solve=plain, damage=False, convs=None, **more):
    groups: dict = {c: [] for c in convs or ()}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    got = sorted((tuple(r) for r in cr.repair(table(spark, rows), **more).collect()), key=str)
    assert got == sorted((want_row(c, g, solve) for c, g in groups.items()), key=str)


def random_rows(rng, convs, most, roles=("system", "user", "assistant")):
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            text = rng.choice(["a.", "b", "c?", "", " \t", "d!", "e. ", f"own {c} {t}.", f"open {t}", "x\x1f", "é。", "."])
            rows.append((c, t + rng.choice([0, 0, 0, 3]), rng.choice(roles), text))
    return rows


def test_every_edit_of_short_conversations(spark):
    rng = random.Random(1)
    rows = random_rows(rng, 150, 3, ("system", "user", "assistant", "tool", "", "s", "ux"))
    compare(spark, rows, all_edits)


def test_longer_conversations_with_repeats_and_nulls(spark):
    rng = random.Random(2)
    rows = random_rows(rng, 300, 14)
    rows += [rows[i] for i in rng.sample(range(len(rows)), 60)]
    rows += [(rng.choice([None, 1000, 1001]), rng.choice([None, 1, 2, 9]), rng.choice([None, "user", "assistant"]), rng.choice([None, "z.", "y"])) for _ in range(25)]
    compare(spark, rows)


def one_long(rng, n):
    return [(5, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice([f"{t}.", f"{t}", "again.", ""])) for t in range(n)]


@pytest.fixture
def many_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_conversations_cut_by_partitions(spark, many_partitions):
    rng = random.Random(3)
    compare(spark, random_rows(rng, 40, 9) + [(c + 100, t, r, x) for c, t, r, x in one_long(rng, 700)])


def test_texts_too_large_to_hold(spark):
    rng = random.Random(4)
    rows = random_rows(rng, 20, 5) + [(50 + c, t, r, x) for c in range(3) for _, t, r, x in one_long(rng, 90)]
    compare(spark, rows, held=300)


def test_many_equal_rows(spark):
    rows = [(1, 3, "user", "same.")] * 500 + [(1, 4, "assistant", "yes.")] + [(1, 2, "assistant", "")] * 33 + [(2, 1, "user", "x.")]
    compare(spark, rows)


def test_damage(spark):
    rng = random.Random(5)
    rows = random_rows(rng, 400, 4) + [(None, None, None, None), (7000, None, "user", "Hello. There")]
    left: list = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        left += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    lost = {c for c, *_ in rows} - {c for c, *_ in left}
    assert lost
    groups: dict = {}
    for c, *row in left:
        groups.setdefault(c, []).append(tuple(row))
    want = [want_row(c, g) for c, g in groups.items()] + [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in lost]
    got = cr.repair(table(spark, rows), damage=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_repaired_turns(spark, many_partitions):
    rng = random.Random(6)
    rows = random_rows(rng, 60, 8)
    found: dict = {}
    for r in cr.repaired_turns(table(spark, rows)).collect():
        found.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    for c in range(60):
        own = sorted(((t, r, x) for k, t, r, x in rows if k == c), key=order)
        _, _, kept = plain(marked([(r, x) for _, r, x in own]))
        assert [(r, x) for _, r, x in sorted(found.get(c, []))] == kept


def test_no_rows_and_int_columns(spark):
    assert cr.repair(table(spark, [(1, 1, "user", "a.")]).limit(0), damage=True).collect() == []
    small = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], "conv_id int, turn int, role string, text string")
    assert cr.repair(small).first()["audit"] == "KK"


def test_grammar_says_the_same_however_it_is_built():
    rng = np.random.default_rng(7)
    sequences = [rng.integers(0, 9, rng.integers(1, 60)) for _ in range(200)] + [np.full(1000, 8), np.tile([2, 4], 500)]
    one, other = cr.Grammar(sequences, least=2), cr.Grammar(sequences, least=1 << 40)
    for a, b in zip(one.roots, other.roots):
        assert (one.matrix[a][0] == other.matrix[b][0]).all()
        cost, state, more = cr.close(*one.matrix[a])
        assert (cost, state, more) == cr.close(*other.matrix[b])
        assert one.edits(a, 0, state) == other.edits(b, 0, state)
