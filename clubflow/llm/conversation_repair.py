"""Repair of conversation structure by a grammar-compressed dynamic programme.

A repaired conversation has roles whose initials read ``(s?(ua)+)?``. Each row is kept, given another role or deleted,
empty rows may be inserted anywhere, and the cheapest edits are wanted, ties by the edits' initials (D, I, K, R).

A row becomes one of nine symbols (its role's initial, and whether it is whole, truncated or has to go). The sequences
of many conversations are compressed by Re-Pair: the most frequent pair of symbols becomes a new symbol, again and
again, and what is left of a sequence is halved in pairs. Every symbol has one matrix: for each state before and after
it, the least cost, the rank of its edits among the symbol's sixteen, and the state in the middle. The product of two
matrices is a (min, +) product. Edits over the same rows are never a proper prefix of each other, as each ends with the
edit of a row, so ranks decide every tie and no edit string is built before the end. The middle states make the rope
that the audit is read from. A rule is evaluated once, whatever the number of conversations that use it.

Rows are range-partitioned by conversation, turn and content, so a conversation of any size is spread over tasks.
Conversations inside a partition are finished there. Of those at its edges, or too large to hold, a partition gives one
matrix and the texts; the matrices are chained per conversation, and the texts pass through one task as a stream, which
the hash of the whole repaired conversation asks for. Equal rows are one row with a number of copies.

Null role or text is one space, as are null ids in the key that decides the damage. Rows of one turn come in the order
of a hash of role and text. Null turns come first; a null conv_id is a conversation. A number of gaps above the range
of long becomes its end.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import narrow, stored
from clubflow.llm.mixing import BLANKS

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = ("user", "assistant")
FAULTS = ("blank", "duplicate", "truncated")
#: A pair becomes a rule if it comes so often in a batch (only the speed depends on it).
LEAST_USES = 8
#: Rows, and bytes of text, that a task holds before it works them off.
BATCH_ROWS, BATCH_BYTES = 1 << 15, 8 << 20
#: States: nothing written, after s, after u, after a.
_START, _S, _U, _A = range(4)
_NEVER = 1 << 40
#: The symbol of a row that has to go; others are 2 * (place of the initial in "sua", 3 for others) + (truncated).
_GONE = 8
_INITIALS = "sua"


def _after(state: int, initial: str) -> int | None:
    """The state after writing a role of this initial, if it may come."""
    if initial == "s":
        return _S if state == _START else None
    if initial == "u":
        return _U if state != _U else None
    return _A if state == _U else None


def _terminal(symbol: int) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Costs, ranks and edits of a row: empty rows before it, then its own edit."""
    best: dict[tuple[int, int], tuple[int, bytes]] = {}

    def offer(p: int, q: int | None, cost: int, edits: bytes) -> None:
        if q is not None and (cost, edits) < best.get((p, q), (_NEVER, b"")):
            best[p, q] = cost, edits

    for p in range(4):
        state, cost, edits = p, 0, b""
        for _ in range(3):
            offer(p, state, cost + DELETE, edits + b"D")
            if symbol != _GONE:
                own, more = (*_INITIALS, "")[symbol // 2], TRUNCATED * (symbol % 2)
                if own:
                    offer(p, _after(state, own), cost + KEEP + more, edits + b"K")
                for initial in "ua":
                    offer(p, _after(state, initial), cost + REROLE + more, edits + b"R")
            state, cost, edits = _A if state == _U else _U, cost + INSERT, edits + b"I"
    order = {e: i for i, e in enumerate(sorted({e for _, e in best.values()}))}
    costs, ranks = np.full((4, 4), _NEVER, np.int64), np.zeros((4, 4), np.int64)
    words = [[b""] * 4 for _ in range(4)]
    for (p, q), (cost, edits) in best.items():
        costs[p, q], ranks[p, q], words[p][q] = cost, order[edits], edits
    return costs, ranks, words


def product(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs, ranks and middle states of one matrix (costs, ranks) after the other."""
    key = ((a[0][:, :, None] + b[0][None]) << 8) | (a[1][:, :, None] << 4) | b[1][None]
    middle = key.argmin(axis=1)
    least = key.min(axis=1)
    return np.minimum(least >> 8, _NEVER), np.unique(least & 255, return_inverse=True)[1].reshape(4, 4), middle


def close(costs: np.ndarray, ranks: np.ndarray) -> tuple[int, int, int]:
    """(cost, last state, empty rows at the end) of the best way from the start, for a matrix of the whole conversation."""
    ends = ((_START, 0), (_A, 0), (_U, 1), (_S, 2))
    cost, _, state, more = min((int(costs[_START, q]) + INSERT * k, int(ranks[_START, q]), q, k) for q, k in ends)
    return cost, state, more


class Grammar:
    """Rules shared by many sequences, with a matrix each."""

    _base = [_terminal(s) for s in range(_GONE + 1)]
    #: Rules for 2, 4, 8, … rows that have to go.
    POWERS = 40

    def __init__(self, sequences: list[np.ndarray], least: int = LEAST_USES):
        self.matrix = [(c, r) for c, r, _ in self._base]
        self.parts: list[tuple[int, int] | None] = [None] * len(self._base)
        self.middle: list[np.ndarray | None] = [None] * len(self._base)
        self.known: dict[tuple[int, int], int] = {}
        self.texts: dict[tuple[int, int, int], bytes] = {}
        for k in range(self.POWERS):
            self.rule(_GONE + k, _GONE + k)
        number: dict[bytes, int] = {}
        which = [number.setdefault(s.astype(np.int64).tobytes(), len(number)) for s in sequences]
        roots = self._compressed([np.frombuffer(s, np.int64) for s in number], least)
        self.roots = [roots[i] for i in which]

    def rule(self, a: int, b: int) -> int:
        new = self.known.get((a, b))
        if new is None:
            new = self.known[a, b] = len(self.matrix)
            costs, ranks, middle = product(self.matrix[a], self.matrix[b])
            self.matrix.append((costs, ranks))
            self.parts.append((a, b))
            self.middle.append(middle)
        return new

    def _compressed(self, sequences: list[np.ndarray], least: int) -> list[int]:
        """Re-Pair over all sequences, then what is left of each in pairs; the symbol of each whole sequence."""
        if not sequences:
            return []
        text = np.concatenate([x for s in sequences for x in (s, [-1])]).astype(np.int64)
        useless: set[int] = set()
        while len(text) > 1:
            a, b = text[:-1], text[1:]
            pairs = (a[(a >= 0) & (b >= 0)] << 32) | b[(a >= 0) & (b >= 0)]
            values, times = np.unique(pairs, return_counts=True)
            times[np.isin(values, list(useless))] = 0
            if not len(times) or times.max() < least:
                break
            pair = int(values[times.argmax()])
            left, right = pair >> 32, pair & 0xFFFFFFFF
            at = np.flatnonzero((a == left) & (b == right))
            if left == right:  # of neighbours that overlap every second one
                begins = np.r_[True, np.diff(at) > 1]
                at = at[(np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]) % 2 == 0]
                if len(at) < least:
                    useless.add(pair)
                    continue
            text[at] = self.rule(left, right)
            text = np.delete(text, at + 1)
        out, ends = [], np.flatnonzero(text < 0)
        for begin, end in zip(np.r_[0, ends[:-1] + 1].tolist(), ends.tolist()):
            symbols = text[begin:end].tolist()
            while len(symbols) > 1:
                symbols = [self.rule(*symbols[i : i + 2]) if i + 1 < len(symbols) else symbols[i] for i in range(0, len(symbols), 2)]
            out.append(symbols[0])
        return out

    def edits(self, symbol: int, p: int, q: int) -> bytes:
        """The edits of a symbol from one state to another."""
        if self.parts[symbol] is None:
            return self._base[symbol][2][p][q]
        found = self.texts.get((symbol, p, q))
        if found is None:
            a, b = self.parts[symbol]
            r = int(self.middle[symbol][p, q])
            found = self.edits(a, p, r) + self.edits(b, r, q)
            if len(found) <= 256:
                self.texts[symbol, p, q] = found
        return found


def symbols(codes: bytes, copies: list[tuple[int, int]]) -> np.ndarray:
    """Symbols of rows; further copies of row ``n`` have to go, so many that powers of two stand for them."""
    base = np.frombuffer(codes, np.uint8).astype(np.int64)
    if not copies:
        return base
    at, more = [], []
    for n, times in copies:
        bits = [k for k in range((times - 1).bit_length()) if (times - 1) >> k & 1]
        # the power 2**0 is the symbol itself, 2**k the k-th rule
        at += [n + 1] * len(bits)
        more += [_GONE + k for k in bits]
    return np.insert(base, at, more)


def kept(edits: bytes, copies: list[tuple[int, int]], rows: int) -> tuple[list[int], list[int]]:
    """Edits that write something, and the row of each (-1: an empty row)."""
    letters = np.frombuffer(edits, np.uint8)
    own = letters != ord("I")
    at = np.flatnonzero(letters != ord("D"))
    place = (np.cumsum(own) - 1)[at]
    if copies:
        times = np.ones(rows, np.int64)
        for n, t in copies:
            times[n] = t
        place = np.searchsorted(np.cumsum(times), place, side="right")
    return letters[at].tolist(), np.where(own[at], place, -1).tolist()


class Writer:
    """The repaired conversation: its hash, and its rows if they are wanted."""

    def __init__(self, rows: list | None = None):
        self.hash, self.rows, self.place, self.turn = hashlib.sha256(), rows, 0, 0

    def write(self, conv: int | None, letter: int, role: str, text: str) -> None:
        if letter == ord("K") and role[:1] == "s":  # only the first may be
            pass
        else:
            if letter != ord("K"):
                role = NAMES[self.turn % 2]
            if letter == ord("I"):
                text = ""
            self.turn += 1
        self.hash.update((("\n" if self.place else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        if self.rows is not None:
            self.rows.append({"kind": _TURN, "conv_id": conv, "ordinal": self.place, "role": role, "text": text})
        self.place += 1


#: Kinds of rows that a partition gives: a part of a conversation, a text of it, a finished conversation, a repaired row.
_PART, _TEXT, _DONE, _TURN = range(4)
_COUNTS = "blank long, duplicate long, truncated long, illegal long"
_GIVEN = (
    f"kind int, conv_id long, part int, ordinal long, role string, text string, gaps long, {_COUNTS}, cost long, audit string, "
    "repaired_sha256 string, first_turn long, last_turn long, turns long, first_initial string, last_initial string, "
    "costs array<long>, ranks array<long>, codes binary, copies binary"
)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in ddl.split(", ")])


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else min(last - first + 1 - turns, 2**63 - 1)


class _Run:
    """Neighbouring rows of one conversation, as counts, symbols and the texts that may stay."""

    def __init__(self, conv: int | None, edge: bool):
        self.conv, self.edge, self.spilled, self.bytes = conv, edge, False, 0
        self.codes, self.copies, self.texts = bytearray(), [], []
        self.counts, self.illegal = Counter(), 0
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str | None, copies: int, fault: int) -> None:
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        self.last_initial = initial
        self.illegal += copies - 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        self.counts[fault] += 1
        # a second copy of a row that is not blank says the same again
        self.counts[1 if fault == 1 else 2] += copies - 1
        n = len(self.codes)
        if fault in (1, 2):
            self.codes.append(_GONE)
        else:
            self.codes.append(2 * (_INITIALS.find(initial) if initial in tuple(_INITIALS) else 3) + (fault == 3))
            self.texts.append((n, role, text))
            self.bytes += len(text) + len(role) + 100
        if copies > 1:
            self.copies.append((n, copies))

    def sent(self, part: int) -> list[dict]:
        out = [{"kind": _TEXT, "conv_id": self.conv, "part": part, "ordinal": n, "role": r, "text": t} for n, r, t in self.texts]
        self.texts, self.bytes = [], 0
        return out

    def counted(self) -> dict:
        return {name: self.counts[k] for k, name in enumerate(FAULTS, 1)} | {"conv_id": self.conv, "illegal": self.illegal}


def _work_off(runs: list[_Run], part: int, with_rows: bool) -> Iterator[dict]:
    grammar = Grammar([symbols(bytes(r.codes), r.copies) for r in runs])
    for run, root in zip(runs, grammar.roots):
        costs, ranks = grammar.matrix[root]
        if run.edge or run.spilled:
            yield from run.sent(part)
            yield run.counted() | {
                "kind": _PART, "part": part, "first_turn": run.first_turn, "last_turn": run.last_turn, "turns": run.turns,
                "first_initial": run.first_initial, "last_initial": run.last_initial, "costs": costs.ravel().tolist(),
                "ranks": ranks.ravel().tolist(), "codes": zlib.compress(bytes(run.codes)),
                "copies": zlib.compress(np.array(run.copies, np.int64).tobytes()),
            }
            continue
        cost, state, more = close(costs, ranks)
        edits = grammar.edits(root, _START, state) + b"I" * more
        made: list | None = [] if with_rows else None
        writer, texts = Writer(made), {n: (r, t) for n, r, t in run.texts}
        for letter, row in zip(*kept(edits, run.copies, len(run.codes))):
            writer.write(run.conv, letter, *(texts[row] if row >= 0 else ("", "")))
        yield from made or ()
        yield run.counted() | {
            "kind": _DONE, "gaps": _gaps(run.first_turn, run.last_turn, run.turns), "cost": cost, "audit": edits.decode(),
            "repaired_sha256": writer.hash.hexdigest(),
        }


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("text") or "") + len(row.get("audit") or "") + len(row.get("codes") or "") + 100
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _solve(with_rows: bool, held: int = BATCH_BYTES):
    """Rows (conv_id, turn, role, text, copies, fault), in order, to what each conversation of the partition gives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        done: list[_Run] = []
        run, rows, size = None, 0, 0
        for conv, turn, role, text, copies, fault in _rows_of(batches):
            if run is None or conv != run.conv:
                if run is not None:
                    done.append(run)
                    rows, size = rows + len(run.codes), size + run.bytes
                    if rows > BATCH_ROWS or size > held:
                        yield from _work_off(done, part, with_rows)
                        done, rows, size = [], 0, 0
                run = _Run(conv, edge=run is None)
            run.add(turn, role, text, copies, fault)
            if run.bytes > held:  # too large to hold: its texts go on as they are
                run.spilled = True
                yield from run.sent(part)
        if run is not None:
            run.edge = True
            yield from _work_off([*done, run], part, with_rows)

    return lambda batches: _batched(work(batches), _schema(_GIVEN))


_CHAINED = f"conv_id long, part int, p int, q int, tail int, last int, gaps long, {_COUNTS}, cost long"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations, in order, to the states before and after each part; the last one has the sums."""
    names = ("conv_id", "part", *FAULTS, "illegal", "first_turn", "last_turn", "turns", "first_initial", "last_initial", "costs", "ranks")

    def one(parts: list[dict]) -> Iterator[dict]:
        whole, middles = None, []
        total, turns, first, last, before = Counter(), 0, None, None, None
        for x in parts:
            own = tuple(np.array(x[c], np.int64).reshape(4, 4) for c in ("costs", "ranks"))
            if whole is None:
                whole = own
            else:
                *whole, middle = product(whole, own)
                middles.append(middle)
                total["illegal"] += before + x["first_initial"] not in ("su", "ua", "au")
            before = x["last_initial"]
            for c in (*FAULTS, "illegal"):
                total[c] += x[c]
            if x["first_turn"] is not None:
                turns += x["turns"] - (x["first_turn"] == last)
                first, last = x["first_turn"] if first is None else first, x["last_turn"]
        cost, state, more = close(*whole)
        ends = [state]
        for middle in reversed(middles):
            ends.append(int(middle[_START, ends[-1]]))
        ends.reverse()
        for n, (x, p, q) in enumerate(zip(parts, [_START, *ends], ends)):
            out = {"conv_id": x["conv_id"], "part": x["part"], "p": p, "q": q, "tail": 0, "last": 0}
            if n == len(parts) - 1:
                out |= {"tail": more, "last": 1, "gaps": _gaps(first, last, turns), "cost": cost}
                out |= {c: total[c] for c in (*FAULTS, "illegal")}
            yield out

    def work() -> Iterator[dict]:
        held: list[dict] = []
        for row in _rows_of(batches):
            x = dict(zip(names, row))
            if held and held[0]["conv_id"] != x["conv_id"]:
                yield from one(held)
                held = []
            held.append(x)
        if held:
            yield from one(held)

    return _batched(work(), _schema(_CHAINED))


_STREAM = ("conv_id", "part", "ordinal", "role", "text", "codes", "copies", "p", "q", "tail", "last", "gaps", *FAULTS, "illegal", "cost")


def _finish(with_rows: bool):
    """Per conversation its parts, each before its texts, to the finished conversation; texts pass through."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        writer, audit, final = None, [], None
        letters: list[int] = []
        places: list[int] = []
        made: list | None = [] if with_rows else None
        now, at = None, 0

        def until(ordinal: int | None, role: str, text: str) -> None:
            nonlocal at
            while at < len(letters) and (places[at] < 0 or places[at] == ordinal):
                own = places[at] >= 0
                writer.write(now, letters[at], *((role, text) if own else ("", "")))
                at += 1
                if own:
                    return

        def finished() -> dict:
            until(None, "", "")
            return {k: final[k] for k in ("conv_id", "gaps", *FAULTS, "illegal", "cost")} | {
                "kind": _DONE, "audit": b"".join(audit).decode(), "repaired_sha256": writer.hash.hexdigest(),
            }

        for row in _rows_of(batches):
            x = dict(zip(_STREAM, row))
            if writer is None or x["conv_id"] != now:
                if writer is not None:
                    yield finished()
                writer, audit, now = Writer(made), [], x["conv_id"]
                letters, places, at = [], [], 0
            if x["codes"] is not None:
                until(None, "", "")
                codes = zlib.decompress(x["codes"])
                copies = np.frombuffer(zlib.decompress(x["copies"]), np.int64).reshape(-1, 2).tolist()
                grammar = Grammar([symbols(codes, copies)])
                edits = grammar.edits(grammar.roots[0], x["p"], x["q"]) + b"I" * x["tail"]
                audit.append(edits)
                letters, places = kept(edits, copies, len(codes))
                at, final = 0, x
            else:
                until(x["ordinal"], x["role"], x["text"])
            if made:
                yield from made
                made.clear()
        if writer is not None:
            yield finished()
            yield from made or ()

    return lambda batches: _batched(work(batches), _schema(_GIVEN))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after the damage that a hash of id and turn decides."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (
        rows.withColumn("damage", F.crc32(key.cast("binary")) % 20)
        .where("damage <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("damage") == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(F.col("damage") == 1, F.lit(""))
            .when(F.col("damage") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.when(F.col("damage") == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def _plain(rows: DataFrame) -> DataFrame:
    return narrow(rows, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )


def _place() -> Column:
    return F.struct(F.col("turn").isNotNull(), F.col("turn"))


def _solved(rows: DataFrame, with_rows: bool, held: int) -> DataFrame:
    """What `_solve` and `_finish` give for rows (conv_id, turn, role, text, copies) without nulls in role and text."""
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    distinct = stored(
        rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("said", said), "said"
    )
    # what a conversation says in more than one turn, and where first
    again = distinct.groupBy(F.col("conv_id").alias("of"), F.col("said").alias("what")).agg(F.min(_place()).alias("first"), F.count("*").alias("n"))
    again = again.where("n > 1").drop("n")
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    fault = (
        F.when(end == "", 1)
        .when(F.coalesce(F.col("first") < _place(), F.lit(False)), 2)
        .when(~end.isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    marked = (
        distinct.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("what")), "left")
        .withColumn("fault", fault)
        # what has to go needs no text
        .withColumn("text", F.when(~F.col("fault").isin(1, 2), F.col("text")))
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("said")]
    laid = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies", "fault")
    given = stored(laid.mapInArrow(_solve(with_rows, held), _GIVEN), "repairs")

    parts = given.where(f"kind = {_PART}")
    names = ["conv_id", "part", *FAULTS, "illegal", "first_turn", "last_turn", "turns", "first_initial", "last_initial", "costs", "ranks"]
    chained = parts.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_chain, _CHAINED)
    chained = chained.select(F.col("conv_id").alias("of"), F.col("part").alias("at"), *[c.split()[0] for c in _CHAINED.split(", ")[2:]])
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at"))
    heads = parts.select("conv_id", "part", F.lit(-1).cast("long").alias("ordinal"), "role", "text", "codes", "copies").join(chained, same)
    kinds = dict(heads.dtypes)
    texts = given.where(f"kind = {_TEXT}")
    own = {"conv_id", "part", "ordinal", "role", "text"}
    texts = texts.select(*[F.col(c) if c in own else F.lit(None).cast(kinds[c]).alias(c) for c in _STREAM])
    stream = heads.select(*_STREAM).unionAll(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "ordinal")
    return given.where(f"kind >= {_DONE}").unionAll(stream.mapInArrow(_finish(with_rows), _GIVEN))


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows: DataFrame, damage: bool = False, held: int = BATCH_BYTES) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): faults, cost, edits and the hash of what is repaired.

    With ``damage`` the rows are damaged first; a conversation that loses all its rows then has zeros. ``held``: bytes of
    text of a conversation that a task holds.
    """
    plain = _plain(rows)
    space = F.lit(" ")
    left = damaged(plain) if damage else plain.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).cast("long").alias("copies")
    )
    found = _solved(left, False, held).select(*RESULT)
    if not damage:
        return found
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    empty = plain.groupBy("conv_id").agg(F.max(F.crc32(key.cast("binary")) % 20).alias("most")).where("most = 0")
    zero = [F.lit(0).cast("long").alias(c) for c in RESULT[1:7]]
    return found.unionAll(empty.select("conv_id", *zero, F.lit("").alias("audit"), F.lit(hashlib.sha256(b"").hexdigest()).alias("repaired_sha256")))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: rows (conv_id, place, role, text)."""
    space = F.lit(" ")
    left = _plain(rows).select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).cast("long").alias("copies")
    )
    return _solved(left, True, BATCH_BYTES).where(f"kind = {_TURN}").select("conv_id", F.col("ordinal").alias("place"), "role", "text")
