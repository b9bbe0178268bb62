"""SimHash near-duplicates: pivot distance tables find all fingerprints a few bits apart.

Each text gets a 64-bit fingerprint of its 3-word shingles. Reference fingerprints (pivots) turn a fingerprint
into a row of Hamming distances; two fingerprints at most ``d`` bits apart differ by at most ``d`` in every
distance. The first pivots are 0 and one mask per block of bits: their distances fix the number of ones per block,
and the distance vectors that lie within the bound can be listed, so a fingerprint meets exactly the cells that
can hold a partner. The number of blocks follows the number of fingerprints, so that cells stay small, and a cell that is
large all the same is cut into parts that meet pair by pair. In a cell the distances to all other pivots discard pairs
by their largest difference, and the survivors are verified by their differing bits.

Null text counts as empty; an empty text has the fingerprint zero and links like any other. Equal fingerprints are
one node, so groups of copies cost one row. Repeated doc_ids give one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import components, local_components, narrow, ragged, raw_bytes, slices, stored

SHINGLE = 3
SEED = 42
BITS = 2
#: Least and greatest number of blocks of bits that the first pivots mark.
BLOCKS = (6, 12)
#: Further reference fingerprints, and pairs of a cell looked at in one step.
PIVOTS = 16
STEP = 1 << 21
#: Fingerprints of one cell that one task holds at a time, twice.
PART_PRINTS = 20_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit k is set when over half of the shingles' XXH64 values have it set."""
    hashes = _hashes(text, shingle)
    return int(_majority(hashes[:, None])[0]) if len(hashes) else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        values = [fingerprint(t) for t in batch.column(1).to_pylist()]
        signed = np.array(values, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    return narrow(docs, "doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)] if words else [], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    return np.array(
        [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=False)], dtype=np.uint64
    )


def _majority(hashes: np.ndarray) -> np.ndarray:
    """For values (n, words) of 64 bits: the bits set in over half of the rows."""
    n, words = hashes.shape
    ones = np.zeros(64 * words, np.int64)
    raw = np.ascontiguousarray(hashes).view(np.uint8).reshape(n, 8 * words)
    for i in range(0, n, 255):  # up to 255 ones fit in a byte
        ones += np.unpackbits(raw[i : i + 255], axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > n, bitorder="little").view("<u8")


def _masks(blocks: int) -> np.ndarray:
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    return np.array([((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])], dtype=np.uint64)


def pivots(count: int, words: int = 1, seed: int = 7) -> np.ndarray:
    """Reference fingerprints of so many 64-bit words."""
    return np.random.default_rng(seed).integers(0, 2**64, (count, words), dtype=np.uint64)


def blocks_for(prints: int) -> int:
    """Blocks for so many different fingerprints: about as many cells as fingerprints, within ``BLOCKS``.

    The ones of a block of 64 / b random bits spread over about 16.5 / sqrt(b) values. More blocks also mean more cells
    that a fingerprint visits, so no more than needed.
    """
    least, most = BLOCKS
    return next((b for b in range(least, most) if prints <= 4 * (16.5 / b**0.5) ** b), most)


def _offsets(blocks: int, bits: int) -> np.ndarray:
    """All differences of ones per block that ``bits`` or fewer flips can make, one of each opposite pair."""
    found = {(0,) * blocks}
    for _ in range(bits):
        found |= {
            tuple(v + s * (i == j) for j, v in enumerate(f)) for f in found for i in range(blocks) for s in (-1, 1)
        }
    return np.array(sorted(f for f in found if f >= (0,) * blocks))


def _cells(fp: np.ndarray, blocks: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, probe): each fingerprint at home in its own cell, and a probe in each cell with possible partners."""
    masks, sizes = _masks(blocks), np.bitwise_count(_masks(blocks)).astype(np.int64)
    # distance to pivot 0 and to the mask of a block give the ones of the block
    d0 = np.bitwise_count(fp).astype(np.int64)
    ones = np.stack([(d0 - np.bitwise_count(fp ^ m).astype(np.int64) + s) // 2 for m, s in zip(masks, sizes)], axis=1)
    shift = np.int64(64 // blocks + 2) ** np.arange(blocks)
    home = ones @ shift
    rows, cells, probe = [np.arange(len(fp))], [home], [np.zeros(len(fp), bool)]
    for o in offsets:
        if not o.any():
            continue
        moved = ones + o
        ok = ((moved >= 0) & (moved <= sizes)).all(axis=1)
        rows.append(np.flatnonzero(ok))
        cells.append((home + o @ shift)[ok])
        probe.append(np.ones(int(ok.sum()), bool))
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(probe)


def _binary(prints: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(prints).astype("<u8")
    width = 8 * prints.shape[1]
    ends = np.arange(len(prints) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(prints), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _spread(blocks: int, bits: int):
    offsets = _offsets(blocks, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.asarray(batch.column(0)).view(np.uint64)
            for i in range(0, len(whole), 20_000):
                fp = whole[i : i + 20_000]
                row, cell, probe = _cells(fp, blocks, offsets)
                near = fp[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(near.view(np.int64)), pa.array(probe), _binary(near[:, None])],
                    names=["cell", "name", "probe", "print"],
                )

    return run


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


def _verified(first, second, prints: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Which of the pairs of rows are links: first by the table of distances to the pivots, then bit by bit."""
    keep = np.arange(len(first))
    for column in table.T:
        keep = keep[np.abs(column[first[keep]] - column[second[keep]]) <= bits]
    return keep[_apart(prints[first[keep]], prints[second[keep]]) <= bits]


def _forest(cell: np.ndarray, name: np.ndarray, prints: np.ndarray, probe: np.ndarray, others: np.ndarray, bits: int):
    """A spanning forest of the links inside each cell, as pairs of names; never all pairs of a cell.

    Rows come ordered by cell, those at home first. A row at home meets the later rows of its cell, ``STEP`` pairs
    at a time.
    """
    nodes, at = np.unique(name, return_inverse=True)
    # the pivot distance table of these rows
    table = np.stack([_apart(prints, p) for p in others], axis=1) if len(others) else np.zeros((len(prints), 0), np.int16)
    label = np.arange(len(nodes))
    edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.repeat(np.r_[edge[1:], len(cell)], np.diff(np.r_[edge, len(cell)]))
    homes = np.flatnonzero(~probe)
    homes = homes[ends[homes] - homes > 1]
    counts = ends[homes] - homes - 1
    total = np.cumsum(counts)
    start = 0
    while start < len(homes):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + STEP, side="right")))
        first = np.repeat(homes[start:stop], counts[start:stop])
        second = ragged(homes[start:stop] + 1, counts[start:stop])
        hit = _verified(first, second, prints, table, bits)
        if len(hit):
            label = local_components(len(label), label[at[first[hit]]], label[at[second[hit]]])[label]
        start = stop
    joined = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[joined], nodes[label[joined]]


def _linker(count: int, bits: int):
    """Links of rows (cell, name, probe, print) ordered by cell and probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = None
        held: list[pa.RecordBatch] = []

        def ready(part: list[pa.RecordBatch]) -> pa.RecordBatch:
            cell = np.concatenate([np.asarray(b.column(0)) for b in part])
            name = np.concatenate([np.asarray(b.column(1)) for b in part])
            probe = np.concatenate([np.asarray(b.column(2).cast(pa.int8())) for b in part]).astype(bool)
            prints = np.concatenate([raw_bytes(b.column(3))[0] for b in part]).view("<u8").reshape(len(cell), -1)
            nonlocal others
            if others is None:
                others = pivots(count, prints.shape[1])
            a, b = _forest(cell, name, prints, probe, others, bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.asarray(batch.column(0))
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            if cut or (held and np.asarray(held[-1].column(0))[-1] != cell[0]):
                done = held + ([batch.slice(0, cut)] if cut else [])
                if done:
                    yield ready(done)
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield ready(held)

    return run


_CELLS = "cell long, name long, probe boolean, print binary"


def _linked(cells: DataFrame, bits: int, count: int) -> DataFrame:
    return (
        cells.repartition(F.col("cell"))
        .sortWithinPartitions("cell", "probe")
        .mapInArrow(_linker(count, bits), "a long, b long")
    )


def links(
    prints: DataFrame, bits: int = BITS, blocks: int | None = None, count: int = PIVOTS, part: int | None = None
) -> DataFrame:
    """(a, b): a spanning set of the links between distinct fingerprints (column ``fp``) at most ``bits`` apart.

    ``part``: fingerprints of a cell that a task holds at a time, twice.
    """
    cells = prints.mapInArrow(_spread(blocks or blocks_for(prints.count()), bits), _CELLS)
    part = part or PART_PRINTS
    large = stored(_large(cells, "cell", F.lit(1), part), "large")
    if large.limit(1).count():
        cells = _tiled(cells, "cell", large).select(F.col("tile").alias("cell"), "name", "probe", "print")
    return _linked(cells, bits, count)


def near_duplicates(docs: DataFrame, bits: int = BITS, blocks: int | None = None, count: int = PIVOTS) -> DataFrame:
    """Rows (doc_id, fp, fingerprint, component_id, n_same): 16 hex digits; smallest doc_id reachable; copies."""
    prints = stored(fingerprints(docs), "fingerprints")
    nodes = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_same")), "nodes"
    )
    found = components(links(nodes.select("fp"), bits, blocks, count)).withColumnRenamed("node", "fp")
    groups = nodes.join(found, "fp", "left").select(
        "fp", "first_id", "n_same", F.coalesce("component", "fp").alias("component")
    )
    groups = stored(groups, "groups")
    least = groups.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = groups.join(least, "component").select("fp", "component_id", "n_same")
    return prints.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same"
    )


def _large(rows: DataFrame, key: str, size: Column, bound: int) -> DataFrame:
    """Keys of more than the bound, and the parts they are cut into."""
    return rows.groupBy(key).agg(F.ceil(F.sum(size) / bound).cast("int").alias("parts")).where("parts > 1")


def _tiled(rows: DataFrame, key: str, large: DataFrame) -> DataFrame:
    """The rows with a column ``tile``: a large key's parts meet pair by pair, any two rows of a key in one tile at least."""
    part = F.pmod(F.xxhash64("name"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.xxhash64(key, F.least(part, q), F.greatest(part, q))
    )
    return rows.join(large, key, "left").select(
        *rows.columns, F.explode(F.when(F.col("parts").isNull(), F.array(key)).otherwise(pairs)).alias("tile")
    )
