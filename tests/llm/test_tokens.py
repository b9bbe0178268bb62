"""Token ids, chunks and windows against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import collected, documents, odd_texts
from tokenizers import Tokenizer

from clubflow.llm import chunked_bpe, packing, word_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_bpe.vocabulary_path())


def texts():
    rng = random.Random(3)
    marks = ["İstanbul", "ﬁne", "é", "é", "’tis", "we'll", "it's", "10²³", "½", "<|endoftext|>", "a<|startoftext|>b", " x y",
             "x\u0085y", "ΑΣ", "👩‍👩‍👧", "中文字", "ß", "µ", "ª", "don't!!", "...", "a_b-c", "###%%%", "\x0b\x0c", "\x1d", "'S", "'LL"]
    mixed = [" ".join(rng.choices(marks, k=rng.randint(1, 60))) for _ in range(40)]
    return odd_texts() + [(9000 + i, t) for i, t in enumerate(mixed)] + [(9900, "y" * 20_000), (9901, "no" + "blank" * 3000 + " end")]


def test_encoding_matches_the_library(spark, library):
    rows = texts()
    got = collected(chunked_bpe.encode(documents(spark, rows), roll=8, zeros=4))
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        r = got[doc]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids, (doc, text[:60])
        assert r.n_tokens == len(ids) and r.decoded == said
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert max(r.n_chunks for r in got.values()) > 50


def test_shared_passages_are_encoded_once():
    import pyarrow as pa

    from clubflow.llm.common import raw_bytes

    rng = random.Random(1)
    passage = " ".join(f"word{rng.randint(0, 999)}" for _ in range(3000))
    chunker = chunked_bpe.ChunkEncoder(word_bpe.encoder(word_bpe.vocabulary_path()))
    for start in ("", "abc ", "another start "):
        data, offsets = raw_bytes(pa.array([start + passage]))
        at = chunked_bpe.cuts(data, offsets)[0]
        raw = data.tobytes()
        chunker.encode([raw[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
    assert chunker.reused > 1.9 * chunker.encoded / 1.1 * 0.9


def test_packing_holds_every_id_once(spark, library):
    rows = texts()
    pieces = packing.pack(documents(spark, rows), with_ids=True).collect()
    by_doc, by_window = {}, {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by_doc.setdefault(p.doc_id, []).append(p)
        by_window.setdefault(p.sequence_id, []).append(p)
    for doc, text in rows:
        own = sorted(by_doc[doc], key=lambda p: p.start)
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == ids
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    for window in by_window.values():
        window.sort(key=lambda p: p.offset)
        assert [p.offset for p in window] == np.cumsum([0] + [p.length for p in window])[:-1].tolist()
        total = sum(p.length for p in window)
        assert total == packing.WINDOW or total & (total - 1) == 0


def test_level_makes_the_sum_of_squares_least():
    rng = np.random.default_rng(2)
    for _ in range(200):
        packer = packing.SumOfSquares(12)
        packer.counts[1:12] = rng.integers(0, 4, 11)
        length = int(rng.integers(1, 12))
        cost = {}
        for h in range(0, 13 - length):
            if h and not packer.counts[h]:
                continue
            n = packer.counts.copy()
            if h:
                n[h] -= 1
            if h + length < 12:
                n[h + length] += 1
            cost[h] = int((n**2).sum())
        best = packer.level(length)
        assert cost[best] == min(cost.values()) and best == max(h for h, v in cost.items() if v == cost[best])


@pytest.mark.parametrize("seed", range(6))
def test_closing_empties_the_emptiest_windows_into_the_others(seed):
    rng = np.random.default_rng(seed)
    size = 64
    packer, full, put = packing.SumOfSquares(size), [], []
    for doc in range(int(rng.integers(0, 120))):
        ids = rng.integers(0, 99, int(rng.integers(1, size))).astype("<u4")
        put.append((doc, ids))
        full += [w] if (w := packer.put((doc, 0, ids, len(ids)))) else []
    open_tokens = sum(len(p[2]) for windows in packer.open.values() for w in windows for p in w)
    closed = list(packer.close())
    whole = [w for w in closed if sum(len(p[2]) for p in w) == size]
    rest = sorted(sum(len(p[2]) for p in w) for w in closed if w not in whole)
    assert len(whole) == open_tokens // size and rest == [1 << k for k in range(7) if open_tokens % size >> k & 1]
    pieces: dict = {}
    for w in full + closed:
        for doc, start, ids, _ in w:
            pieces.setdefault(doc, []).append((start, ids.tolist()))
    assert {d: [x for _, part in sorted(p) for x in part] for d, p in pieces.items()} == {d: i.tolist() for d, i in put}
    # a piece is cut only where it closes a window
    assert sum(len(p) - 1 for p in pieces.values()) <= len(whole) + len(rest)


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")]).where("doc_id > 5")
    assert packing.pack(docs).count() == 0 and chunked_bpe.encode(docs).count() == 0
