"""Substring and suffix-array deduplication against plain counting."""

import hashlib
import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import collected, documents, odd_texts
from pyspark.sql import functions as F

from clubflow.llm import minimiser, substring_dedup, suffix_dedup


def plain_words(rows, width):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def plain_bytes(rows, width):
    starts = defaultdict(int)
    for _, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - width + 1):
            starts[raw[i : i + width]] += 1
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - width + 1):
            if starts[raw[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_word_windows_match_plain_counting(spark, seed):
    rows = odd_texts(seed)
    got = collected(substring_dedup.remove_repeats(documents(spark, rows)))
    want = plain_words(rows, 20)
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == want
    assert sum(w[1] for w in want.values()) > 300


@pytest.mark.parametrize("seed", [1, 2])
def test_byte_windows_match_plain_counting(spark, seed):
    rows = odd_texts(seed)
    got = collected(suffix_dedup.remove_repeats(documents(spark, rows)))
    want = plain_bytes(rows, 200)
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == want
    assert sum(w[1] for w in want.values()) > 3000


def test_byte_windows_through_files(spark):
    rows = odd_texts(3)
    got = collected(suffix_dedup.remove_repeats(documents(spark, rows), memory=100))
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == plain_bytes(rows, 200)


@pytest.mark.parametrize("folder", [False, True])
def test_collection_is_the_sorted_suffixes(tmp_path, folder):
    rng = random.Random(4)
    for _ in range(25):
        texts = [bytes(rng.choices(b"ab\x00c", k=rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        built = suffix_dedup.Collection(texts, str(tmp_path) if folder else None)
        own, start = [], 0
        for i, t in enumerate(texts):
            own += [([b + 1 for b in t[k:]] + [0, i], start + k) for k in range(len(t) + 1)]
            start += len(t)
        own.sort()
        assert built.suffix.read().tolist() == [s for _, s in own]
        common = [0]
        for (a, _), (b, _) in zip(own, own[1:]):
            k = 0
            while a[k] == b[k] and a[k]:
                k += 1
            common.append(k)
        assert built.common.read().tolist() == common


def test_repeated_and_missing_ids_are_documents_of_their_own(spark):
    text = " ".join(f"v{i}" for i in range(90))
    docs = documents(spark, [(1, text), (1, text), (None, text), (2, "short")])
    rows = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect())
    assert sorted(n for _, n in rows) == [0, 0, 90, 90]
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert sorted(r.n_removed for r in rows) == [0] + [len(text)] * 3


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")]).where("doc_id > 5")
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0


def test_large_group_of_copies(spark):
    text = " ".join(f"v{i}" for i in range(60))
    rows = [(i, text) for i in range(300)] + [(1000 + i, f"only{i} " + text[5:]) for i in range(100)]
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in collected(substring_dedup.remove_repeats(documents(spark, rows, 7))).items()} == plain_words(rows, 20)
    got = collected(suffix_dedup.remove_repeats(documents(spark, rows, 7)))
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == plain_bytes(rows, 200)


def test_texts_without_repeats_keep_all_columns(spark):
    text = " ".join(f"v{i}é" for i in range(90))
    docs = documents(spark, [(1, text + " end"), (2, "start " + text), (3, None), (4, "")])
    got = collected(suffix_dedup.without_repeats(docs))
    assert set(got[1].asDict()) == set(docs.columns)
    assert got[1].text == " end" and got[1].n_chars == 4 and got[2].text == "start " or got[2].text == "start"
    assert got[3].text is None and got[4].text == ""


def test_negative_ids_lose_as_much_as_others(spark):
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choices([f"u{i}" for i in range(500)], k=n))
    passage = say(120)
    texts = [say(20) + " " + passage + " " + say(20), passage[:300], passage[50:400] + say(30), say(90)]
    for ids in ((1, 2, 3, 4), (-1, -2, -3, -4), (-7, 0, 5, -1)):
        rows = list(zip(ids, texts))
        got = collected(suffix_dedup.remove_repeats(documents(spark, rows)))
        assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == plain_bytes(rows, 200)
        got = collected(substring_dedup.remove_repeats(documents(spark, rows)))
        assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == plain_words(rows, 20)


def test_int_ids(spark):
    text = " ".join(f"v{i}" for i in range(90))
    docs = documents(spark, [(1, text), (2, text)]).withColumn("doc_id", F.col("doc_id").cast("int"))
    assert sorted(r.n_removed for r in substring_dedup.remove_repeats(docs).collect()) == [0, 90]
    assert {r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()} == {len(text)}
    out = suffix_dedup.without_repeats(docs)
    assert out.schema["doc_id"].dataType.simpleString() == "int" and {r.text for r in out.collect()} == {""}


def test_columns_with_the_names_of_helpers_stay(spark):
    text = " ".join(f"v{i}" for i in range(90))
    names = ["row_place", "row_spans", "row_place_", "place", "spans", "__place", "__spans"]
    docs = documents(spark, [(1, text), (2, text), (2, "x")]).selectExpr("doc_id", "text", *[f"'{n}' as `{n}`" for n in names])
    out = suffix_dedup.without_repeats(docs).collect()
    assert len(out) == 3 and all(r[n] == n for r in out for n in names)


def test_windows_do_not_depend_on_blocks():
    rng = np.random.default_rng(12)
    values = rng.integers(0, 4, 3000).astype(np.uint8)
    offsets = np.array([0, 0, 7, 900, 900, 1600, 2999, 3000, 3000])

    def windows(block):
        doc, first, last, least = minimiser.super_kmers(values, offsets, 40, 8, block)
        return [(int(d), w, int(m)) for d, a, b, m in zip(doc, first, last, least) for w in range(a, b + 1)]

    whole = windows(1 << 20)
    assert len(whole) == sum(max(0, b - a - 39) for a, b in zip(offsets, offsets[1:]))
    for block in (1, 37, 100, 899, 900, 2999):
        assert windows(block) == whole


def test_run_hashes_over_several_blocks():
    rng = np.random.default_rng(13)
    n = 2 * minimiser.BLOCK + 12345
    values = rng.integers(0, 3, n).astype(np.uint8)
    starts = np.sort(rng.integers(0, n - 50, 5000))
    starts[:3] = [0, 0, 1]
    starts = np.sort(np.r_[starts, minimiser.BLOCK - 25, minimiser.BLOCK, 2 * minimiser.BLOCK])
    got = minimiser.run_hashes(values, starts, starts + 50)
    want = [minimiser.run_hashes(values[s : s + 50], np.array([0]), np.array([50]))[0] for s in starts.tolist()]
    assert got.tolist() == want


@pytest.mark.parametrize("send", [lambda: suffix_dedup._send(64, 200, 32), lambda: substring_dedup._send(64, 20, 4)])
def test_one_very_long_text_is_dealt_out_in_blocks(send):
    """A text of 50 MB; what is held does not grow with the hashes of all of it."""
    rng = np.random.default_rng(14)
    letters = rng.integers(97, 123, 50 << 20).astype(np.uint8)
    letters[rng.random(len(letters)) < 0.15] = 32
    text = letters.tobytes().decode()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["place", "text"])
    tracemalloc.start()
    sent = sum(b.num_rows for b in send()(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent and peak < 16 * len(text)
