"""Language, quality, phrases, pages and the pipeline: plain versions and held-out accuracy."""

import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from helpers import collected, documents, odd_texts
from pyspark.sql import functions as F

import corpus_pipeline
from clubflow.llm import common, html_extract, language_id, phrase_fingerprint, quality
from clubflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    got = collected(QUERIES["op3_language_id"](spark, FOLDER))
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if got[r.doc_id].held_out]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in out]) > 0.98
    assert all(0 <= g.score <= 1 for g in got.values())


def test_language_of_odd_texts(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    profiles = language_id.learn(train)
    assert set(profiles) == {"en", "de"}
    got = collected(language_id.predict(documents(spark, odd_texts() + [(5000, "12 34 !"), (5001, "und die der")]), profiles))
    assert got[5000].lang_pred == "und" and got[5000].score == 0 and got[5001].lang_pred == "de"
    none = language_id.predict(documents(spark, [(1, "text")]), {}).first()
    assert none.lang_pred == "und"


def test_out_of_place_distance_matches_a_plain_version():
    from collections import Counter

    def plain(text):
        words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        grams = Counter()
        for w in words:
            grams.update(w)
        padded = " " + " ".join(words) + " "
        grams.update(a + b for a, b in zip(padded, padded[1:]))
        grams.update(a + b + c for a, b, c in zip(padded, padded[1:], padded[2:]) if b != " ")
        return grams

    text = "Der Hund, die Katze! 7 und der Straße"
    keys, counts = language_id.grams(text)
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    assert dict(zip(keys.tolist(), counts.tolist())) == {number(g): n for g, n in plain(text).items()}


def test_quality_on_held_out_rows(spark):
    got = collected(QUERIES["op6_quality_classifier"](spark, FOLDER))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    out = [d for d in labels if d in got and got[d].held_out]
    good = [got[d].score for d in out if labels[d] == 1]
    bad = [got[d].score for d in out if labels[d] == 0]
    assert np.mean([a > b for a in good for b in bad]) + 0.5 * np.mean([a == b for a in good for b in bad]) > 0.9
    assert np.mean([got[d].predicted == labels[d] for d in out]) > 0.9


def test_quality_of_odd_texts_and_no_labels(spark):
    docs = documents(spark, odd_texts())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.rate(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(d, i % 2) for i, (d, _) in enumerate(odd_texts())] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.rate(docs, labels).collect())


def test_isotonic_steps_rise():
    rng = np.random.default_rng(1)
    x, w = np.arange(50.0), rng.integers(1, 9, 50).astype(float)
    y = np.floor(w * np.clip(x / 50 + rng.normal(0, 0.3, 50), 0, 1))
    at, height = quality.isotonic(x, y, w)
    assert (np.diff(height) > 0).all() and (np.diff(at) > 0).all()


def plain_phrases(text):
    known, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def test_fingerprints_match_a_plain_version(spark):
    rows = odd_texts()
    text = dict(rows)
    ids = sorted(text, reverse=True)
    got = collected(phrase_fingerprint.compare_edited(documents(spark, rows), ranges=5))
    assert set(got) == set(ids)
    for doc, after in zip(ids, ids[1:] + ids[:1]):
        a, b = text[doc] or "", text[after] or ""
        n = len(a) // 3
        changed = a[: len(a) - n] + b[:n]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(changed.encode()).hexdigest())
        mine, other, following = (phrase_fingerprint.fingerprint(t) for t in (a, changed, b))
        assert r.fingerprint == mine.astype(">u4").tobytes().hex() and r.edited_fingerprint == other.astype(">u4").tobytes().hex()
        assert (r.near_edited, r.near_next) == ((mine == other).mean(), (mine == following).mean())
    long = "the quick brown fox jumps over the lazy dog again and again " * 40
    p, q = plain_phrases(long), plain_phrases(long[:1800] + "something else entirely here " * 20)
    exact = len(p & q) / len(p | q)
    near = phrase_fingerprint.likeness(phrase_fingerprint.fingerprint(long), phrase_fingerprint.fingerprint(long[:1800] + "something else entirely here " * 20))
    assert phrase_fingerprint.Phrases().add(long).known == p and abs(near - exact) < 0.25


def test_single_and_repeated_documents(spark):
    one = phrase_fingerprint.compare_edited(documents(spark, [(1, "abcdef")])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    twice = phrase_fingerprint.compare_edited(documents(spark, [(1, "abc"), (1, "abc"), (None, None)])).collect()
    assert len(twice) == 3 and phrase_fingerprint.compare_edited(documents(spark, [(1, "a")]).where("doc_id > 2")).count() == 0


def test_pages(spark):
    rows = [
        (1, "u", "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>A title</h1><p>One &amp; two,  three\n four words of text.</p>"
                 "<p>Another sentence of the story, long enough.</p></article><footer>&copy; us</footer></body></html>"),
        (2, None, None), (3, "u", ""), (4, "u", "<p>"), (4, "u", "<p>"), (5, "u", "<script>var a='<p>no</p>'</script><!-- <p>no</p> -->"), (6, "u", "<<<>>> & <p" + "x" * 5000),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    model = html_extract.labeller(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    got = html_extract.extract(pages, model).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and text[1] == "A title\nOne & two, three four words of text.\nAnother sentence of the story, long enough."
    assert text[2] == text[3] == text[4] == text[5] == "" and all(r.n_chars == len(r.text) for r in got)
    # composed pages that were not trained on
    rng = random.Random(77)
    long, short = [f"Sentence number {i} tells a small story, with a comma." for i in range(60)], ["Home", "More", "About us", "Login"]
    made = [html_extract.compose(rng, long, short) for _ in range(120)]
    said = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame([(i, "u", p) for i, (p, _) in enumerate(made)], "page_id long, url string, html string"), model).collect()}
    assert np.mean([said[i] == "\n".join(m) for i, (_, m) in enumerate(made)]) > 0.85


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><meta charset=utf-8><title>T</title><body><p>One two.</p><p>Three.</p></body></html>",
        "<head><link href=a><style>p{}</style><p>One two.</p><p>Three.</p>",
        "<head><title>T</title>One two.<p>Three.",
        "<p>One two.</p><head>Three.",
        "<head><noscript><link href=a><body><noscript>no</noscript><p>One two.</p><p>Three.</p>",
        "<title-bar>One two.</title-bar><p>Three.</p>",
        "<script-list><p>One two.</p></script-list><p>Three.</p><style-guide></style-guide>",
        "<body><p>One two.</p><noscript><img src=a><p>Three.</p>",
        "<body><p>One two.</p><noscript><img src=a><div>Three.</div><noscript><p>no</p></noscript>",
        "<body><p>One two.</p><select><option>a<option>b<hr><option>c<p>Three.</p>",
        "<body><p>One two.</p><svg><path d=''><g><h2>Three.</h2>",
        "<body><p>One two.</p><object><param name=a><p>Three.</p>",
        "<body><p>One two.</p><iframe src=a><section>Three.</section>",
        "<div><select><option>a</div><p>One two.</p><p>Three.</p>",
        # with their end tags they hide blocks too
        "<head></head><p>One two.</p><noscript><div><p>no</p></div></noscript><template><p>no<svg></template><p>Three.</p>",
        "<p>One two.</p><svg><foreignObject><p>no</p></foreignObject></svg><select><option><div>no</div></select><p>Three.</p>",
    ],
)
def test_hidden_elements_without_an_end_tag_do_not_hide_the_page(page):
    assert [b[0] for b in html_extract.blocks(page)] == ["One two.", "Three."]


def test_quotes_open_values_behind_equals_signs_only():
    pages = ["<p title=it's>First.</p><p>It's second.</p>", "<p it's>First.</p><p>It's second.</p>", "<p a=b'c d=\"x>y\" e = 'q>'>First.<p>It's second."]
    for page in pages:
        assert [b[0] for b in html_extract.blocks(page)] == ["First.", "It's second."]
    assert [b[0] for b in html_extract.blocks("<p title=it's>First.</p>")] == ["First."]


def test_very_long_paragraphs_are_main_text(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    model = html_extract.labeller(pages)
    story = " ".join(f"Sentence number {i} goes on with the story, at some length." for i in range(2000))
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>{story}</p><p>A short end of it all, in one line.</p></article><footer>&copy; us</footer>"
    got = html_extract.extract(spark.createDataFrame([(1, "u", page)], "page_id int, url string, html string"), model).first()
    assert got.text == f"A title\n{story}\nA short end of it all, in one line."


def test_the_sample_is_bounded_when_one_id_has_many_pages(spark):
    page = "<article><p>A sentence that is long enough for the sample of texts.</p></article>"
    rows = [(None, page)] * 30 + [(1, page)] * 30 + [(1, page.replace("long", f"long {i}")) for i in range(30)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    assert html_extract.labeller(pages, sample=5, composed=10).w


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    model = html_extract.Labeller(1, inputs=5, hidden=3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, y, mask = rng.normal(size=(2, 4, 5)), rng.integers(0, 2, (2, 4)).astype(float), np.array([[1, 1, 1, 1], [1, 1, 0, 0.0]])

    def loss():
        p = model.chance(x, mask)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    found = model.gradient(x, mask, y)
    for name, w in model.w.items():
        for i in range(0, w.size, max(1, w.size // 5)):
            old = w.flat[i]
            w.flat[i] = old + 1e-3
            up = loss()
            w.flat[i] = old - 1e-3
            down = loss()
            w.flat[i] = old
            assert abs((up - down) / 2e-3 - found[name].flat[i]) < 2e-4


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], FOLDER)
        assert out.columns == docs.columns
        kept.append(corpus_pipeline.stored(out, "test"))
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert ids[0] > ids[1] >= ids[2] > ids[3] == ids[4]
    good = [d for d, q in labels.items() if q == 1 and d in ids[0]]
    bad = [d for d, q in labels.items() if q == 0 and d in ids[0]]
    assert np.mean([d in ids[1] for d in good]) > 0.97 and np.mean([d in ids[1] for d in bad]) < 0.3
    # of equal texts one stays
    text = {r.doc_id: r.text for r in kept[3].collect()}
    assert len(set(text.values())) == len(text)
    packed = QUERIES["pipeline"](spark, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids[4]


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    rows = odd_texts() + [(3, "same id"), (3, "same id"), (None, "no id at all")]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1) for d, _ in rows[:9]], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < 0"), str(tmp_path)).count() == 0


def test_pipeline_keeps_columns_with_the_names_of_helpers(spark, tmp_path):
    names = ["row_place", "row_spans", "row_statistics", "__place", "__spans", "__quality_statistics"]
    docs = documents(spark, odd_texts()).select("doc_id", "text", "lang", *[F.lit(n).alias(n) for n in names])
    spark.createDataFrame([(d, i % 2) for i, (d, _) in enumerate(odd_texts())], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(r[n] == n for r in out.collect() for n in names)


def test_work_tables_go_when_the_next_stage_starts(spark, tmp_path):
    folder = common.work_dir(spark) + "/llm"
    docs = documents(spark, odd_texts())
    spark.createDataFrame([(d, i % 2) for i, (d, _) in enumerate(odd_texts())], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    # the first stage's copy of the documents is gone, and nothing that a result still needs
    assert not [d for d in set(os.listdir(folder)) - before if d.startswith("statistics")]
    lazy = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    again = corpus_pipeline.STAGES[1][1](spark, lazy, str(tmp_path))
    assert again.count() >= 0


def plain_ratings(rows, labels):
    """Scores by one loop over the labelled rows, and the isotonic fit by its min-max formula."""
    x = {d: np.array(quality.statistics(t)) for d, t in rows}
    known = [(x[d], y, f) for d, y, f in labels]
    mean, spread = np.mean([a for a, _, _ in known], axis=0), np.std([a for a, _, _ in known], axis=0)
    model = quality.Model(mean, np.where(spread > 1e-9, spread, 1.0))  # for its fixed random directions

    def features(a):
        z = np.clip((a - model.mean) / model.spread, -quality.REACH, quality.REACH)
        return np.append(np.cos(z @ model.turn + model.phase) * np.sqrt(2 / quality.WIDTH), 1.0)

    share = np.mean([y for _, y, _ in known])
    weights = {}
    for fold in (0, 1):  # learned on the other fold
        left, right = np.zeros((quality.WIDTH + 1, quality.WIDTH + 1)), np.zeros(quality.WIDTH + 1)
        total = 0.0
        for a, y, f in known:
            if f != fold:
                w = 0.5 / share if y else 0.5 / (1 - share)
                g = features(a)
                left += w * np.outer(g, g)
                right += w * g * y
                total += w
        weights[fold] = np.linalg.solve(left + quality.RIDGE * max(total, 1.0) * np.eye(len(right)), right)
    cells: dict = {}
    for a, y, f in known:
        c = int(np.clip(np.round(features(a) @ weights[f] * quality.BINS), -quality.BINS, 2 * quality.BINS))
        good, n = cells.get(c, (0, 0))
        cells[c] = good + y, n + 1
    at = sorted(cells)
    mean_of = lambda a, b: sum(cells[c][0] for c in at[a : b + 1]) / sum(cells[c][1] for c in at[a : b + 1])
    height = [max(min(mean_of(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))]
    steps: dict = {}
    for c, h in zip(at, height):
        top, n = steps.get(round(h, 12), (0, 0))
        steps[round(h, 12)] = top + c / quality.BINS * cells[c][1], n + cells[c][1]
    middles = [top / n for top, n in steps.values()]
    both = (weights[0] + weights[1]) / 2
    return {d: float(np.clip(np.interp(features(a) @ both, middles, list(steps)), 0, 1)) for d, a in x.items()}


def test_ratings_match_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 160")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fold = {r.doc_id: r.fold for r in docs.select("doc_id", (F.abs(F.xxhash64("doc_id")) % 2).alias("fold")).collect()}
    used = [(r.doc_id, r.quality, fold[r.doc_id]) for r in labels.collect() if r.doc_id in fold and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    assert 0 < sum(y for _, y, _ in used) < len(used)
    want = plain_ratings(rows, used)
    got = {r.doc_id: r.score for r in quality.rate(docs, labels).collect()}
    assert got.keys() == want.keys() and max(abs(got[d] - want[d]) for d in want) < 1e-6


def test_quality_stage_keeps_every_column_and_what_the_scores_say(spark):
    rows = odd_texts() + [(3, "same id"), (None, "no id at all")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(d, i % 2) for i, (d, _) in enumerate(odd_texts())], "doc_id long, quality int")
    out = quality.accepted(docs, labels)
    assert out.columns == docs.columns
    said = sorted((str(r.doc_id) for r in quality.rate(docs, labels).where("predicted = 1").collect()))
    assert sorted(str(r.doc_id) for r in out.collect()) == said
    plan = out._jdf.queryExecution().toString()
    assert "Exchange" not in plan  # stored rows are filtered where they are
