"""Small odd tables for the operators' tests."""

from __future__ import annotations

import random

WORDS = [f"w{i}" for i in range(400)] + ["the", "of", "and", "à", "Straße", "naïve"]


def odd_texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Null, empty, blank, tiny, very long, repeated, near and overlapping texts; ids out of order."""
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choices(WORDS, k=n))
    passage, line = say(60), say(25)
    base = say(120)
    texts = [
        None, "", " \t\n ", "x", "one two", base, base, base, base.replace("the", "THE"), base + " tail",
        say(30) + " " + passage + " " + say(30), say(10) + "\n" + passage, passage, passage + " " + passage,
        line + "\n" + say(40), say(40) + "\n" + line, line + " " + line + " " + line, "ab " * 400, "ab " * 300 + say(30),
        say(6000), "ünïcödé " * 60 + say(20), "\x1c\x1f odd blanks here \x85 x", "…「日本語」 テキスト " * 20,
    ]
    words = base.split()
    words[50] = "changed"
    texts.append(" ".join(words))
    texts += [say(rng.randint(1, 200)) for _ in range(20)]
    ids = list(range(3, 3 + 7 * len(texts), 7))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def documents(spark, rows, parts: int = 3):
    """A table of documents with columns that clash with names the operators use inside."""
    full = [(d, t, "en", "s", len(t or ""), 1, "a", 0.5, 7) for d, t in rows]
    return spark.createDataFrame(
        full,
        "doc_id long, text string, lang string, source string, n_chars long, place long, spans string, score double, cell int",
    ).repartition(parts)


def collected(df, key: str = "doc_id"):
    return {r[key]: r for r in df.collect()}
