"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of blocks: runs of text between block tags, with the tags (and their class, id and
role words) that are open around them. Each block becomes a vector of hashed tag-path parts, hashed words and a few
measures; a bidirectional LSTM in numpy reads the whole sequence in both directions and labels every block as main
text or not. The labeller is trained when the query starts, on pages composed from block texts of a bounded sample
of pages (``SAMPLE`` pages) in many layouts, whose labels are known by construction.

Null html counts as empty; a page without main blocks gives the empty text. A repeated page_id gives a row each time.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import narrow, slices

PATHS, WORDS, MEASURES = 256, 64, 8
HIDDEN = 16
#: Pages whose block texts the training pages are made of, and how many training pages.
SAMPLE = 200
COMPOSED = 700
ROUNDS = 14

# Fixed values of HTML: elements without content of their own, elements that break a line of text, elements never shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
HIDDEN_TAGS = frozenset("script style noscript template head title svg iframe object select textarea".split())
# An element that the tag on the left ends when it is still open.
ENDS = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol pre section table ul".split()
)

# What may stand in head; anything else ends it.
_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title html head".split())
# Blocks that end a hidden element without an end tag of its own (a rule may stand in a list of options).
_BREAKS = (_CLOSES_P | frozenset("p li dt dd tr td th tbody thead tfoot caption center body".split())) - {"hr"}

# A quote opens a value only behind an equals sign; elsewhere it is a letter like others.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Za-z]+")
_BLANK = re.compile(r"\s+")

#: Text, tag path, share of the characters that are in links
Block = tuple[str, tuple[str, ...], float]


def _ended(page: str) -> set[int]:
    """Where the hidden elements start that have an end tag of their own."""
    opened: dict[str, list[int]] = {}
    found = set()
    for m in _TOKEN.finditer(page):
        tag = (m["tag"] or "").lower()
        if tag in HIDDEN_TAGS:
            if not m["end"]:
                opened.setdefault(tag, []).append(m.start())
            elif opened.get(tag):
                found.add(opened[tag].pop())
    return found


def blocks(page: str | None) -> list[Block]:
    """The visible blocks of a page in order: text with single blanks, path of open tags, share of linked text."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int]] = []
    ended: set[int] | None = None
    text: list[str] = []
    linked = 0
    path: tuple[str, ...] = ()
    hidden = links = 0

    def close() -> None:
        nonlocal linked
        if text:
            whole = _BLANK.sub(" ", entities.unescape("".join(text))).strip()
            if whole:
                out.append((whole, path, min(1.0, linked / len(whole))))
            text.clear()
        linked = 0

    def drop(at: int) -> None:
        nonlocal hidden, links, path
        for tag, _, _ in stack[at:]:
            hidden -= tag in HIDDEN_TAGS
            links -= tag == "a"
        del stack[at:]
        path = tuple(part for _, parts, _ in stack for part in parts)

    def reveal(tag: str) -> None:
        """End the hidden elements that the tag cannot stand in and whose end tag is missing."""
        nonlocal ended
        if tag in _BREAKS:
            if ended is None:
                ended = _ended(page)
            lost = len(stack)
            for at in range(len(stack) - 1, -1, -1):
                name, _, start = stack[at]
                if name == "head":
                    if tag == "body":
                        lost = at
                elif name in HIDDEN_TAGS:
                    if start not in ended:
                        lost = at
                    elif tag != "body":
                        break
            drop(lost)
        if stack and stack[-1][0] == "head" and tag not in _HEAD:
            drop(len(stack) - 1)

    last = 0
    for m in _TOKEN.finditer(page):
        if hidden and stack[-1][0] == "head" and page[last : m.start()].strip():
            drop(len(stack) - 1)  # text cannot stand in head
        if m.start() > last and not hidden:
            piece = page[last : m.start()]
            text.append(piece)
            if links:
                linked += len(piece)
        last = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            close()
        if m["end"]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    if tag not in INLINE:
                        close()
                    drop(at)
                    break
            continue
        if hidden:
            reveal(tag)
        if tag == "br":
            text.append(" ")
        ends = ENDS.get(tag) or (("p",) if tag in _CLOSES_P else ())
        if ends:
            # open inline tags inside an ended element end with it
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in ends:
                    drop(at)
                    break
                if stack[at][0] not in INLINE:
                    break
        if tag not in VOID and not m["rest"].endswith("/"):
            parts = [tag]
            rest = m["rest"]
            if rest and "=" in rest:
                for found in _NAMES.findall(rest):
                    parts += [f".{w.lower()}" for w in _PART.findall("".join(found))]
            stack.append((tag, tuple(parts), m.start()))
            path += tuple(parts)
            hidden += tag in HIDDEN_TAGS
            links += tag == "a"
    if hidden and stack[-1][0] == "head" and page[last:].strip():
        drop(len(stack) - 1)
    if last < len(page) and not hidden:
        text.append(page[last:])
    close()
    return out


_slots: dict[str, int] = {}


def _slot(word: str, size: int) -> int:
    got = _slots.get(word)
    if got is None:
        if len(_slots) > 300_000:
            _slots.clear()
        got = _slots[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return got % size


def vectors(page: list[Block]) -> np.ndarray:
    """One row of features per block."""
    x = np.zeros((len(page), PATHS + WORDS + MEASURES), np.float32)
    for row, (text, path, linked) in zip(x, page):
        own = [p for p in path if p not in ("html", "body")]
        for p in own:
            row[_slot(p, PATHS)] = 1
        for p in own[-2:]:
            row[_slot("last " + p, PATHS)] = 1
        words = text.split()
        weight = 1 / len(words)
        for w in words:
            row[PATHS + _slot(w.lower(), WORDS)] += weight
        marks = sum(map(text.count, ".,;:!?"))
        row[PATHS + WORDS :] = (
            np.log1p(len(text)) / 6, np.log1p(len(words)) / 5, linked, marks / len(words),
            text[-1] in ".!?:", len(own) / 6, len(words) < 4, 1,
        )
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one for each direction, and a logistic output; weights are plain arrays."""

    def __init__(self, seed: int = 5, inputs: int = PATHS + WORDS + MEASURES, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.w: dict[str, np.ndarray] = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.1, (inputs, 4 * hidden)).astype(np.float32)
            self.w["h" + d] = rng.normal(0, 0.15, (hidden, 4 * hidden)).astype(np.float32)
            self.w["c" + d] = np.zeros(4 * hidden, np.float32)
            self.w["c" + d][hidden : 2 * hidden] = 1  # remember at first
        self.w["o"] = rng.normal(0, 0.1, 2 * hidden + 1).astype(np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str):
        """States over time for pages x (page, time, feature); where the mask is 0 the state stays."""
        n, steps, _ = x.shape
        k = self.hidden
        gates = x.reshape(n * steps, -1) @ self.w["x" + d] + self.w["c" + d]
        gates = gates.reshape(n, steps, 4 * k)
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        states, memory = np.zeros((n, steps, k), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = gates[:, t] + h @ self.w["h" + d]
            i, f, o = _sigmoid(g[:, :k]), _sigmoid(g[:, k : 2 * k]), _sigmoid(g[:, 2 * k : 3 * k])
            u, m = np.tanh(g[:, 3 * k :]), mask[:, t, None]
            new = f * c + i * u
            memory.append((t, h, c, i, f, o, u, new, m))
            c = np.where(m > 0, new, c)
            h = np.where(m > 0, o * np.tanh(new), h)
            states[:, t] = h
        return states, memory

    def chance(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        f, b = self._pass(x, mask, "f")[0], self._pass(x, mask, "b")[0]
        return _sigmoid(np.concatenate((f, b), axis=2) @ self.w["o"][:-1] + self.w["o"][-1])

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        k = self.hidden
        runs = {d: self._pass(x, mask, d) for d in "fb"}
        both = np.concatenate((runs["f"][0], runs["b"][0]), axis=2)
        p = _sigmoid(both @ self.w["o"][:-1] + self.w["o"][-1])
        err = (p - y) * mask / max(1.0, float(mask.sum()))
        g = {"o": np.append(np.einsum("nt,ntk->k", err, both), err.sum()).astype(np.float32)}
        for part, d in enumerate("fb"):
            out = err[:, :, None] * self.w["o"][part * k : (part + 1) * k]
            dgates = np.zeros((*x.shape[:2], 4 * k), np.float32)
            dh, dc = np.zeros_like(out[:, 0]), np.zeros_like(out[:, 0])
            gh = np.zeros_like(self.w["h" + d])
            for t, h, c, i, f, o, u, new, m in reversed(runs[d][1]):
                dh = dh + out[:, t]
                on, th = m > 0, np.tanh(new)
                dnew = np.where(on, dc + dh * o * (1 - th * th), 0)
                dg = np.concatenate(
                    (dnew * u * i * (1 - i), dnew * c * f * (1 - f), np.where(on, dh * th, 0) * o * (1 - o), dnew * i * (1 - u * u)),
                    axis=1,
                )
                dgates[:, t] = dg
                gh += h.T @ dg
                dc = np.where(on, dnew * f, dc)
                dh = np.where(on, dg @ self.w["h" + d].T, dh)
            flat = dgates.reshape(-1, 4 * k)
            g["x" + d], g["h" + d], g["c" + d] = x.reshape(len(flat), -1).T @ flat, gh, flat.sum(axis=0)
        return g


def train(pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS, seed: int = 5) -> Labeller:
    """Adam steps over batches of pages (vectors, labels of the blocks)."""
    model, rng = Labeller(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(pages))
        for i in range(0, len(order), 32):
            x, mask, y = _together([pages[j] for j in order[i : i + 32]])
            # a part of the path hidden now and then, so that no single tag decides
            x[:, :, :PATHS] *= rng.random((len(x), 1, PATHS)) > 0.15
            step += 1
            for name, g in model.gradient(x, mask, y).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                model.w[name] -= (rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return model


def _together(pages: list[tuple[np.ndarray, np.ndarray]]):
    steps = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), steps, PATHS + WORDS + MEASURES), np.float32)
    mask, y = np.zeros((len(pages), steps), np.float32), np.zeros((len(pages), steps), np.float32)
    for k, (v, labels) in enumerate(pages):
        x[k, : len(v)], y[k, : len(v)], mask[k, : len(v)] = v, labels, 1
    return x, mask, y


def compose(rng: random.Random, long: list[str], short: list[str]) -> tuple[str, list[str]]:
    """A page in a layout drawn at random, and the texts of its main blocks in order."""
    esc = entities.escape

    def some(texts: list[str], low: int, high: int) -> list[str]:
        return [rng.choice(texts) for _ in range(rng.randint(low, high))]

    def named(*names: str) -> str:
        return f'{rng.choice(("class", "id"))}="{rng.choice(names)}"'

    def menu(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{esc(s)}</a></li>' for i, s in enumerate(some(short, 2, n))) + "</ul>"

    def paras(n: int, texts: list[str]) -> str:
        return "".join(f"<p>{esc(s)}</p>" for s in some(texts, 1, n))

    before = [
        lambda: f"<nav>{menu(9)}</nav>",
        lambda: f"<header>{rng.choice((menu(5), '<p>' + esc(rng.choice(short)) + '</p>', '<h1>' + esc(rng.choice(short)) + '</h1>'))}</header>",
        lambda: f"<div {named('menu', 'navbar', 'navigation', 'topnav', 'breadcrumb', 'breadcrumbs')}>{menu(7)}</div>",
        lambda: f"<div {named('ad', 'ads', 'advert', 'advertisement', 'banner', 'sponsored', 'promo')}>{esc(rng.choice(long))}</div>",
        lambda: f"<div {named('cookie', 'cookie-notice', 'notice', 'consent', 'alert', 'popup', 'newsletter')}><p>{esc(rng.choice(long))}</p></div>",
        lambda: f"<aside>{rng.choice((menu(6), paras(2, long)))}</aside>",
        lambda: f"<form><label>{esc(rng.choice(short))}</label><input name=q><button>{esc(rng.choice(short))}</button></form>",
    ]
    after = before[3:] + [
        lambda: f"<footer>{rng.choice((paras(1, long), '&copy; ' + esc(rng.choice(long)), menu(5)))}</footer>",
        lambda: f"<div {named('footer', 'site-footer', 'copyright', 'legal', 'disclaimer')}>{esc(rng.choice(long))}</div>",
        lambda: f"<div {named('sidebar', 'side', 'widget', 'related', 'recommended', 'share', 'social', 'tags')}>{rng.choice((menu(6), paras(2, long)))}</div>",
        lambda: f"<{(t := rng.choice(('div', 'section', 'ol')))} {named('comments', 'comment', 'comment-list', 'discussion', 'replies')}>"
        + "".join(f'<div class="comment"><b>{esc(rng.choice(short))}</b><p>{esc(s)}</p></div>' for s in some(long, 1, 4)) + f"</{t}>",
    ]
    main: list[str] = []

    def block(tag: str, text: str, tail: str | None = None) -> str:
        main.append(text)
        return f"<{tag}>{esc(text)}</{tag if tail is None else tail}>"

    def body() -> str:
        parts = []
        if rng.random() < 0.8:
            parts.append(block("h1", rng.choice(short + long)))
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            text = rng.choice(long)
            if kind < 0.12:
                main.append(text)
                parts.append(f"<p><b>{esc(text)}<br>")
            elif kind < 0.2:
                parts.append(block("h2", rng.choice(short)))
            elif kind < 0.26:
                parts.append("<ul>" + "".join(block("li", t) for t in some(long + short, 1, 4)) + "</ul>")
            elif kind < 0.3:
                parts.append(f"<blockquote>{block('p', text)}</blockquote>")
            elif kind < 0.34:
                parts.append("<table><tr>" + "".join(block("td", t) for t in some(short, 1, 4)) + "</tr></table>")
            elif kind < 0.37:
                parts.append(block("pre", text))
            elif kind < 0.41:
                parts.append(rng.choice(before[3:5] + after[-2:])())
            else:
                parts.append(block("p", text))
        return "".join(parts)

    frame = rng.choice((
        ("<article>", "</article>"), ("<article>", "</article>"), ("<main><article>", "</article></main>"),
        ("<main>", "</main>"), (f"<div {named('content', 'article', 'post', 'entry', 'main', 'text', 'story')}>", "</div>"),
        ('<div role="main">', "</div>"), ("<section>", "</section>"), ("<div>", "</div>"),
    ))
    top = "".join(rng.choice(before)() for _ in range(rng.randint(0, 4)))
    bottom = "".join(rng.choice(after)() for _ in range(rng.randint(0, 4)))
    page = f"<html><head><title>{esc(rng.choice(short))}</title><style>p{{margin:0}}</style></head><body>{top}{frame[0]}{body()}{frame[1]}{bottom}</body></html>"
    return page, main


def labeller(pages: DataFrame, sample: int = SAMPLE, composed: int = COMPOSED, seed: int = 5) -> Labeller:
    """Train on composed pages of whole block texts; at most ``sample`` different pages, the first by page_id, reach the driver."""
    rows = narrow(pages, "page_id", "html").where("html is not null").withColumn("hash", F.xxhash64("html"))
    # ids and hashes first, then the html of the chosen ones
    chosen = rows.select("page_id", "hash").distinct().orderBy(F.col("page_id").asc_nulls_first(), "hash").limit(sample).collect()
    wanted = F.lit(False)
    for page_id, h in chosen:
        wanted = wanted | (F.col("page_id").eqNullSafe(F.lit(page_id).cast("long")) & (F.col("hash") == h))
    ids = [page_id for page_id, _ in chosen if page_id is not None]
    rows = rows.where(F.col("page_id").isNull() | F.col("page_id").isin(ids)).where(wanted).dropDuplicates(["page_id", "hash"]).collect()
    texts = sorted({b[0] for r in rows for b in blocks(r["html"])})
    rng = random.Random(seed)
    long = [t for t in texts if len(t) >= 40] or ["A sentence of some length that says nothing, for pages without text."]
    short = [t for t in texts if len(t) < 40] or ["Home", "About", "News", "Contact us"]
    made = []
    for _ in range(composed):
        page, main = compose(rng, long, short)
        seen, left, labels = blocks(page), list(main), []
        for text, _, _ in seen:
            hit = bool(left) and text == _BLANK.sub(" ", left[0]).strip()
            labels.append(float(hit))
            if hit:
                left.pop(0)
        made.append((vectors(seen), np.array(labels, np.float32)))
    return train([m for m in made if len(m[1])], seed=seed)


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars, n_blocks) of all pages."""
    model = model or labeller(pages)
    weights = model.w  # about 40,000 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller()
        own.w = weights
        for batch in slices(batches, 2, 1 << 20):
            seen = [blocks(p) for p in batch.column(2).to_pylist()]
            text = [""] * len(seen)
            order = sorted((i for i, s in enumerate(seen) if s), key=lambda i: len(seen[i]))
            while order:
                # pages of about the same number of blocks together
                most = max(1, 4096 // len(seen[order[0]]))
                some = [i for i in order[:most] if len(seen[i]) <= 2 * len(seen[order[0]])]
                order = order[len(some) :]
                x, mask, _ = _together([(vectors(seen[i]), np.zeros(len(seen[i]))) for i in some])
                for i, p in zip(some, own.chance(x, mask)):
                    text[i] = "\n".join([b[0] for b, v in zip(seen[i], p.tolist()) if v >= 0.5])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                 pa.array([len(s) for s in seen], pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    return narrow(pages, "page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks long"
    )
