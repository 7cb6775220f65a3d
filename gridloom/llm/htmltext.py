"""HTML extraction: a bidirectional LSTM in numpy labels every block of a page from the whole sequence of blocks."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text of a page; without an end tag the first two reach to the end of the page,
#: head to the first tag that can't be in it, and the others to the end of their parent.
_RAW = frozenset("script style".split())
_UNSEEN = frozenset("template iframe svg canvas head textarea select datalist audio video".split())
_IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
#: Elements without an end tag.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements inside a line of text; all others begin and end blocks.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input "
    "object map math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mfenced mstyle mspace mpadded mtable mtr mtd semantics annotation".split()
)
#: Elements that end an open paragraph, even one with an unclosed unseen element in it.
_ENDS_P = frozenset("p div section article main aside header footer nav h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote form figure hr details address fieldset".split())
#: Elements that an element of the same group, opened inside their parent, ends.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[^\W_]+")

PATH_BUCKETS, WORD_BUCKETS = 1024, 1024
PATH_SIZE, WORD_SIZE, SCALARS, HIDDEN = 16, 6, 5, 16
#: Blocks that are read at a time, padding included, but for a single longer page.
CELLS = 1 << 13


@cache
def _ending(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I)


def path_of(names: Iterable[str], above: frozenset[int] = frozenset()) -> frozenset[int]:
    """Buckets of tags, classes and ids with those above them; the same object if none is new."""
    own = {_bucket(x, PATH_BUCKETS) for x in names}
    return above if own <= above else above | own


def blocks(page: str | None) -> list[tuple[frozenset[int], str, int]]:
    """The leaves of a page in order: (buckets of tags, classes and ids above it, its text, characters inside links).

    White space runs become one space; blocks without text are left out.  Character references are decoded.  A
    quote counts only after an equals sign.  Elements share the paths above them, so depth costs no copies.
    """
    out: list[tuple[frozenset[int], str, int]] = []
    stack: list[tuple[str, frozenset[int]]] = []
    depth: Counter[str] = Counter()  # open elements by tag
    unseen = 0  # open elements whose text isn't seen
    parts: list[str] = []
    linked = 0

    def push(tag: str, names: Iterable[str] = ()) -> None:
        nonlocal unseen
        stack.append((tag, path_of((tag, *names), stack[-1][1] if stack else frozenset())))
        depth[tag] += 1
        unseen += tag in _UNSEEN

    def cut(to: int) -> None:
        nonlocal unseen
        for tag, _ in stack[to:]:
            depth[tag] -= 1
            unseen -= tag in _UNSEEN
        del stack[to:]

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((stack[-1][1] if stack else frozenset(), text, linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if stack and stack[-1][0] == "head" and raw.strip():
            cut(len(stack) - 1)
        if unseen:
            return
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if depth["a"]:
            linked += len(text)

    page = page or ""
    at = 0
    while found := _TOKEN.search(page, at):
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = (found[3] or "").lower()
        if not tag:
            if found[1]:
                add(found[1])
            continue
        if found[2]:
            if depth[tag]:
                if tag not in _INLINE:
                    end_block()
                at_tag = len(stack) - 1
                while stack[at_tag][0] != tag:
                    at_tag -= 1
                cut(at_tag)
            elif tag not in _INLINE:
                end_block()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in _IN_HEAD and depth["head"]:
            inner = [t for t, _ in stack]
            if tag == "body" or "noscript" not in inner or not _ending("noscript").search(page, at):
                cut(inner.index("head"))
        if tag in _RAW or tag in _UNSEEN:
            end_block()
            if found[0].endswith("/>"):
                continue
            close = _ending(tag).search(page, at)
            if tag in _RAW:
                at = close.end() if close else len(page)
                continue
            # what ends before its parent does and has no other of its kind inside is passed over at once
            parent = next((t for t, _ in reversed(stack) if t not in _INLINE), None)
            if tag != "head" and close and not (parent and _ending(parent).search(page, at, close.start())) and not re.compile(rf"<{re.escape(tag)}\b", re.I).search(page, at, close.start()):
                at = close.end()
            else:
                push(tag)
            continue
        if tag not in _INLINE:
            end_block()
            # a new block ends an open paragraph and inline elements in it
            unclosed = next((i for i, (t, _) in enumerate(stack) if t in _UNSEEN), len(stack)) if unseen else len(stack)
            if unclosed < len(stack) and (tag not in _ENDS_P or _ending(stack[unclosed][0]).search(page, at)):
                unclosed = len(stack)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    cut(i)
                    break
                if stack[i][0] not in _INLINE and i < unclosed:
                    break
            if tag in _ENDS:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in _ENDS[tag]:
                        cut(i)
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "menu") or tag in ("li", "dd", "dt") and stack[i][0] in ("div", "section", "article"):
                        break
        if tag not in _VOID and not found[0].endswith("/>"):
            names = []
            if found[4] and "=" in found[4]:
                for key, a, b, c in _NAMED.findall(found[4]):
                    names += [w.lower() for w in _WORD.findall(a or b or c)] if key.lower() != "role" else [f"role:{(a or b or c).lower()}"]
            push(tag, names)
    add(page[at:])
    end_block()
    return out


@lru_cache(maxsize=1 << 16)
def _bucket(word: str, n: int) -> int:
    return zlib.crc32(word.encode()) % n


def vectors(found: list[tuple[frozenset[int], str, int]]) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Of each block: buckets of its path's parts, buckets of all its words with their shares, and a few numbers."""
    paths, words, numbers = [], [], np.zeros((len(found), SCALARS))
    for i, (path, text, linked) in enumerate(found):
        paths.append(np.array(sorted(path) or [0]))
        counts = np.bincount([zlib.crc32(w.encode()) % WORD_BUCKETS for w in _WORD.findall(text.lower())] or [0])
        used = np.flatnonzero(counts)
        words.append((used, counts[used] / counts.sum()))
        n = len(text)
        numbers[i] = (np.log1p(n) / 6, min(1.0, linked / n), text[-1] in ".!?…", text.count(",") * 20 / (n + 20), 1.0 / (1 + i))
    return paths, words, numbers


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def new_weights(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    inputs = PATH_SIZE + WORD_SIZE + SCALARS
    w = {"path": np.zeros((PATH_BUCKETS, PATH_SIZE)), "word": np.zeros((WORD_BUCKETS, WORD_SIZE)), "out": rng.normal(0, 0.2, 2 * HIDDEN + inputs), "bias": np.zeros(1)}
    for d in ("f", "b"):
        w[f"x{d}"] = rng.normal(0, 0.25, (inputs, 4 * HIDDEN))
        w[f"h{d}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        w[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return w


def _inputs(w: dict, pages: list, longest: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((longest, len(pages), PATH_SIZE + WORD_SIZE + SCALARS))
    mask = np.zeros((longest, len(pages)))
    for p, (paths, words, numbers) in enumerate(pages):
        for i, (a, (b, share)) in enumerate(zip(paths, words, strict=True)):
            x[i, p, :PATH_SIZE] = w["path"][a].sum(axis=0)
            x[i, p, PATH_SIZE : PATH_SIZE + WORD_SIZE] = share @ w["word"][b]
        x[: len(paths), p, PATH_SIZE + WORD_SIZE :] = numbers
        mask[: len(paths), p] = 1
    return x, mask


def _pass(w: dict, d: str, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
    """One direction over a batch; steps beyond a page's end leave its state as it is."""
    n = HIDDEN
    h, c = np.zeros((x.shape[1], n)), np.zeros((x.shape[1], n))
    out, kept = np.zeros((*x.shape[:2], n)), []
    drive = x @ w[f"x{d}"] + w[f"c{d}"]
    for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
        gates = drive[t] + h @ w[f"h{d}"]
        i, f, o = _sigmoid(gates[:, :n]), _sigmoid(gates[:, n : 2 * n]), _sigmoid(gates[:, 2 * n : 3 * n])
        g = np.tanh(gates[:, 3 * n :])
        m = mask[t][:, None]
        before = (h, c)
        fresh = f * c + i * g
        c = m * fresh + (1 - m) * c
        tanh = np.tanh(fresh)
        h = m * (o * tanh) + (1 - m) * h
        out[t] = h
        kept.append((t, i, f, o, g, tanh, *before))
    return out, kept


def forward(w: dict, pages: list) -> tuple[np.ndarray, tuple]:
    """Logits (longest, pages) that a block belongs to the main text, and what training needs."""
    longest = max(len(p[0]) for p in pages)
    x, mask = _inputs(w, pages, longest)
    (a, ka), (b, kb) = _pass(w, "f", x, mask), _pass(w, "b", x, mask)
    joined = np.concatenate([a, b, x], axis=2)
    return joined @ w["out"] + w["bias"], (x, mask, joined, {"f": ka, "b": kb})


def scores(w: dict, pages: list) -> np.ndarray:
    """The logits of ``forward`` alone: no states are kept, so memory is what the batch's inputs and two numbers a block take."""
    n, longest = HIDDEN, max(len(p[0]) for p in pages)
    x, mask = _inputs(w, pages, longest)
    out = x @ w["out"][2 * n :] + w["bias"]
    for d, own in (("f", w["out"][:n]), ("b", w["out"][n : 2 * n])):
        h, c = np.zeros((len(pages), n)), np.zeros((len(pages), n))
        for t in range(longest) if d == "f" else range(longest - 1, -1, -1):
            gates = x[t] @ w[f"x{d}"] + w[f"c{d}"] + h @ w[f"h{d}"]
            i, f, o = _sigmoid(gates[:, :n]), _sigmoid(gates[:, n : 2 * n]), _sigmoid(gates[:, 2 * n : 3 * n])
            m = mask[t][:, None]
            fresh = f * c + i * np.tanh(gates[:, 3 * n :])
            c = m * fresh + (1 - m) * c
            h = m * (o * np.tanh(fresh)) + (1 - m) * h
            out[t] += h @ own
    return out


def _gradients(w: dict, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
    logits, (x, mask, joined, kept) = forward(w, pages)
    y = np.zeros_like(logits)
    for p, l in enumerate(labels):  # noqa: E741
        y[: len(l), p] = l
    error = (_sigmoid(logits) - y) * mask / mask.sum()
    out = {k: np.zeros_like(v) for k, v in w.items()}
    out["out"], out["bias"] = np.einsum("tp,tpk->k", error, joined), error.sum(keepdims=True).ravel()[:1]
    back = error[..., None] * w["out"]
    n = HIDDEN
    dx = back[..., 2 * n :].copy()
    for d, begin in (("f", 0), ("b", n)):
        dh, dc = np.zeros((x.shape[1], n)), np.zeros((x.shape[1], n))
        for t, i, f, o, g, tanh, h0, c0 in reversed(kept[d]):
            m = mask[t][:, None]
            dh = dh + back[t][:, begin : begin + n]
            through, own = dh * (1 - m), dh * m
            dfresh = own * o * (1 - tanh**2) + dc * m
            gates = np.concatenate([dfresh * g * i * (1 - i), dfresh * c0 * f * (1 - f), own * tanh * o * (1 - o), dfresh * i * (1 - g**2)], axis=1)
            out[f"x{d}"] += x[t].T @ gates
            out[f"h{d}"] += h0.T @ gates
            out[f"c{d}"] += gates.sum(axis=0)
            dx[t] += gates @ w[f"x{d}"].T
            dh, dc = gates @ w[f"h{d}"].T + through, dfresh * f + dc * (1 - m)
    for p, (paths, words, _) in enumerate(pages):
        for i, (a, (b, share)) in enumerate(zip(paths, words, strict=True)):
            out["path"][a] += dx[i, p, :PATH_SIZE]
            out["word"][b] += share[:, None] * dx[i, p, PATH_SIZE : PATH_SIZE + WORD_SIZE]
    return out


def practice_pages(n: int, seed: int = 7) -> Iterator[tuple[str, str]]:
    """Made-up pages of many layouts with the main text that each should give; the training set of the labeller."""
    rng = np.random.default_rng(seed)
    one = lambda *xs: xs[int(rng.integers(len(xs)))]
    letters = np.array(list("aaeeiioouutnsrldmpcbghéèüñö"))
    word = lambda: "".join(rng.choice(letters, int(rng.integers(1, 11))))
    junk = lambda w: w + one("", "", "", "***", "!!", "&amp;&amp;", ",")

    def sentence(least: int = 1, most: int = 40) -> str:
        return " ".join(junk(word()) for _ in range(int(rng.integers(least, most)))).capitalize() + one(".", ".", ".", "")

    def links(k: int) -> list[str]:
        return [f'<a href="/{word()}">{word()}</a>' for _ in range(k)]

    def clutter(where: str) -> str:
        text = lambda a, b: sentence(a, b)
        named = lambda *xs: one(f'class="{one(*xs)}"', f'id="{one(*xs)}"', f'class="{one(*xs)} {one("wrap", "box", "inner", "content")}"')
        kinds = [
            lambda: f"<nav><ul>{''.join(f'<li>{x}</li>' for x in links(int(rng.integers(3, 9))))}</ul></nav>",
            lambda: f'<div {named("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "main-menu")}>{one(" ", " | ").join(links(5))}</div>',
            lambda: f'<ul {named("menu", "nav", "links", "tags", "pagination", "pager")}>{"".join(f"<li>{x}</li>" for x in links(4))}</ul>',
            lambda: f'<div {named("ad", "ads", "advert", "advertisement", "ad-banner", "banner", "sponsored", "sponsor", "promo", "ad-slot")}>{one(text(2, 20), f"<p>{text(2, 20)}</p>", f"<p>{text(2, 20)}</p><p>{text(1, 9)}</p>")}</div>',
            lambda: f"<header>{one('', '<h1>' + text(1, 5) + '</h1>')}<p>{text(2, 9)}</p>{one('', ' '.join(links(3)))}</header>",
            lambda: f'<div {named("header", "site-header", "masthead", "logo", "page-header")}><span>{text(1, 6)}</span></div>',
            lambda: f"<aside><h{one(2, 3)}>{one('Related', 'More', text(1, 4))}</h3><p>{text(3, 30)}</p><ul>{''.join(f'<li>{x}</li>' for x in links(3))}</ul></aside>",
            lambda: f'<div {named("sidebar", "side", "widget", "related", "recommended", "rail", "popular", "trending")}><h3>{text(1, 4)}</h3><p>{text(3, 40)}</p>{"".join(f"<p>{text(3, 30)}</p>" for _ in range(int(rng.integers(0, 3))))}</div>',
            lambda: f'<div {named("cookie", "cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "popup", "modal", "privacy-notice")}><p>{one("We use cookies. ", "This site uses cookies. ", "")}{text(2, 25)}</p><button>{one("Accept", "OK", text(1, 3))}</button></div>',
            lambda: f'<form action="/x"><p>{text(1, 9)}</p><label>{text(1, 4)}</label><input type="text"><button>{one("Search", "Send", "Subscribe", text(1, 3))}</button></form>',
            lambda: f'<div {named("newsletter", "subscribe", "signup", "share", "social", "login", "search", "toolbar")}><p>{text(2, 15)}</p></div>',
            lambda: f'<div role="{one("navigation", "banner", "complementary", "contentinfo", "search", "alert", "dialog")}"><p>{text(2, 30)}</p></div>',
        ]
        ends = [
            lambda: f"<footer>{one('<p>' + text(2, 20) + '</p>', '&copy; ' + text(2, 20), ' '.join(links(3)))}</footer>",
            lambda: f'<div {named("footer", "site-footer", "copyright", "legal", "bottom", "page-footer")}><p>&copy; {text(2, 20)}</p></div>',
        ]
        comments = lambda: "".join(
            f'<{one("div", "li", "article", "p")} {named("comment", "reply", "comment-body", "user-comment")}>{one(f"<p>{text(2, 40)}</p>", text(2, 40), f"<b>{word()}</b> {text(2, 30)}<p>{text(3, 30)}</p>")}</div>'
            for _ in range(int(rng.integers(1, 5)))
        )
        ends.append(lambda: f'<{(tag := one("section", "div", "ol"))} {named("comments", "comment-list", "discussion", "responses", "disqus", "reader-comments", "replies")}><h3>{one("Comments", text(1, 4))}</h3>{comments()}</{tag}>')
        return one(*(kinds if where == "before" else kinds[1:] + ends * 4))()

    for page in range(n):
        lines: list[str] = []

        def keep(markup: str, text: str, lines: list[str] = lines) -> str:
            lines.append(html.unescape(text))
            return markup.replace("@", text)

        body = [keep("<h1>@</h1>", sentence(1, 14))] if rng.random() < 0.85 else []
        for _ in range(int(rng.integers(1, 14))):
            kind = rng.random()
            text = sentence(1, one(3, 12, 60, 90))
            if kind < 0.6:
                body.append(keep(one("<p>@</p>", "<p>@</p>", "<p>@", "<div>@</div>", '<p class="text">@</p>'), text))
            elif kind < 0.7:
                body.append(keep("<p><b>@<br>", text))
            elif kind < 0.78:
                body.append(keep(one("<h2>@</h2>", "<h3>@</h3>"), sentence(1, 8)))
            elif kind < 0.85:
                body.append("<ul>" + "".join(keep("<li>@</li>", sentence(1, 15)) for _ in range(int(rng.integers(1, 5)))) + "</ul>")
            elif kind < 0.9:
                body.append("<table>" + "".join("<tr>" + keep("<td>@</td>", sentence(1, 5)) + keep("<td>@</td>", sentence(1, 5)) + "</tr>" for _ in range(int(rng.integers(1, 4)))) + "</table>")
            elif kind < 0.95:
                body.append(keep("<blockquote>@</blockquote>", text))
            else:
                body.append(keep(f'<p><a href="/{word()}">@</a></p>', word()))
            if rng.random() < 0.08:
                body.append(clutter("before"))
        inner = "".join(body)
        shell = one(
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<article class="post"><div class="body">', "</div></article>"),
            ('<div class="article">', "</div>"), ('<div id="content">', "</div>"), ('<div class="post content">', "</div>"), ('<div class="entry content"><div class="text">', "</div></div>"),
            ('<div role="main">', "</div>"), ('<section class="main story">', "</section>"), ("", ""),
        )
        before = "".join(clutter("before") for _ in range(int(rng.integers(0, 4))))
        after = "".join(clutter("after") for _ in range(int(rng.integers(0, 4))))
        if shell == ("", "") and not before and not after:
            before = clutter("before")
        yield f"<html><head><title>{sentence(1, 9)}</title></head><body>{before}{shell[0]}{inner}{shell[1]}{after}</body></html>", "\n".join(" ".join(x.split()) for x in lines)


@cache
def train(pages: int = 900, epochs: int = 8, seed: int = 11) -> dict[str, np.ndarray]:
    """Fit the labeller to practice pages by backpropagation through time with Adam."""
    data = []
    for markup, wanted in practice_pages(pages):
        found = blocks(markup)
        left = wanted.split("\n")
        labels = []
        for _, text, _ in found:  # main blocks are met in page order
            labels.append(float(bool(left) and text == left[0]))
            if labels[-1]:
                left.pop(0)
        if found:
            data.append((vectors(found), np.array(labels)))
    rng, w = np.random.default_rng(seed), new_weights()
    m, v = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}
    step, batch = 0, 24
    total = epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        order = np.concatenate([sorted(part, key=lambda i: len(data[i][1])) for part in np.array_split(order, max(1, len(order) // 240))])
        for i in rng.permutation(range(0, len(order), batch)):
            some = [data[j] for j in order[i : i + batch]]
            grads = _gradients(w, [p for p, _ in some], [y for _, y in some])
            size = np.sqrt(sum(np.square(g).sum() for g in grads.values()))
            step += 1
            for k in w:
                g = grads[k] * min(1.0, 1.0 / (size + 1e-9)) + (1e-5 * w[k] if k in ("path", "word") else 0)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= 0.02 * (1 - step / (total + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return w


def main_texts(pages: list[str | None], w: dict[str, np.ndarray], batch: int = 64, cells: int = CELLS) -> list[str]:
    """The main text of each page.  Up to ``batch`` pages of like length are read together, as far as they, padded to the longest, have ``cells`` blocks."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < min(len(order), at + batch) and (end + 1 - at) * len(found[order[end]]) <= cells:
            end += 1
        some = order[at:end]
        logits = scores(w, [vectors(found[i]) for i in some])
        for p, i in enumerate(some):
            out[i] = "\n".join(text for (_, text, _), z in zip(found[i], logits[:, p], strict=False) if z > 0)
        at = end
    return out


def extract_text(pages: DataFrame, column: str = "html", weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """Add ``text``, the main text of each page, to every row; a column of that name is replaced.

    Every leaf block of the whole page is classified; blocks of the main text are joined by line feeds in page
    order.  A null or empty page has an empty text; repeated rows are read each, pages of any length and depth whole,
    and an empty table gives an empty one.  The labeller is fitted to made-up pages unless weights are given; they
    have a fixed size and are broadcast.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights or train())

    @F.pandas_udf("string")
    def extract(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in parts:
            yield pd.Series(main_texts([p if isinstance(p, str) else None for p in pages], shared.value), dtype=object)

    return pages.withColumn("text", extract(column))
