"""Main text of HTML pages: a bidirectional LSTM labels every leaf block in document context.

A page is cut into leaf blocks: maximal runs of text between block-level tags.  A block is
described by its tag path (hashed tag, class and id words of its ancestors, the nearest
strongest), its words (hashed) and a few measures (length, share of link text, place).  The
sequence of a page's blocks is read by two LSTMs, one in each direction, so the label of a
block depends on the whole page; blocks labelled as main text are kept, joined by newlines.

The network is written in numpy and trained here, on pages composed by `sample_page` from many
layouts with known labels (article, menu, header, footer, sidebar, notice, advert, form,
comments).  Training is deterministic, takes seconds on the driver, and the weights
(about 200 KB) are broadcast; pages are labelled in batches of equal length.

White space inside a block becomes one space, character references are decoded, comments,
scripts, styles, templates and titles are no text, nor is what svg, iframe, canvas, audio and video
hold.  Only a script, style or title without an end reaches to the end of the page; others that have
no end or are closed at once are empty.  Text in math, object and noscript counts.  Unclosed paragraphs and list items end
where the next begins; unknown tags and stray closing tags do not break a block unless they
are block-level.

Defined cases: null and empty pages, and pages without a main block, give ''; text outside any
tag is a block of its own; repeated pages each get a row; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import FOLD, Memo, WordHashes, map_texts

PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 160, 32, 8, 16
PAGES, EPOCHS, RATE, SEED = 1500, 8, 0.01, 11
DECAY = 0.8

_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4"
    " h5 h6 head header hgroup html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th"
    " thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open one of the named tags, up to the named limits.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_IN_P = _BLOCK - {"button", "label", "legend", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head", "title", "select", "textarea"}
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))"
    r"|<(script|style|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    # Not after "/>", not without an end, and not over another one's beginning: then it is a tag like others.
    r"|<(template|iframe|svg|canvas|audio|video|annotation|annotation-xml)(?=[\s/>])[^>]*(?<!/)>[^<]*+(?:<(?!/?\2[\s/>])[^<]*+)*+</\2\s*>"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>",
    re.S | re.I,
)
#: How what may reach to the end of the page ends where it is closed.
_CLOSED = re.compile(r"(?:-->|<!--?->|</(?:script|style|title)\s*>)\Z", re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


#: Levels of a path that a block keeps: what lies further out weighs less than a float can tell beside the others.
DEEPEST = 100


@dataclass
class Block:
    path: list[tuple[str, ...]]
    text: str
    in_links: int


def _names(attributes: str) -> tuple[str, ...]:
    """The words of class, id and role."""
    if "=" not in attributes:
        return ()
    values = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return tuple(part.lower() for value in values for part in _PART.findall(html.unescape(value)))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter[str] = Counter()  # how often each tag is in the stack
    parts: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block([(tag, *names) for tag, names in stack[-DEEPEST:]], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def cut(at: int) -> None:
        opened.subtract(tag for tag, _ in stack[at:])
        del stack[at:]

    def close(tags: set[str], limits: set[str]) -> None:
        if not any(opened[tag] for tag in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                cut(i)
                return
            if stack[i][0] in limits:
                return

    at, last = 0, page.rfind(">") + 1  # no tag ends after that; only an unclosed comment, script, style or title goes on
    if "<!--" in page[last:]:
        last = len(page)
    for token in _TOKEN.finditer(page, 0, last):
        start, end = token.span()
        if start > at:
            text = page[at:start]
            parts.append(html.unescape(text) if "&" in text else text)
            if links:
                linked += len(text)
        at = end
        name = token[4] or token[7]
        if not name:
            if end == last and (token[1] or page.startswith("<!--", start)) and not _CLOSED.search(page, start, end):
                at = len(page)  # never closed: the rest of the page is no text
            continue
        name, closing, attributes = name.lower(), token[3] or token[6], token[5] or token[8] or ""
        if name == "br" or name == "hr":
            if name == "hr":
                flush()
            else:
                parts.append(" ")
        elif name == "a":
            links = 0 if closing else 1
        elif name in _BLOCK:
            flush()
            if closing:
                if opened[name]:
                    cut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
                continue
            if name in _IN_P:
                close({"p"}, {"td", "th", "button", "table"})
            if name in _ENDS:
                close(*_ENDS[name])
            stack.append((name, _names(attributes)))
            opened[name] += 1
        elif name not in _VOID and not closing and attributes.endswith("/"):
            continue
    if at < len(page):
        tail = page[at:]
        parts.append(html.unescape(tail) if "&" in tail else tail)
        if links:
            linked += len(tail)
    flush()
    return out


def _bucket(token: str, dim: int) -> int:
    return zlib.crc32(token.encode()) % dim


class Describer:
    """Vectors of blocks."""

    def __init__(self):
        self.hashes = WordHashes()
        self.paths = Memo(self._path, limit=1 << 14, longest=40)

    @staticmethod
    def _path(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
        vector = np.zeros(PATH_DIM, np.float32)
        for depth, level in enumerate(reversed(path)):
            for i, token in enumerate(level):
                vector[_bucket(("" if i else "<") + token, PATH_DIM)] += DECAY**depth
        return np.minimum(vector, 2)

    def _hashed_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(blocks x WORD_DIM) shares of hashed words, and the numbers of words."""
        starts, hashes = self.hashes(b" ".join(texts).translate(FOLD))
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
        n = np.bincount(owner, minlength=len(texts))
        slots = owner * WORD_DIM + (hashes % np.uint64(WORD_DIM)).astype(np.int64)
        counts = np.bincount(slots, minlength=len(texts) * WORD_DIM).reshape(len(texts), WORD_DIM)
        return np.minimum(counts / np.sqrt(n + 3)[:, None], 1), n

    def describe(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """One (blocks x features) array for each page."""
        out, at = [], 0
        found = [block for page in pages for block in page]
        features = np.zeros((len(found), PATH_DIM + WORD_DIM + MEASURES), np.float32)
        n = np.zeros(len(found), np.int64)
        for first in range(0, len(found), 2048):
            some = slice(first, first + 2048)
            features[some, PATH_DIM : PATH_DIM + WORD_DIM], n[some] = self._hashed_words([b.text.encode() for b in found[some]])
        for i, block in enumerate(found):
            features[i, :PATH_DIM] = self.paths[tuple(block.path)]
        length = np.array([len(b.text) for b in found], np.float64)
        signs = np.array([sum(map(b.text.count, ".,;")) for b in found], np.float64)
        ended = np.array([b.text[-1] in ".!?\u2026\u3002" for b in found], np.float64)
        links = np.array([b.in_links for b in found], np.float64)
        place = np.concatenate([np.arange(len(p)) / len(p) for p in pages if p] or [np.zeros(0)])
        rest = np.concatenate([np.arange(len(p) - 1, -1, -1) / len(p) for p in pages if p] or [np.zeros(0)])
        measures = (np.log1p(length) / 5, np.log1p(n) / 4, links / np.maximum(length, 1), place, rest, ended, signs / (n + 1), np.ones(len(found)))
        features[:, PATH_DIM + WORD_DIM :] = np.stack(measures, axis=1)
        for page in pages:
            out.append(features[at : at + len(page)])
            at += len(page)
        return out


class BlockLabeller:
    """Two LSTMs and a logistic output; `forward` and `backward` work on (steps, pages, features)."""

    def __init__(self, seed: int = SEED):
        rng, width = np.random.default_rng(seed), PATH_DIM + WORD_DIM + MEASURES
        self.weights = {}
        for side in "lr":
            self.weights[f"x{side}"] = rng.normal(0, width**-0.5, (width, 4 * HIDDEN)).astype(np.float32)
            self.weights[f"h{side}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1.0
            self.weights[f"b{side}"] = bias
        self.weights["out"] = rng.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN).astype(np.float32)
        self.weights["bias"] = np.zeros(1, np.float32)

    def _side(self, x: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states in reading order; gates are input, forget, output, candidate."""
        wh = self.weights[f"h{side}"]
        pre = x @ self.weights[f"x{side}"] + self.weights[f"b{side}"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        states, tape = np.empty((*x.shape[:2], HIDDEN), np.float32), []
        for t in range(len(x)):
            z = pre[t] + h @ wh
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g, before, earlier = np.tanh(z[:, 3 * HIDDEN :]), c, h
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            if keep:
                tape.append((i, f, o, g, before, earlier, squashed))
        return states, tape

    def forward(self, x: np.ndarray, keep: bool = False):
        left, tape_l = self._side(x, "l", keep)
        right, tape_r = self._side(x[::-1], "r", keep)
        both = np.concatenate([left, right[::-1]], axis=2)
        z = both @ self.weights["out"] + self.weights["bias"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), (both, tape_l, tape_r)

    def _back(self, x: np.ndarray, side: str, tape: list, grad: np.ndarray, out: dict) -> None:
        wh, dz = self.weights[f"h{side}"], np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
        d_wh = np.zeros_like(wh)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, before, earlier, squashed = tape[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - squashed**2)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            d_wh += earlier.T @ dz[t]
            dh, dc = dz[t] @ wh.T, dc * f
        flat = dz.reshape(-1, 4 * HIDDEN)
        out[f"x{side}"], out[f"h{side}"], out[f"b{side}"] = x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(axis=0)

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over unmasked blocks."""
        p, (both, tape_l, tape_r) = self.forward(x, keep=True)
        d = ((p - y) * mask / mask.sum()).astype(np.float32)
        out = {"out": np.einsum("tb,tbh->h", d, both), "bias": d.sum(keepdims=True).reshape(1)}
        grad = d[:, :, None] * self.weights["out"]
        self._back(x, "l", tape_l, grad[:, :, :HIDDEN], out)
        self._back(np.ascontiguousarray(x[::-1]), "r", tape_r, grad[::-1, :, HIDDEN:], out)
        return out

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of one length go through together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        by_length: dict[int, list[int]] = {}
        for k, page in enumerate(pages):
            by_length.setdefault(len(page), []).append(k)
        for length, which in by_length.items():
            step = max(1, 20_000 // max(1, length))
            for at in range(0, len(which) if length else 0, step):
                some = which[at : at + step]
                p, _ = self.forward(np.stack([pages[k] for k in some], axis=1))
                for column, k in enumerate(some):
                    out[k] = p[:, column] >= 0.5
        return out


# How the parts of a page are commonly called: used to compose training pages.
ROLES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs links tabs pagination pager sitemap toc".split(),
    "header": "header masthead site-header page-header top topbar top-bar branding logo banner head".split(),
    "footer": "footer site-footer page-footer colophon bottom copyright foot legal".split(),
    "sidebar": "sidebar side aside widget related recommended rail popular trending tags categories archive author-box more-stories".split(),
    "notice": "notice cookie cookie-banner cookies consent gdpr alert modal popup overlay newsletter subscribe paywall signup message flash disclaimer".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion ad-slot adsbygoogle ad-container banner-ad commercial".split(),
    "form": "form search search-form login contact-form signup-form field".split(),
    "comments": "comments comment comment-list discussion reply replies responses respond disqus reader-comments feedback thread".split(),
    "share": "share social share-buttons social-links follow sharing toolbar".split(),
}
MAIN = "article content main post entry-content story post-body article-body text main-content body-text page-content post-content prose".split()
WORDS = {
    "menu": "home about contact news blog products services help login archive shop support team careers pricing docs next previous".split(),
    "header": "welcome home daily site journal official tagline world menu search sign in".split(),
    "footer": "© copyright all rights reserved privacy policy terms of use imprint contact sitemap powered by 2024".split(),
    "sidebar": "related posts popular recent read more you may also like tags categories archive trending about the author".split(),
    "notice": "we use cookies accept this site to improve your experience subscribe newsletter agree settings please enable javascript".split(),
    "advert": "advertisement sponsored buy now offer sale discount save today free shop best deal click here promoted".split(),
    "form": "name email password search submit send your message subscribe required login remember me".split(),
    "comments": "comments reply says posted by anonymous ago great thanks report like comment leave a 3 days".split(),
    "share": "share tweet facebook email print follow us copy link".split(),
}
TAGS = {
    "menu": ["nav", "div", "ul", "menu", "section", "nav"], "header": ["header", "div", "section", "header"], "footer": ["footer", "div", "section", "footer"],
    "sidebar": ["aside", "div", "section", "aside"], "notice": ["div", "section", "aside", "dialog", "p"], "advert": ["div", "aside", "section", "ins", "p", "div"],
    "form": ["form", "form", "div"], "comments": ["section", "div", "ol", "ul"], "share": ["div", "ul", "section"],
}


def sample_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page composed of parts in a random layout, and whether each of its blocks is main text."""
    labels: list[bool] = []
    syllables = [rng.choice("b c d f g h l m n p r s t v w é ä ch th st".split()) + rng.choice("a e i o u ie ou ä ó".split()) for _ in range(40)]

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.choice((1, 1, 2, 2, 3, 4))))

    def prose(low: int, high: int) -> str:
        words = [word() for _ in range(rng.randint(low, high))]
        ends = [w + rng.choice(["", "", "", "", ",", "", "", "."]) for w in words]
        kind = rng.random()
        if kind < 0.1:
            ends = [w + rng.choice(["###", "***", "&amp;&amp;&amp;", "%%%"]) for w in ends]
        elif kind < 0.18:
            ends = [x for w in words for x in (w, "|")][: rng.randint(1, 2 * len(words))]
        elif kind < 0.24:
            ends = words[:1] * len(words)
        text = " ".join(ends).capitalize()
        return text.upper() if kind > 0.97 else text + rng.choice([".", ".", ".", ""])

    def block(tag: str, text: str, main: bool, attributes: str = "") -> str:
        labels.append(main)
        if rng.random() < 0.1:
            text = f"<b>{text}" + rng.choice(["</b>", "<br>"])
        elif rng.random() < 0.15:
            text = f'{text} <a href="/{word()}">{word()}</a> {word()}'
        end = "" if tag in ("p", "li") and rng.random() < 0.15 else f"</{tag}>"
        return f"<{tag}{attributes}>{text}{end}"

    def named(names: list[str]) -> str:
        chosen = rng.choice(names)
        if rng.random() < 0.25:
            chosen = rng.choice(["site", "js", "c", "main", "block", "wp", "the"]) + rng.choice("-_") + chosen
        kind = rng.choice(["class", "class", "id"])
        extra = f" {word()}" if kind == "class" and rng.random() < 0.3 else ""
        return f' {kind}="{chosen}{extra}"'

    def phrase(role: str, low: int, high: int) -> str:
        return " ".join(rng.choice(WORDS[role]) if rng.random() < 0.6 else word() for _ in range(rng.randint(low, high))).capitalize()

    def part(role: str) -> str:
        tag = rng.choice(TAGS[role])
        plain = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
        attributes = "" if plain else named(ROLES[role])
        like_prose = rng.random() < (0.15 if role in ("menu", "share", "form") else 0.5)
        text: Callable[[], str] = (lambda: prose(2, 40)) if like_prose else (lambda: phrase(role, 1, 8))
        if tag in ("p", "ins") or rng.random() < 0.35 and tag not in ("ul", "ol", "menu"):
            labels.append(False)
            body = text()
            body = f"&copy; {body} &middot; {prose(1, 6)}" if role == "footer" and rng.random() < 0.4 else body
            return f"<{'div' if tag == 'ins' else tag}{attributes}>{body}</{'div' if tag == 'ins' else tag}>"
        inner = []
        if rng.random() < 0.35 and tag not in ("ul", "ol", "menu"):
            inner.append(block(rng.choice(["h2", "h3", "h4", "div"]), phrase(role, 1, 4), False))
        if role in ("menu", "share") or tag in ("ul", "ol", "menu") or rng.random() < 0.3:
            items = []
            for _ in range(rng.randint(1, 8)):
                labels.append(False)
                linked = role in ("menu", "share") or rng.random() < 0.5
                label = text() if role == "comments" else phrase(role, 1, 3) if rng.random() < 0.5 else word()
                items.append(f'<li><a href="/{word()}">{label}</a></li>' if linked else f"<li>{label}</li>")
            inner.append("".join(items) if tag in ("ul", "ol", "menu") else f"<ul>{''.join(items)}</ul>")
        elif role == "form":
            inner += [block(rng.choice(["label", "p", "div", "button"]), phrase(role, 1, 4), False) + '<input type="text">' for _ in range(rng.randint(1, 4))]
        else:
            inner += [block(rng.choice(["p", "div", "p"]), text(), False, named(ROLES[role]) if rng.random() < 0.2 else "") for _ in range(rng.randint(1, 5))]
        return f"<{tag}{attributes}>{''.join(inner)}</{tag}>"

    def article() -> str:
        title = prose(3, 12)
        inner = []
        if rng.random() < 0.85:
            heading = block("h1", title, True)
            inner.append(f"<header>{heading}</header>" if rng.random() < 0.15 else heading)
        for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 20])):
            kind = rng.random()
            if kind < 0.72:
                inner.append(block("p", prose(1, 90), True))
            elif kind < 0.8:
                inner.append(block(rng.choice(["h2", "h3"]), prose(2, 7), True))
            elif kind < 0.86:
                inner.append("<ul>" + "".join(block("li", prose(2, 20), True) for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.9:
                inner.append(f"<blockquote>{block('p', prose(5, 40), True)}</blockquote>")
            elif kind < 0.93:
                inner.append("<table>" + "".join("<tr>" + "".join(block("td", prose(1, 4), True) for _ in range(2)) + "</tr>" for _ in range(2)) + "</table>")
            elif kind < 0.95:
                inner.append(block("pre", prose(4, 30), True))
            else:
                inner.append(part(rng.choice(["advert", "share", "notice", "sidebar", "form", "advert"])))
        body = "".join(inner)
        layout = rng.random()
        if layout < 0.45:
            return f"<article{named(MAIN) if rng.random() < 0.3 else ''}>{body}</article>"
        if layout < 0.6:
            return f"<main>{body}</main>"
        if layout < 0.9:
            return f"<div{named(MAIN)}>{body}</div>"
        return body

    def group(roles: list[str], chance: float) -> str:
        return "".join(part(r) for r in roles if rng.random() < chance)

    before = group(rng.sample(["menu", "header", "notice", "advert", "form", "menu"], 6), 0.4)
    side = group(["sidebar", "menu"], 0.2)
    middle = article()
    after = group(rng.sample(["comments", "share", "sidebar", "advert", "form", "notice"], 6), 0.3) + group(["footer"], 0.8)
    wrap = rng.random()
    body = f"{before}<div{named(['wrapper', 'container', 'page', 'layout', 'row'])}>{side}{middle}</div>{after}" if wrap < 0.4 else before + side + middle + after
    head = f"<!DOCTYPE html><html><head><title>{word()}</title><style>p{{x:y}}</style><script>var a='<p>';</script></head>"
    return f"{head}<body>{body}</body></html>", labels


@lru_cache(maxsize=1)
def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> BlockLabeller:
    """The network after training with Adam on composed pages; the same on every call."""
    rng, describer, net = random.Random(seed), Describer(), BlockLabeller(seed)
    data = []
    for _ in range(pages):
        page, labels = sample_page(rng)
        found = blocks(page)
        if len(found) == len(labels) and found:
            data.append((describer.describe([found])[0], np.array(labels, np.float32)))
    data.sort(key=lambda d: len(d[1]))
    batches = [data[i : i + 32] for i in range(0, len(data), 32)]
    first, second = ({k: np.zeros_like(w) for k, w in net.weights.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rng.shuffle(batches)
        for batch in batches:
            steps = max(len(y) for _, y in batch)
            x = np.zeros((steps, len(batch), batch[0][0].shape[1]), np.float32)
            y, mask = np.zeros((steps, len(batch)), np.float32), np.zeros((steps, len(batch)), np.float32)
            for k, (features, labels) in enumerate(batch):
                shift = rng.randint(0, steps - len(labels))
                x[shift : shift + len(labels), k], y[shift : shift + len(labels), k], mask[shift : shift + len(labels), k] = features, labels, 1
            step += 1
            rate = RATE * (0.5 ** (epoch / 3))
            for name, g in net.gradients(x, y, mask).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                net.weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return net


def main_text(pages: list[str], net: BlockLabeller, describer: Describer) -> list[str]:
    """The main text of each page."""
    found = [blocks(page) for page in pages]
    labels = net.label(describer.describe(found))
    return ["\n".join(b.text for b, main in zip(page, mine, strict=True) if main) for page, mine in zip(found, labels, strict=True)]


def extract(pages: DataFrame, net: BlockLabeller | None = None, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    sent = pages.sparkSession.sparkContext.broadcast(net or trained())
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(markup).cast("string").alias("markup"))

    def start():
        network, describer = sent.value, Describer()

        def make(raws: list[bytes]) -> list[pa.Array]:
            out = []
            for at in range(0, len(raws), 512):
                out += main_text([raw.decode() for raw in raws[at : at + 512]], network, describer)
            return [pa.array(out, pa.string())]

        return make

    found = map_texts(rows, "key", "markup", start, "text string", carry=True)
    return found.select(F.col("doc_id").alias("page_id"), "row.url", "text", F.length("text").cast("long").alias("n_chars"))
