"""Main text of web pages by a recurrent block labeller.

A tolerant scanner turns a page into its sequence of leaf blocks, each with the
path of open tags and its text.  A block's vector joins the hashed path
(tags, classes and ids), hashed words, and a few figures of its text.  A
bidirectional LSTM in numpy reads the vectors of the whole page and labels each
block as main text or not, using context from both sides.

The labeller is trained here on pages that ``training_pages`` generates from a
seed: many layouts, tag habits, class names and languages of nonsense words,
with known labels.  No page of the table is an input of the training.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements whose content is raw text or a control and never main text, void elements, elements that break a block, and those that close an open paragraph.
RAW = frozenset("script style title textarea select template iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html label legend li main menu nav noscript ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("button label option".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}

# A quote opens a value only after an equals sign, and only if it closes somewhere; a tag ends at the next ">" outside values.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?>[^>=]++|=\s*+(?>\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\x1c-\x1f\x85]+")
_SPLIT = re.compile(r"[^0-9A-Za-z\u0080-\U0010ffff]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of characters in links) of every leaf block with text, in page order."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = total = links = 0
    path: tuple[str, ...] | None = None

    def flush() -> None:
        nonlocal parts, linked, total, path
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip(" ")
            if text:
                out.append((path or (), text, linked / max(total, 1)))
        parts, linked, total, path = [], 0, 0, None

    def add(raw: str) -> None:
        nonlocal linked, total, path
        text = entities.unescape(raw)
        if path is None and text.strip():
            path = tuple(label for name, label in stack if name in BLOCK or label != name)
        parts.append(text)
        total += len(text)
        linked += len(text) if links else 0

    def pop(to: int) -> None:
        nonlocal links
        if any(name in BLOCK for name, _ in stack[to:]):
            flush()
        links -= sum(name == "a" for name, _ in stack[to:])
        del stack[to:]

    at, length = 0, len(page)
    while at < length:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
                if stack[i][0] in ("table", "body") and name not in BLOCK:
                    break
            else:
                if name in BLOCK:
                    flush()
            continue
        if name == "head":  # pages without its end tag are common; only the raw elements inside it matter
            flush()
            continue
        if name in RAW:
            if not m[0].endswith("/>") or name not in ("template", "iframe"):
                end = _END[name].search(page, at)
                # Without an end tag only what stands before the next tag is taken for its content.
                at = end.end() if end else max(page.find("<", at), at) if page.find("<", at) >= 0 else length
            continue
        if name == "br" or name == "hr":
            if name == "hr":
                flush()
            else:
                parts.append(" ")
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    pop(i)
                    break
                if stack[i][0] in ("table", "button", "td", "th", "div", "article", "section", "body", "li", "blockquote"):
                    break
        if name in SIBLINGS:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
                if stack[i][0] in SIBLINGS[name]:
                    break
        if name in BLOCK:
            flush()
        label = name
        words = sorted({w.lower() for a in _ATTR.finditer(m[3]) for w in _SPLIT.split(a[2] or a[3] or a[4] or "") if w})
        if words:
            label = name + "." + ".".join(words)
        if m[0].endswith("/>") and name not in BLOCK:
            continue
        stack.append((name, label))
        links += name == "a"
    flush()
    return out


PATH_DIM, WORD_DIM, FIGURES, HIDDEN = 192, 32, 8, 16
WIDTH = PATH_DIM + WORD_DIM + FIGURES


def _hash(text: str, size: int) -> int:
    return zlib.crc32(text.encode()) % size


@functools.lru_cache(1 << 16)
def _path_slots(path: tuple[str, ...]) -> tuple[int, ...]:
    slots = set()
    for depth, label in enumerate(path):
        name, *words = label.split(".")
        slots.add(_hash(f"tag:{name}", PATH_DIM))
        slots.update(_hash(f"word:{w}", PATH_DIM) for w in words)
        if depth == len(path) - 1:
            slots.add(_hash(f"leaf:{name}", PATH_DIM))
    return tuple(slots)


@functools.lru_cache(1)
def _kinds() -> np.ndarray:
    """1 for capitals and 2 for digits, by code point."""
    return np.array([1 if chr(c).isupper() else 2 if chr(c).isdigit() else 0 for c in range(0x110000)], np.uint8)


def vectors(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    """One row a block: hashed path, all its words hashed, and figures of its whole text."""
    out = np.zeros((len(page), WIDTH), np.float32)
    for i, (path, text, linked) in enumerate(page):
        out[i, list(_path_slots(path))] = 1
        words = text.lower().encode().split(b" ")
        n = len(words)
        out[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount([zlib.crc32(w) % WORD_DIM for w in words], minlength=WORD_DIM) / n
        kinds = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=3) / max(len(text), 1)
        out[i, -FIGURES:] = (
            min(n, 60) / 30, float(n <= 3), linked, sum(text.count(c) for c in ".!?") / n, kinds[1], kinds[2], i / max(len(page) - 1, 1), float("©" in text or "|" in text),
        )
    return out


class Labeller:
    """Weights of the two directions and of the output layer."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        init = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
        self.w = [init(WIDTH, 4 * HIDDEN) for _ in range(2)]
        self.u = [init(HIDDEN, 4 * HIDDEN) for _ in range(2)]
        self.b = [np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN))).astype(np.float32) for _ in range(2)]
        self.out, self.bias = init(2 * HIDDEN), np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.w, *self.u, *self.b, self.out, self.bias]

    def _run(self, x: np.ndarray, mask: np.ndarray, d: int, learn: bool = False):
        """One direction over (time, page, width); keeps what the gradient needs only to learn."""
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        z_x = (x.reshape(-1, WIDTH) @ self.w[d]).reshape(steps, n, -1) + self.b[d]
        hs, keep = np.zeros((steps, n, HIDDEN), np.float32), {}
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            z = z_x[t] + h @ self.u[d]
            i, f, o = (1 / (1 + np.exp(-z[:, k * HIDDEN : (k + 1) * HIDDEN])) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = np.where(m, f * c + i * g, c)
            tc = np.tanh(c_new)
            if learn:
                keep[t] = (i, f, o, g, c, tc, h)
            h = np.where(m, o * tc, h)
            c = c_new
            hs[t] = h
        return hs, keep

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate((self._run(x, mask, 0)[0], self._run(x, mask, 1)[0]), 2)
        return both @ self.out + self.bias[0]

    def gradients(self, x, mask, y) -> tuple[float, list[np.ndarray]]:
        runs = [self._run(x, mask, d, learn=True) for d in range(2)]
        both = np.concatenate((runs[0][0], runs[1][0]), 2)
        z = both @ self.out + self.bias[0]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        count = max(mask.sum(), 1)
        loss = -float((np.log(np.where(y > 0, p, 1 - p) + 1e-9) * mask).sum() / count)
        dz = ((p - y) * mask / count).astype(np.float32)
        g_out = np.tensordot(dz, both, ([0, 1], [0, 1])).astype(np.float32)
        g_bias = np.array([dz.sum()], np.float32)
        g_w, g_u, g_b = [], [], []
        steps, n, _ = x.shape
        for d in range(2):
            d_h_out = dz[:, :, None] * self.out[d * HIDDEN : (d + 1) * HIDDEN]
            d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            d_z = np.zeros((steps, n, 4 * HIDDEN), np.float32)
            g_ud = np.zeros_like(self.u[d])
            for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
                i, f, o, g, c, tc, h = runs[d][1][t]
                m = mask[t][:, None]
                total = d_h + d_h_out[t]
                d_ht = np.where(m, total, 0)
                d_ct = np.where(m, d_c + d_ht * o * (1 - tc**2), 0)
                d_z[t] = np.concatenate((d_ct * g * i * (1 - i), d_ct * c * f * (1 - f), d_ht * tc * o * (1 - o), d_ct * i * (1 - g**2)), 1)
                g_ud += h.T @ d_z[t]
                d_h = np.where(m, d_z[t] @ self.u[d].T, total)
                d_c = np.where(m, d_ct * f, d_c)
            flat = d_z.reshape(-1, 4 * HIDDEN)
            g_w.append(x.reshape(-1, WIDTH).T @ flat)
            g_u.append(g_ud)
            g_b.append(flat.sum(0))
        return loss, [*g_w, *g_u, *g_b, g_out, g_bias]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i], mask[: len(p), i] = p, True
    return x, mask


# Class names of the generated layouts, by the part of a page that they mark.
NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu site-nav links toc".split(),
    "header": "header site-header masthead top banner logo topbar branding".split(),
    "footer": "footer site-footer bottom copyright legal colophon".split(),
    "side": "sidebar side aside related widget rail secondary recommended popular trending".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad promoted".split(),
    "notice": "cookie cookies notice consent gdpr banner-notice alert popup modal newsletter subscribe".split(),
    "form": "form search login signup contact-form subscribe-form".split(),
    "comments": "comments comment reader-comments discussion replies comment-list responses".split(),
    "share": "share social sharing meta byline tags author-box pagination".split(),
    "main": "content article post entry main story article-body post-content entry-content text body-text".split(),
}


def training_pages(count: int, seed: int) -> Iterator[tuple[str, list[int]]]:
    """Generated pages with the label of every leaf block: 1 for main text."""
    rng = random.Random(seed)
    syllables = "the an ing er on re st en th le de la que ment tion ie ch un ver be ei sch ci as ra do lo ni ka mo ti su ro".split()

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.choice((1, 1, 2, 2, 3))))

    def sentence(lo: int, hi: int) -> str:
        style = rng.random()
        words = [word() for _ in range(rng.randint(lo, hi))]
        if style < 0.06:
            words = [w + rng.choice(("%%%", "***", "###", "&amp;&amp;&amp;", "$$$", "!!")) for w in words]
        elif style < 0.09:
            words = [w.upper() for w in words]
        elif style < 0.12:
            words = [words[0]] * len(words)
        elif style < 0.15:
            words = " | ".join(words).split(" ")
        words[0] = words[0].capitalize()
        return " ".join(words) + rng.choice((".", ".", ".", "", "!", "?"))

    def prose() -> str:
        return " ".join(sentence(3, 18) for _ in range(rng.choice((1, 1, 2, 3, 5))))

    for _ in range(count):
        out: list[str] = []
        labels: list[int] = []
        plain = rng.random() < 0.35
        named = lambda kind: "" if plain and rng.random() < 0.6 else f' {rng.choice(("class", "class", "id"))}="{rng.choice(NAMES[kind])}{rng.choice(("", "", " box", " wide c1"))}"'  # noqa: B023, E731

        def leaf(tag: str, text: str, label: int, extra: str = "", close: bool = True) -> None:
            out.append(f"<{tag}{extra}>{text}" + (f"</{tag}>" if close else ""))  # noqa: B023
            labels.append(label)  # noqa: B023

        def listing(kind: str, tag: str, most: int) -> None:
            out.append(f"<{tag}{named(kind)}>")  # noqa: B023
            if rng.random() < 0.3:
                leaf(rng.choice(("h3", "h4", "p", "div")), sentence(1, 3), 0)
            inner = rng.random() < 0.7
            out.append("<ul>" if inner else "")  # noqa: B023
            for _ in range(rng.randint(2, most)):
                text = sentence(1, 4) if rng.random() < 0.6 else word()
                leaf("li" if inner else rng.choice(("p", "div")), f'<a href="/{word()}">{text}</a>', 0)
            out.append("</ul>" if inner else "")  # noqa: B023
            out.append(f"</{tag}>")  # noqa: B023

        def box(kind: str, tag: str) -> None:
            form = rng.random()
            if form < 0.4:
                leaf(tag, prose(), 0, named(kind))  # noqa: B023
            else:
                out.append(f"<{tag}{named(kind)}>")  # noqa: B023
                for _ in range(rng.randint(1, 3)):
                    leaf(rng.choice(("p", "div", "h4")), prose() if rng.random() < 0.6 else sentence(1, 4), 0)
                out.append(f"</{tag}>")  # noqa: B023

        def form() -> None:
            out.append(f"<form{named('form')}>")  # noqa: B023
            for _ in range(rng.randint(1, 3)):
                leaf("label", sentence(1, 3), 0)
                out.append('<input type="text">')  # noqa: B023
            leaf("button", word(), 0)
            out.append("</form>")  # noqa: B023

        def comments() -> None:
            tag = rng.choice(("section", "div"))
            out.append(f'<{tag} {rng.choice(("class", "id"))}="{rng.choice(NAMES["comments"])}">')  # noqa: B023
            if rng.random() < 0.5:
                leaf(rng.choice(("h2", "h3", "h4")), sentence(1, 3), 0)
            for _ in range(rng.randint(1, 6)):
                holder = rng.choice(("div", "li", "article"))
                out.append(f'<{holder} class="{rng.choice(("comment", "reply", "comment-body"))}">')  # noqa: B023
                if rng.random() < 0.5:
                    leaf("div", word() + " " + word(), 0)
                leaf("p", prose(), 0)
                out.append(f"</{holder}>")  # noqa: B023
            out.append(f"</{tag}>")  # noqa: B023

        title = sentence(2, 9)
        out.append(f'<!DOCTYPE html><html lang="{rng.choice(("en", "fr", "de", "es"))}"><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>')
        tops = [lambda: listing("nav", rng.choice(("nav", "nav", "div")), 8), lambda: box("header", rng.choice(("header", "header", "div")) if not plain else "header"), lambda: box("notice", "div") if not plain else None, lambda: leaf("div", prose(), 0, f' class="{rng.choice(NAMES["ad"])}"'), lambda: out.append(f"<!-- {word()} -->"), lambda: leaf("noscript", sentence(2, 8), 0)]
        rng.shuffle(tops)
        for f in tops[: rng.randint(1, 5)]:
            f()
        if rng.random() < 0.25:
            listing("side", "aside", 6)
        style = rng.random()
        holder = "article" if style < 0.5 else "main" if style < 0.65 else "div" if style < 0.9 else "section"
        wrap = rng.random() < 0.3
        if wrap:
            out.append(f"<div{named('main')}>")
        out.append(f"<{holder}" + (f' class="{rng.choice(NAMES["main"])}"' if holder in ("div", "section") or rng.random() < 0.3 else "") + ">")
        if rng.random() < 0.8:
            leaf(rng.choice(("h1", "h1", "h1", "h2")), title, 1)
        if rng.random() < 0.2:
            leaf("div", sentence(1, 5), 0, f' class="{rng.choice(NAMES["share"])}"')
        loose = rng.random() < 0.3
        for i in range(rng.choice((1, 1, 2, 3, 4, 6, 8, 12, 20))):
            r = rng.random()
            if r < 0.72 or i == 0:
                if loose and rng.random() < 0.4:
                    leaf("p", ("<b>" if rng.random() < 0.6 else "") + prose() + rng.choice(("<br>", "")), 1, close=False)
                else:
                    text = prose()
                    if rng.random() < 0.15:
                        text += f' <a href="/{word()}">{sentence(1, 3)}</a> ' + sentence(1, 6)
                    leaf("p", text, 1)
            elif r < 0.8:
                leaf(rng.choice(("h2", "h3")), sentence(1, 6), 1)
            elif r < 0.86:
                tag = rng.choice(("ul", "ol"))
                out.append(f"<{tag}>")
                for _ in range(rng.randint(2, 4)):
                    leaf("li", sentence(2, 10), 1)
                out.append(f"</{tag}>")
            elif r < 0.9:
                out.append("<blockquote>")
                leaf("p", prose(), 1)
                out.append("</blockquote>")
            elif r < 0.93:
                out.append("<table><tr>")
                for _ in range(3):
                    leaf("td", sentence(1, 3), 1)
                out.append("</tr></table>")
            elif r < 0.96:
                leaf("div", prose(), 0, f' class="{rng.choice(NAMES["ad"])}"')
            else:
                leaf("pre", sentence(2, 8), 1)
        if rng.random() < 0.25:
            box("share", "div") if not plain else None
        if rng.random() < 0.2:
            comments()
        out.append(f"</{holder}>")
        if wrap:
            out.append("</div>")
        ends = [lambda: listing("side", rng.choice(("aside", "div")) if not plain else "aside", 6), comments, form, lambda: leaf("div", prose(), 0, f' class="{rng.choice(NAMES["ad"])}"'), lambda: box("notice", "div") if not plain else None]
        rng.shuffle(ends)
        for f in ends[: rng.randint(0, 3)]:
            f()
        if rng.random() < 0.85:
            if rng.random() < 0.6:
                leaf("footer", f"&copy; {word()}.{word()}.com &middot; " + sentence(2, 8), 0)
            else:
                box("footer", "footer")
        cut = rng.random() < 0.1
        yield "".join(out) + ("" if cut else "</body></html>"), labels


@functools.lru_cache(1)
def trained(pages: int = 1500, epochs: int = 6, seed: int = 11) -> Labeller:
    """The labeller after Adam over generated pages in batches; the same every time."""
    data = []
    for page, labels in training_pages(pages, seed):
        found = blocks(page)
        if len(found) == len(labels):  # a generated text can be empty or join a neighbour; such pages teach nothing certain
            data.append((vectors(found), np.array(labels, np.float32)))
    model = Labeller(seed)
    m = [np.zeros_like(p) for p in model.parameters()]
    v = [np.zeros_like(p) for p in model.parameters()]
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: (len(data[i][0]) // 8))
        starts = rng.permutation(range(0, len(order), 32))
        for at in starts:
            part = [data[i] for i in order[at : at + 32]]
            x, mask = _padded([a for a, _ in part])
            y = np.zeros(mask.shape, np.float32)
            for i, (_, label) in enumerate(part):
                y[: len(label), i] = label
            _, grads = model.gradients(x, mask, y)
            step += 1
            for p, g, a, b in zip(model.parameters(), grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.006 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return model


def labels(model: Labeller, pages: list[list[tuple[tuple[str, ...], str, float]]]) -> list[np.ndarray]:
    """Whether each block of each page is main text; pages of like length run together."""
    out = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        # At most about 8,000 steps a batch bound its memory; a longer page runs alone.
        take = max(1, 8000 // len(pages[order[min(at + 63, len(order) - 1)]]))
        part = order[at : at + min(take, 64)]
        x, mask = _padded([vectors(pages[i]) for i in part])
        s = model.scores(x, mask) > 0
        for j, i in enumerate(part):
            out[i] = s[: len(pages[i]), j]
        at += len(part)
    return out


def _extract(model):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            at = b.schema.get_field_index("html")
            col = b.column(at)
            texts: list[str] = []
            for lo in range(0, len(col), 256):
                pages = [blocks(x) if x else [] for x in col[lo : lo + 256].to_pylist()]
                for page, good in zip(pages, labels(m, pages), strict=True):
                    texts.append("\n\n".join(text for (_, text, _), g in zip(page, good, strict=True) if g))
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), pa.array(texts, pa.string())], names=[*(n for i, n in enumerate(b.schema.names) if i != at), "text"])

    return extract


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the trained parameters."""
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([[p.astype(np.float32).tobytes() for p in trained().parameters()]], pa.list_(pa.binary()))], names=["parameters"])


_labellers: dict[str, Labeller] = {}


def labeller(spark: SparkSession) -> Labeller:
    """The trained labeller; an executor trains it, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _labellers:
        row = spark.range(1, numPartitions=1).mapInArrow(_train, "parameters array<binary>").first()
        model = Labeller(0)
        for p, blob in zip(model.parameters(), row[0], strict=True):
            p[...] = np.frombuffer(bytes(blob), np.float32).reshape(p.shape)
        _labellers.clear()
        _labellers[app] = model
    return _labellers[app]


def extract_text(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url", model: Labeller | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text and n_chars (code points), one row per input row.

    Blocks of main text are joined in page order by two line feeds; white space
    inside a block is one space.  A null or empty page, and one without main
    text, has an empty text.  A script, style, title, form control, template or
    iframe that is not closed hides only what stands before the next tag.  Null ids and urls and repeated rows are kept as
    they are; an empty table gives an empty result; other columns are not read.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or labeller(pages.sparkSession))
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    fields = base.schema
    out = base.mapInArrow(_extract(held), f"page_id {fields['page_id'].dataType.simpleString()}, url {fields['url'].dataType.simpleString()}, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
