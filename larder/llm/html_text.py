"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: runs of text between block-level
tags, each with the tags, classes, ids and roles above it. A bidirectional LSTM
in numpy reads, for every block, the hashed names of its whole tag path, a hashed
word vector and a few measures (length, link share, place in the page), so that each block is
judged with the whole page in view. Blocks called main are joined by a blank line.

The labeller is trained here on at most ``SAMPLE`` pages of the table. Their
labels come from meaning-bearing markup (``MAIN`` and ``ASIDE`` names); each
sampled page is also shown in other layouts, with its blocks put under other
wrappers and with text of other pages as comments, sidebars or notices, so that
the labeller does not lean on one template. Scripts, styles, form controls and
other text that is never shown are left out while blocks are read.

Defined cases: null and empty html give an empty text of 0 characters; a page
without a main block too; unclosed tags end where their parent does; rows are
independent, so repeated rows or null ids pass through; without any page to
learn from there is nothing to label either.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import flat, gathered, span_hashes, words

SAMPLE = 500
PATHS, WORDS, MEASURES, HIDDEN = 1024, 32, 6, 24
#: Path names whose weights are gathered at once.
GATHER = 1 << 16
SCHEMA = "page_id long, url string, text string, n_chars long"

#: Names in tags, classes, ids or roles that mark main text, and those that mark what is not.
MAIN = frozenset("article main content post entry story body text articlebody prose maincontent postcontent".split())
ASIDE = frozenset(
    """nav navigation navbar menu menubar breadcrumb breadcrumbs header masthead banner footer contentinfo copyright
    aside sidebar side complementary widget widgets ad ads advert advertisement adverts sponsor sponsored promo
    notice notices cookie cookies consent alert popup modal newsletter subscribe signup login form search
    comment comments commentlist reply replies respond disqus discussion responses related recommended share sharing
    social pagination pager toolbar tags meta toc legal disclaimer""".split()
)
_LAYOUT = frozenset("body text meta side content".split())  # weak alone: other names decide first

_RAW = "script|style|noscript|template|textarea|title|iframe"  # up to their end tag, whatever stands inside
_UNSHOWN = frozenset("select option button datalist svg object canvas audio video map".split())
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<({_RAW})\b(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>).*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")
_VOID = frozenset("br img hr input meta link area base col embed source track wbr param".split())
_INLINE = frozenset(
    "a b i u s em strong span small big sub sup code kbd samp var cite q abbr acronym font mark del ins time label tt bdi bdo dfn img wbr data ruby rt rp".split()
)
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "option": ({"option"}, {"optgroup", "select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
           "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

Block = tuple[tuple[str, ...], str, float]  # distinct names of the whole path, text, share of it in links


@lru_cache(maxsize=4096)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    for _, value in _ATTRIBUTE.findall(attributes):
        found += [f".{n}" for n in _NAME.findall(value.strip("\"'").lower())]
        flat_name = "".join(_NAME.findall(value.lower()))
        if flat_name in MAIN or flat_name in ASIDE:
            found.append(f".{flat_name}")
    return tuple(dict.fromkeys(found))


def _unclosed(m: re.Match) -> bool:
    """Whether a comment or raw element goes on to the end of the page."""
    if m[1] is not None:
        return re.search(rf"</{m[1]}\s*>\Z", m[0], re.I) is None
    return m[0].startswith("<!--") and not m[0].endswith("-->")


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open tags, and how many distinct names are above each
    above: dict[str, None] = {}  # distinct names of the open tags
    places: defaultdict[str, list[int]] = defaultdict(list)  # where in the stack each tag is open
    solid: list[int] = []  # where an element is open that is not inline
    bounds: list[int] = []  # those of them that are not paragraphs
    held: list[str] = []
    linked = unshown = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text and not unshown:
                out.append((tuple(above), text, min(1.0, linked / len(text))))
            held.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            held.append(text)
            if places["a"]:
                linked += len(text)

    def shut_from(k: int) -> None:
        nonlocal unshown
        for tag, _ in reversed(stack[k:]):
            places[tag].pop()
            unshown -= tag in _UNSHOWN
        while len(above) > stack[k][1]:
            above.popitem()
        del stack[k:]
        for own in (solid, bounds):
            while own and own[-1] >= k:
                own.pop()

    at = 0
    last = page.rfind(">") + 1  # no tag ends behind it, so what begins there is looked at once
    for m in _TOKEN.finditer(page, 0, last):
        add(page[at : m.start()])
        at = m.end()
        if at == last and _unclosed(m):
            at = len(page)
        if m[1] is not None:
            if m[1].lower() == "title":
                flush()
            continue
        closing, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        inline = tag in _INLINE
        if not inline:
            flush()
        if closing:
            if places[tag] and not (inline and solid and solid[-1] > places[tag][-1]):
                shut_from(places[tag][-1])
            continue
        if tag in _VOID or attributes.endswith("/") and not inline:
            continue
        if not inline:
            shut, within = _CLOSES.get(tag, ((), None))
            bound = bounds[-1:] if within is None else [places[t][-1] for t in within if places[t]]
            least = max(bound, default=-1)
            ends = [places[t][at_least] for t in ("p", *shut) if (at_least := bisect_right(places[t], least)) < len(places[t])]
            if ends:
                shut_from(min(ends))
            solid.append(len(stack))
            if tag != "p":
                bounds.append(len(stack))
        places[tag].append(len(stack))
        unshown += tag in _UNSHOWN
        stack.append((tag, len(above)))
        above.update(dict.fromkeys(_names(tag, attributes)))
    add(page[at:].partition("<!--")[0])
    flush()
    return out


def _path_ids(path: tuple[str, ...]) -> list[int]:
    """Columns of a path's names, at most PATHS, whatever the depth."""
    return list(dict.fromkeys(map(_hash_name, path))) or [0]


@lru_cache(maxsize=1 << 16)
def _hash_name(name: str) -> int:
    return zlib.crc32(name.encode()) % PATHS


def features(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all blocks of all pages: hashed path names (flat), their offsets, and dense columns."""
    ids: list[int] = []
    at = [0]
    for own in pages:
        for path, _, _ in own:
            ids += _path_ids(path)
            at.append(len(ids))
    texts = [b[1] for own in pages for b in own]
    data, offsets = flat(pa.array(texts, pa.string()))
    dense = np.zeros((len(texts), WORDS + MEASURES), np.float32)
    if texts:
        starts, ends, first = words(data, offsets)
        n = np.diff(first)
        bucket = (span_hashes(data, starts, ends, lower=True) % np.uint64(WORDS)).astype(np.int64)
        whose = np.repeat(np.arange(len(texts)), n)
        dense[:, :WORDS] = np.bincount(whose * WORDS + bucket, minlength=len(texts) * WORDS).reshape(-1, WORDS) * 2 / np.maximum(n, 1)[:, None]
        sizes = np.diff(offsets)
        page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        start = np.concatenate([[0], np.cumsum([len(p) for p in pages])])
        place = np.arange(len(texts)) - start[page]
        dense[:, WORDS] = np.minimum(np.log1p(sizes) / 8, 1.5)
        dense[:, WORDS + 1] = [b[2] for own in pages for b in own]
        dense[:, WORDS + 2] = np.minimum(np.log1p(n) / 6, 1.5)
        dense[:, WORDS + 3] = place / np.maximum(1, start[page + 1] - start[page])
        dense[:, WORDS + 4] = np.exp(-place / 4.0)
        dense[:, WORDS + 5] = [t[-1] in ".!?:\"”»" for t in texts]
    return np.array(ids, np.int64), np.array(at, np.int64), dense


def _parts(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of blocks with at most GATHER path names (or one block), given each block's first name (n+1)."""
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + GATHER, side="right")) - 1)
        yield i, j
        i = j


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class BlockLabeller:
    """Bidirectional LSTM over the blocks of a page."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {
            "path": rng.normal(0, 0.15, (PATHS, 8 * h)), "dense": rng.normal(0, 0.15, (WORDS + MEASURES, 8 * h)), "bias": np.zeros(8 * h),
            "back0": rng.normal(0, 0.2, (h, 4 * h)), "back1": rng.normal(0, 0.2, (h, 4 * h)), "out": rng.normal(0, 0.2, (2 * h,)), "out_bias": np.zeros(1),
        }
        self.w["bias"][h : 2 * h] = self.w["bias"][5 * h : 6 * h] = 1.0  # forget gates open at first
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _inputs(self, ids: np.ndarray, at: np.ndarray, dense: np.ndarray) -> np.ndarray:
        sums = [np.add.reduceat(self.w["path"][ids[at[i] : at[j]]], at[i:j] - at[i], axis=0) for i, j in _parts(at)]
        return np.concatenate(sums) + dense @ self.w["dense"] + self.w["bias"]

    def _sweep(self, x: np.ndarray, mask: np.ndarray, back: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states of pages x steps; where the mask is 0 the state stays."""
        pages, steps, _ = x.shape
        h, size = np.zeros((pages, HIDDEN), np.float32), HIDDEN
        c = np.zeros_like(h)
        out = np.zeros((pages, steps, size), np.float32)
        for t in range(steps):
            gates = x[:, t] + h @ back
            i, f, o = _sigmoid(gates[:, :size]), _sigmoid(gates[:, size : 2 * size]), _sigmoid(gates[:, 2 * size : 3 * size])
            g = np.tanh(gates[:, 3 * size :])
            m = mask[:, t, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if trace is not None:
                trace.append((h, c, i, f, o, g, tanh_c, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tanh_c, h)
            out[:, t] = h
        return out

    def _grid(self, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Block number at (page, step), and the mask."""
        start = np.concatenate([[0], np.cumsum(counts)])[:-1]
        steps = np.arange(max(counts))
        mask = steps < np.array(counts)[:, None]
        return np.where(mask, start[:, None] + steps, 0), mask

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are main."""
        out = [np.zeros(len(p), bool) for p in pages]
        order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and j - i < 256 and (j - i + 1) * len(pages[order[j]]) <= 8192:
                j += 1
            group = order[i:j]
            i = j
            x = self._inputs(*features([pages[k] for k in group]))
            grid, mask = self._grid([len(pages[k]) for k in group])
            h = HIDDEN
            z = self._sweep(x[:, : 4 * h][grid], mask, self.w["back0"]) @ self.w["out"][:h]
            z += self._sweep(x[:, 4 * h :][grid][:, ::-1], mask[:, ::-1], self.w["back1"])[:, ::-1] @ self.w["out"][h:]
            for k, row in zip(group, z + self.w["out_bias"]):
                out[k] = row[: len(pages[k])] > 0
        return out

    def train(self, pages: list[list[Block]], labels: list[list[int]], passes: int = 8, rate: float = 0.01, seed: int = 9) -> None:
        """Back-propagation through time with Adam on the logistic loss."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, h = 0, HIDDEN
        usable = [k for k, p in enumerate(pages) if p]
        for turn in range(passes):
            own_rate = rate * (1 - turn / passes)
            order = sorted(rng.permutation(usable).tolist(), key=lambda k: len(pages[k]) // 8)
            groups = [order[i : i + 32] for i in range(0, len(order), 32)]
            for g in rng.permutation(len(groups)):
                group = groups[g]
                ids, at, dense = features([pages[k] for k in group])
                keep = rng.random(len(ids)) > 0.15  # names are dropped at random, so that no single one decides
                keep[at[:-1]] = True
                at = np.concatenate([[0], np.cumsum(keep)])[at]
                ids = ids[keep]
                x = self._inputs(ids, at, dense)
                grid, mask = self._grid([len(pages[k]) for k in group])
                y = np.zeros(grid.shape, np.float32)
                for r, k in enumerate(group):
                    y[r, : len(labels[k])] = labels[k]
                traces: list[list] = [[], []]
                f = self._sweep(x[:, : 4 * h][grid], mask, self.w["back0"], traces[0])
                b = self._sweep(x[:, 4 * h :][grid][:, ::-1], mask[:, ::-1], self.w["back1"], traces[1])[:, ::-1]
                both = np.concatenate([f, b], axis=2)
                dz = np.where(mask, _sigmoid(both @ self.w["out"] + self.w["out_bias"]) - y, 0) / mask.sum()
                grads = {"out": np.einsum("pt,pth->h", dz, both), "out_bias": np.array([dz.sum()])}
                dboth = dz[:, :, None] * self.w["out"]
                dx = np.zeros((len(x), 8 * h), np.float32)
                for d, (trace, back) in enumerate(zip(traces, ("back0", "back1"))):
                    dout = dboth[:, :, d * h : (d + 1) * h]
                    dout, where = (dout, grid) if d == 0 else (dout[:, ::-1], grid[:, ::-1])
                    dh = dc = np.zeros((len(group), h), np.float32)
                    dback = np.zeros_like(self.w[back])
                    for t in range(len(trace) - 1, -1, -1):
                        h0, c0, i, fg, o, gg, tc, m = trace[t]
                        dh = dh + dout[:, t]
                        own_h, own_c = np.where(m, dh, 0), np.where(m, dc, 0)
                        own_c = own_c + own_h * o * (1 - tc * tc)
                        dg = np.concatenate([own_c * gg * i * (1 - i), own_c * c0 * fg * (1 - fg), own_h * tc * o * (1 - o), own_c * i * (1 - gg * gg)], axis=1)
                        dback += h0.T @ dg
                        rows = m[:, 0]
                        dx[where[rows, t], d * 4 * h : (d + 1) * 4 * h] += dg[rows]
                        dh = np.where(m, dg @ self.w[back].T, dh)
                        dc = np.where(m, own_c * fg, dc)
                    grads[back] = dback
                grads["dense"], grads["bias"] = dense.T @ dx, dx.sum(axis=0)
                dpath = np.zeros_like(self.w["path"])
                for i, j in _parts(at):
                    np.add.at(dpath, ids[at[i] : at[j]], np.repeat(dx[i:j], np.diff(at[i : j + 1]), axis=0))
                grads["path"] = dpath
                step += 1
                for k, g_k in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g_k
                    second[k] = 0.99 * second[k] + 0.01 * g_k * g_k
                    self.w[k] -= (own_rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def markup_label(path: tuple[str, ...]) -> int:
    """Whether the markup above a block says that it is main text."""
    names = {n.lstrip(".") for n in path}
    if names & (ASIDE - _LAYOUT):
        return 0
    return int(bool(names & (MAIN - _LAYOUT)) or bool({".content", ".text", ".body"} & set(path)))


# Layouts that sampled pages are shown in: wrappers of main text, and of other blocks by kind.
_MAIN_WRAPS = ["article", "main", "main article", "div.content", "div.post", "div.entry .content", "div.post .content", "section.article", "div.article .body",
               "div.story", "section.story .body", "div.main", "div.main .content", "div.text", "div.page div.content", "div.container div.post", "main div.prose",
               "div.wrapper main article", "div.container div.row div.col .main article", "div.article", "section div.articlebody", "div.layout main section"]
_MAIN_LEAVES = ["p", "p", "p", "p", "h2", "ul li", "blockquote p", "section p", "div p", "ol li", "pre", "h3", "table tr td", "figure figcaption", "dl dd", "div", "div.paragraph"]
_ASIDE_KINDS = {
    "menu": ["nav ul li", "nav.menu ul li", "div.menu ul li", "div.navbar a", "ul.navigation li", "header nav ul li", "div.breadcrumbs a", "nav.breadcrumb ol li", "div.nav ul li", "ul.menu li", "div.topnav a"],
    "head": ["header h1", "header p", "header", "div.header p", "div.masthead", "header.site .header div", "div.banner p", "div.header h2", "div.top .header"],
    "foot": ["footer p", "footer", "div.footer p", "footer.site .footer div", "div.footer ul li", "div.copyright", "div.legal p", "footer section p"],
    "side": ["aside p", "aside", "aside.sidebar div.widget p", "div.sidebar p", "div.sidebar ul li", "aside section h3", "div.widget p", "aside ul li", "div.related ul li", "section.related p", "div.sidebar div", "div.recommended p"],
    "ad": ["div.ad", "div.ads p", "div.advert", "div.advertisement p", "aside.ad p", "div.sponsored p", "section.promo p", "div.ad .banner p", "div.advert p"],
    "notice": ["div.cookie .notice p", "div.notice", "div.cookies", "div.consent p", "div.alert", "section.newsletter p", "div.popup p", "div.cookie .banner", "div.modal p", "p.notice", "div.disclaimer p"],
    "form": ["form p", "form label", "form div", "form.search label", "div.login form p", "form.signup p", "div.subscribe form label", "form fieldset legend"],
    "comment": ["section.comments div.comment p", "div.comments p", "div.comment .body p", "ol.commentlist li p", "div.comments ul li", "section.comments article.comment p", "div.comments article p", "section.responses p",
                "div.disqus p", "div.comments div.reply p", "section.comments h3", "ul.comments li", "div.discussion p", "div.comments h2", "aside.comments p", "article.comment p"],
    "share": ["div.share ul li", "div.social a", "div.tags a", "div.pagination a", "div.meta p", "div.share p"],
}


def _wrap(text: str) -> tuple[str, ...]:
    return tuple(n for part in text.split() for n in ([f".{part[1:]}"] if part.startswith(".") else [part.split(".")[0], *[f".{c}" for c in part.split(".")[1:]]]))


def _relaid(main: list[Block], others: list[Block], donors: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """One page in another layout: its blocks under other wrappers, and labels."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    outer = ("html", "body") + (_wrap(pick(["div", "div.page", "div.wrapper", "div.container"])) if rng.random() < 0.5 else ())
    donor = lambda: pick(donors) if donors else "text"
    short = lambda: " ".join(donor().split()[: int(rng.integers(1, 9))])
    rows: list[Block] = []
    labels: list[int] = []

    def side(kind: str, count: int, within: tuple[str, ...] = ()) -> None:
        wrap = _wrap(pick(_ASIDE_KINDS[kind]))
        for _ in range(count):
            long = kind in ("comment", "side", "notice", "ad", "foot") and rng.random() < (0.8 if kind == "comment" else 0.5)
            text = donor() if long else pick(others)[1] if others and rng.random() < 0.5 else short()
            links = 1.0 if wrap[-1] in ("a", "li") and kind in ("menu", "side", "share", "foot") and rng.random() < 0.9 else 0.0
            rows.append((outer + within + wrap, text, links))
            labels.append(0)

    for kind in ("notice", "head", "menu", "ad", "form"):
        if rng.random() < 0.5:
            side(kind, int(rng.integers(1, 7)) if kind == "menu" else int(rng.integers(1, 3)))
    if rng.random() < 0.25:
        side("side", int(rng.integers(1, 5)))
    wrap = outer + _wrap(pick(_MAIN_WRAPS))
    if rng.random() < 0.5:
        rows.append((wrap + _wrap(pick(["h1", "h1", "h1.title", "h2"])), short(), 0.0))
        labels.append(1)
    inner = wrap
    for k, (_, text, _) in enumerate(main):
        leaf = _wrap(pick(_MAIN_LEAVES)) if rng.random() < 0.35 else ("p",)
        if rng.random() < 0.15:
            text = " ".join(text.split()[: int(rng.integers(1, 8))])
        rows.append((inner + leaf, text, float(rng.random() * 0.3) if rng.random() < 0.1 else 0.0))
        labels.append(1)
        if rng.random() < 0.06:
            side(pick(["ad", "share", "notice", "side", "form"]), 1, inner[len(outer) :])
    if rng.random() < 0.5:
        side("comment", int(rng.integers(1, 8)), wrap[len(outer) :] if rng.random() < 0.3 else ())
    for kind in ("share", "side", "ad", "form", "notice", "menu", "foot"):
        if rng.random() < (0.75 if kind == "foot" else 0.3):
            side(kind, int(rng.integers(1, 4)))
    return rows, labels


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> BlockLabeller:
    """A labeller trained on at most SAMPLE pages, those with the least hash of id and html."""
    cols = pages.select(F.col(html_col).cast("string").alias("html"), F.xxhash64(F.col(id_col).cast("string"), F.col(html_col).cast("string")).alias("spin")).filter(F.col("html").isNotNull())
    count = max(1, cols.count())
    chosen = cols.filter(F.pmod("spin", F.lit(1 << 20)) <= F.lit(int(min(1.0, 2 * SAMPLE / count) * (1 << 20))))
    sample = [r[0] for r in chosen.orderBy("spin").limit(SAMPLE).collect()]
    rng = np.random.default_rng(3)
    read = [blocks(p) for p in sample]
    donors = [b[1] for own in read for b in own if len(b[1]) > 60][:2000]
    shown: list[list[Block]] = []
    labels: list[list[int]] = []
    for own in read:
        marks = [markup_label(b[0]) for b in own]
        shown.append(own)
        labels.append(marks)
        main = [b for b, k in zip(own, marks) if k][:40] or [b for b in own if len(b[1]) > 80][:40]
        others = [b for b, k in zip(own, marks) if not k]
        for _ in range(3):
            rows, k = _relaid(main, others, donors, rng)
            shown.append(rows)
            labels.append(k)
    model = BlockLabeller()
    if any(shown):
        model.train(shown, labels)
    return model


def extract(pages: DataFrame, model: BlockLabeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page (see the module)."""
    shared = pages.sparkSession.sparkContext.broadcast(model or fit(pages, id_col, html_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        for batch in gathered(batches, "html", 2 << 20, 2000):
            read = [blocks(p) if p else [] for p in batch.column(2).to_pylist()]
            texts = ["\n\n".join(b[1] for b, k in zip(own, main) if k) for own, main in zip(read, labeller.label(read))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    cols = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    return cols.mapInArrow(run, SCHEMA)
