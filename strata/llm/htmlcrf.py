"""Main text of HTML pages by a linear-chain conditional random field.

A page is cut into leaf blocks: runs of text between block-level tags, with
their ancestors. Each block is a position of a chain with two labels, main text
and the rest. Features are the ancestor tags, the words of the ancestors' class, id and
role attributes, and properties of the text (length, link share, punctuation).
Weights are fitted by gradient ascent on the likelihood of labelled pages
(forward-backward) and pages are decoded by Viterbi.

Labelled pages are made from at most ``sample_pages`` pages: as they are, with
the blocks of their article elements as main text, and rebuilt in other layouts (other
containers, menus, sidebars, notices, adverts, forms and reader comments
around and inside the article), where each block's label is known by construction.

Defined results: null and empty pages, and pages without main text, give the
empty text; unclosed and misnested tags are repaired by the usual implied ends; text outside any
element is a block; character references that name nothing stay as they are;
repeated rows are extracted alike; without pages to learn from, the model is fitted
on the layouts alone; extra columns pass through.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, join_small

SAMPLE_PAGES = 300
SAMPLE_CHARS = 100_000
CHAIN_BLOCKS = 80         # longer pages give no training chain, only texts for rebuilt pages
LABEL = "data-label"
#: fixed values: HTML element classes
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
SILENT = frozenset("noscript template svg canvas audio video object map datalist select option optgroup button".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()) | SILENT
#: an opening tag ends these open elements, up to the nearest of the scope
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
           "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
           "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"})}
PHRASING_ONLY = frozenset("p h1 h2 h3 h4 h5 h6".split())       # ended by any block-level start tag

#: elements open inside each other; deeper ones become siblings, as in browsers
DEPTH = 512
_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+'|["'])*+)>""",
                    re.S)
_CLOSED = re.compile(r"^<!---?>$|--!?>$")
_ATTR = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
#: an unquoted value takes the slash before the end of the tag
_UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"'>]+/$""")
_END = {t: re.compile(f"</{t}", re.I) for t in RAW}


@dataclass
class Block:
    text: str
    path: int           # number of the ancestor path, see Paths
    linked: int         # characters inside links


class Paths:
    """Ancestor paths by number, with their features; ``label`` is that of the innermost marked element."""

    MOST = 20_000

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.features: list[frozenset] = [frozenset()]
        self.label: list[int | None] = [None]

    def child(self, parent: int, tag: str, attrs: str) -> int:
        key = (parent, tag, attrs)
        got = self.number.get(key)
        if got is None:
            got = self.number[key] = len(self.features)
            words, label = {f"a:{tag}"}, None
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id", "role", "itemprop"):
                    words.update(f"c:{w}" for w in _NAME.findall(value.lower()))
                elif name == LABEL:
                    label = int(value)
            if attrs and _HIDDEN.search(attrs):
                words.add("c:hidden")
            self.features.append(frozenset(f for f in self.features[parent] if f[0] != "p") | words | {f"p:{tag}"})
            self.label.append(self.label[parent] if label is None else label)
        return got


def blocks(page: str, paths: Paths) -> list[Block]:
    """Leaf blocks of a page in page order; blocks without text are left out."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    text: list[str] = []
    at = links = linked = silent = 0        # silent: how many silent elements are open

    def flush():
        nonlocal linked
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            if s:
                out.append(Block(s, stack[-1][1] if stack else 0, linked))
            text.clear()
        linked = 0

    def pop_to(i):
        nonlocal silent
        silent -= sum(t in SILENT for t, _ in stack[i:])
        del stack[i:]

    find = _TOKEN.search
    # behind the last > nothing closes: what is left is text, but for an unclosed comment. No tag is sought there
    last = page.rfind(">") + 1
    while m := find(page, at, last):
        if m.start() > at and not silent:
            s = page[at:m.start()]
            text.append(s)
            if links:
                linked += len(s)
        at = m.end()
        tag = m[2]
        if tag is None:
            if at == last and m[0].startswith("<!--") and not _CLOSED.search(m[0]):
                at = len(page)
            continue
        tag = tag.lower()
        if tag in RAW:
            if not m[1]:
                end = _END[tag].search(page, at)
                at = end.start() if end else len(page)
            continue
        if tag == "a":
            links = max(0, links + (-1 if m[1] else 1))
        elif tag == "br":
            text.append(" ")
        elif silent or tag in SILENT:
            # dropped like an inline element: what is open around it goes on
            if tag not in BLOCK:
                continue
            if m[1]:
                i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if i is None:
                    continue
                outer = next((j for j, (t, _) in enumerate(stack) if t in SILENT), len(stack))
                if i < outer:       # the end of an element around a silent one that was not closed
                    pop_to(outer)
                    flush()
                    links = 0
                pop_to(i)
            elif tag not in VOID and not (tag == "svg" and m[3].endswith("/") and not _UNQUOTED_SLASH.search(m[3])):
                if len(stack) >= DEPTH:
                    if silent:
                        continue
                    pop_to(DEPTH - 1)
                stack.append((tag, paths.child(stack[-1][1] if stack else 0, tag, m[3].strip())))
                silent += tag in SILENT
        elif tag in BLOCK:
            flush()
            links = 0
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
                continue
            if tag in VOID:
                continue
            if stack and stack[-1][0] in PHRASING_ONLY:
                pop_to(len(stack) - 1)
            ends, scope = IMPLIED.get(tag, ((), ()))
            if ends:
                low = len(stack)
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in scope:
                        break
                    if stack[i][0] in ends:
                        low = i
                pop_to(low)
            if len(stack) >= DEPTH:
                pop_to(DEPTH - 1)
            stack.append((tag, paths.child(stack[-1][1] if stack else 0, tag, m[3].strip())))
    if at < len(page) and not silent:
        rest = page[at:]
        cut = rest.find("<!--")
        text.append(rest if cut < 0 else rest[:cut])
    if silent:
        pop_to(next(j for j, (t, _) in enumerate(stack) if t in SILENT))
    flush()
    return out


_LENGTHS = (2, 4, 8, 16, 32, 64)
_PLACES = ("t:first", "t:early", "t:late", "t:last")


def text_features(b: Block, i: int, n: int) -> tuple[str, ...]:
    """Features of a block's text and its place among ``n`` blocks."""
    s = b.text
    words = s.count(" ") + 1
    size = sum(words > k for k in _LENGTHS)
    share = min(3, 4 * b.linked // max(1, len(s)))
    return (f"t:size{size}", f"t:link{share}", "t:stop" if s[-1] in ".!?…。\"”»" else "t:nostop",
            "t:copy" if s[0] in "©®" else "t:nocopy", _PLACES[min(3, 4 * i // max(1, n))])


@dataclass(frozen=True)
class Model:
    """Weights for the label main text (the other label's are 0), transitions [from][to], and starts."""

    weight: dict[str, float]
    move: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]

    def decode(self, gains: list[float]) -> list[int]:
        """Viterbi: the most likely labels for the blocks' gains of being main text; ties go to 0."""
        if not gains:
            return []
        (m00, m01), (m10, m11) = self.move
        a, b = self.start[0], self.start[1] + gains[0]
        back = []
        for g in gains[1:]:
            from0 = (a + m00 >= b + m10, a + m01 >= b + m11)
            a, b = (a + m00 if from0[0] else b + m10), (a + m01 if from0[1] else b + m11) + g
            back.append(from0)
        y = int(b > a)
        labels = [y]
        for from0 in reversed(back):
            y = 0 if from0[y] else 1
            labels.append(y)
        return labels[::-1]


class Extractor:
    """Main text of pages under a model; path scores are remembered within a task."""

    def __init__(self, model: Model):
        self.model, self.paths, self.gain = model, Paths(), {}

    def _gain(self, key, features) -> float:
        got = self.gain.get(key)
        if got is None:
            w = self.model.weight
            got = self.gain[key] = sum(w.get(f, 0.0) for f in features)
        return got

    def labelled(self, page: str | None) -> list[tuple[Block, int]]:
        if not page:
            return []
        if len(self.paths.features) > Paths.MOST:
            self.paths, self.gain = Paths(), {}
        found = blocks(page, self.paths)
        n, gains = len(found), []
        for i, b in enumerate(found):
            f = text_features(b, i, n)
            gains.append(self._gain(b.path, self.paths.features[b.path]) + self._gain(f, f))
        return list(zip(found, self.model.decode(gains)))

    def text(self, page: str | None) -> str:
        return "\n\n".join(b.text for b, y in self.labelled(page) if y)


# --- training -------------------------------------------------------------------------------------------------------

#: elements and attribute words whose blocks are not main text, also inside an article
ASIDE_TAGS = frozenset({"a:nav", "a:aside", "a:footer", "a:header", "a:form", "a:button", "a:select", "a:menu",
                        "a:dialog"})


def natural_labels(found: list[Block], paths: Paths) -> list[int] | None:
    """Labels of a page that has an article or main element; None without one."""
    inside = [bool({"a:article", "a:main"} & paths.features[b.path]) for b in found]
    if not any(inside):
        return None
    noise = {f"c:{w}" for group in NOISE for w in group[1]}
    return [int(y and not (ASIDE_TAGS | noise) & paths.features[b.path]) for y, b in zip(inside, found)]


#: layouts: (open tag, close tag) around main text
CONTAINERS = [("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
              ('<div class="content">', "</div>"), ('<div id="content">', "</div>"),
              ('<div class="post-content">', "</div>"), ('<div class="entry-content">', "</div>"),
              ('<div class="article-body">', "</div>"), ('<section class="story">', "</section>"),
              ('<div class="post"><div class="body">', "</div></div>"), ('<div role="main">', "</div>"),
              ('<div class="main"><div class="text">', "</div></div>"), ('<article class="post">', "</article>"),
              ('<div id="main"><section>', "</section></div>"), ('<div class="page"><article>', "</article></div>")]
#: kinds of other blocks: tags they come in, attribute words, whether they read like prose
NOISE = [
    (("nav", "div", "ul"), ("nav", "navbar", "menu", "navigation", "breadcrumb", "breadcrumbs", "topbar"), "links"),
    (("header", "div"), ("header", "masthead", "banner", "site"), "short"),
    (("aside", "div"), ("sidebar", "aside", "widget", "rail", "related", "recommended", "trending", "popular"), "mixed"),
    (("div", "aside", "p"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "promotion", "sponsor"),
     "prose"),
    (("div", "p", "section"), ("cookie", "cookies", "notice", "consent", "gdpr", "alert", "popup", "modal", "privacy",
                               "disclaimer", "paywall"), "prose"),
    (("form", "div"), ("form", "newsletter", "subscribe", "signup", "search", "login", "subscription"), "short"),
    (("div", "section", "ol"), ("comments", "comment", "commentlist", "replies", "reply", "discussion", "respond",
                                "disqus", "responses"), "prose"),
    (("div", "ul"), ("share", "social", "sharing", "tags", "pagination", "pager", "toolbar"), "links"),
    (("footer", "div"), ("footer", "copyright", "legal", "colophon"), "mixed"),
]


def _noise_html(kind, rng: random.Random, prose: list[str], short: list[str]) -> str:
    tags, words, style = kind
    tag, word = rng.choice(tags), rng.choice(words)
    named = tag not in ("nav", "header", "aside", "form", "footer") or rng.random() < 0.5
    attr = f' {rng.choice(["class", "id"])}="{word}{rng.choice(["", "", " box", "-wrap", "-1"])}"' if named else ""
    if tag in ("div", "p", "ul", "ol", "section") and not attr:
        attr = f' class="{word}"'

    def line():
        s = rng.choice(prose if style == "prose" or style == "mixed" and rng.random() < 0.5 else short)
        return f'<a href="/x">{s}</a>' if style == "links" or style == "mixed" and rng.random() < 0.4 else s

    n = rng.randint(1, 5)
    if tag in ("ul", "ol"):
        inner = "".join(f"<li>{line()}</li>" for _ in range(n))
    elif tag == "p":
        inner = line()
    else:
        how = rng.random()
        if how < 0.35:
            inner = "<ul>" + "".join(f"<li>{line()}</li>" for _ in range(n)) + "</ul>"
        elif how < 0.8:
            inner = "".join(f"<p>{line()}</p>" for _ in range(n))
        else:
            inner = line()
        if tag == "form" or rng.random() < 0.1:
            inner += f'<label>{rng.choice(short)}</label><input name="q"><button>{rng.choice(short)}</button>'
    return f'<{tag}{attr} {LABEL}="0">{inner}</{tag}>'


def rebuilt_page(texts: list[str], noise: list[str], rng: random.Random) -> str:
    """A page in a random layout around main texts, with a label attribute on its parts."""
    esc = [html.escape(t) for t in texts]
    prose = [html.escape(t) for t in noise if len(t.split()) > 4] or ["Lorem ipsum dolor sit amet, consectetur elit."]
    short = [html.escape(" ".join(t.split()[:3])) for t in noise] or ["Home"]
    prose = prose + esc
    parts = []
    for i, t in enumerate(esc):
        form = rng.random()
        if i == 0:
            parts.append(f"<h1>{' '.join(t.split()[:12])}</h1>")
        if form < 0.7:
            parts.append(f"<p>{t}</p>" if rng.random() < 0.8 else f'<p>{t[:len(t) // 2]}<a href="/y">{t[len(t) // 2:]}</a></p>')
        elif form < 0.78:
            parts.append(f"<h2>{' '.join(t.split()[:6])}</h2><p>{t}")
        elif form < 0.86:
            half = len(t) // 2
            parts.append(f"<ul><li>{t[:half]}</li><li>{t[half:]}</li></ul>")
        elif form < 0.92:
            parts.append(f"<blockquote>{t}</blockquote>")
        elif form < 0.96:
            parts.append(f"<figure><img src=x><figcaption>{t}</figcaption></figure>")
        else:
            parts.append(f"<table><tr><td>{t}</td><td>{' '.join(t.split()[:3])}</td></tr></table>")
    for kind in NOISE:
        if rng.random() < 0.25:
            parts.insert(rng.randint(0, len(parts)), _noise_html(kind, rng, prose, short))
    if rng.random() < 0.3:
        parts.append(_noise_html(NOISE[6], rng, prose, short))
    open_, close = rng.choice(CONTAINERS)
    main = f'<div {LABEL}="1">{open_}{"".join(parts)}{close}</div>'
    if rng.random() < 0.5:      # the marker on the container itself, without an element of its own
        main = f'{open_.replace(">", f" {LABEL}=\"1\">", 1)}{"".join(parts)}{close}'
    before = [_noise_html(k, rng, prose, short) for k in NOISE[:6] if rng.random() < 0.5]
    after = [_noise_html(k, rng, prose, short) for k in NOISE[2:] if rng.random() < 0.5]
    rng.shuffle(before)
    return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def labelled_pages(pages: list[str], rebuilt: int = 2, seed: int = 7, chain_blocks: int = CHAIN_BLOCKS
                   ) -> list[tuple[list[frozenset], list[int]]]:
    """Training chains (features of each block, labels) from pages as they are and rebuilt."""
    rng, paths, out, stock = random.Random(seed), Paths(), [], []

    def chain(found, labels):
        n = len(found)
        out.append(([paths.features[b.path] | set(text_features(b, i, n)) for i, b in enumerate(found)], labels))

    for page in pages:
        found = blocks(page, paths)
        labels = natural_labels(found, paths)
        if labels is None:
            continue
        if len(labels) <= chain_blocks:
            chain(found, labels)
        stock.append(([b.text for b, y in zip(found, labels) if y], [b.text for b, y in zip(found, labels) if not y]))
    stock = [s for s in stock if s[0]] or [
        (["A first paragraph of plain text, long enough to read.", "A second paragraph follows the first one here."],
         ["Home", "About us", "All rights reserved by their owners, see the terms."])]
    for _ in range(max(400, rebuilt * len(stock))):
        texts, noise = rng.choice(stock)
        k = rng.randint(1, min(8, len(texts)))
        found = blocks(rebuilt_page(rng.sample(texts, k), noise, rng), paths)
        if len(found) <= chain_blocks:
            chain(found, [paths.label[b.path] or 0 for b in found])
    return [c for c in out if c[1]]


def fit(chains: list[tuple[list[frozenset], list[int]]], rounds: int = 120, ridge: float = 2e-4) -> Model:
    """Maximum likelihood by full-batch Adam steps; gradients by forward-backward over all chains at once."""
    count: dict[str, int] = {}
    for feats, _ in chains:
        for f in feats:
            for name in f:
                count[name] = count.get(name, 0) + 1
    names = sorted(n for n, k in count.items() if k >= 2)
    index = {n: i for i, n in enumerate(names)}
    width, longest = len(names), max(map(len, (y for _, y in chains)))
    x = np.zeros((len(chains), longest, width), np.float32)
    y = np.zeros((len(chains), longest), np.int64)
    real = np.zeros((len(chains), longest), bool)
    for c, (feats, labels) in enumerate(chains):
        real[c, :len(labels)] = True
        y[c, :len(labels)] = labels
        for t, f in enumerate(feats):
            x[c, t, [index[n] for n in f if n in index]] = 1
    flat = x[real]
    w = np.zeros(width + 6)         # features, transitions 00 01 10 11, starts
    seen = np.zeros(6)
    pair = real[:, 1:]
    np.add.at(seen, (2 * y[:, :-1] + y[:, 1:])[pair], 1)
    np.add.at(seen, 4 + y[:, 0], 1)
    target = np.concatenate((flat.T @ y[real], seen))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        gain = np.zeros(real.shape)
        gain[real] = flat @ w[:width].astype(np.float32)
        score = np.stack((np.zeros_like(gain), gain), 2)
        move = w[width:width + 4].reshape(2, 2)
        alpha = np.zeros(score.shape)
        alpha[:, 0] = score[:, 0] + w[width + 4:]
        for t in range(1, longest):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + score[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        beta = np.zeros(score.shape)
        moves = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            ahead = move + (score[:, t + 1] + beta[:, t + 1])[:, None, :]
            on = real[:, t + 1]
            beta[:, t] = np.where(on[:, None], np.logaddexp.reduce(ahead, axis=2), 0)
            moves += np.exp(alpha[:, t, :, None] + ahead - total[:, None, None])[on].sum(0)
        p = np.exp(alpha + beta - total[:, None, None])
        expected = np.concatenate((flat.T @ p[..., 1][real].astype(np.float32), moves.ravel(), p[:, 0].sum(0)))
        grad = (target - expected) / len(chains) - ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    move = w[width:width + 4].tolist()
    return Model(dict(zip(names, w[:width].tolist())), ((move[0], move[1]), (move[2], move[3])),
                 (float(w[-2]), float(w[-1])))


def train(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES,
          sample_chars: int = SAMPLE_CHARS, chain_blocks: int = CHAIN_BLOCKS) -> Model:
    """Fit on at most ``sample_pages`` different pages, those with the smallest hash of their HTML, of up to
    ``sample_chars`` characters; pages of more than ``chain_blocks`` blocks give texts for rebuilt pages only."""
    rows = pages.select(F.col(html_col).alias("html")).where(
        F.col("html").isNotNull() & (F.length("html") <= sample_chars))
    keyed = rows.select(F.xxhash64("html").alias("key"), "html")
    # a page counts once, however often it is repeated
    chosen = bounded_sample(keyed.select("key").distinct(), F.pmod("key", F.lit(1)), F.col("key"), sample_pages)
    few = join_small(keyed, chosen, ["key"]).groupBy("key").agg(F.min("html").alias("html"))
    return fit(labelled_pages(sorted(r["html"] for r in few.select("html").collect()), chain_blocks=chain_blocks))


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> tuple[DataFrame, str]:
    """``pages`` plus the main text of every page; second result: the new column's name."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def make():
        e = Extractor(shared.value)
        return lambda rows: [[e.text(p) for p in rows]]

    out, (name,) = annotate(pages, html_col, make, [("text", T.StringType())])
    return out, name
