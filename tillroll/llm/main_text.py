"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: stretches of text between block-level tags. Each block is a vector
of its hashed tag path (tags, classes, ids, roles), its hashed words and a few counts. A
bidirectional LSTM in numpy reads the blocks of the whole page in both directions and labels each
as main text or not, so a block is judged by what surrounds it.

There are no labels for pages, so the labeller learns, in one task, from a bounded sample of pages
(`sample_pages`, those with the smallest hash of their id) whose own markup tells (`taught`),
and from disguised versions of them. In these, main text stands under plain containers or ones with names
of headers and widgets, and some of its paragraphs are lists, tables, quotes, code, captions and
headings; menus, sidebars, notices, forms and comments, made of the sample's words, are put in, short
ones and whole paragraphs. So neither a tag nor one name decides. A name within an article proves nothing by
itself: such blocks are not learnt from.

Blocks of many pages are labelled at once, in batches of about PADDED blocks with their padding; a longer
page is a batch.

Defined cases: a null or empty page and a page without blocks have an empty text; markup that is
never closed ends with the page; character references without a meaning stay as they are; repeated
rows are extracted each; an empty table gives an empty result; if no page of the sample tells its
main text, labels come from `own_label` alone; columns besides id, url and html are not read.
"""

from __future__ import annotations

import html
import pickle
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import slices, words

SAMPLE_PAGES = 400
VERSIONS = 4
EPOCHS = 6
BATCH = 16
RATE = 0.01
HIDDEN = 16
PATH_SIZE = WORD_SIZE = 24
HASHES = 1 << 13
SEED = 11
PADDED = 20_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<=/)>"
    r"|<(?P<raw>script|style|template|textarea|iframe|svg)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
# Formulas are part of the sentence they are in.
FORMULA = re.compile(r"(?:math|m(?:i|n|o|s|text|row|space|sup|sub|subsup|under|over|underover|frac|sqrt|root|fenced|style|padded|phantom|error|table|tr|td|multiscripts|prescripts)|semantics|annotation(?:-xml)?)")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that another one of the given kinds ends.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form button select dialog menu figure title head".split())
# Elements that hold no main text, an article's own ones neither.
NEVER = frozenset("nav aside form button select dialog menu title head".split())
# Names that tell much, and those that articles' own parts have too.
ASIDE_NAME = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|breadcrumbs?|comments?|cookies?|disqus|footer|menu|modal|nav\w*|newsletter|"
    r"popup|promo\w*|repl(?:y|ies)|sharing|sidebar|sponsor\w*|subscribe|toolbar)(?:$|[-_])"
)
WEAK_NAME = re.compile(r"(?:^|[-_])(?:banner|header|notice|related|share|social|widget)(?:$|[-_])")
ASIDE_ROLES = ("navigation", "banner", "contentinfo", "complementary")


class Block(NamedTuple):
    """text: as given back; path: names of the open elements, outermost first; linked: characters within links."""

    text: str
    path: tuple[str, ...]
    linked: int


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    if "=" in attributes:
        for kind, *values in ATTRIBUTE.findall(attributes):
            found += [f"{kind.lower()}={v}" for v in "".join(values).lower().split()]
    return tuple(found)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page with text, in page order."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    found: list[Block] = []
    parts: list[str] = []
    links = linked = 0

    def end() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                found.append(Block(text, tuple(n for _, names in stack for n in names), linked))
            parts.clear()
        linked = 0

    for token in TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            parts.append(text)
            if links:
                linked += len(text)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE or FORMULA.fullmatch(tag):
            if tag == "a":
                links = max(0, links - 1) if token["close"] else links + 1
            elif tag == "br":
                parts.append(" ")
            continue
        end()
        links = 0
        if token["close"]:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID:
            if stack and (stack[-1][0] == "p" or tag in ENDED_BY.get(stack[-1][0], ())):
                stack.pop()
            stack.append((tag, _names(tag, token["attributes"])))
    end()
    return found


class Hints(NamedTuple):
    """What the names of a path say: within an article, within a part of that that may be aside, and of the whole path."""

    main: bool
    doubtful: bool
    never: bool
    aside: bool
    strong: bool
    weak: bool


@lru_cache(maxsize=1 << 16)
def hints(path: tuple[str, ...]) -> Hints:
    main = doubtful = never = aside = strong = weak = False
    for name in path:
        kind, _, value = name.partition("=")
        if name in MAIN or name == "role=main":
            main = True
            continue
        own_strong = bool(value) and (bool(ASIDE_NAME.search(value)) or value in ASIDE_ROLES)
        own_weak = bool(value) and bool(WEAK_NAME.search(value))
        never |= name in NEVER
        if name in ASIDE or own_strong or own_weak:
            doubtful |= main
            aside |= not main
        strong |= own_strong
        weak |= own_weak
    return Hints(main, doubtful, never, aside, strong, weak)


def own_label(path: tuple[str, ...]) -> bool | None:
    """Whether the markup says that the block is main text; None if it says nothing."""
    h = hints(path)
    if h.aside or h.never:
        return False
    return True if h.main and not h.doubtful else None


def taught(page: list[Block]) -> list[float]:
    """1 for main text, 0 for what is outside of it, 0.5 for parts of an article that may be either."""
    return [0.5 if own_label(b.path) is None and hints(b.path).main else float(own_label(b.path) is True) for b in page]


# --- vectors ------------------------------------------------------------------


def _table(size: int, seed: int) -> np.ndarray:
    return (np.random.default_rng(seed).normal(0, 1, (HASHES, size)) / np.sqrt(size) * 3).astype(np.float32)


PATH_TABLE, WORD_TABLE = _table(PATH_SIZE, 1), _table(WORD_SIZE, 2)


def _means(strings: pa.Array, table: np.ndarray) -> np.ndarray:
    """The mean vector of each text's words."""
    found = words(strings)
    counts = np.diff(found.rows)
    result = np.zeros((len(strings), table.shape[1]), np.float32)
    some = counts > 0
    if some.any():
        vectors = table[(found.hashes % np.uint64(HASHES)).astype(np.int64)]
        result[some] = np.add.reduceat(vectors, found.rows[:-1][some], axis=0) / counts[some, None]
    return result


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages."""
    flat = [b for page in pages for b in page]
    paths = {p: i for i, p in enumerate(dict.fromkeys(b.path for b in flat))}
    # Each name of a path is one word.
    spelled = [" ".join(n.replace("=", "0").replace("-", "0").replace("_", "0") for n in p) for p in paths]
    path = _means(pa.array(spelled, pa.string()), PATH_TABLE)[[paths[b.path] for b in flat]]
    word = _means(pa.array([b.text for b in flat], pa.string()), WORD_TABLE)
    size = np.array([len(b.text) for b in flat], np.float32)
    counts = np.array([len(p) for p in pages])
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    more = np.stack(
        [
            np.log1p(size) / 5,
            np.array([min(1, b.linked / max(1, len(b.text))) for b in flat]),
            np.array([b.text.count(".") + b.text.count(",") for b in flat]) / (1 + size) * 10,
            np.array([b.text[-1] in ".!?:;\"'" for b in flat]),
            place / np.maximum(1, np.repeat(counts, counts)),
            np.array([len(b.path) for b in flat]) / 10,
            *np.array([hints(b.path) for b in flat], np.float32).reshape(-1, len(Hints._fields)).T,
        ],
        axis=1,
    )
    return np.concatenate([path, word, more.astype(np.float32)], axis=1)


SIZE = PATH_SIZE + WORD_SIZE + 6 + len(Hints._fields)


# --- the network --------------------------------------------------------------


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def padded(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks as (steps, pages, size), which of them there are, and for each place its place read backwards."""
    steps, n = int(counts.max()), len(counts)
    there = np.arange(steps)[:, None] < counts[None, :]
    x = np.zeros((n, steps, rows.shape[1]), np.float32)
    x[there.T] = rows
    back = np.where(there, counts[None, :] - 1 - np.arange(steps)[:, None], np.arange(steps)[:, None])
    return x.transpose(1, 0, 2), there, back


def forward(x: np.ndarray, there: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list]:
    """States after every step and, to learn from them, all gates."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    inputs = x @ w + b
    out, kept = np.zeros((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        z = inputs[t] + h @ u
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        c_next = f * c + i * g
        s = np.tanh(c_next)
        if keep:
            kept.append((h, c, i, f, o, g, s))
        m = there[t][:, None]
        h, c = np.where(m, o * s, h), np.where(m, c_next, c)
        out[t] = h
    return out, kept


def backward(x, there, u, kept, d_out) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the input, recurrent and bias weights."""
    steps, n, _ = x.shape
    d_z = np.zeros((steps, n, 4 * HIDDEN), np.float32)
    d_u = np.zeros_like(u)
    d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, s = kept[t]
        m = there[t][:, None]
        d_h = d_h + d_out[t]
        own_h, own_c = np.where(m, d_h, 0), np.where(m, d_c, 0)
        d_s = own_c + own_h * o * (1 - s * s)
        z = np.concatenate([d_s * g * i * (1 - i), d_s * c * f * (1 - f), own_h * s * o * (1 - o), d_s * i * (1 - g * g)], axis=1)
        d_z[t] = z
        d_u += h.T @ z
        d_h = np.where(m, z @ u.T, d_h)
        d_c = np.where(m, d_s * f, d_c)
    flat = d_z.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, x.shape[2]).T @ flat, d_u, flat.sum(0)


def scores(p: dict[str, np.ndarray], x, there, back, keep: bool = True) -> tuple[np.ndarray, tuple]:
    pages = np.arange(x.shape[1])[None, :]
    turned = x[back, pages]
    ahead, kept_a = forward(x, there, p["wa"], p["ua"], p["ba"], keep)
    behind, kept_b = forward(turned, there, p["wb"], p["ub"], p["bb"], keep)
    both = np.concatenate([ahead, behind[back, pages]], axis=2)
    return both @ p["v"] + p["o"], (turned, kept_a, kept_b, both)


def train(pages: list[list[Block]], labels: list[list[float]], epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """labels: 1 main text, 0 not, 0.5 unknown, which is not learnt from."""
    rng = np.random.default_rng(SEED)
    p = {}
    for side in "ab":
        p["w" + side] = rng.normal(0, 1 / np.sqrt(SIZE), (SIZE, 4 * HIDDEN))
        p["u" + side] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        p["b" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    p["v"], p["o"] = rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    counts = np.array([len(x) for x in pages])
    rows = vectors(pages)
    begin = np.cumsum(counts) - counts
    truth = np.concatenate([np.array(y, np.float32) for y in labels])
    step = 0
    for _ in range(epochs):
        # Pages of about one length together, batches in random order.
        order = np.argsort(counts + rng.random(len(counts)) * 4)
        batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
        for chosen in [batches[k] for k in rng.permutation(len(batches))]:
            at = np.concatenate([np.arange(begin[i], begin[i] + counts[i]) for i in chosen])
            x, there, back = padded(rows[at], counts[chosen])
            y = np.zeros(there.T.shape, np.float32)
            y[there.T] = truth[at]
            z, (turned, kept_a, kept_b, both) = scores(p, x, there, back)
            said = there & (y.T != 0.5)
            error = np.where(said, _sigmoid(z) - y.T, 0).astype(np.float32) / max(1, said.sum())
            g = {"v": both.reshape(-1, 2 * HIDDEN).T @ error.ravel(), "o": np.array([error.sum()], np.float32)}
            d = error[:, :, None] * p["v"]
            g["wa"], g["ua"], g["ba"] = backward(x, there, p["ua"], kept_a, d[:, :, :HIDDEN])
            d_behind = d[:, :, HIDDEN:][back, np.arange(len(chosen))[None, :]]
            g["wb"], g["ub"], g["bb"] = backward(turned, there, p["ub"], kept_b, d_behind)
            step += 1
            for k in p:
                grad = np.clip(g[k], -1, 1)
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return p


def label(p: dict[str, np.ndarray] | None, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text."""
    result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    if p is None:
        return [np.array([own_label(b.path) is True for b in page], bool) for page in pages]
    counts = np.array([len(x) for x in pages])
    order = [i for i in np.argsort(counts, kind="stable").tolist() if counts[i]]
    while order:
        # Sorted by length, so the last page of a batch tells its padded size.
        n = 1
        while n < len(order) and (n + 1) * counts[order[n]] <= PADDED:
            n += 1
        chosen, order = order[:n], order[n:]
        z, _ = scores(p, *padded(vectors([pages[i] for i in chosen]), counts[chosen]), keep=False)
        for j, i in enumerate(chosen):
            result[i] = z[: counts[i], j] > 0
    return result


# --- what it learns from ------------------------------------------------------

PLAIN = ("div", "section", "div class=content", "div class=post", "div class=entry", "div id=content", "div class=story", "td")
DISGUISES = {
    "nav": ("div class=menu", "ul class=nav", "div class=navbar", "div id=menu"),
    "footer": ("div class=footer", "div id=footer", "section class=footer"),
    "header": ("div class=header", "div id=header"),
    "article": PLAIN,
    "main": PLAIN,
}
# Paths of what is put in: around the main text, or within its container.
AROUND = (
    "header", "header nav ul li", "aside", "aside ul li", "div class=sidebar", "div class=sidebar ul li", "div class=cookie", "div class=notice",
    "div class=cookie-notice p", "form", "form label", "div class=newsletter form", "div class=related ul li", "div class=breadcrumb", "div class=social",
    "div class=banner", "section class=comments", "section id=comments div class=comment p", "div class=comments div class=comment", "ol class=comment-list li p",
)
WITHIN = (
    "aside", "div class=ad", "div class=share", "div class=comments p", "section class=comments p", "form", "div class=related li", "footer", "nav ul li",
    "div class=ad p", "div class=newsletter p", "div class=comments div class=comment div class=body p", "aside p", "div class=sponsored p",
)
# What paragraphs of the main text may be instead: the path, and whether the text is cut to a few words.
FORMS = (
    ("ul li", True), ("ul li", False), ("ol li", True), ("ol li p", False), ("table tr td", True), ("table tbody tr td", False), ("table tr th", True),
    ("blockquote", False), ("blockquote p", False), ("pre", False), ("pre", True), ("h2", True), ("h3", True), ("h4", True), ("figure figcaption", True),
    ("dl dt", True), ("dl dd", False), ("div", False), ("details summary", True), ("section p", False),
)
# Containers of main text whose names sound like something else, or like nothing.
WRAPS = (
    "div class=elementor-widget", "div class=widget-container", "div class=widget", "div class=text-widget", "div class=article-notice", "div class=share-box",
    "div class=banner-text", "div class=header-content", "div class=related-content", "div class=social-post", "div class=entry-body", "section",
)
TITLES = ("header h1", "div class=post-header h1", "div class=entry-header h1", "div class=article-header h1", "header div h1", "div h1", "h1", "header h2")


def reformed(parts: list[tuple[Block, float]], rng) -> list[tuple[Block, float]]:
    """The page with runs of its main text as lists, tables, quotes and the like, and with other containers around it."""
    inside = [i for i, (_, y) in enumerate(parts) if y == 1]
    if not inside:
        return parts
    parts = list(parts)
    root = parts[inside[0]][0].path[:-1]
    wrap = tuple(WRAPS[rng.integers(len(WRAPS))].split(" ")) if rng.random() < 0.4 else ()
    if rng.random() < 0.3:
        wrap += (f"class=x{rng.integers(1 << 20)}",)
    for i in inside:
        b = parts[i][0]
        parts[i] = Block(b.text, b.path[: len(root)] + wrap + b.path[len(root) :], b.linked), 1.0
    for _ in range(rng.integers(0, 4)):
        path, cut = FORMS[rng.integers(len(FORMS))]
        at = int(rng.integers(len(inside)))
        run: list[tuple[Block, float]] = []
        first, last = inside[at], inside[min(len(inside) - 1, at + int(rng.integers(0, 4)))] + 1
        for b, y in parts[first:last]:
            if y != 1:
                run.append((b, y))
                continue
            names, text = root + wrap + tuple(path.split(" ")), b.text.split()
            if cut:
                # A long paragraph becomes several short entries.
                for k in range(0, min(len(text), 18), 6):
                    run.append((Block(" ".join(text[k : k + int(rng.integers(1, 7))]).rstrip("."), names, 0), 1.0))
            else:
                run.append((Block(b.text, names, 0), 1.0))
        parts[first:last] = run
        inside = [i for i, (_, y) in enumerate(parts) if y == 1]
    if rng.random() < 0.8:
        b = parts[inside[0]][0]
        parts[inside[0]] = Block(b.text, root + tuple(TITLES[rng.integers(len(TITLES))].split(" ")), 0), 1.0
    return parts


def disguised(page: list[Block], truth: list[float], phrases: list[str], rng) -> tuple[list[Block], list[float]]:
    """The page with other markup for the same parts, and with more parts that are not main text."""
    changed = {}
    for name, options in DISGUISES.items():
        if rng.random() < 0.5:
            changed[name] = tuple(options[rng.integers(len(options))].split(" "))
    parts = [(Block(b.text, tuple(m for n in b.path for m in changed.get(n, (n,))), b.linked), y) for b, y in zip(page, truth)]
    parts = reformed(parts, rng)
    inside = [i for i, (_, y) in enumerate(parts) if y == 1]
    root = tuple(n for n in parts[inside[0]][0].path[:-1] if n not in ("header", "h1")) if inside else ()
    outer = tuple(n for n in root if n in ("html", "body")) or ("html", "body")

    def group(path: str, base: tuple[str, ...]) -> list[tuple[Block, float]]:
        names = base + tuple(path.split(" "))
        texts = [phrases[rng.integers(len(phrases))] for _ in range(rng.integers(1, 6))]
        far = "li" in names[-3:] and "comment" not in path
        texts = [" ".join(t.split()[: rng.integers(1, 5)]) if far else t for t in texts]
        return [(Block(t, names, len(t) if far else 0), 0.0) for t in texts if t]

    if inside:
        for _ in range(rng.integers(0, 3)):
            at = int(rng.choice([inside[0], inside[-1] + 1]))
            parts[at:at] = group(AROUND[rng.integers(len(AROUND))], outer)
            inside = [i for i, (_, y) in enumerate(parts) if y == 1]
        if rng.random() < 0.5:
            at = int(rng.integers(inside[0], inside[-1] + 2))
            parts[at:at] = group(WITHIN[rng.integers(len(WITHIN))], root)
    return [b for b, _ in parts], [y for _, y in parts]


def learned(pages: list[str]) -> dict[str, np.ndarray] | None:
    """The model of a sample of pages; None if none of them tells its main text."""
    known = []
    for text in pages:
        page = blocks(text)
        truth = taught(page)
        if 1.0 in truth:
            known.append((page, truth))
    if not known:
        return None
    rng = np.random.default_rng(SEED)
    phrases = [b.text for page, _ in known for b in page]
    learn = list(known)
    for page, truth in known:
        learn += [disguised(page, truth, phrases, rng) for _ in range(VERSIONS)]
    return train([x for x, _ in learn], [y for _, y in learn])


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, np.ndarray] | None:
    """Train on at most `sample_pages` pages whose markup tells their main text; None if none does.

    The ids are drawn first; the pages behind them, the least of each id, go to one task.
    """
    order = F.xxhash64("page_id")
    ids = pages.where("page_id is not null and html is not null").select("page_id").distinct().orderBy(order, "page_id").limit(sample_pages)
    rows = pages.where("html is not null").select("page_id", "html").join(F.broadcast(ids), "page_id")  # sample_pages ids at most
    rows = rows.groupBy("page_id").agg(F.min_by("html", F.xxhash64("html")).alias("html"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learned(texts))], pa.binary())], ["model"])

    found = rows.repartition(1).sortWithinPartitions(order, "page_id").select("html").mapInArrow(learn, "model binary").first()
    return pickle.loads(found["model"]) if found else None


def main_text(pages: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """page_id, url, text, n_chars and the number of blocks of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [blocks(x or "") for x in part.column("html").to_pylist()]
                texts = ["\n".join(b.text for b, y in zip(page, keep) if y) for page, keep in zip(found, label(shared.value, found))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in found], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars", "n_blocks"],
                )

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")
