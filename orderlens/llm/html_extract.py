"""Main text of HTML pages by a tree-structured graphical model.

Every block of a page is a variable, content or not. A log-linear potential on each block (tag, names, text, links) and one
on each parent-child pair make a conditional random field on the DOM tree. Sum-product messages go up and down the tree,
level by level over all pages of a batch, and give each block's marginal. Weights are fitted by gradient steps on the
likelihood of labelled pages: observed minus expected counts.

Labelled pages come from the pages themselves, a bounded sample: what stands in a page's one <article> is content. Each is
also laid out anew in other ways that pages have (other elements and names for the same blocks, with headers, side columns,
notices, forms, adverts and reader comments filled with text of other pages), so the model does not lean on one template.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import hashed_sample, id_text, pieces, stored
from orderlens.llm.html_tree import Page, read_page

#: Sample of pages the model learns from (each also in LAYOUTS other forms), gradient steps, and the prior's strength.
SAMPLE_PAGES, LAYOUTS, STEPS, PRIOR = 256, 3, 200, 1e-4
#: Words in class, id and role that tell what a block is for.
NAMES = {
    "menu": "nav|menu|breadcrumb|pagination|pager|toolbar|topbar|tabs", "head": "header|masthead|logo|site-title|brand",
    "foot": "footer|copyright|colophon|legal|contentinfo", "side": "sidebar|aside|widget|complementary",
    "related": "related|recommend|popular|trending|also|more-stories|teaser",
    "notice": "cookie|consent|notice|gdpr|privacy|popup|modal|overlay|alert|banner|subscribe|newsletter|paywall|promo",
    "advert": r"(?<![a-z])ads?(?![a-z])|advert|sponsor|dfp|commercial", "form": "form|login|signup|search|contact",
    "comment": "comment|repl(?:y|ies)|respond|disqus|discussion|reader",
    "share": "share|social|follow|tags|byline|author|meta|date",
    "body": "article|content|post|entry|story|main|body|text|prose"}
_NAMES = [re.compile(p) for p in NAMES.values()]
TAGS = ("html body main article section div p h1 h2 h3 h4 h5 h6 header footer nav aside form ul ol li dl dt dd table tbody "
        "tr td th blockquote pre figure figcaption address details span a b strong em i label").split()
_TAG = {t: i for i, t in enumerate(TAGS)}
WORD_LEVELS, LINK_LEVELS, TREE_LEVELS = (1, 4, 10, 25, 80), (0.01, 0.3, 0.6, 0.9), (1, 10, 40, 150, 600)
#: Feature numbers: tag, names, own words, own links, sentence ends, words of the subtree, bias.
_AT = np.cumsum([0, len(TAGS) + 1, len(NAMES) + 1, len(WORD_LEVELS) + 1, len(LINK_LEVELS) + 1, 4, len(TREE_LEVELS) + 1, 1])
FEATURES = int(_AT[-1])
#: Groups of tags; the kind of a parent-child pair is the pair of their groups.
GROUPS = {t: k for k, ts in enumerate(("p h1 h2 h3 h4 h5 h6 blockquote pre", "li ul ol dl dt dd", "table tbody tr td th",
                                       "span a b strong em i label", "header footer nav aside form", "article", "main",
                                       "html body")) for t in ts.split()}
OTHER_GROUP = 8
PAIR_KINDS = (OTHER_GROUP + 1) ** 2


@dataclass
class Batch:
    """The blocks of many pages: feature numbers (node, feature), parent (-1 for roots), kind of the pair, levels."""

    node: np.ndarray
    feature: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.parent)


@dataclass
class Model:
    """unary: weight of each feature for content; pair: weight of (kind, parent's label, child's label)."""

    unary: np.ndarray
    pair: np.ndarray


def page_features(page: Page) -> list[list[int]]:
    """The active features of every block."""
    own = [0] * len(page.tag)
    letters, ends = [0] * len(page.tag), [0] * len(page.tag)
    for piece in page.text:
        if piece is not None:
            owner, text = piece
            words = len(text.split())
            if words:
                own[owner] += words
                letters[owner] += len(text)
                ends[owner] += text.count(". ") + text.rstrip().endswith((".", "!", "?", "…", "。"))
    below = own[:]
    for i in range(len(own) - 1, 0, -1):
        below[page.parent[i]] += below[i]
    rows = []
    for i, tag in enumerate(page.tag):
        naming = page.naming[i]
        active = [_TAG.get(tag, len(TAGS)), FEATURES - 1]
        if naming:
            named = [_AT[1] + k for k, pattern in enumerate(_NAMES) if pattern.search(naming)]
            active += named or [_AT[1] + len(NAMES)]
        active.append(_AT[2] + sum(own[i] >= n for n in WORD_LEVELS))
        if own[i]:
            active.append(_AT[3] + sum(page.linked[i] >= n * letters[i] for n in LINK_LEVELS))
            active.append(_AT[4] + min(ends[i], 3))
        active.append(_AT[5] + sum(below[i] >= n for n in TREE_LEVELS))
        rows.append(active)
    return rows


def batch_of(pages: list[Page]) -> Batch:
    rows = [r for page in pages for r in page_features(page)]
    starts = np.cumsum([0, *(len(p.tag) for p in pages)])
    parent = np.array([q + s if q >= 0 else -1 for p, s in zip(pages, starts) for q in p.parent], np.int64)
    depth = np.array([d for p in pages for d in p.depth], np.int64)
    group = np.array([GROUPS.get(t, OTHER_GROUP) for p in pages for t in p.tag], np.int64)
    kind = group[parent] * (OTHER_GROUP + 1) + group
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))
    return Batch(np.repeat(np.arange(len(rows)), [len(r) for r in rows]),
                 np.array([f for r in rows for f in r], np.int64), parent, kind, levels)


def marginals(batch: Batch, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each block, and P(parent's label, block's label) as (block, 2, 2); zero for roots."""
    size = len(batch)
    own = np.zeros((size, 2))
    own[:, 1] = np.bincount(batch.node, model.unary[batch.feature], size)
    pair = model.pair[batch.kind]
    up = own.copy()  # log potential of the block and all below it
    message = np.zeros((size, 2))  # from the block to its parent
    for level in reversed(batch.levels[1:]):
        message[level] = np.logaddexp(pair[level, :, 0] + up[level, None, 0], pair[level, :, 1] + up[level, None, 1])
        np.add.at(up, batch.parent[level], message[level])
    down = np.zeros((size, 2))  # from the parent to the block
    joint = np.zeros((size, 2, 2))
    for level in batch.levels[1:]:
        above = batch.parent[level]
        rest = up[above] + down[above] - message[level]
        both = rest[:, :, None] + pair[level] + up[level][:, None, :]
        both -= both.max(axis=(1, 2), keepdims=True)
        joint[level] = np.exp(both)
        joint[level] /= joint[level].sum(axis=(1, 2), keepdims=True)
        down[level] = np.logaddexp(rest[:, None, 0] + pair[level, 0], rest[:, None, 1] + pair[level, 1])
        down[level] -= down[level].max(axis=1, keepdims=True)
    total = up + down
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -700, 700))), joint


def fit_model(pages: list[Page], labels: list[np.ndarray], steps: int = STEPS, prior: float = PRIOR) -> Model:
    """Weights by Adam steps on the mean log likelihood of the labelled trees less ``prior`` times the squared weights."""
    batch, y = batch_of(pages), np.concatenate(labels).astype(int)
    child = np.flatnonzero(batch.parent >= 0)
    seen_pair = np.zeros((PAIR_KINDS, 2, 2))
    np.add.at(seen_pair, (batch.kind[child], y[batch.parent[child]], y[child]), 1)
    seen = np.bincount(batch.feature, y[batch.node], FEATURES)
    weights, mean, square = np.zeros(FEATURES + seen_pair.size), 0.0, 0.0
    for step in range(1, steps + 1):
        model = Model(weights[:FEATURES], weights[FEATURES:].reshape(seen_pair.shape))
        content, joint = marginals(batch, model)
        expected = np.bincount(batch.feature, content[batch.node], FEATURES)
        expected_pair = np.zeros_like(seen_pair)
        np.add.at(expected_pair, batch.kind[child], joint[child])
        gradient = np.concatenate((seen - expected, (seen_pair - expected_pair).ravel())) / len(y) - prior * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        weights = weights + 0.2 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Model(weights[:FEATURES], weights[FEATURES:].reshape(seen_pair.shape))


def main_text(page: Page, content: np.ndarray) -> str:
    """The text of content blocks, one line per block in page order, white space collapsed; empty blocks give none."""
    lines: list[str] = []
    line: list[str] = []
    for piece in [*page.text, None]:
        if piece is None:
            joined = " ".join("".join(line).split())
            if joined:
                lines.append(joined)
            line = []
        elif content[piece[0]]:
            line.append(piece[1])
    return "\n".join(lines)


def extract_pages(htmls: list[str], model: Model) -> list[str]:
    pages = [read_page(h) for h in htmls]
    content = marginals(batch_of(pages), model)[0] >= 0.5
    starts = np.cumsum([0, *(len(p.tag) for p in pages)])
    return [main_text(p, content[a:b]) for p, a, b in zip(pages, starts[:-1], starts[1:])]


def article_labels(page: Page) -> np.ndarray | None:
    """Blocks inside the page's one <article>, less those of menus, asides, forms and the like in it; None if the page has
    none or several."""
    if page.tag.count("article") != 1:
        return None
    inside = np.zeros(len(page.tag), bool)
    for i in range(len(page.tag)):
        if page.tag[i] == "article":
            inside[i] = True
        elif i:
            inside[i] = (inside[page.parent[i]] and page.tag[i] not in ("nav", "aside", "form", "footer")
                         and not any(p.search(page.naming[i]) for n, p in zip(NAMES, _NAMES) if n in (
                             "menu", "foot", "side", "related", "notice", "advert", "form", "comment")))
    return inside


def new_layout(blocks: list[tuple[str, str]], other: list[str], choose: np.random.Generator) -> str:
    """A page with the given content blocks (tag, text) in a layout drawn at random, content marked by data-y."""
    def pick(*options: str) -> str:
        return options[choose.integers(len(options))]

    def words(low: int, high: int) -> str:
        text = other[choose.integers(len(other))].split()
        at = choose.integers(max(1, len(text) - high + 1))
        return escape(" ".join(text[at: at + choose.integers(low, high + 1)])) or "x"

    def links(count: int) -> str:
        items = [f'<a href="#">{words(1, 3)}</a>' for _ in range(count)]
        return pick("<ul><li>" + "</li><li>".join(items) + "</li></ul>", " | ".join(items),
                    "<ul><li>" + "<li>".join(items) + "</ul>")

    def lines(count: int, low: int = 5, high: int = 40) -> str:
        return "".join(f"<p>{words(low, high)}.</p>" for _ in range(count))

    def box(names: str, inner: str, *tags: str) -> str:
        tag = pick(*(tags or ("div", "section")))
        attribute = "" if tag in ("nav", "header", "footer", "aside", "form") and choose.random() < 0.5 else \
            f' {pick("class", "id")}="{pick(*names.split())}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def advert() -> str:
        return box("ad ads advert advertisement ad-slot sponsored banner-ad", pick(words(3, 30), lines(1), links(2)),
                   "div", "aside", "section")

    def notice() -> str:
        return box("cookie-notice cookie-banner consent notice alert newsletter subscribe-box gdpr popup paywall",
                   lines(choose.integers(1, 3)) + pick("", "<button>OK</button>"), "div", "section", "aside")

    def form() -> str:
        return box("search-form login signup contact-form newsletter",
                   f'<label>{words(1, 4)}</label><input type="text">' + pick("", f"<p>{words(4, 15)}</p>")
                   + "<button>Go</button>", "form")

    def related() -> str:
        return box("related recommended popular also-read trending", f"<h3>{words(1, 4)}</h3>" + links(4), "div", "aside",
                   "section")

    def comments() -> str:
        each = [box("comment comment-body reply reader-comment", f"<p><b>{words(1, 2)}</b></p>" + lines(
            choose.integers(1, 3), 5, 60), "div", "li", "article", "section") for _ in range(choose.integers(1, 5))]
        return box("comments comment-list discussion responses reader-comments", f"<h3>{words(1, 3)}</h3>" + "".join(each),
                   "div", "section", "ol")

    body = "".join(f"<{t} data-y>{escape(x)}</{t}>" + (pick(advert, related, notice)() if choose.random() < 0.06 else "")
                   for t, x in blocks)
    names = "content post entry article story main-content post-body article-body entry-content text"
    shell, attribute = pick("article", "main", "div", "div", "section"), f' class="{pick(*names.split())}"'
    if shell in ("article", "main") and choose.random() < 0.5:
        attribute = ""
    core = f"<{shell}{attribute} data-y>{body}</{shell}>"
    while choose.random() < 0.3:
        core = pick(f'<div class="{pick("wrapper", "container", "row", "page", "layout", "column")}">{core}</div>',
                    f"<main>{core}</main>", f"<div>{core}</div>")
    top = [lambda: box("header site-header masthead top", f"<h2>{words(1, 3)}</h2>" + links(3), "header", "div"),
           lambda: box("nav menu main-menu breadcrumb navbar", links(6), "nav", "div"), advert, notice, form]
    bottom = [related, comments, advert, form, notice,
              lambda: box("sidebar side widget aside", f"<h3>{words(1, 3)}</h3>" + links(4) + lines(1, 3, 25), "aside",
                          "div"),
              lambda: box("footer site-footer copyright legal", f"<p>&copy; {words(2, 12)}</p>" + links(3), "footer",
                          "div")]
    before = "".join(part() for part in top if choose.random() < 0.5)
    after = "".join(part() for part in bottom if choose.random() < 0.5)
    return f"<html><head><title>{words(2, 6)}</title></head><body>{before}{core}{after}</body></html>"


def training_pages(htmls: list[str], layouts: int = LAYOUTS) -> tuple[list[Page], list[np.ndarray]]:
    """The labelled pages among ``htmls``, each as it stands and in ``layouts`` other forms."""
    choose = np.random.default_rng(11)
    pages, labels, contents = [], [], []
    for html in htmls:
        page = read_page(html)
        inside = article_labels(page)
        if inside is not None:
            pages.append(page)
            labels.append(inside)
            blocks: dict[int, list[str]] = {}
            for piece in page.text:
                if piece is not None and inside[piece[0]] and piece[1].strip():
                    blocks.setdefault(piece[0], []).append(piece[1])
            contents.append([(page.tag[i] if page.tag[i] in ("p", "h1", "h2", "h3", "li", "blockquote") else "p",
                              " ".join("".join(t).split())) for i, t in blocks.items()])
    texts = [" ".join(t for _, t in blocks) or "x" for blocks in contents]
    for blocks in contents:
        for _ in range(layouts if blocks else 0):
            kept = blocks[:choose.integers(1, 4)] if choose.random() < 0.25 else blocks  # short articles too
            marked = new_layout(kept, texts, choose)
            # The mark becomes a name of the reader's, so that labels are read off the same tree the model sees.
            page = read_page(re.sub(r'<(\w+)((?: class="[^"]*")?) data-y>', lambda m: f'<{m[1]}{m[2]} id="__y">', marked))
            labels.append(np.array(["__y" in n for n in page.naming]))
            page.naming = [n.replace("__y", "").strip() for n in page.naming]
            pages.append(page)
    return pages, labels


#: Characters from which on a page is not learned from.
LONGEST_LEARNED = 200_000


def fit(pages: DataFrame, rows: int = SAMPLE_PAGES) -> Model:
    """The model of at most ``rows`` pages with an <article> and under LONGEST_LEARNED characters, those with the smallest
    hash of page_id (bounded sample; longer pages are read, only not learned from; of several pages with one id the first in
    order). Without such a page the weights are those of the layouts alone, filled with placeholder words."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    able = pages.select(html.alias("html"), id_text("page_id").alias("id")).filter(
        F.col("html").contains("<article") & (F.length("html") < LONGEST_LEARNED))
    keys = hashed_sample(stored(able.select("id").distinct(), "page-ids"), rows, "id")  # only the chosen pages' html travels
    chosen = able.join(F.broadcast(keys), "id").groupBy("id").agg(F.min("html").alias("html"))
    sample = chosen.orderBy(F.xxhash64("id"), "id").collect()
    found, labels = training_pages([r["html"] for r in sample] or ["<article><h1>x x</h1><p>x x x x x x.</p></article>"])
    return fit_model(found, labels)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text: one row per row of ``pages``, from the whole html.

    Null and empty html, and pages without content, give an empty text. Character references are decoded, white space
    within a block becomes one space, blocks follow in page order, one per line. Very long pages are read whole; unclosed
    and misplaced tags are tolerated. Repeated rows and null ids are kept as they are; other columns are ignored; an empty
    table gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = extract_pages(batch.column("html").to_pylist(), shared.value)
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"),
                                              "text": pa.array(texts, pa.string())})

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return (pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
            .mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string"))
