"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.shared import map_texts, text_of

SAMPLE_PAGES = 300
SAMPLE_CHARS = 100_000
TEMPLATE_PAGES = 400
STEPS = 120
PENALTY = 1e-4
SEED = 11

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html iframe label legend li main menu "
    "nav object ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is raw and no text of the page, with what ends them
RAW = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE)
    for name in ("script", "style", "textarea", "title")
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)"""
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
#: the end of a tag's attributes when its last slash belongs to a value without quotes
OPEN_VALUE = re.compile(r"""=\s*[^\s"']*/\Z""")
NAME_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text, the tags and names around it, and how much of it is link text."""

    text: str
    path: tuple[str, ...]
    linked: int = 0


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    path: tuple[str, ...] | None = None
    linked: int = 0


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, without markup, with character references decoded.

    A block ends where a block element begins or ends. An open paragraph ends at the
    next block element, a closing tag ends all that is open inside its element, and
    one without an open element is ignored. A self-closed element is empty. Only the
    content of ``RAW`` elements is skipped; text in svg, math or noscript has them as
    ancestors. White space in a block is one space; blocks without text are left out.
    A quote opens a value only directly after ``=`` and if it is closed again; anywhere else
    in a tag it is a plain character. An unclosed tag or comment runs to the end of the page.
    """
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    now = _Open()
    links = at = 0

    def end_block() -> None:
        nonlocal now
        if now.parts:
            text = " ".join("".join(now.parts).split())
            if text:
                out.append(Block(text, now.path or (), now.linked))
            now = _Open()

    def add(text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        if text:
            if now.path is None and not text.isspace():
                now.path = tuple(mark for _, mark in stack)
            now.parts.append(text)
            now.linked += len(text) if links else 0

    while m := TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        empty = m[3].endswith("/") and not OPEN_VALUE.search(m[3])
        if name in RAW and not m[1] and not empty:
            close = RAW[name].search(page, m.end(2))
            at = close.end() if close else len(page)
            continue
        block = name in BLOCK_TAGS
        if block:
            end_block()
        if m[1]:
            if any(tag == name for tag, _ in stack):
                while stack:
                    tag, _ = stack.pop()
                    links -= tag == "a"
                    if tag == name:
                        break
        elif name in VOID_TAGS:
            if name in ("br", "hr"):
                now.parts.append(" ")
        else:
            if block:
                opened = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK_TAGS), None)
                if opened is not None and stack[opened][0] == "p":
                    links -= sum(tag == "a" for tag, _ in stack[opened:])
                    del stack[opened:]
            if not empty:
                stack.append((name, _mark(name, m[3])))
                links += name == "a"
    if at < len(page):
        add(page[at:])
    end_block()
    return out


def _mark(name: str, attributes: str) -> str:
    """A tag with the words of its class, id and role."""
    if not attributes or "=" not in attributes:
        return name
    words = {w for value in NAMES.findall(attributes) for w in NAME_PART.findall(value.lower())}
    return " ".join([name, *sorted(f".{w}" for w in words)])


def features(block: Block) -> list[str]:
    """Ancestor tags and their class words, and the shape of the text."""
    tags = {part for mark in block.path for part in mark.split()}
    last = block.path[-1].split()[0] if block.path else "none"
    n = len(block.text.split())
    return [
        "bias",
        *(f"in {t}" for t in sorted(tags - {"html", "body"})),
        f"last {last}",
        f"words {min(n.bit_length(), 7)}",
        "linked" if 2 * block.linked > len(block.text) else "plain",
        "sentence" if block.text[-1] in ".!?" else "open",
    ]


class Crf:
    """Two states, other (0) and main text (1); weights per feature and state, and between neighbours."""

    def __init__(self, weights: dict[str, tuple[float, float]], moves: list[list[float]]):
        self.weights, self.moves = weights, moves

    def scores(self, block: Block) -> tuple[float, float]:
        other = main = 0.0
        for f in features(block):
            w = self.weights.get(f)
            if w is not None:
                other += w[0]
                main += w[1]
        return other, main

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest states of a page's blocks (Viterbi; ties go to other)."""
        (oo, om), (mo, mm) = self.moves
        back: list[tuple[int, int]] = []
        other = main = 0.0
        for k, block in enumerate(blocks):
            a, b = self.scores(block)
            if k:
                from_o = (other + oo, other + om)
                from_m = (main + mo, main + mm)
                back.append((int(from_m[0] > from_o[0]), int(from_m[1] > from_o[1])))
                other, main = max(from_o[0], from_m[0]) + a, max(from_o[1], from_m[1]) + b
            else:
                other, main = a, b
        state = int(main > other)
        states = [state]
        for step in reversed(back):
            state = step[state]
            states.append(state)
        return states[::-1] if blocks else []


def train_crf(pages: list[tuple[list[Block], list[int]]]) -> Crf:
    """Fit the field to labelled pages: penalised likelihood by forward-backward and Adam.

    Pages are padded to one array, so each step of the recursions is done for all at once.
    """
    pages = [p for p in pages if p[0]]
    names = {f: i for i, f in enumerate(sorted({f for blocks, _ in pages for b in blocks for f in features(b)}))}
    longest = max(len(b) for b, _ in pages)
    page = np.concatenate([np.full(len(b), k) for k, (b, _) in enumerate(pages)])
    step = np.concatenate([np.arange(len(b)) for b, _ in pages])
    sizes = np.array([len(b) for b, _ in pages])
    goal = np.concatenate([s for _, s in pages])
    rows, cols = zip(*((r, names[f]) for r, b in enumerate(b for bs, _ in pages for b in bs) for f in features(b)))
    rows, cols = np.array(rows), np.array(cols)
    valid = np.arange(longest)[None, :] < sizes[:, None]
    truth = np.zeros((len(pages), longest, 2))
    truth[page, step, goal] = 1
    pairs = np.einsum("psa,psb->ab", truth[:, :-1], truth[:, 1:])
    w, t = np.zeros((len(names), 2)), np.zeros((2, 2))
    state = [np.zeros_like(x) for x in (w, w, t, t)]
    for k in range(1, STEPS + 1):
        node = np.zeros((len(pages), longest, 2))
        flat = np.stack([np.bincount(rows, weights=w[cols, s], minlength=len(page)) for s in (0, 1)], axis=1)
        node[page, step] = flat
        ahead = np.zeros_like(node)
        ahead[:, 0] = node[:, 0]
        for i in range(1, longest):
            ahead[:, i] = np.logaddexp.reduce(ahead[:, i - 1, :, None] + t, axis=1) + node[:, i]
        behind = np.zeros_like(node)
        for i in range(longest - 2, -1, -1):
            came = np.logaddexp.reduce(t + (node[:, i + 1] + behind[:, i + 1])[:, None, :], axis=2)
            behind[:, i] = np.where(valid[:, i + 1, None], came, 0)
        total = np.logaddexp.reduce(ahead[np.arange(len(pages)), sizes - 1], axis=1)
        p = np.exp(ahead + behind - total[:, None, None]) * valid[:, :, None]
        both = ahead[:, :-1, :, None] + t + (node[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        moves = (np.exp(both) * valid[:, 1:, None, None]).sum(axis=(0, 1))
        wrong = (truth - p)[page, step]
        grad_w = np.stack([np.bincount(cols, weights=wrong[rows, s], minlength=len(names)) for s in (0, 1)], axis=1)
        for grad, value, m, v in ((grad_w, w, state[0], state[1]), (pairs - moves, t, state[2], state[3])):
            grad = grad / len(page) - PENALTY * value
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += 0.2 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return Crf({f: (float(w[i, 0]), float(w[i, 1])) for f, i in names.items()}, t.tolist())


#: what surrounds the text of the labelled template pages: a wrapper and how its content looks
AROUND = (
    '<nav>{links}</nav>', '<ul class="menu">{links}</ul>', '<div id="navbar" class="nav">{links}</div>',
    '<header><p>{short}</p>{links}</header>', '<div class="header banner">{short}</div>', '<aside><h3>{short}</h3>{links}</aside>',
    '<div class="sidebar widget"><h3>{short}</h3><p>{long}</p></div>', '<div class="ad">{long}</div>', '<div class="advert sponsored"><p>{long}</p></div>',
    '<section id="promo">{short}</section>', '<div class="cookie notice">{long}</div>', '<div role="alert" class="banner consent"><p>{long}</p></div>',
    '<form action="/s"><label>{short}</label><button>{short}</button></form>', '<div class="newsletter subscribe"><p>{long}</p></div>',
    '<footer>{short}</footer>', '<footer><p>{long}</p>{links}</footer>', '<div id="footer">{short}</div>', '<div class="copyright">{short}</div>',
    '<section class="comments"><h3>{short}</h3><div class="comment"><p>{long}</p></div><div class="comment"><p>{long}</p></div></section>',
    '<div id="comments"><ul><li>{long}</li><li>{long}</li></ul></div>', '<div class="related">{links}</div>',
    '<div class="share social">{links}</div>', '<div class="breadcrumb">{links}</div>',
)
INSIDE = (
    '<p>{long}</p>', '<p>{long}</p>', '<p>{short}</p>', '<h2>{short}</h2>', '<ul><li>{long}</li><li>{short}</li></ul>',
    '<blockquote>{long}</blockquote>', '<p><b>{long}<br></p>', '<pre>{short}</pre>', '<table><tr><td>{short}</td><td>{short}</td></tr></table>',
)
CONTENT = (
    "<article>{0}</article>", "<article>{0}</article>", "<article>{0}</article>", "<main>{0}</main>",
    "<main><article>{0}</article></main>", '<div class="content">{0}</div>', '<div id="main" class="post entry">{0}</div>',
    '<div class="article body">{0}</div>', "<article class=\"post\"><div>{0}</div></article>",
)


def template_pages(n: int = TEMPLATE_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages made from the templates with random words; the label is where a block was put."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        made = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(low, high))]
        return " ".join(made).capitalize() + rng.choice((".", ".", "", "!"))

    def fill(template: str, mark: str) -> str:
        for slot, make in (
            ("{links}", lambda: "".join(f'<li><a href="/x">{mark}{words(1, 3)}</a></li>' for _ in range(rng.randint(1, 8)))),
            ("{short}", lambda: mark + words(1, 6)),
            ("{long}", lambda: mark + words(3, 80)),
        ):
            while slot in template:
                template = template.replace(slot, make(), 1)
        return template

    pages = []
    for _ in range(n):
        inner = [fill("<h1>{short}</h1>", "M")] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 12)):
            inner.append(fill(rng.choice(INSIDE), "M"))
            if rng.random() < 0.12:
                inner.append(fill(rng.choice(AROUND), "O"))
        parts = [fill(rng.choice(AROUND), "O") for _ in range(rng.randint(0, 4))]
        parts.append(rng.choice(CONTENT).format("".join(inner)))
        parts += [fill(rng.choice(AROUND), "O") for _ in range(rng.randint(0, 4))]
        blocks = leaf_blocks("<html><body>" + "".join(parts) + "</body></html>")
        labels = [int(b.text[0] == "M") for b in blocks]
        for b in blocks:
            b.text = b.text[1:] or "a"
        pages.append((blocks, labels))
    return pages


OUTSIDE = frozenset("nav aside footer header form button select label .ad".split())


def labelled_by_markup(page: str) -> tuple[list[Block], list[int]]:
    """A page labelled by its own semantic elements; without ``article`` or ``main`` it teaches nothing."""
    blocks = leaf_blocks(page)
    tags = [{part for mark in b.path for part in mark.split()} for b in blocks]
    if not any(t & {"article", "main"} for t in tags):
        return [], []
    return blocks, [int(bool(t & {"article", "main"}) and not t & OUTSIDE) for t in tags]


def fit_pages(pages: DataFrame, sample: int = SAMPLE_PAGES, html_col: str = "html") -> Crf:
    """A field trained on the template pages and on at most ``sample`` distinct pages of the table.

    The sample (pages of at most ``SAMPLE_CHARS`` characters whose hashes are lowest) is
    all that reaches the driver: its hashes are found first, then its pages fetched.
    """
    page = F.col(f"`{html_col}`")
    given = pages.select(page.alias("html"), F.xxhash64(page, F.lit(SEED)).alias("mark"))
    given = given.where(F.length("html") <= SAMPLE_CHARS)
    marks = [r["mark"] for r in given.select("mark").distinct().orderBy("mark").limit(sample).collect()]
    rows = given.where(F.col("mark").isin(marks)).groupBy("mark").agg(F.min("html").alias("html")).collect()
    rows.sort(key=lambda r: r["mark"])
    return train_crf([*template_pages(), *(labelled_by_markup(r["html"]) for r in rows)])


def main_text(page: str, crf: Crf) -> str:
    """The blocks that the field takes for main text, two line ends between them."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, s in zip(blocks, crf.decode(blocks)) if s)


def extract(
    pages: DataFrame,
    crf: Crf | None = None,
    id_col: str = "page_id",
    html_col: str = "html",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id``, ``text`` and ``row`` (the columns ``keep``) for every row of ``pages``.

    A null or empty page has an empty text. Repeated rows and null ids are worked on
    row by row, columns not named aren't read, and an empty table gives an empty
    table. Without ``crf`` one is trained first.
    """
    crf = crf or fit_pages(pages, html_col=html_col)

    def job(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, crf) for p in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(texts, pa.string()), batch.column("row")], ["id", "text", "row"]
        )

    row = F.struct(F.lit(True).alias("_"), *(F.col(f"`{c}`") for c in keep))
    given = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), text_of(F.col(f"`{html_col}`")).alias("html"), row.alias("row")
    )
    schema = T.StructType.fromDDL("id long, text string").add(given.schema["row"])
    return map_texts(given, "html", schema, job)
