"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .hashing import slices

#: Elements of the HTML standard by the way they take part in blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
SILENT = frozenset("script style noscript template svg iframe object select button textarea title canvas audio video math head".split())
RAW = frozenset("script style noscript template svg iframe textarea title".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr option".split())

NAME_END = re.compile(r"[\s/>]")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")


DEEPEST = 200  # levels of elements that mark what lies inside them


@dataclass
class Block:
    text: str
    path: int
    link: int


@dataclass
class Paths:
    """Chains of open elements, each known by a number; 0 is the empty chain."""

    parent: list[int] = field(default_factory=lambda: [0])
    marks: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    tag: list[str] = field(default_factory=lambda: [""])
    level: list[int] = field(default_factory=lambda: [0])
    known: dict[tuple[int, str, str], int] = field(default_factory=dict)
    sums: dict[int, np.ndarray] = field(default_factory=dict)

    def below(self, path: int, tag: str, attributes: str) -> int:
        key = (path, tag, attributes if "=" in attributes else "")
        if key not in self.known:
            names = " ".join(a or b or c for a, b, c in NAMES.findall(key[2])).lower()
            inside = not {"tag:article", "tag:main"}.isdisjoint(self.marks[path])
            own = (f"tag:{tag}", f"{'inner' if inside else 'outer'}:{tag}", *(f"name:{w}" for w in dict.fromkeys(PART.findall(names))))
            self.known[key] = len(self.tag)
            self.parent.append(path)
            self.tag.append(tag)
            self.level.append(self.level[path] + 1)
            deep = self.level[path] >= DEEPEST
            self.marks.append(self.marks[path] if deep else tuple(dict.fromkeys((*self.marks[path], *own))))
        return self.known[key]


class Tags:
    """Tags, comments and declarations of a page, found in one pass forward.

    A tag ends at the first ``>`` outside quotes, at the first one at all if its quotes don't close, or with the
    page. Where quotes close and no free ``>`` follows is remembered, so that no part is looked at twice
    however broken the page is.
    """

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.places = {mark: [m.start() for m in re.finditer(mark, page)] for mark in ">\"'"}
        self.dead: set[int] = set()

    def ahead(self, mark: str, at: int) -> int:
        places = self.places[mark]
        i = bisect_left(places, at)
        return places[i] if i < len(places) else self.size

    def unquoted(self, at: int) -> int:
        """Place of the first ``>`` outside quotes; the size of the page for none."""
        seen = []
        while at not in self.dead:
            seen.append(at)
            end, opens = self.ahead(">", at), min(self.ahead('"', at), self.ahead("'", at))
            if end < opens:
                return end
            closes = self.size if opens == self.size else self.ahead(self.page[opens], opens + 1)
            if closes == self.size:
                break
            at = closes + 1
        self.dead.update(seen)
        return self.size

    def after(self, at: int) -> tuple[int, int, bool, str, str]:
        """(start, end, closing, name, attributes) of the next one; the name is empty for what is no tag."""
        page, start = self.page, self.page.find("<", at)
        while start >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, self.size if end < 0 else end + 3, False, "", ""
            closing = page.startswith("/", start + 1)
            begin = start + 1 + closing
            letter = page[begin : begin + 1]
            if letter.isascii() and letter.isalpha():
                stop = NAME_END.search(page, begin)
                stop = stop.start() if stop else self.size
                end = self.unquoted(stop)
                end = self.ahead(">", stop) if end == self.size else end
                if end < self.size:
                    return start, end + 1, closing, page[begin:stop], page[stop:end]
                return start, self.size, False, "", ""
            if closing or page[begin : begin + 1] in ("!", "?"):
                return start, min(self.size, self.ahead(">", start) + 1), False, "", ""
            start = page.find("<", start + 1)
        return self.size, self.size, False, "", ""

    def raw_end(self, tag: str, at: int) -> int:
        """Behind the closing tag of an element whose content is no markup, or the end of the page."""
        close = re.compile(rf"</{tag}\b", re.I).search(self.page, at)
        end = self.ahead(">", close.end()) if close else self.size
        return min(self.size, end + 1)


def leaf_blocks(page: str, paths: Paths) -> list[Block]:
    """Runs of text between block-level tags, with references decoded and white space collapsed."""
    out: list[Block] = []
    stack, pieces = [0], []
    open_: Counter[str] = Counter()
    tags, link, depth, silent, at = Tags(page), 0, 0, 0, 0

    def flush() -> None:
        nonlocal link
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Block(text, stack[-1], link))
        pieces.clear()
        link = 0

    def add(text: str) -> None:
        nonlocal link
        if not silent:
            pieces.append(text)
            link += len(text) if depth else 0

    while at < len(page):
        start, end, closing, name, attributes = tags.after(at)
        if start > at:
            add(page[at:start])
        at = end
        if not name:
            continue
        tag = name.lower()
        if tag in INLINE:
            depth = (0 if closing else 1) if tag == "a" else depth
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if closing:
            flush()
            depth = 0
            while open_[tag]:
                inner = paths.tag[stack.pop()]
                silent -= inner in SILENT
                open_[inner] -= 1
                if inner == tag:
                    break
            continue
        if tag in RAW:
            at = tags.raw_end(tag, at)
            continue
        flush()
        depth = 0
        if tag == "body":
            silent, stack = 0, [p for p in stack if paths.tag[p] not in SILENT]
            open_ = Counter(paths.tag[p] for p in stack[1:])
        top = paths.tag[stack[-1]]
        if (top == "p" and tag in ENDS_P) or (top in LEAVES and top == tag):
            open_[paths.tag[stack.pop()]] -= 1
        stack.append(paths.below(stack[-1], tag, attributes))
        open_[tag] += 1
        silent += tag in SILENT
    flush()
    return out


def _level(x: float, cuts: Sequence[float]) -> int:
    return sum(x > c for c in cuts)


def text_marks(block: Block) -> list[str]:
    n = len(block.text)
    return [
        f"size:{_level(n, (15, 40, 80, 160, 320))}", f"words:{_level(block.text.count(' ') + 1, (1, 3, 8, 20, 50))}",
        f"links:{_level(block.link / n, (0.01, 0.3, 0.7))}", f"stop:{block.text[-1] in '.!?…。'}",
        f"sign:{any(c in block.text for c in '©®™')}",
    ]


class Field:
    """Weights of marks for (other, main) and of steps from one block's label to the next."""

    def __init__(self, marks: dict[str, int]) -> None:
        self.marks = marks
        self.weights, self.steps, self.first = np.zeros((len(marks) + 1, 2)), np.zeros((2, 2)), np.zeros(2)

    def ids(self, blocks: list[Block], paths: Paths) -> list[list[int]]:
        out = []
        for block in blocks:
            names = (*paths.marks[block.path], f"leaf:{paths.tag[block.path]}", *text_marks(block))
            out.append([self.marks[n] for n in names if n in self.marks])
        return out

    def emissions(self, ids: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[i].sum(0) for i in ids]).reshape(-1, 2)

    def page_emissions(self, blocks: list[Block], paths: Paths) -> np.ndarray:
        """As ``emissions``, with the sums of known paths kept beside them."""
        out = np.empty((len(blocks), 2))
        for i, block in enumerate(blocks):
            if block.path not in paths.sums:
                names = (*paths.marks[block.path], f"leaf:{paths.tag[block.path]}")
                paths.sums[block.path] = self.weights[[self.marks[n] for n in names if n in self.marks]].sum(0)
            own = [self.marks[n] for n in text_marks(block) if n in self.marks]
            out[i] = paths.sums[block.path] + self.weights[own].sum(0)
        return out

    def viterbi(self, emissions: np.ndarray) -> list[int]:
        (a, b), (c, d) = self.steps.tolist()
        back: list[tuple[int, int]] = []
        x = y = 0.0
        for i, (e, f) in enumerate(emissions.tolist()):
            if i == 0:
                x, y = e + self.first[0], f + self.first[1]
                continue
            from_x, from_y = (0 if x + a >= y + c else 1), (0 if x + b > y + d else 1)
            x, y = e + max(x + a, y + c), f + max(x + b, y + d)
            back.append((from_x, from_y))
        label, out = int(y > x), []
        for step in [*reversed(back), None]:
            out.append(label)
            label = step[label] if step else label
        return out[::-1] if len(emissions) else []

    def gradient(self, ids: list[list[int]], labels: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected minus observed counts: for emissions, steps and the first label."""
        e = self.emissions(ids)
        n = len(e)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = self.first + e[0]
        for i in range(1, n):
            forward[i] = e[i] + np.logaddexp(forward[i - 1][0] + self.steps[0], forward[i - 1][1] + self.steps[1])
        for i in range(n - 2, -1, -1):
            after = e[i + 1] + backward[i + 1]
            backward[i] = np.logaddexp(self.steps[:, 0] + after[0], self.steps[:, 1] + after[1])
        total = np.logaddexp(*forward[-1])
        single = np.exp(forward + backward - total)
        single[np.arange(n), labels] -= 1
        pairs = np.zeros((2, 2))
        for i in range(1, n):
            pairs += np.exp(forward[i - 1][:, None] + self.steps + (e[i] + backward[i])[None, :] - total)
            pairs[labels[i - 1], labels[i]] -= 1
        return single, pairs, single[0]


def train(pages: Sequence[tuple[str, Sequence[int]]], *, epochs: int = 6, rate: float = 0.3, seed: int = 1) -> Field:
    """Fit by stochastic gradient on the likelihood of labelled pages (html, label of each block)."""
    paths = Paths()
    parsed = [(leaf_blocks(page, paths), list(labels)) for page, labels in pages]
    names: dict[str, int] = {}
    for blocks, labels in parsed:
        if len(blocks) != len(labels):
            raise ValueError(f"{len(blocks)} blocks with {len(labels)} labels")
        for b in blocks:
            for n in (*paths.marks[b.path], f"leaf:{paths.tag[b.path]}", *text_marks(b)):
                names.setdefault(n, len(names))
    model = Field(names)
    ready = [(model.ids(blocks, paths), labels) for blocks, labels in parsed if blocks]
    squares = np.full(model.weights.shape, 1e-2)
    rng = random.Random(seed)
    for epoch in range(epochs):
        rng.shuffle(ready)
        for ids, labels in ready:
            single, pairs, first = model.gradient(ids, labels)
            change = np.zeros_like(model.weights)
            np.add.at(change, np.concatenate([np.array(i, int) for i in ids]), np.repeat(single, [len(i) for i in ids], axis=0))
            squares += change * change
            model.weights -= rate * (change / np.sqrt(squares) + 1e-4 * model.weights)
            model.steps -= rate * 0.1 / (1 + epoch) * np.clip(pairs, -1, 1)
            model.first -= rate * 0.1 / (1 + epoch) * np.clip(first, -1, 1)
    return model


#: Names that the labelled pages give to containers, by what they hold.
OTHER_NAMES = {
    "nav": "menu nav navbar navigation topnav breadcrumb breadcrumbs links toc pagination pager tabs",
    "header": "header masthead topbar branding banner site logo",
    "footer": "footer bottom copyright colophon legal imprint",
    "aside": "sidebar aside side rail widget related recommended popular trending recirculation",
    "notice": "notice cookie cookies consent gdpr alert warning disclaimer banner popup modal overlay message paywall toast",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner adsense commercial teaser",
    "form": "form search searchbox login signin signup subscribe newsletter subscription register contact",
    "comment": "comment comments commentlist discussion replies reply respond thread disqus feedback reactions guestbook",
    "share": "share sharing social tags meta author byline metadata tools toolbar buttons",
}
AROUND_NAMES = "page wrapper container site body content layout root app wrap outer"
MAIN_NAMES = "article content main post entry story body text page maincontent articlebody richtext"
SYLLABLES = "an be co da el fi ga ho in jo ka le mi no or pa qui ra so ta un ve wo xi ya zu é ção ñ über straße".split()


def labelled_pages(count: int, seed: int = 1) -> list[tuple[str, list[int]]]:
    """Pages laid out by chance, with the label (1 main text) of each of their blocks."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
    words = lambda n: " ".join(word() for _ in range(n))
    sentence = lambda n: words(max(1, n)).capitalize() + rng.choice(".....!?")

    def named(kind: str) -> str:
        names = rng.choice((OTHER_NAMES[kind] if kind in OTHER_NAMES else MAIN_NAMES).split())
        other = rng.choice(("", "", "", " left", " box", f"-{rng.choice(('wrapper', 'box', 'list', 'item', 'area', 'block'))}"))
        return f' {rng.choice(("class", "class", "id"))}="{names}{other}"'

    def paragraph() -> tuple[str, int]:
        close = rng.random() < 0.85
        inner = " ".join(sentence(rng.randint(1, 25)) for _ in range(rng.choice((1, 1, 2, 3, 5))))
        if rng.random() < 0.2:
            inner = sentence(rng.randint(1, 3))
        odd = rng.random()
        if odd < 0.05:
            inner = " | ".join(word() for _ in range(rng.randint(3, 60))) + " |" * (rng.random() < 0.5)
        elif odd < 0.12:
            inner = " ".join(w.upper() + "!!" for w in inner.split())
        elif odd < 0.16:
            inner = " ".join(w + rng.choice(("###", "$$$", "%%%", "***")) for w in inner.split())
        elif odd < 0.2:
            inner = " ".join([word()] * rng.randint(5, 40))
        if rng.random() < 0.2:
            inner = f"<b>{inner}" + "</b>" * (rng.random() < 0.5)
        if rng.random() < 0.1:
            inner += f' <a href="/x">{words(2)}</a> {words(3)}.'
        return f"<p>{inner}" + "<br>" * (rng.random() < 0.1) + "</p>" * close, 1

    def other(kind: str) -> tuple[str, list[int]]:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, rng.choice(("div", "section")))
        bare = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
        tag, names = (tag, "") if bare else (rng.choice((tag, "div", "section", "ul" if kind == "nav" else "div")), named(kind))
        parts, n = [], rng.randint(1, 6)
        for _ in range(n):
            if kind == "nav" or (kind in ("aside", "share", "footer", "header") and rng.random() < 0.5):
                parts.append(f'<li><a href="/{word()}">{words(rng.randint(1, 4))}</a></li>')
            elif kind == "form":
                parts.append(f"<p><label>{words(2)}</label><input name=q></p>")
            elif kind == "footer":
                parts.append(f"<p>&copy; {words(3)} &middot; {sentence(rng.randint(2, 15))}</p>")
            else:
                shape = rng.choice(("p", "div", "p", "h3", "li", *(("h1", "h1") if kind == "header" else ())))
                parts.append(f"<{shape}>{' '.join(sentence(rng.randint(1, 22)) for _ in range(rng.choice((1, 1, 2, 4))))}</{shape}>")
        if rng.random() < 0.3:
            return f"<{tag}{names}>{sentence(rng.randint(2, 25))}</{tag}>", [0]
        return f"<{tag}{names}>{''.join(parts)}</{tag}>", [0] * n

    pages = []
    for number in range(count):
        out, labels = [], []
        if number % 40 == 39:
            pages.append((" ".join(sentence(rng.randint(2, 25)) for _ in range(rng.randint(1, 9))), [1]))
            continue

        def put(part: str, own: list[int], out: list[str] = out, labels: list[int] = labels) -> None:
            out.append(part)
            labels.extend(own)

        around = f"<div{rng.choice((' id', ' class'))}='{rng.choice(AROUND_NAMES.split())}'>" if rng.random() < 0.35 else ""
        if around:
            put(around, [])
        for kind in ("header", "nav", "notice", "ad", "form"):
            if rng.random() < 0.55:
                put(*other(kind))
        shell = rng.choice(("article", "article", "article", "main", "div", "section", ""))
        if shell:
            put(f"<{shell}{named('main') if shell in ('div', 'section') or rng.random() < 0.3 else ''}>", [])
        if rng.random() < 0.7:
            head = f"<h1>{words(rng.randint(2, 12))}</h1>"
            wrapped = shell == "article" and rng.random() < 0.2
            line = f"<p{named('share')}>{words(rng.randint(1, 5))}</p>" if shell and rng.random() < 0.3 else ""
            put(f"<header>{head}{line}</header>" if wrapped else head + line, [1, 0] if line else [1])
        if shell and rng.random() < 0.15:
            put(*other("share"))
        for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 14))):
            roll = rng.random()
            if roll < 0.74:
                part, label = paragraph()
                put(part, [label])
            elif roll < 0.8:
                put(f"<h2>{words(rng.randint(1, 6))}</h2>", [1])
            elif roll < 0.84:
                n = rng.randint(1, 4)
                put(f"<ul>{''.join(f'<li>{sentence(rng.randint(1, 14))}</li>' for _ in range(n))}</ul>", [1] * n)
            elif roll < 0.88:
                shape = rng.choice(("blockquote", "pre", "table"))
                n = rng.randint(1, 6) if shape == "table" else 1
                cells = f"<tr>{''.join(f'<td>{words(rng.randint(1, 6))}</td>' for _ in range(n))}</tr>"
                put(f"<{shape}>{cells if shape == 'table' else sentence(12)}</{shape}>", [1] * n)
            elif shell:
                put(*other(rng.choice(("ad", "aside", "aside", "share", "notice", "form", "footer"))))
        if shell and rng.random() < 0.25:
            put(*other("comment"))
        if shell:
            put(f"</{shell}>", [])
        for kind in ("comment", "aside", "ad", "footer"):
            if rng.random() < 0.55:
                put(*other(kind))
        if around:
            put("</div>", [])
        pages.append((f"<html><head><title>{words(3)}</title></head><body>{''.join(out)}</body></html>", labels))
    return pages


def extracted(pages: DataFrame, model: Field | None = None, *, pages_to_learn: int = 1200) -> DataFrame:
    """Main text of every row of ``pages`` (html): all columns but text and n_chars of its own, and these.

    Blocks are runs of text between block-level tags; scripts, styles, the head and comments are no
    blocks. The field labels the blocks of a page together; those it calls main are joined by
    newlines, whole. Null and empty pages, and pages without main text, give an empty text. Tags
    left open, cut-off pages and references are read as a browser would. Every row gives one
    row, repeated and null ids included; there is no shuffle. Without ``model`` the field is trained
    on ``labelled_pages(pages_to_learn)``.
    """
    model = model or train(labelled_pages(pages_to_learn))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in pages.schema.fields if f.name.lower() not in ("text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf, paths = shared.value, Paths()
        for part in slices(batches, "html"):
            texts = []
            for page in part.column(part.schema.get_field_index("html")).to_pylist():
                blocks = leaf_blocks(page or "", paths)
                labels = crf.viterbi(crf.page_emissions(blocks, paths))
                texts.append("\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label))
            if len(paths.tag) > 50_000:
                paths = Paths()
            yield pa.record_batch(
                [*(part.column(f.name) for f in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*(f.name for f in kept), "text", "n_chars"],
            )

    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*(f.name for f in kept)).mapInArrow(run, schema)
