"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order. A bidirectional LSTM in numpy reads, for each block, hashed vectors of its
tag path and of its words and a few figures, and decides for every block with the whole page in view whether it belongs
to the article. The model is fitted on a bounded sample of pages whose blocks are labelled by what their mark-up says, and
on copies of them with boilerplate of other kinds put in.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 240
PATH_DIMS, WORD_DIMS, HIDDEN = 96, 8, 16
FIGURES = 3
INPUT = PATH_DIMS + WORD_DIMS + FIGURES
# Blocks of training sequences, and of the pages that are labelled side by side.
TRAIN_BLOCKS, BATCH_BLOCKS = 96, 1 << 15

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# Elements whose content is never text of the page: RAW ones hold no tags and end with their end tag only, the others
# are hidden between their tags.
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea")}
TITLE_END = re.compile(r"</title\s*>", re.I)
HIDDEN_TAGS = frozenset("noscript template svg iframe object canvas select button".split())
# Any other start tag ends the head.
HEAD_TAGS = frozenset("html head title base link meta script style noscript template".split())
# Quotes count behind "=" only; nothing is tried twice, so that a tag without end costs one pass.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)|=)*+)>|<[!?/][^>]*>", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")

# What mark-up calls things that are not the article. Fixed values, used for training labels only.
BOILERPLATE_TAGS = frozenset("nav header footer aside form dialog menu".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disqus footer form header login "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related replies "
    "search share sharing sidebar social sponsor sponsored subscribe subscription tags toolbar widget".split())
ARTICLE_TAGS = frozenset("article main".split())


@dataclass
class Block:
    """Text between two block-level tags. path: the open elements with their class, id and role names, outermost
    first; linked: characters inside links."""

    path: tuple[str, ...]
    text: str
    linked: int


@dataclass
class Tag:
    start: int
    end: int
    name: str
    closes: bool
    rest: str
    pair: int = -1  # of a hidden element: the number of its end tag


def _tags(page: str) -> list[Tag]:
    """The tags, comments and declarations (without name) of a page. Raw elements are one tag with their content;
    titles hold no tags. A start tag of a hidden element knows its end tag, if it has one."""
    tags: list[Tag] = []
    opened: dict[str, list[Tag]] = {}
    at, titles = 0, True
    while token := TOKEN.search(page, at):
        at = token.end()
        tag = Tag(token.start(), at, (token["tag"] or "").lower(), bool(token["close"]), token["rest"] or "")
        if tag.closes:
            if opened.get(tag.name):
                opened[tag.name].pop().pair = len(tags)
        elif not tag.rest.endswith("/"):
            if tag.name in RAW:
                end = RAW[tag.name].search(page, at)
                at = tag.end = end.end() if end else len(page)
            elif tag.name in HIDDEN_TAGS:
                opened.setdefault(tag.name, []).append(tag)
            elif tag.name == "title" and titles:
                end = TITLE_END.search(page, at)
                at, titles = (end.start(), True) if end else (at, False)
        tags.append(tag)
    return tags


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that hold text. Character references are decoded, white space inside a block is one
    space. Content of scripts, styles and the like, comments and the head are left out. Any text is accepted:
    tags that are never closed or never opened change the path only; a script, style or textarea without end reaches to
    the end of the page, a head to the first text or element that cannot stand in one."""
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = 0
    at = 0
    head = -1  # place of an open head on the stack

    def close():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append(Block(tuple(n for _, n in stack), text, linked))
        parts.clear()
        linked = 0

    def text(raw: str):
        nonlocal linked, head
        if head >= 0:
            if not raw.strip() or stack[-1][0] == "title":
                return
            del stack[head:]
            head = -1
        if raw:
            decoded = references.unescape(raw)
            parts.append(decoded)
            if any(tag == "a" for tag, _ in stack):
                linked += len(decoded)

    tags = _tags(page)
    number = 0
    while number < len(tags):
        token, tag = tags[number], tags[number].name
        text(page[at : token.start])
        at = token.end
        number += 1
        if not tag:
            continue
        opens = not token.closes and not token.rest.endswith("/")
        if opens and (tag in RAW or token.pair >= 0):
            if tag not in ("select", "button", "textarea"):
                close()
            if token.pair >= 0:
                at, number = tags[token.pair].end, token.pair + 1
            continue
        if head >= 0 and not token.closes and tag not in HEAD_TAGS:
            del stack[head:]
            head = -1
        block = tag not in INLINE
        if block:
            close()
        if token.closes:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    head = head if head < k else -1
                    break
        elif tag not in VOID and opens:
            if tag == "head" and head < 0:
                head = len(stack)
            if tag in CLOSES_P or tag == "li":
                wanted = "li" if tag == "li" else "p"
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == wanted:
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE:
                        break
            names = " ".join(a or b or c for a, b, c in NAMES.findall(token.rest)).lower() if token.rest else ""
            stack.append((tag, f"{tag} {names}" if names else tag))
    text(page[at:])
    close()
    return found


class _Slots(dict):
    """Name -> one of ``width`` slots; a bounded memory of hashes."""

    def __init__(self, width: int):
        super().__init__()
        self.width = width

    def __missing__(self, name: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[name] = slot = zlib.crc32(name.encode("utf-8", "replace")) % self.width
        return slot


_path_slots, _word_slots = _Slots(PATH_DIMS), _Slots(WORD_DIMS)
_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed tags and name parts of a path; tags and names have slots of their own."""
    vector = _paths.get(path)
    if vector is None:
        if len(_paths) > 1 << 14:
            _paths.clear()
        vector = np.zeros(PATH_DIMS, np.float32)
        for element in path:
            tag, _, names = element.partition(" ")
            vector[_path_slots[f"<{tag}"]] += 1
            for part in WORD.findall(names):
                vector[_path_slots[f".{part}"]] += 1
        _paths[path] = vector = np.minimum(vector, 2)
    return vector


def features(found: list[Block]) -> np.ndarray:
    """(block, INPUT): path vector, word vector of unit length, length, share of linked text, few words."""
    out = np.zeros((len(found), INPUT), np.float32)
    for i, block in enumerate(found):
        out[i, :PATH_DIMS] = _path_vector(block.path)
        words = block.text.lower().split()
        counts = np.bincount(np.fromiter(map(_word_slots.__getitem__, words), np.int64, len(words)), minlength=WORD_DIMS)
        out[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = counts / np.sqrt((counts * counts).sum())
        out[i, -FIGURES:] = np.log1p(len(block.text)) / 8, block.linked / len(block.text), 1 / (1 + len(words))
    return out


class Labeller:
    """Bidirectional LSTM with one output. Sequences are (time, batch, ...) and padded behind their ends."""

    def __init__(self, seed: int = 4):
        rng = np.random.default_rng(seed)
        self.p = {}
        for side in "fb":
            self.p[f"x{side}"] = rng.normal(0, 0.1, (INPUT, 4 * HIDDEN)).astype(np.float32)
            self.p[f"h{side}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # forget gates start open
            self.p[f"c{side}"] = bias
        self.p["o"] = rng.normal(0, 0.2, 2 * HIDDEN + INPUT).astype(np.float32)
        self.p["ob"] = np.zeros(1, np.float32)

    @staticmethod
    def _gates(z: np.ndarray) -> tuple[np.ndarray, ...]:
        s = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
        return s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        steps, batch, _ = x.shape
        inputs = x.reshape(-1, INPUT) @ self.p[f"x{side}"] + self.p[f"c{side}"]
        inputs = inputs.reshape(steps, batch, -1)
        h = c = np.zeros((batch, HIDDEN), np.float32)
        out = np.zeros((steps, batch, HIDDEN), np.float32)
        saved = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            i, f, o, g = self._gates(inputs[t] + h @ self.p[f"h{side}"])
            m = mask[t][:, None]
            new = f * c + i * g
            now = np.tanh(new)
            if keep:
                saved.append((t, i, f, o, g, c, now, h))
            c = np.where(m, new, c)
            h = np.where(m, o * now, h)
            out[t] = h
        return out, saved

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, saved_f = self._run(x, mask, "f", keep)
        b, saved_b = self._run(x, mask, "b", keep)
        joined = np.concatenate((f, b, x), axis=2)
        return joined @ self.p["o"] + self.p["ob"], joined, saved_f, saved_b

    def step(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of the mean cross-entropy over blocks."""
        score, joined, saved_f, saved_b = self.forward(x, mask, keep=True)
        p = 1 / (1 + np.exp(-score))
        n = mask.sum()
        d = np.where(mask, p - y, 0) / n
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["o"] = (joined * d[:, :, None]).sum(axis=(0, 1))
        grad["ob"] = np.array([d.sum()], np.float32)
        for side, saved, part in (("f", saved_f, 0), ("b", saved_b, HIDDEN)):
            outer = d[:, :, None] * self.p["o"][part : part + HIDDEN]
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, i, f, o, g, c, now, h in reversed(saved):
                m = mask[t][:, None]
                dh = dh + outer[t]
                dh_in, dc_in = np.where(m, dh, 0), np.where(m, dc, 0)
                dn = dc_in + dh_in * o * (1 - now * now)
                dz = np.concatenate((dn * g * i * (1 - i), dn * c * f * (1 - f), dh_in * now * o * (1 - o), dn * i * (1 - g * g)), axis=1)
                grad[f"x{side}"] += x[t].T @ dz
                grad[f"h{side}"] += h.T @ dz
                grad[f"c{side}"] += dz.sum(axis=0)
                dh = np.where(m, dz @ self.p[f"h{side}"].T, dh)
                dc = np.where(m, dn * f, dc)
        loss = -np.where(mask, y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9), 0).sum() / n
        return float(loss), grad

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page belongs to the article."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            # Pages of like length side by side, and no more of them than the batch may hold.
            longest, count = len(pages[order[-1]]), 1
            count = max(1, min(len(order), BATCH_BLOCKS // longest))
            part, order = order[-count:], order[:-count]
            x, mask = _padded([pages[k] for k in part])
            score = self.forward(x, mask)[0]
            for column, k in enumerate(part):
                out[k] = score[: len(pages[k]), column] > 0
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        mask[: len(p), k] = True
    return x, mask


def markup_label(path: tuple[str, ...], has_article: bool) -> bool:
    """Training label of a block: inside the article element if the page has one, and in nothing named as
    boilerplate."""
    tags = [e.partition(" ")[0] for e in path]
    names = {w for e in path for w in WORD.findall(e.partition(" ")[2])}
    inside = not has_article or any(t in ARTICLE_TAGS for t in tags)
    start = next((k for k, t in enumerate(tags) if t in ARTICLE_TAGS), 0)
    # A header inside the article is the article's own.
    bad = any(t in BOILERPLATE_TAGS and not (t == "header" and k > start and has_article) for k, t in enumerate(tags))
    return inside and not bad and not names & BOILERPLATE_NAMES


def _varied(found: list[Block], rng: np.random.Generator, texts: list[str]) -> list[Block]:
    """A page with boilerplate put in at random places, beside and inside the article, and at times with other
    containers around its article."""
    out = list(found)
    container = rng.choice(["article", "main", "div content", "div post body", "section entry", "div story text"])
    if rng.random() < 0.5:
        out = [Block(tuple(container if e.partition(" ")[0] == "article" else e for e in b.path), b.text, b.linked) for b in out]
    # What a block says is weak evidence: articles have short and repeated blocks too.
    mixed, said = rng.random(len(out)) < rng.choice([0.0, 0.3, 0.8]), str(rng.choice(texts))
    out = [Block(b.path, said if rng.random() < 0.5 else str(rng.choice(texts)), b.linked and 1) if m else b for b, m in zip(out, mixed, strict=True)]
    names, tags = sorted(BOILERPLATE_NAMES), sorted(BOILERPLATE_TAGS)
    for _ in range(rng.integers(1, 5)):
        where = int(rng.integers(0, len(out) + 1))
        around = out[min(where, len(out) - 1)].path if out else ("html", "body")
        around = around[: int(rng.integers(1, len(around) + 1))] if around else ()
        element = str(rng.choice(tags)) if rng.random() < 0.4 else f"{rng.choice(['div', 'section', 'ul', 'p', 'span'])} {rng.choice(names)}"
        leaf = rng.choice(["", "p", "li", "h3", "div"])
        path = (*around, element, leaf) if leaf else (*around, element)
        new = []
        for _ in range(rng.integers(1, 5)):
            text = str(rng.choice(texts))
            new.append(Block(path, text, len(text) if rng.random() < 0.3 else 0))
        out[where:where] = new
    return out


ARTICLE_NAMES = frozenset("content post body entry story text".split())


def _labels(found: list[Block]) -> np.ndarray:
    is_article = lambda e: e.partition(" ")[0] in ARTICLE_TAGS or bool(set(WORD.findall(e.partition(" ")[2])) & ARTICLE_NAMES)
    renamed = [tuple("article" if is_article(e) else e for e in b.path) for b in found]
    has = any("article" in path for path in renamed)
    return np.array([markup_label(path, has) for path in renamed], np.float32)


def fit(pages: list[str], *, rounds: int = 16, batch: int = 32, rate: float = 0.01, seed: int = 4) -> Labeller:
    """Adam on the sample and on varied copies of it."""
    model = Labeller(seed)
    rng = np.random.default_rng(seed)
    parsed = [b for b in (blocks(p) for p in pages) if b]
    if not parsed:
        return model
    texts = [b.text[:200] for page in parsed[:64] for b in page]
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    count = 0
    for _ in range(rounds):
        for start in range(0, len(parsed), batch):
            chosen = [page if rng.random() < 0.4 else _varied(page, rng, texts) for page in (parsed[k] for k in rng.permutation(len(parsed))[:batch])]
            windows = []
            for page in chosen:
                first = int(rng.integers(0, max(1, len(page) - TRAIN_BLOCKS + 1)))
                windows.append((features(page[first : first + TRAIN_BLOCKS]), _labels(page)[first : first + TRAIN_BLOCKS]))
            x, mask = _padded([w[0] for w in windows])
            y = np.zeros(mask.shape, np.float32)
            for k, (_, label) in enumerate(windows):
                y[: len(label), k] = label
            _, grad = model.step(x, mask, y)
            count += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.p[k] = (model.p[k] - rate * (m[k] / (1 - 0.9**count)) / (np.sqrt(v[k] / (1 - 0.999**count)) + 1e-8)).astype(np.float32)
    return model


def train(pages: DataFrame, *, html_col: str = "html", sample: int = SAMPLE) -> Labeller:
    """The labeller from at most ``sample`` pages, those with the smallest hashes, copies once; null pages are left out.
    The hashes are picked first, so that no more than the sample is sent to the driver."""
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("at"))
    last = rows.select("at").distinct().orderBy("at").limit(sample).agg(F.max("at")).first()[0]
    if last is None:
        return fit([])
    picked = rows.filter(F.col("at") <= last).groupBy("at").agg(F.first("html").alias("html"))
    return fit([r.html for r in sorted(picked.collect())])


def extract(pages: DataFrame, model: Labeller, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row: the blocks that the model takes for the article, in page order, joined
    by one space.

    A null or empty page, or one without article text, gives an empty text. Repeated rows each give a row; null
    ids and URLs are kept; other columns are not read; an empty table gives an empty table. Pages are read whole;
    memory follows the longest page.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                parsed = [blocks(page) for page in batch.column(2).to_pylist()]
                chosen = labeller.label([features(p) for p in parsed])
                texts = [" ".join(b.text for b, yes in zip(p, c, strict=True) if yes) for p, c in zip(parsed, chosen, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["_id", "_url", "text", "n_chars"])

    id_type = rows.schema["_id"].dataType.simpleString()
    url_type = rows.schema["_url"].dataType.simpleString()
    out = rows.mapInArrow(run, f"_id {id_type}, _url {url_type}, text string, n_chars bigint")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
