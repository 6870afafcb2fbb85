"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: runs of text between block-level tags, each with
the tags, classes and ids above it. A block's vector holds its hashed tag path, its hashed
words and a few measures; a bidirectional LSTM in numpy reads the whole sequence, so each
block is judged in the context of the page. Blocks labelled as article are decoded, white
space becomes one space, and they are joined by line feeds in page order.

The labeller is trained on the driver on pages that ``layouts`` makes up: usual places of
menus, headers, footers, sidebars, notices, adverts, forms and comments around and inside
usual article containers, with arbitrary further class names. No page of the input is used,
so a page gets the same text whatever else the table holds. The weights (about 40,000
numbers) travel with the task.

Null, empty and tag-only pages have the empty text. Script, style and other unseen content
is no block; an unclosed one lasts to the end of the page. Between the start tag of a ``RAW``
element and its end tag nothing is markup. Rows are judged alone, repeated
rows get equal results, an empty table gives an empty one, columns not asked for by ``keep``
are ignored.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adweave.llm import textbatch as T

PATH, WORDS, MEASURES, HIDDEN = 256, 16, 5, 24
WIDTH = PATH + WORDS + MEASURES
PAGES, PAGE_BYTES = 400, 4_000_000  # pages read by the labeller at a time, and their bytes
PIECE = 1_000_000  # bytes of block text hashed at a time

# Fixed values of HTML: tags without content, tags inside a line, content that is not shown,
# and which open tags a start tag ends.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
             "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = set("script style noscript template svg iframe title textarea object head math canvas "
             "audio video select".split())
RAW = set("script style title textarea iframe".split())
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
        "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
        "option": {"option"}}
HOLDS = set("ul ol dl table div section article main aside nav header footer form body td th "
            "blockquote figure".split())
P_ENDS_AT = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
                "header hr main nav ol p pre section table ul figure".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Block:
    path: np.ndarray  # the sum of the vectors of all names on the way, shared by neighbours
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    for m in ATTRIBUTE.finditer(attributes) if "=" in attributes else ():
        value = (m[2] or m[3] or m[4] or "").lower()
        found += [f".{x}" for x in re.split(r"[^a-z]+", value) if x]
    return tuple(found)


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page with text, in order."""
    out: list[Block] = []
    stack: list[tuple[str, list[str], np.ndarray]] = []  # tag, names new on the way, path to it
    names: set[str] = set()
    opened: Counter[str] = Counter()
    now: Block | None = None
    hidden = ""
    at = 0
    endless: set[str] = set()  # elements without an end tag in the rest of the page

    def text(raw: str) -> None:
        nonlocal now
        if not raw:
            return
        if now is None:
            now = Block(stack[-1][2] if stack else _NOWHERE)
            out.append(now)
        decoded = html.unescape(raw) if "&" in raw else raw
        now.parts.append(decoded)
        if opened["a"]:
            now.linked += len(decoded)

    def enter(tag: str, attributes: str) -> None:
        new = [x for x in dict.fromkeys(_names(tag, attributes)) if x not in names]
        names.update(new)
        path = stack[-1][2] if stack else _NOWHERE
        stack.append((tag, new, sum((_sign(x) for x in new), path)))
        opened[tag] += 1

    def leave(k: int) -> None:
        for tag, new, _ in stack[k:]:
            names.difference_update(new)
            opened[tag] -= 1
        del stack[k:]

    while m := TOKEN.search(page, at):
        if not hidden:
            text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if tag in RAW and not m[1] and not m[3].endswith("/") and tag not in endless:
            end = RAW_END[tag].search(page, at)
            if end:
                at, now = end.end(), None
                continue
            endless.add(tag)
            if not hidden:
                at = len(page)
                break
        if not tag:
            continue
        if hidden:
            # a head without an end tag ends where the body starts
            if (m[1] and tag == hidden) or (hidden == "head" and tag == "body"):
                hidden = ""
            if not (tag == "body" and not m[1]):
                continue
        closed = m[3].endswith("/") if m[3] else False
        if tag == "br" or tag in VOID:
            if tag not in INLINE:
                now = None
            elif tag == "br":
                text(" ")
            continue
        if tag not in INLINE:
            now = None
        if not m[1]:
            if tag in UNSEEN:
                hidden = "" if closed else tag
                continue
            ends = ENDS.get(tag, set()) | ({"p"} if tag in P_ENDS_AT else set())
            while any(opened[x] for x in ends):
                k = next((i for i in range(len(stack) - 1, -1, -1)
                          if stack[i][0] in ends or stack[i][0] in HOLDS), -1)
                if k < 0 or stack[k][0] not in ends:
                    break
                leave(k)
            if not closed:
                enter(tag, m[3] or "")
        elif opened[tag]:
            leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
    if not hidden:
        text(page[at:])
    return [b for b in out if b.parts and "".join(b.parts).strip()]


@functools.cache
def _sign(name: str) -> np.ndarray:
    """A fixed vector of signs for a name of the tag path."""
    rng = np.random.default_rng(zlib.crc32(name.encode()))
    return rng.choice([-1.0, 1.0], PATH).astype(np.float32) / np.sqrt(PATH)


_NOWHERE = np.zeros(PATH, np.float32)


@functools.cache
def _path(names: tuple[str, ...]) -> np.ndarray:
    return sum((_sign(x) for x in dict.fromkeys(names)), _NOWHERE)


def _word_table() -> np.ndarray:
    return np.random.default_rng(5).choice([-1.0, 1.0], (1024, WORDS)).astype(np.float32)


def word_vectors(texts: list[str]) -> np.ndarray:
    """Mean hashed vector of the words of each text."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    table, parts = _word_table(), [np.zeros((0, WORDS), np.float32)]
    for p in T.pieces(iter([batch]), limit=PIECE):
        w = T.words(p, T.NOT_SPACE)
        h = T.Hashes(p.buf, fold=True).span(w.start, w.end)
        total = np.zeros((len(h) + 1, WORDS), np.float64)
        np.cumsum(table[(h % T.U64(1024)).astype(np.int64)], axis=0, out=total[1:])
        n = np.maximum(w.per_row, 1)[:, None]
        parts.append(((total[w.first[1:]] - total[w.first[:-1]]) / n).astype(np.float32))
    return np.concatenate(parts)


def vectors(paths: list[np.ndarray], texts: list[str], linked: list[int],
            place: np.ndarray) -> np.ndarray:
    size = np.array([len(t) for t in texts], np.float32)
    x = np.empty((len(texts), WIDTH), np.float32)
    for i, path in enumerate(paths):
        x[i, :PATH] = path
    x[:, PATH:PATH + WORDS] = word_vectors(texts)
    x[:, PATH + WORDS:] = np.stack([
        np.log1p(size) / 5, np.minimum(size, 200) / 200,
        np.array(linked, np.float32) / np.maximum(size, 1),
        np.array([t[-1:] in ".!?" for t in texts], np.float32), place], axis=1)
    return x


# The labeller. Both directions have their own weights: w (inputs and state -> 4 gates).

def start_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {}
    for d in "fb":
        w[f"w{d}"] = rng.normal(0, 1 / np.sqrt(WIDTH + HIDDEN), (WIDTH + HIDDEN, 4 * HIDDEN))
        w[f"c{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
    return w | {"out": rng.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _walk(w: np.ndarray, c: np.ndarray, x: np.ndarray, mask: np.ndarray,
          training: bool = False) -> tuple:
    """One direction over pages x blocks x WIDTH; masked blocks keep the state.

    Only training needs what every step has seen.
    """
    n, steps, _ = x.shape
    h = np.zeros((n, HIDDEN), x.dtype)
    s = np.zeros((n, HIDDEN), x.dtype)
    pre = x @ w[:WIDTH] + c
    seen, states = [], np.empty((n, steps, HIDDEN), x.dtype)
    for t in range(steps):
        z = pre[:, t] + h @ w[WIDTH:]
        i, f, o = (_sig(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        new = f * s + i * g
        m = mask[:, t, None]
        if training:
            seen.append((h, s, i, f, o, g, new, m))
        s = np.where(m, new, s)
        h = np.where(m, o * np.tanh(new), h)
        states[:, t] = h
    return states, seen


def _unwalk(w: np.ndarray, x: np.ndarray, seen: list, up: np.ndarray) -> tuple:
    """Gradients of one direction's weights from the gradient of its states."""
    n = x.shape[0]
    gw, gc = np.zeros_like(w), np.zeros(4 * HIDDEN, w.dtype)
    dh, ds = np.zeros((n, HIDDEN), w.dtype), np.zeros((n, HIDDEN), w.dtype)
    for t in range(len(seen) - 1, -1, -1):
        h, s, i, f, o, g, new, m = seen[t]
        dh = dh + up[:, t]
        th = np.tanh(new)
        dn = np.where(m, dh * o * (1 - th * th) + ds, 0)
        dz = np.concatenate([dn * g * i * (1 - i), dn * s * f * (1 - f),
                             np.where(m, dh * th * o * (1 - o), 0), dn * i * (1 - g * g)], axis=1)
        gw += np.concatenate([x[:, t], h], axis=1).T @ dz
        gc += dz.sum(axis=0)
        dh = np.where(m, 0, dh) + dz @ w[WIDTH:].T
        ds = np.where(m, dn * f, ds)
    return gw, gc


def label(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of article for every block of padded pages."""
    ahead, _ = _walk(w["wf"], w["cf"], x, mask)
    behind, _ = _walk(w["wb"], w["cb"], x[:, ::-1], mask[:, ::-1])
    return _sig(np.concatenate([ahead, behind[:, ::-1]], axis=2) @ w["out"] + w["bias"])


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
    ahead, seen_f = _walk(w["wf"], w["cf"], x, mask, True)
    behind, seen_b = _walk(w["wb"], w["cb"], x[:, ::-1], mask[:, ::-1], True)
    both = np.concatenate([ahead, behind[:, ::-1]], axis=2)
    d = (_sig(both @ w["out"] + w["bias"]) - y) * mask / float(mask.sum())
    up = d[..., None] * w["out"]
    gwf, gcf = _unwalk(w["wf"], x, seen_f, up[..., :HIDDEN])
    gwb, gcb = _unwalk(w["wb"], x[:, ::-1], seen_b, up[:, ::-1, HIDDEN:])
    return {"wf": gwf, "cf": gcf, "wb": gwb, "cb": gcb,
            "out": np.einsum("nt,nth->h", d, both), "bias": d.sum(keepdims=True).reshape(1)}


def pad(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = int(sizes.max()) if len(sizes) else 0
    mask = np.arange(steps) < sizes[:, None]
    out = np.zeros((len(sizes), steps, WIDTH), x.dtype)
    out[mask] = x
    return out, mask


@functools.cache
def train(pages: int = 2500, rounds: int = 12, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights after Adam over made-up pages; the same on every call."""
    from adweave.llm import layouts

    rng = np.random.default_rng(seed)
    made = [layouts.page(rng) for _ in range(pages)]
    made.sort(key=len)
    flat = [b for p in made for b in p]
    place = np.concatenate([np.linspace(0, 1, len(p)) for p in made])
    x = vectors([_path(b[0]) for b in flat], [b[1] for b in flat], [b[2] for b in flat], place)
    x = x.astype(np.float32)
    y = np.array([b[3] for b in flat], np.float32)
    cut = np.concatenate([[0], np.cumsum([len(p) for p in made])])
    w = {k: v.astype(np.float32) for k, v in start_weights(rng).items()}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step, size = 0, 50
    steps = rounds * -(-pages // size)
    for _ in range(rounds):
        for b in rng.permutation(range(0, pages, size)):
            sizes = np.diff(cut[b:b + size + 1])
            xs, mask = pad(x[cut[b]:cut[min(b + size, pages)]], sizes)
            ys = np.zeros(mask.shape, np.float32)
            ys[mask] = y[cut[b]:cut[min(b + size, pages)]]
            step += 1
            for k, g in _gradients(w, xs, mask, ys).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] = w[k] - 0.012 * (1.02 - step / steps) * (first[k] / (1 - 0.9**step)) \
                    / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return w


def main_texts(w: dict[str, np.ndarray], pages: list[str]) -> list[str]:
    found = [blocks(p) for p in pages]
    flat = [b for f in found for b in f]
    texts = [b.text() for b in flat]
    sizes = np.array([len(f) for f in found], np.int64)
    out = [""] * len(pages)
    if not flat:
        return out
    place = np.concatenate([np.linspace(0, 1, n) for n in sizes])
    x = vectors([b.path for b in flat], texts, [b.linked for b in flat], place)
    cut = np.concatenate([[0], np.cumsum(sizes)])
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    for rows in _budget(order, sizes):
        if len(rows) == 1:  # a page of its own is not copied
            xs, mask = x[None, cut[rows[0]]:cut[rows[0] + 1]], np.ones((1, sizes[rows[0]]), bool)
        else:
            take = np.concatenate([np.arange(cut[r], cut[r + 1]) for r in rows])
            xs, mask = pad(x[take], sizes[rows])
        for r, p, m in zip(rows, label(w, xs, mask), mask):
            keep = cut[r] + np.flatnonzero(p[m] >= 0.5)
            out[r] = "\n".join(texts[i] for i in keep)
    return out


def _budget(order: np.ndarray, sizes: np.ndarray, most: int = 40_000) -> Iterator[np.ndarray]:
    """Pages of like length, of at most ``most`` padded blocks together (or one page)."""
    group: list[int] = []
    for r in order:
        if group and (len(group) + 1) * sizes[r] > most:
            yield np.array(group)
            group = []
        group.append(int(r))
    if group:
        yield np.array(group)


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Pages of at most ``PAGE_BYTES`` together (or one page), ``PAGES`` at most."""
    size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy()
    first = total = 0
    for i, n in enumerate(size.tolist()):
        if i > first and (total + n > PAGE_BYTES or i - first == PAGES):
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if batch.num_rows:
        yield batch.slice(first)


def extract(pages: DataFrame, text: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, text and n_chars (its code points)."""
    keep = [c for c in (["page_id", "url"] if keep is None else keep) if c not in ("text", "n_chars")]
    slim = pages.select(*keep, F.col(text).alias("__html"))
    schema = ", ".join([f"`{n}` {t}" for n, t in slim.drop("__html").dtypes]
                       + ["text string", "n_chars bigint"])
    weights = {k: v.astype(np.float32) for k, v in train().items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, len(keep)):
                found = main_texts(weights, [x or "" for x in part.column(len(keep)).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                    keep + ["text", "n_chars"])

    return slim.mapInArrow(run, schema)
