"""Main text of web pages, by markup and by differencing with the page of the nearest URL.

A page becomes lines, one per block of text, each with a kind: ``BARE`` (no
container tells), ``MAIN`` (plain text of an article), ``ODD`` (in the article,
but a list of links or an element with a class of its own) and ``SHELL`` (menus,
headers, footers, sidebars, notices, adverts, forms and comments by element,
role or class). Scripts, styles and markup are no lines at all.

Pages are sorted by host and path. Each is paired with the nearest page of its
host that is no copy of it, and their lines are aligned by a longest common
subsequence. Aligned lines are the site's, not the page's, and are deleted,
except plain text of an article: pages quote the same passages. Shell lines only
hold the alignment in place. If a page has an article, bare lines outside go too.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches
from themewell.llm.prefix import with_running_sums
from themewell.session import cut

BARE, MAIN, ODD, SHELL = range(4)

BLOCK_PAGES = 256  # neighbours by URL that are compared in one task, at least
MAX_BLOCKS = 1 << 16  # blocks are told apart by their first keys, which all tasks hold: 16 MB at most
KEY_CHARS = 200
REACH = 2  # different pages on each side that may be the partner
RARE = 8  # times a line may stand in a page without being kept as a bit vector
COPY = 0.5  # a page that has more of the text which most neighbours have not is a copy

# Element names and class words that tell what a part of a page is for.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg object audio video canvas math".split())
_SHELL_TAGS = frozenset("head nav header footer aside form dialog menu button select fieldset".split())
_SHELL_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SHELL_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs comment comments consent
    cookie cookies copyright crumbs disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notices overlay pager pagination popup promo promotion promoted recommended related replies reply respond search share
    sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets""".split()
)
_STATE_WORDS = frozenset("has with without no is open enabled disabled".split())
_MAIN_CLASSES = frozenset(
    "articlebody article-body article-content article-text entry-content post-body post-content post-text story-body main-content page-content".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PLAIN = _HEADINGS | frozenset("p article main section div blockquote pre ul ol li dl dt dd figure figcaption table tbody thead tr td th hgroup body html".split())
_BLOCKS = _PLAIN | _SHELL_TAGS | frozenset("address caption center details hr legend optgroup option summary tfoot".split())
#: What an opening tag ends, if it is the innermost block.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: As in browsers, quotes count after an equals sign, and what is open at the end of the page is dropped.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>|\Z", re.I) for t in _RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)")


# ---- lines ------------------------------------------------------------------


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(raw):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(name.lower(), references.unescape(value))
    return found


def _says(classes: list[str]) -> bool:
    """Whether a class or id names a part that is not main text."""
    for name in classes:
        words = [w.lower() for w in _WORD.findall(name)]
        if not _STATE_WORDS.intersection(words) and not _SHELL_WORDS.isdisjoint(words):
            return True
    return False


class _Frame:
    """An open block: its tag, its kind, whether it is plain, and the open inline elements in it."""

    __slots__ = ("tag", "kind", "inline", "names")

    def __init__(self, tag: str, kind: int) -> None:
        self.tag, self.kind, self.inline, self.names = tag, kind, [], Counter()


def _kind(tag: str, raw: str, outer: int) -> int:
    """Kind of what stands in an element, given the kind around it."""
    if outer == SHELL:
        return SHELL
    found = _attributes(raw) if raw and not raw.isspace() else {}
    if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")):
        return SHELL
    classes = f"{found.get('class', '')} {found.get('id', '')}".split()
    role = found.get("role", "").lower()
    if tag in ("html", "body"):
        return outer
    if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop") == "articleBody":
        # An article may itself be a comment or an advert, but is not for being "with comments".
        return SHELL if tag == "article" and {c.lower() for c in classes} & _SHELL_WORDS else MAIN
    if tag == "header" and outer in (MAIN, ODD):
        return ODD
    if tag in _SHELL_TAGS or role in _SHELL_ROLES or _says(classes):
        return SHELL
    if outer == BARE:
        return MAIN if _MAIN_CLASSES.intersection(c.lower() for c in classes) else BARE
    return ODD if outer == ODD or tag not in _PLAIN or classes else outer


def lines_of(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in page order: references decoded, white space made one space, empty ones left out."""
    out: list[tuple[int, str]] = []
    if not html:
        return out
    frames = [_Frame("", BARE)]
    open_blocks: Counter = Counter()
    parts: list[str] = []
    linked = total = in_links = 0

    def flush() -> None:
        nonlocal linked, total
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            frame = frames[-1]
            kind = frame.inline[-1][1] if frame.inline else frame.kind
            if kind == ODD and any(f.tag in _HEADINGS for f in frames[-2:]):
                kind = MAIN  # a heading is text also in a header of the article
            elif kind == MAIN and 2 * linked > total and frame.tag not in _HEADINGS:
                kind = ODD
            out.append((kind, text))
        linked = total = 0

    def add(text: str) -> None:
        nonlocal linked, total
        if text:
            text = references.unescape(text) if "&" in text else text
            parts.append(text)
            total += len(text)
            linked += len(text) if in_links else 0

    def close(tag: str) -> None:
        while frames[-1].tag != tag:
            open_blocks[frames.pop().tag] -= 1
        frames.pop()
        open_blocks[tag] -= 1

    at, length = 0, len(html)
    while at < length:
        m = _TAG.search(html, at)
        if m is None:
            break
        add(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        ending, tag, raw = m[1], m[2].lower(), m[3]
        frame = frames[-1]
        if tag in _RAW:
            if not ending and not raw.endswith("/"):
                at = _RAW_END[tag].search(html, at).end()
            add(" ")
        elif tag == "br" or tag in ("td", "th"):
            add(" ")
        elif tag in _BLOCKS:
            if ending and not open_blocks[tag] and tag != "p":
                continue
            flush()
            in_links = 0
            if ending and open_blocks[tag]:
                close(tag)
            if ending or tag in _VOID:
                continue
            if frame.tag == "p" or (frame.tag == "head" and tag != "head"):
                close(frame.tag)
            for ended in _ENDS.get(tag, ()):
                if frames[-1].tag == ended:
                    close(ended)
            frames.append(_Frame(tag, _kind(tag, raw, frames[-1].inline[-1][1] if frames[-1].inline else frames[-1].kind)))
            open_blocks[tag] += 1
        elif tag in _VOID:
            continue
        elif not ending:
            outer = frame.inline[-1][1] if frame.inline else frame.kind
            kind = SHELL if _kind(tag, raw, outer) == SHELL else outer
            if kind != outer:
                flush()
            frame.inline.append((tag, kind))
            frame.names[tag] += 1
            in_links += tag == "a"
        elif frame.names[tag]:
            kind = frame.inline[-1][1]
            while True:
                name, _ = frame.inline.pop()
                frame.names[name] -= 1
                in_links = max(0, in_links - (name == "a"))
                if name == tag:
                    break
            if kind == SHELL != (frame.inline[-1][1] if frame.inline else frame.kind):
                frame.inline.append((tag, kind))  # what was read so far still is of the kind
                flush()
                frame.inline.pop()
    add(html[at:])
    flush()
    return out


# ---- longest common subsequence ---------------------------------------------


def _bits(places: list[int], n: int) -> int:
    """A number with the bits of ``places`` set."""
    if len(places) <= RARE:
        return sum(1 << j for j in places)
    flags = np.zeros(n, np.uint8)
    flags[places] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _prefix_lengths(a: list, b: list) -> np.ndarray:
    """Length of a longest common subsequence of ``a`` and each beginning of ``b``, all of ``b`` in one bit vector."""
    full = (1 << len(b)) - 1
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    # Only lines that stand often in b keep their bits, so these take RARE times less than all would.
    kept = {x: _bits(at, len(b)) for x, at in places.items() if len(at) > RARE}
    v = full
    for x in a:
        if x in places:
            u = v & (kept[x] if x in kept else _bits(places[x], len(b)))
            v = ((v + u) | (v - u)) & full
    raw = np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    zeros = 1 - np.unpackbits(raw, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate(([0], np.cumsum(zeros)))


def aligned(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``. Memory is linear in the lines."""
    both = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in both]
    right = [x for x in b if x in both]
    found: list[int] = []
    open_parts = [(left, right)]
    while open_parts:
        own, other = open_parts.pop()
        head = 0
        while head < min(len(own), len(other)) and a[own[head]] == other[head]:
            head += 1
        tail = 0
        while tail < min(len(own), len(other)) - head and a[own[-1 - tail]] == other[-1 - tail]:
            tail += 1
        found += own[:head] + own[len(own) - tail :]
        own, other = own[head : len(own) - tail], other[head : len(other) - tail]
        if not own or not other:
            continue
        if len(own) == 1:
            found += own if a[own[0]] in other else []
            continue
        half = len(own) // 2
        front = _prefix_lengths([a[i] for i in own[:half]], other)
        back = _prefix_lengths([a[i] for i in reversed(own[half:])], other[::-1])[::-1]
        cut_at = int(np.argmax(front + back))
        open_parts += [(own[:half], other[:cut_at]), (own[half:], other[cut_at:])]
    return sorted(found)


# ---- differencing -----------------------------------------------------------


@dataclass
class _Page:
    row: dict
    path: str
    kinds: list[int]
    lines: list[str]

    def __post_init__(self) -> None:
        self.hashes = [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in self.lines]
        self.own = Counter()  # characters of text that may be the page's own, by line
        for k, h, x in zip(self.kinds, self.hashes, self.lines, strict=True):
            if k != SHELL:
                self.own[h] += len(x)


def _partner(page: _Page, near: list[_Page]) -> _Page | None:
    """The nearest of some neighbours that is no copy: one that has most of what only few of them share with the page."""
    held = Counter(h for p in near for h in p.own)
    rare = Counter({h: n for h, n in page.own.items() if 2 * held[h] <= len(near)})
    for other in sorted(near, key=lambda p: -_closeness(page.path, p.path)):
        if sum(n for h, n in rare.items() if h in other.own) <= COPY * rare.total():
            return other
    return None


def _closeness(a: str, b: str) -> int:
    """Characters that two paths share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def main_text(page: _Page, near: list[_Page]) -> tuple[str, _Page | None, int]:
    """(text, partner, lines deleted) of a page among neighbours, the nearest first where paths are equally close."""
    partner = _partner(page, near)
    shared = set(aligned(page.hashes, partner.hashes)) if partner else set()
    whole = [(k, x, i in shared) for i, (k, x) in enumerate(zip(page.kinds, page.lines, strict=True))]
    has_article = any(k == MAIN for k, _, _ in whole)
    kept = [x for k, x, same in whole if k == MAIN or (not same and k == (ODD if has_article else BARE))]
    gone = sum(same and k in (BARE, ODD) for k, _, same in whole)
    return "\n\n".join(kept), partner, gone


def place_of(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL; without a host all of it is path."""
    m = _URL.match(url or "")
    return (m[1].lower(), m[2]) if m else ("", (url or "").split("?")[0].split("#")[0])


def _keys(pages: DataFrame) -> DataFrame:
    """(key): host, path and a hash that tells pages of one path apart, as one bounded string per page."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                yield batch_of(schema, {"key": [_key(*x) for x in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), strict=True)]})

        return run

    return map_batches(pages.select("page_id", "url"), make, "key string")


def _key(page_id: int | None, url: str | None) -> str:
    host, path = place_of(url)
    tie = xxhash.xxh64_hexdigest(f"{page_id} {url}".encode("utf-8", "surrogatepass"))
    return f"{host}\x01{path}"[:KEY_CHARS] + "\x01" + tie


def _first_keys(pages: DataFrame) -> list[str]:
    """First keys of the blocks, in order: every ``BLOCK_PAGES``-th key, or rarer if there would be over ``MAX_BLOCKS``."""
    ranked = with_running_sums(_keys(pages).withColumn("one", F.lit(1).cast("long")), ["key"], ["one"])
    ranked = cut(ranked.select("key", F.col("before_one").alias("rank")))
    step = max(BLOCK_PAGES, math.ceil(ranked.count() / MAX_BLOCKS))
    return sorted(r["key"] for r in ranked.where((F.col("rank") > 0) & (F.col("rank") % step == 0)).select("key").collect())


_LINES = "block int, host string, path string, tie string, page_id long, url string, kinds binary, lines array<string>"
_TEXTS = "page_id long, url string, text string, n_chars long, partner_id long, n_lines long, n_deleted long"


def _parsed(pages: DataFrame) -> DataFrame:
    first = np.array([k.encode("utf-8", "surrogatepass") for k in _first_keys(pages)], object)

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                columns: dict[str, list] = {f: [] for f in schema.names}
                ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
                for page_id, url, html in zip(ids, urls, batch.column("html"), strict=True):
                    lines = lines_of(html.as_py())
                    key = _key(page_id, url)
                    block = int(np.searchsorted(first, key.encode("utf-8", "surrogatepass"), "right"))
                    values = (block, *place_of(url), key[-16:], page_id, url, bytes(k for k, _ in lines), [x for _, x in lines])
                    for name, value in zip(schema.names, values, strict=True):
                        columns[name].append(value)
                yield batch_of(schema, columns)

        return run

    return map_batches(pages, make, _LINES)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, partner_id, n_lines, n_deleted), one row per row of ``pages`` (page_id, url, html).

    ``text`` is the main text, blocks joined by an empty line; ``partner_id`` the
    page it was compared with, ``n_lines`` all its lines and ``n_deleted`` those
    deleted for being aligned. The nearest ``REACH`` different pages on each side
    can be partners. A copy is told from a page of the same make by what most of
    these have not. A page has no partner if there are none, or only copies.

    A null or empty html has an empty text. Pages without URL, or with one that
    has no host, are neighbours of each other. Rows that repeat get equal texts:
    they are copies of each other and look for another partner. Order within a
    path goes by a hash of id and URL. Empty in, empty out; other columns are
    not read.
    """
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            window: list[_Page] = []  # pages of one host and block; the first ``done`` are finished
            done, at = 0, None

            def distinct(around: Iterator[_Page], page: _Page) -> list[_Page]:
                """The nearest pages that differ from ``page`` and each other."""
                found: list[_Page] = []
                for other in around:
                    if len(found) == REACH:
                        break
                    if other.hashes != page.hashes and all(other.hashes != x.hashes for x in found):
                        found.append(other)
                return found

            def finished(last: bool) -> Iterator[dict]:
                nonlocal done
                while done < len(window):
                    page = window[done]
                    right = distinct(iter(window[done + 1 :]), page)
                    if not last and len(right) < REACH:
                        return
                    left = distinct(reversed(window[:done]), page)
                    near = [p for pair in zip(left + [None] * REACH, right + [None] * REACH, strict=False) for p in pair if p]
                    text, partner, gone = main_text(page, near)
                    done += 1
                    yield {
                        "page_id": page.row["page_id"], "url": page.row["url"], "text": text, "n_chars": len(text),
                        "partner_id": partner and partner.row["page_id"], "n_lines": len(page.lines), "n_deleted": gone,
                    }
                    forget()

            def forget() -> None:
                """Drops finished pages that no later one can need: all before the last REACH + 1 different ones."""
                nonlocal done
                kept, seen = done, []
                while kept > 0 and len(seen) <= REACH:
                    kept -= 1
                    if window[kept].hashes in seen:
                        del window[kept]
                        done -= 1
                    else:
                        seen.append(window[kept].hashes)
                del window[:kept]
                done -= kept

            def table(rows: list[dict]) -> pa.RecordBatch:
                return batch_of(schema, {f: [r[f] for r in rows] for f in schema.names})

            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    here = (row["block"], row["host"])
                    if here != at:
                        rows += finished(True)
                        window, done, at = [], 0, here
                    window.append(_Page(row, row["path"], list(row.pop("kinds")), row.pop("lines")))
                    if len(window) < 2 or window[-1].hashes != window[-2].hashes:
                        rows += finished(False)
                yield table(rows)
            yield table(list(finished(True)))

        return run

    order = ["block", "host", "path", "tie"]
    dealt = _parsed(plain).repartition("block").sortWithinPartitions(*order)
    return map_batches(dealt, make, _TEXTS)
