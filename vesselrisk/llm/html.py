"""Main text of web pages: block structure and a suffix array per host, two votes on every block.

A page is cut into blocks. Blocks in menus, headers, footers, sidebars, forms, notices,
adverts, comments and the like (by element, role, class or id) are boilerplate. If a
page has an ``article`` or ``main`` element, the other blocks in it are its text in order.

Blocks of articles. All of them, of all pages with a host, go into the host's suffix array, with the suffixes
that begin a block. Equal suffixes of a host are folded first (least and greatest page), then Spark sorts them,
and common prefixes of neighbours show which blocks occur whole on distinct pages (pages with distinct article
texts). A block on at least ``MIN_PAGES`` of them and on at least one in ``SHARE`` of the host's is the host's. It goes
if markup or place agrees: a name with a boilerplate word beside others (``notice-of-death``) marks it weakly, or only
blocks of the host lie between it and the article's begin or end. So neither vote alone removes a block.
The suffixes that begin within a block are searched too. Each page's windows of ``RUN`` tokens are counted by the hash of their
tokens; a window whose hash is on too few pages of the host is on no more itself, so its suffix can have no part in a run of
the host. The others are folded, sorted and counted exactly, with the same two limits. Neighbouring ones join, and a
run of ``LONG`` tokens or more (``RUN`` of them distinct) goes if its block is marked weakly, or only blocks of the host lie between it and an end of the article.

Pages without an article are judged by their host's suffix array of all positions. The token streams of all blocks outside articles, of
all pages of such hosts, give suffixes of ``DEPTH`` tokens, which are folded and sorted alike; common prefixes of
neighbours show which runs of ``RUN`` tokens or more (or whole shorter blocks) occur on distinct
pages, with the same two limits. Neighbouring ones join to runs of any length, and a run goes if it
begins or ends its block or has ``LONG`` tokens, so a phrase within a sentence stays. Boilerplate blocks
go too, and the other tokens stay, each in its block.

A page of which less than one in ``OWN`` tokens would stay is a near copy of others rather than a frame around a text of its
own, and keeps all its blocks.

A host's suffixes are dealt by host and first tokens, sorted outside memory and read as a stream, so a
host may hold any share of the pages. The suffix rows are written once; pages meet their host's blocks by a digest of
host and html. What joins pages or suffix rows is broadcast while it has at most ``FEW_BLOCKS`` entries, in shuffled joins beyond (same rows).

Tags are found in one pass over a page, in time linear in its length, malformed or not.

Defined results: null or empty html gives an empty text; null and relative urls have no host, so their pages lose marked boilerplate only; equal copies of a page
are one page when distinct pages are counted; repeated rows each have a result; an empty table gives an empty one;
input columns called ``text`` or ``n_chars`` are replaced, all others may have any name.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from base64 import b64encode
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, with_columns
from .common import cut_lineage, shared_path

RUN = 6
DEPTH = 12
LONG = 12
MIN_PAGES = 3
SHARE = 2
OWN = 4
HEAD_CHARS = 64
BUCKETS = 1 << 16
BUFFER = 1 << 22  # hashes of windows that a task holds before it writes their counts
FEW_BLOCKS = 100_000
OUTPUTS = ["text", "n_chars"]
# Elements, and words of class, id and role, that mark boilerplate.
BOILER_TAGS = set("nav header footer aside form button select option textarea dialog menu head title noscript template svg iframe object canvas".split())
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar "
    "aside widget widgets related recommended recommendations share sharing social comment comments disqus replies respond pagination pager toolbar search "
    "legal copyright disclaimer complementary contentinfo form".split()
)
# Words that say what kind of box a name stands for, not what is in it.
BOX_WORDS = set(
    "area bar block body bottom box button buttons card container content desktop fixed footer global group header icon icons inline inner item items label left "
    "link links list main mobile outer page panel post posts article articles reader readers right row section site slot sticky stories story tag text title top "
    "unit user users view wrap wrapper".split()
)
IN_ARTICLE = {"header", "masthead"}  # inside an article these hold its title
MAIN_TAGS = {"article", "main"}
BLOCK_TAGS = set(
    "p div h1 h2 h3 h4 h5 h6 ul ol li table caption thead tbody tfoot tr td th section article main blockquote pre dl dt dd figure figcaption header footer nav "
    "aside form fieldset hr address details summary body html center menu dialog head title noscript template option".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS_BY_ITSELF = {"p", "li", "dt", "dd", "td", "th", "tr", "option"}
NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
TAG_STOP = re.compile("[>\"']")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style")}
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tags_of(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Markup as (begin, end, closing, name, attributes); comments, declarations, scripts and styles have no name.

    A tag ends at the first ``>`` outside quotes, or, if its quotes hide every one, at the first ``>``. A place where
    quotes led nowhere is remembered and each text between two quotes is crossed once more at most, so time is linear.
    """
    at, n, dead = 0, len(html), set()
    while (begin := html.find("<", at)) >= 0:
        if html.startswith("<!--", begin):
            stop = html.find("-->", begin + 4)
            at = n if stop < 0 else stop + 3
            yield begin, at, False, "", ""
            continue
        m = NAME.match(html, begin)
        if not m and not html.startswith(("<!", "<?"), begin):
            at = begin + 1
            continue
        first = html.find(">", m.end() if m else begin)
        if first < 0:  # nothing further can end; comments aside, the rest is text
            if (at := html.find("<!--", begin + 1)) < 0:
                return
            continue
        if not m:
            at = first + 1
            yield begin, at, False, "", ""
            continue
        tag = m[2].lower()
        if tag in RAW_END and not m[1]:
            over = RAW_END[tag].search(html, first + 1)
            at = over.end() if over else n
            yield begin, at, False, "", ""
            continue
        seen, i = [], m.end()
        while True:
            stop = TAG_STOP.search(html, i)
            i = stop.start() if stop else -1
            if i < 0 or html[i] == ">" or i in dead:
                break
            seen.append(i)
            i = html.find(html[i], i + 1) + 1
            if not i:
                break
        if i <= 0 or html[i] != ">":
            dead.update(seen)
            i = first
        at = i + 1
        yield begin, at, bool(m[1]), tag, html[m.end() : i]


def _mark(tag: str, attributes: str, in_article: bool) -> str:
    """``boiler``, ``weak`` (in an article, a name of other words too) or nothing."""
    if tag in MAIN_TAGS or tag in ("body", "html"):
        own: set[str] = set()
        if tag == "article" and attributes:
            own = {w.lower() for k, *v in ATTRIBUTE.findall(attributes) if k.lower() in ("class", "id") for w in WORD.findall("".join(v))}
        return "boiler" if own & {"comment", "comments", "ad", "advert", "promo", "sponsored"} else ""
    if tag in BOILER_TAGS and not (in_article and tag in IN_ARTICLE):
        return "boiler"
    if not attributes or not attributes.strip():
        return ""
    weak = ""
    marks = BOILER_WORDS - IN_ARTICLE if in_article else BOILER_WORDS
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            for one in value.split():
                words = {w.lower() for w in WORD.findall(one)}
                if words & marks:
                    if not in_article or all(w in marks or w in BOX_WORDS or len(w) == 1 for w in words):
                        return "boiler"
                    weak = "weak"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "boiler"
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "boiler"
    return weak


def blocks_of(html: str) -> tuple[bool, list[tuple[str, str]]]:
    """(has an article, blocks as (kind, text)); kinds: ``main``, ``weak`` (in articles), ``open`` (outside), ``boiler``."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, mark, within an article
    places: defaultdict[str, list[int]] = defaultdict(list)  # of each tag in the stack
    walls: list[int] = []  # places of article, main and body
    parts: list[str] = []
    has_main = False

    def state() -> tuple[str, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else ("", False)

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            mark, main = state()
            out.append((mark or ("main" if main else "open"), text))

    def cut(k: int) -> None:
        for tag, _, _ in stack[k:]:
            places[tag].pop()
        while walls and walls[-1] >= k:
            walls.pop()
        del stack[k:]

    at = 0
    for begin, end, closing, tag, attributes in tags_of(html):
        if begin > at:
            parts.append(html[at:begin])
        at = end
        if not tag:
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            k = places[tag][-1] if places[tag] else -1
            if k >= 0 and not (tag in ENDS_BY_ITSELF and walls and walls[-1] > k):
                if not block and (any(x[1] != stack[k][1] for x in stack[k:]) or stack[k][1] != (stack[k - 1][1] if k else "")):
                    flush()
                cut(k)
            continue
        if tag in VOID_TAGS or attributes.rstrip().endswith("/") and not block:
            continue
        if block and stack and stack[-1][0] in ("p", tag) and stack[-1][0] in ENDS_BY_ITSELF:
            cut(len(stack) - 1)
        mark, main = state()
        if mark != "boiler":
            mark = _mark(tag, attributes, main) or mark
        main = main or (tag in MAIN_TAGS and mark != "boiler")
        has_main = has_main or main
        if block or mark != state()[0]:
            if not block:
                flush()
            if tag in MAIN_TAGS or tag == "body":
                walls.append(len(stack))
            places[tag].append(len(stack))
            stack.append((tag, mark, main))
    parts.append(html[at:])
    flush()
    return has_main, out


def _article_blocks(html: str) -> list[tuple[str, str]] | None:
    """The (kind, text) of an article's blocks that markup leaves; none for a page without an article."""
    has_main, blocks = blocks_of(html)
    return [b for b in blocks if b[0] in ("main", "weak")] if has_main or not html else None


def _article(html: str, of_host: list[int] | None = None, covers: list[tuple[int, int]] | None = None) -> str | None:
    """An article's text; ``of_host`` names the blocks that its host repeats, ``covers`` the (block, token) where a window of the host's begins."""
    blocks = _article_blocks(html)
    if blocks is None:
        return None
    repeated, n = set(of_host or ()), len(blocks)
    runs: dict[int, list[tuple[int, int]]] = {}
    if covers:
        gone: dict[int, set[int]] = {}
        for block, at in covers:
            gone.setdefault(block, set()).update(range(at, at + RUN))
        runs = {i: _long_runs(found, blocks[i][1].split()) for i, found in gone.items() if i not in repeated}
        repeated.update(i for i, found in runs.items() if found == [(0, len(blocks[i][1].split()))])
    first = next((i for i in range(n) if i not in repeated), n)
    last = next((i for i in range(n - 1, -1, -1) if i not in repeated), -1)
    kept = []
    for i, (kind, t) in enumerate(blocks):
        if i in repeated:
            if first < i < last and kind != "weak":
                kept.append(t)
        elif runs.get(i):
            tokens = t.split()
            for a, b in reversed(runs[i]):
                if kind == "weak" or (a == 0 and i == first) or (b == len(tokens) and i == last):
                    del tokens[a:b]
            kept.append(" ".join(tokens))
        else:
            kept.append(t)
    if (repeated or runs) and OWN * sum(len(t.split()) for t in kept) < sum(len(t.split()) for _, t in blocks):
        kept = [t for _, t in blocks]
    return "\n".join(t for t in kept if t)


def _long_runs(gone: set[int], tokens: list[str]) -> list[tuple[int, int]]:
    """The runs [begin, end) of ``LONG`` tokens or more; of fewer than ``RUN`` distinct ones (a filled line) it is no passage."""
    at = sorted(gone)
    begins = [i for i, x in enumerate(at) if not i or at[i - 1] != x - 1]
    runs = [(at[i], at[j - 1] + 1) for i, j in zip(begins, [*begins[1:], len(at)])]
    return [(a, b) for a, b in runs if b - a >= LONG and len(set(tokens[a:b])) >= RUN]


def _page_id(blocks: list[tuple[str, str]]) -> int:
    """Equal articles are one page."""
    digest = hashlib.blake2b("\n".join(t for _, t in blocks).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


class _Windows:
    """All runs of ``RUN`` tokens within the blocks of some pages, each with the hash of its tokens (``bucket``)."""

    def __init__(self, pages: list[list[tuple[str, str]]]):
        self.words: list[str] = []
        where: list[tuple[int, int]] = []
        sizes: list[int] = []
        for page, blocks in enumerate(pages):
            for block, (_, text) in enumerate(blocks):
                tokens = text.split()
                self.words += tokens
                where.append((page, block))
                sizes.append(len(tokens))
        self.ends = np.cumsum(sizes, dtype=np.int64)  # of each block in ``words``
        of = np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64))
        n = max(0, len(of) - RUN + 1)
        self.begin = np.nonzero(of[:n] == of[RUN - 1 :])[0] if n else np.empty(0, np.int64)
        self.of = of[self.begin]  # a window's block among all
        words = pa.array(self.words, pa.large_string()).dictionary_encode()
        crc = np.array([zlib.crc32(w.encode()) for w in words.dictionary.to_pylist()], np.uint64)
        hashed = crc[words.indices.to_numpy()] if n else np.empty(0, np.uint64)
        mixed = np.zeros(len(self.begin), np.uint64)
        for i in range(RUN if n else 0):
            mixed = (mixed ^ hashed[self.begin + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        self.bucket = (mixed >> np.uint64(48)).astype(np.int64)
        self.page, self.block = (np.array([x[i] for x in where], np.int64)[self.of] for i in range(2))

    def at(self, i: np.ndarray) -> np.ndarray:
        """Places of windows in their blocks."""
        return self.begin[i] - np.concatenate(([0], self.ends))[self.of[i]]


def _pack_counts(buckets: list[np.ndarray]) -> bytes:
    count = np.bincount(np.concatenate(buckets), minlength=BUCKETS)
    some = np.nonzero(count)[0]
    return zlib.compress(np.diff(some, prepend=0).astype("<u2").tobytes() + count[some].astype("<u4").tobytes(), 1)


def _unpack_counts(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    n = len(raw) // 6
    count = np.zeros(BUCKETS, np.int64)
    count[np.cumsum(np.frombuffer(raw, "<u2", n), dtype=np.int64)] = np.frombuffer(raw, "<u4", n, 2 * n)
    return count


def _block_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(html, host, key) to the suffixes that begin a block of an article; a page without an article gives a row without a host.

    Rows with ``counts`` say for a host on how many pages the windows of each hash are; windows begin anywhere in a block.
    """
    types = {"host": pa.string(), "head": pa.string(), "page": pa.int64(), "key": pa.binary(), "block": pa.int32(), "counts": pa.binary()}
    held: defaultdict[str, list[np.ndarray]] = defaultdict(list)
    n_held = 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values())], names=list(types))

    for batch in batches:
        for piece, texts in slices(batch, "html", 1 << 20):
            rows: list[tuple] = []
            hosts, articles = [], []
            for html, host, key in zip(texts, piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                blocks = _article_blocks(html.decode())
                if blocks is None:
                    rows.append((None, None, None, key, None, None))
                elif host:
                    page = _page_id(blocks)
                    hosts.append(host)
                    articles.append(blocks)
                    for i, (_, text) in enumerate(blocks):
                        # Sorted by its first tokens; a digest stands for the rest, so that a head is a whole block.
                        rest = b64encode(hashlib.blake2b(text.encode(), digest_size=16).digest())[:22].decode()
                        rows.append((host, f"{' '.join(text[:HEAD_CHARS].split(' ')[:RUN])} \n{rest}", page, key, i, None))
            windows = _Windows(articles)
            distinct = np.unique(windows.page * BUCKETS + windows.bucket)
            ends = np.searchsorted(distinct, np.arange(len(hosts) + 1) * BUCKETS)
            for host, i, j in zip(hosts, ends, ends[1:]):
                if j > i:
                    held[host].append((distinct[i:j] % BUCKETS).astype(np.uint16))
            n_held += len(distinct)
            if n_held > BUFFER:
                rows += [(host, None, None, None, None, _pack_counts(found)) for host, found in held.items()]
                held.clear()
                n_held = 0
            yield batch_of(rows)
    yield batch_of([(host, None, None, None, None, _pack_counts(found)) for host, found in held.items()])


def _often(counts: pd.DataFrame) -> pd.DataFrame:
    """The hashes of windows that are on enough pages of their host (host, pages, counts); equal pages count more than once here, so none is missed."""
    count = sum(map(_unpack_counts, counts["counts"]))
    pages = int(counts["pages"].iloc[0])
    often = np.nonzero((count >= MIN_PAGES) & (count * SHARE >= pages))[0].astype("<u2")
    rows = [(counts["host"].iloc[0], often.tobytes())] if len(often) else []
    return pd.DataFrame(rows, columns=["host", "often"], dtype=object)


def _inner_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(html, host, key, often) to the suffixes anywhere in a block of an article whose first tokens have one of the hashes ``often``."""
    types = {"host": pa.string(), "head": pa.string(), "suffix": pa.string(), "page": pa.int64(), "key": pa.binary(), "block": pa.int32(), "at": pa.int32()}
    for batch in batches:
        for piece, texts in slices(batch, "html", 1 << 20):
            pages = []
            for html, *other in zip(texts, *(piece.column(i).to_pylist() for i in (1, 2, 3))):
                blocks = _article_blocks(html.decode())
                if blocks:
                    pages.append((blocks, *other))
            windows = _Windows([p[0] for p in pages])
            bounds = np.searchsorted(windows.page, np.arange(len(pages) + 1))
            rows: list[tuple] = []
            for (blocks, host, key, often), i, j in zip(pages, bounds, bounds[1:]):
                asked = np.zeros(BUCKETS, bool)
                asked[np.frombuffer(often, "<u2")] = True
                found = i + np.nonzero(asked[windows.bucket[i:j]])[0]
                page = _page_id(blocks)
                for begin, end, block, at in zip(*(c.tolist() for c in (windows.begin[found], windows.ends[windows.of[found]], windows.block[found], windows.at(found)))):
                    head = " ".join(windows.words[begin : begin + RUN])
                    rows.append((host, head, f"{head} {' '.join(windows.words[begin + RUN : min(begin + DEPTH, end)])}", page, key, block, at))
            cols = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values())], names=list(types))


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _streams(html: str) -> list[tuple[int, str, list[str]]]:
    """(block, kind, tokens) outside articles."""
    return [(i, kind, t.split()) for i, (kind, t) in enumerate(blocks_of(html)[1]) if kind in ("open", "boiler")]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(html, host, page, uid) to suffixes: (host, head, suffix, page, uid, block, at, n: tokens that a shared head covers)."""
    names = ["host", "head", "suffix", "page", "uid", "block", "at", "n"]
    for batch in batches:
        for piece, texts in slices(batch, "html", 1 << 20):
            rows: list[tuple] = []
            for html, host, page, uid in zip(texts, *(piece.column(i).to_pylist() for i in (1, 2, 3))):
                for block, _, tokens in _streams(html.decode()):
                    n = min(RUN, len(tokens))
                    for i in range(len(tokens) - n + 1):
                        tail = " ".join(tokens[i + n : i + DEPTH])
                        # A block of fewer than RUN tokens is a head of its own kind: it never is a prefix of a longer one.
                        head = " ".join(tokens[i : i + n]) + ("" if n == RUN else " \n")
                        rows.append((host, head, f"{head} {tail}", page, uid, block, i, n))
            cols = list(zip(*rows)) if rows else [[]] * len(names)
            types = [pa.string(), pa.string(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _shared_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct suffixes in order of (host, suffix) with least and greatest page, to the heads that distinct pages share.

    Neighbours whose common prefix reaches over the head are one run of the suffix array.
    """
    last: tuple[str, str] | None = None
    low = high = None
    before = ""
    for batch in batches:
        found: list[tuple[str, str]] = []
        for host, head, suffix, first, most in zip(*(batch.column(i).to_pylist() for i in range(5))):
            same = last is not None and last[0] == host and _common_prefix(before, suffix) >= len(head) and len(last[1]) == len(head)
            if not same:
                if last is not None and low != high:
                    found.append(last)
                last, low, high = (host, head), first, most
            else:
                low, high = min(low, first), max(high, most)
            before = suffix
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in range(2)], names=["host", "head"])
    if last is not None and low != high:
        yield pa.RecordBatch.from_arrays([pa.array([last[i]], pa.string()) for i in range(2)], names=["host", "head"])


def _common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _host_runs(n: int, gone: set[int]) -> set[int]:
    """The positions of ``gone`` in a block of ``n`` tokens that lie in runs at an end of the block or of ``LONG`` tokens."""
    out: set[int] = set()
    at = 0
    while at < n:
        if at in gone:
            end = at
            while end in gone:
                end += 1
            if at == 0 or end >= n or end - at >= LONG:
                out.update(range(at, end))
            at = end
        else:
            at += 1
    return out


def _unique_runs(html: str, covers: list[tuple[int, int, int]]) -> str:
    """The text of an open page without the covered runs."""
    gone: dict[int, set[int]] = {}
    for block, at, n in covers:
        gone.setdefault(block, set()).update(range(at, at + n))
    streams = [(block, tokens) for block, kind, tokens in _streams(html) if kind == "open"]
    runs = {block: _host_runs(len(tokens), gone.get(block, set())) for block, tokens in streams}
    total = sum(len(tokens) for _, tokens in streams)
    if OWN * (total - sum(map(len, runs.values()))) < total:
        runs = {}
    kept = [" ".join(t for i, t in enumerate(tokens) if i not in runs.get(block, ())) for block, tokens in streams]
    return "\n".join(t for t in kept if t)


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` (without the html) with ``text`` and ``n_chars``."""
    taken = {*OUTPUTS, html.lower()}
    keep = [c for c in pages.columns if c.lower() not in taken]
    page = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"))
    host = host_of(F.col(f"row.`{url}`"))
    html_of = F.col(f"row.`{html}`")
    source = page.select(
        F.struct(*[F.col(f"row.`{c}`").alias(c) for c in keep]).alias("row") if keep else F.lit(0).alias("row"),
        html_of.alias("html"), host.alias("host"), F.unhex(F.md5(F.concat(host, F.lit("\n"), F.coalesce(html_of, F.lit(""))))).alias("key"),
    )
    path = shared_path(pages.sparkSession, "page-blocks")
    columns = "host string, head string, page long, key binary, block int, counts binary"
    source.select("html", "host", "key").mapInArrow(_block_suffixes, columns).write.parquet(path)
    rows = pages.sparkSession.read.schema(columns).parquet(path)
    blocks = rows.where("head is not null")
    folded = blocks.groupBy("host", "head").agg(F.min("page").alias("first"), F.max("page").alias("most"))
    array = folded.sortWithinPartitions("host", "head").select("host", "head", F.col("head").alias("suffix"), "first", "most")
    shared = _of_host(array, blocks, blocks.select("host", "page"))
    on_pages = blocks.join(_small(shared), ["host", "head"], "left_semi").select("key", "block").distinct()
    on_pages = on_pages.select("key", "block", F.lit(None).cast("int").alias("at"))
    covers = _inner_covers(source, rows, blocks.select("host", "page"))
    if covers is not None:
        on_pages = on_pages.unionByName(covers)
    of_host = cut_lineage(on_pages.groupBy("key").agg(
        F.collect_set(F.when(F.col("at").isNull(), F.col("block"))).alias("blocks"),
        F.collect_set(F.when(F.col("at").isNotNull(), F.struct("block", "at"))).alias("covers")))
    few = of_host.agg(F.coalesce(F.sum(F.size("blocks") + F.size("covers") + 1), F.lit(0))).first()[0] <= FEW_BLOCKS
    judged = source.join(F.broadcast(of_host) if few else of_host, "key", "left")
    schema = T.StructType([source.schema["row"], T.StructField("text", T.StringType())])

    def articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, "html"):
                blocks, covers = (piece.column(piece.schema.get_field_index(c)).to_pylist() for c in ("blocks", "covers"))
                found = [_article(t.decode(), x, [(c["block"], c["at"]) for c in y or ()]) for t, x, y in zip(texts, blocks, covers)]
                yield with_columns(piece, ["row"], {"text": pa.array(found, pa.string())})

    done = judged.mapInArrow(articles, schema).where(F.col("text").isNotNull())
    if not rows.where("head is null and counts is null").isEmpty():
        done = done.unionByName(_judge_open(source, schema))
    kept = [F.col(f"row.`{c}`").alias(c) for c in keep]
    return done.select(*kept, "text", F.length("text").cast("long").alias("n_chars"))


def _inner_covers(source: DataFrame, rows: DataFrame, pages: DataFrame) -> DataFrame | None:
    """(key, block, at) where a window of tokens begins that enough distinct pages of the host share; none if there can be none."""
    sizes = pages.distinct().groupBy("host").agg(F.count("*").alias("pages"))
    counts = rows.where("counts is not null").select("host", "counts").join(sizes, "host")
    often = cut_lineage(counts.groupBy("host").applyInPandas(_often, "host string, often binary"))
    n, size = often.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("often") + 16), F.lit(0))).first()
    if not n:
        return None
    asked = source.select("html", "host", "key").join(F.broadcast(often) if size <= 100 * FEW_BLOCKS else often, "host").select("html", "host", "key", "often")
    columns = "host string, head string, suffix string, page long, key binary, block int, at int"
    path = shared_path(source.sparkSession, "page-windows")
    asked.mapInArrow(_inner_suffixes, columns).write.parquet(path)
    suffixes = source.sparkSession.read.schema(columns).parquet(path)
    distinct = suffixes.groupBy("host", "head", "suffix").agg(F.min("page").alias("first"), F.max("page").alias("most"))
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    array = distinct.repartition(parts, "host", "head").sortWithinPartitions("host", "head", "suffix")
    shared = _of_host(array, suffixes, pages)
    return suffixes.join(_small(shared), ["host", "head"], "left_semi").select("key", "block", "at").distinct()


def _small(heads: DataFrame) -> DataFrame:
    """Heads for a semi-join: in a broadcast while they have at most 100 bytes for each of ``FEW_BLOCKS``, measured first."""
    heads = cut_lineage(heads)
    size = heads.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("head") + 16), F.lit(0))).first()[0]
    return F.broadcast(heads) if size <= 100 * FEW_BLOCKS else heads


def _of_host(array: DataFrame, suffixes: DataFrame, pages: DataFrame) -> DataFrame:
    """(host, head) of the runs that enough distinct pages of their host share.

    ``array`` holds a host's distinct suffixes in order; ``pages`` names the (host, page) that are counted.
    """
    twice = array.mapInArrow(_shared_heads, "host string, head string")
    sizes = pages.distinct().groupBy("host").agg(F.count("*").alias("pages"))
    on = suffixes.select("host", "head", "page").join(_small(twice), ["host", "head"], "left_semi").distinct().groupBy("host", "head").agg(F.count("*").alias("on"))
    return on.join(sizes, "host").where((F.col("on") >= MIN_PAGES) & (F.col("on") * SHARE >= F.col("pages"))).select("host", "head")


def _judge_open(source: DataFrame, schema: T.StructType) -> DataFrame:
    """(row, text) of the pages without an article."""

    def left_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, "html"):
                yield piece.filter(pa.array([_article_blocks(t.decode()) is None for t in texts], pa.bool_()))

    opened = cut_lineage(source.mapInArrow(left_open, source.schema).withColumn("uid", F.monotonically_increasing_id()))
    page = F.xxhash64("html").alias("page")
    columns = "host string, head string, suffix string, page long, uid long, block long, at long, n long"
    hosts = opened.where("host != ''").select("host").distinct()
    streams = source.select("html", "host", page, F.lit(-1).cast("long").alias("uid")).join(hosts, "host", "left_semi")
    suffixes = streams.select("html", "host", "page", "uid").mapInArrow(_suffixes, columns)
    distinct = suffixes.groupBy("host", "head", "suffix").agg(F.min("page").alias("first"), F.max("page").alias("most"))
    n = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    array = distinct.repartition(n, "host", "head").sortWithinPartitions("host", "head", "suffix")
    shared = _of_host(array, suffixes, streams.select("host", "page"))
    own = opened.select("html", "host", page, "uid").mapInArrow(_suffixes, columns)
    covers = own.join(shared, ["host", "head"], "left_semi").groupBy("uid").agg(F.collect_list(F.struct("block", "at", "n")).alias("covers"))

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, "html"):
                covers = piece.column(piece.schema.get_field_index("covers")).to_pylist()
                found = [_unique_runs(t.decode(), [(c["block"], c["at"], c["n"]) for c in x or []]) for t, x in zip(texts, covers)]
                yield with_columns(piece, ["row"], {"text": pa.array(found, pa.string())})

    return opened.join(covers, "uid", "left").mapInArrow(text, schema)
