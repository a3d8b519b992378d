"""Main text of web pages by page structure and a suffix array over each host.

A page is read into blocks of text (paragraphs, headings, list items, cells, ...),
each with a part of the page: *main* (within ``article`` or ``main``), *furniture*
(within what the page itself marks as menu, header, footer, sidebar, notice,
advert, form, comments, ..., by element, role, class or id), *doubtful* (within the
main part, but of a class like ``post-header`` or ``share-price`` that may mean
either) or *open*, where the page has no main part and says nothing.  All blocks of
all pages go through the suffix array; furniture is dropped, and repetition decides
the others:

* the words of all of a page's blocks, in page order and cut where the main part begins
  or ends, are its token stream; a host's streams are concatenated;
* the suffix array: suffixes (by their first ``DEPTH`` tokens, equal ones as one row
  a task with the number of pages) are sorted by host and tokens in range partitions,
  and the common prefix of each with its neighbour is measured;
* neighbours that share ``SHARED`` tokens or more form an interval; one that ``PAGES``
  or more distinct pages of the host reach is a repeated substring, and overlapping
  ones join up to the longest.  An interval cut by the border of a partition comes as
  parts, which one aggregation of its parts' page counts joins;
* a doubtful or open block of which repeated substrings cover more than half is
  boilerplate and dropped, the others are unique runs and kept whole;
* a main block is boilerplate if substrings that more than half of the host's pages, and
  ``MAIN_PAGES`` at least, have cover more than half of it, and if such blocks are the
  lesser part of the article: an article that is copied as a whole, or of a host with few
  pages, stays whole;
* an unmarked page keeps its longest run of blocks that are repeated alike, if no more
  than half of the host's pages have it (a copied article), or if it has no other text.

Suffixes that can't be in an interval are not sorted.  Each suffix has a slot, a hash of
its host and first ``SHARED`` tokens; the slots of all suffixes are counted, as packed
arrays a range of slots, and those in slots of fewer than ``PAGES`` suffixes stay out.
None that is repeated is lost, whatever shares its slot.

Streams are written once, packed a few MB of text to a row; texts never are: pages
are read again for the result, where the blocks to drop come by a hash of host and
html.  Pages of one html and host count as one.

Defined results: null and empty html give an empty text; character references are
decoded, white space within a block becomes one space, empty blocks vanish, and
blocks are joined by a newline in page order; repeated rows and ids are treated alike;
null or odd urls share one empty host; other columns are ignored.
"""
from __future__ import annotations

import html as html_lib
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import chunks, discard, mix, scratch_table, ship, string_buffers, tidy, word_hashes
from emporium.llm.suffix_tree import _freeing
from emporium.llm.url_filter import host_of

SHARED = 5  # tokens that a repeated substring has at least
DEPTH = 8  # tokens by which suffixes are sorted
PAGES = 3  # distinct pages of the host that have it: two may be a copy
MAIN_PAGES = 6  # distinct pages that say more than a page's own mark of its article
TOKEN = np.dtype(">u4")  # big-endian, so that binaries sort as sequences of tokens
CHUNK_CHARS = 1 << 23  # characters of text whose pages are packed in one row, unless one page has more
SLOT_BITS = 24  # of a range of slots, which holds about a million suffixes
SLICES = 2  # shares of the streams that are joined with what is known of their suffixes, one at a time

MAIN, DOUBTFUL, OPEN, FURNITURE = "main", "doubtful", "open", "furniture"
_KINDS = {MAIN: 0, DOUBTFUL: 1, OPEN: 2, FURNITURE: 3}
_FACTORS = mix(np.arange(1, DEPTH + 1, dtype=np.uint64)) | np.uint64(1)

# Element names and words in class, id and role attributes.
_RAW = {"script", "style", "template", "textarea", "title", "iframe", "object", "svg", "math", "noscript",
        "xmp", "noembed", "noframes"}
_BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog",
           "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2",
           "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
           "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
         "wbr"}
_FURNITURE_TAGS = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "button", "select",
                   "fieldset", "search", "datalist"}
_FURNITURE_WORDS = {"ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "banner", "breadcrumb",
                    "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie",
                    "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar",
                    "navigation", "newsletter", "notice", "notification", "overlay", "pager", "pagination", "popup",
                    "promo", "promoted", "recommended", "related", "respond", "share", "sharing", "sidebar", "signup",
                    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# Those that mark furniture beside any other word; the others may belong to it ("share-price").
_STRONG_WORDS = {"ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "breadcrumb", "breadcrumbs",
                 "comment", "comments", "consent", "cookie", "cookies", "disqus", "menu", "modal", "nav", "navbar",
                 "navigation", "newsletter", "pager", "pagination", "popup", "sidebar", "signup", "sponsor",
                 "sponsored", "subscribe"}
# Words that say nothing of their own beside a furniture word ("site-header", "share-buttons").
_FILLERS = {"area", "bar", "block", "bottom", "box", "buttons", "container", "global", "icons", "inner", "left",
            "links", "list", "main", "page", "posts", "primary", "right", "secondary", "section", "site", "sticky",
            "tools", "top", "widgets", "wrapper"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_MAIN_TAGS = {"article", "main"}
_MAIN_WORDS = {"main", "article", "articlebody"}  # of role and itemprop

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
                        re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _mark(name: str, value: str) -> str | None:
    """FURNITURE or DOUBTFUL if a class, id or role says so."""
    found = None
    for label in value.lower().strip("\"'").split():
        words = set(_SPLIT.split(label)) - {""}
        if not words & _FURNITURE_WORDS:
            continue
        plain = not (words - _FURNITURE_WORDS - _FILLERS) and name not in _HEADINGS
        if plain or words & _STRONG_WORDS:
            return FURNITURE
        found = DOUBTFUL
    return found


def _part_of(name: str, attributes: str, parent: str) -> str:
    """The part of the page that an element begins."""
    if parent == FURNITURE:
        return FURNITURE
    in_main = parent in (MAIN, DOUBTFUL)
    if name in _FURNITURE_TAGS and not (name == "header" and in_main):
        return FURNITURE
    main, doubt = name in _MAIN_TAGS, False
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, words = key.lower(), set(_SPLIT.split(value.lower()))
            if key == "hidden" or (key == "aria-hidden" and "true" in words):
                return FURNITURE
            if key == "style":
                if "display:none" in value.lower().replace(" ", ""):
                    return FURNITURE
            elif key == "itemprop":
                main |= bool(words & _MAIN_WORDS)
            else:
                mark = _mark(name, value) if name not in ("html", "body", "main", "h1") else None
                if mark == FURNITURE:
                    return FURNITURE
                doubt |= mark == DOUBTFUL
                main |= key == "role" and bool(words & _MAIN_WORDS)
    if main:
        return MAIN
    return DOUBTFUL if doubt and in_main else parent


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(part, text) of every block that holds text, in page order."""
    found: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and their parts
    part, begun, buffer = OPEN, OPEN, []

    def flush() -> None:
        if buffer:
            text = " ".join(html_lib.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                found.append((begun, text))

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        text = page[at:m.start() if m else size]
        if text:
            if not buffer:
                begun = part
            if part == begun or begun == FURNITURE:
                buffer.append(text)  # marked words within a line are left out of it
        if m is None:
            break
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        name = name.lower()
        closing = bool(m.group(1) or m.group(4))
        if name in _RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name == "br":
            buffer.append(" ")
            continue
        block = name in _BLOCKS
        if block:
            flush()
        if name in _VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if not block and stack[i][0] in _BLOCKS:
                    break  # an inline end tag doesn't end a block
        else:
            if block and stack and stack[-1][0] == "p":
                stack.pop()  # a block ends a paragraph
            if name == "body":
                stack = [x for x in stack if x[0] == "html"]
            parent = stack[-1][1] if stack else OPEN
            attributes = m.group(3) or m.group(6) or ""
            own = _part_of(name, attributes, parent)
            if own == DOUBTFUL and not block:
                own = parent  # words within a line are part of it
            if block or own != parent:
                stack.append((name, own))
            elif name in ("span", "a", "b", "i", "em", "strong", "font", "u"):
                continue
        part = stack[-1][1] if stack else OPEN
    flush()
    if any(p == MAIN for p, _ in found):  # what is outside the article isn't the article
        found = [(FURNITURE if p == OPEN else p, t) for p, t in found]
    return found


def _packed(x: np.ndarray) -> bytes:
    """Numbers below 2^32, bytes of one weight beside each other, Huffman coded."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    planes = x.astype("<u4").view(np.uint8).reshape(-1, 4).T[:width].tobytes()
    z = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
    return bytes([width]) + z.compress(planes) + z.flush()


def _unpacked(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(x[1:], -15), np.uint8).reshape(x[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, :x[0]] = planes.T
    return out.view("<u4").reshape(-1)


def _names(tokens: np.ndarray, hosts: np.ndarray) -> np.ndarray:
    """64-bit hashes of a host and a row of tokens, zeros at its end left out."""
    name = np.zeros(len(tokens), np.uint64)
    for j in range(tokens.shape[1]):
        token = tokens[:, j].astype(np.uint64)
        name += np.where(token > 0, mix(token), np.uint64(0)) * _FACTORS[j]
    return mix(name ^ mix(hosts.view(np.uint64)))


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of tokens as one binary."""
    width, n = rows.shape[1] * TOKEN.itemsize, len(rows)
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets),
                                                  pa.py_buffer(rows.astype(TOKEN).tobytes())])


class Chunk:
    """The pages of one row of ``_parsed``, as arrays."""

    def __init__(self, row: dict):
        self.keys = np.frombuffer(row["keys"], np.int64).reshape(-1, 2)
        self.hosts = np.frombuffer(row["hosts"], np.int64)
        self.blocks = _unpacked(row["blocks"]).astype(np.int64)  # of each page
        self.kinds = _unpacked(row["kinds"])  # of each block
        self.sizes = _unpacked(row["sizes"]).astype(np.int64)  # tokens of each block
        self.twins = np.zeros(len(self.hosts), bool)  # pages that an earlier one equals
        self.twins[row["twins"] or []] = True
        self._words, self._ids = np.cumsum(_unpacked(row["words"]), dtype=np.uint32), _unpacked(row["ids"])

    def suffixes(self) -> None:
        """Find ``at``, ``page``, ``end``, ``main`` and ``name`` of every suffix.

        Suffixes shorter than ``SHARED`` are left out, unless they are their whole run.
        """
        n = len(self._ids)
        page = np.repeat(np.arange(len(self.blocks)), self.blocks)
        main = self.kinds == _KINDS[MAIN]
        fresh = np.ones(len(page), bool)
        fresh[1:] = (page[1:] != page[:-1]) | (main[1:] != main[:-1])
        run = np.cumsum(fresh) - 1
        length = np.bincount(run, weights=self.sizes).astype(np.int64)
        end = np.repeat(np.cumsum(length), length)
        first = np.zeros(n + 1, bool)
        first[np.cumsum(length) - length] = True
        page, main = np.repeat(page, self.sizes), np.repeat(main, self.sizes)
        at = np.flatnonzero(((end - np.arange(n) >= SHARED) | first[:n]) & ~self.twins[page])
        self.at, self.page, self.end, self.main = at, page[at], end[at], main[at]
        self.tokens = np.concatenate([self._words[self._ids], np.zeros(DEPTH, np.uint32)])
        hashed = np.concatenate([mix(self._words.astype(np.uint64))[self._ids], np.zeros(SHARED, np.uint64)])
        name = np.zeros(n, np.uint64)
        for j in range(SHARED):
            name += hashed[j:n + j] * _FACTORS[j]
        self.name = mix(name[at] ^ mix(self.hosts.view(np.uint64))[self.page])
        short = np.flatnonzero(self.end - at < SHARED)
        self.name[short] = _names(self.heads(short)[:, :SHARED], self.hosts[self.page[short]])

    def undecided(self) -> np.ndarray:
        """Which pages have blocks of which they don't say what they are."""
        page = np.repeat(np.arange(len(self.blocks)), self.blocks)
        return np.bincount(page, weights=np.isin(self.kinds, (_KINDS[DOUBTFUL], _KINDS[OPEN])),
                           minlength=len(self.blocks)) > 0

    def heads(self, nth: np.ndarray) -> np.ndarray:
        """The first ``DEPTH`` tokens of some suffixes, zeros beyond the end of the run."""
        place = self.at[nth][:, None] + np.arange(DEPTH)
        return np.where(place < self.end[nth][:, None], self.tokens[place], 0)

    def often(self, slots: list[dict], shift: int) -> np.ndarray:
        """Numbers of the suffixes in slots that ``PAGES`` or more suffixes have."""
        held = [np.cumsum(_unpacked(x["slots"]), dtype=np.uint64) + np.uint64(x["part"] << SLOT_BITS)
                for x in sorted(slots, key=lambda x: x["part"])]
        if not held:
            return np.zeros(0, np.int64)
        slot, held = self.name >> np.uint64(shift), np.concatenate(held)
        return np.flatnonzero(held[np.minimum(np.searchsorted(held, slot), len(held) - 1)] == slot)


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    for i in range(b.num_rows):
        yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def _chunk_row(held: list[list[tuple[str, str]]]) -> dict[str, list]:
    """Kinds, sizes and tokens of the blocks of some pages."""
    data, offsets = string_buffers(pa.array([text for blocks in held for _, text in blocks], pa.large_string()))
    hashed = [word_hashes(d, o) for _, _, d, o in chunks(data, offsets)]
    h = np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in hashed)])
    sizes = np.concatenate([np.zeros(0, np.int64), *(x for _, x in hashed)])
    words, ids, n = np.unique(np.maximum(h >> np.uint64(32), np.uint64(1)).astype(np.uint32), return_inverse=True,
                              return_counts=True)
    order = np.argsort(-n, kind="stable")  # frequent words have small numbers
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    kinds = np.array([_KINDS[part] for blocks in held for part, _ in blocks], np.uint8)
    return {"blocks": [_packed(np.array([len(x) for x in held]))], "kinds": [_packed(kinds)],
            "sizes": [_packed(sizes)], "words": [_packed(np.diff(words[order], prepend=np.uint32(0)))],
            "ids": [_packed(rank[ids])], "tokens": [len(h)]}


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(row, page_id, url, host, key, twin, html); key and twin are of host and html."""
    host, body = host_of(F.coalesce(F.col(url_col), F.lit(""))), F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"), F.xxhash64(host).alias("host"), F.xxhash64(host, body).alias("key"),
        F.xxhash64(body, host).alias("twin"), F.col(html_col).alias("html"))


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """The token streams of all pages, a row for each few MB of text.

    keys, hosts, blocks: of each page; kinds, sizes: of each of its blocks, the dropped
    ones too; ids: the tokens of all blocks as numbers of ``words``; twins: numbers of
    the pages that equal an earlier one.
    """

    def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begin, size, held = 0, 0, []
            for i in range(b.num_rows):
                held.append(page_blocks(b.column("html")[i].as_py() or ""))
                size += sum(len(text) for _, text in held[-1])
                if size >= CHUNK_CHARS or i + 1 == b.num_rows:
                    own = b.slice(begin, i + 1 - begin)
                    keys = np.stack([own.column(c).to_numpy() for c in ("key", "twin")], axis=1)
                    yield pa.RecordBatch.from_pydict({
                        "chunk": own.column("row").slice(0, 1), "keys": [keys.tobytes()],
                        "hosts": [own.column("host").to_numpy().tobytes()], **_chunk_row(held)})
                    begin, size, held = i + 1, 0, []

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, keys in zip(b.column("chunk").to_pylist(), b.column("keys").to_pylist()):
                key = np.frombuffer(keys, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict({
                    "key": key[:, 0].copy(), "twin": key[:, 1].copy(), "chunk": np.full(len(key), chunk),
                    "nth": np.arange(len(key), dtype=np.int32)})

    rows = _keyed(pages, id_col, url_col, html_col).select("row", "host", "key", "twin", "html")
    streams = scratch_table(rows.mapInArrow(
        tidy(read_pages), "chunk long, keys binary, hosts binary, blocks binary, kinds binary, sizes binary, "
        "words binary, ids binary, tokens long"), "html-streams")
    placed = streams.select("chunk", "keys").mapInArrow(tidy(places), "key long, twin long, chunk long, nth int")
    first = placed.groupBy("key", "twin").agg(
        F.min(F.struct("chunk", "nth")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    twins = scratch_table(placed.join(first, ["key", "twin"]).where(F.struct("chunk", "nth") != F.col("first"))
                          .groupBy("chunk").agg(F.collect_list("nth").alias("twins")), "html-twins")
    return streams.join(twins, "chunk", "left")


def _often(parsed: DataFrame) -> tuple[DataFrame, int]:
    """((chunk, often), shift): the slots of each chunk's suffixes that ``PAGES`` or more
    suffixes have, and by how many bits a name is shifted to its slot."""
    total = parsed.agg(F.sum("tokens")).first()[0] or 0
    parts = max(0, int(total).bit_length() - 20)
    shift = 64 - SLOT_BITS - parts
    low, borders = np.uint64((1 << SLOT_BITS) - 1), np.arange((1 << parts) + 1, dtype=np.uint64) << np.uint64(SLOT_BITS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                chunk = Chunk(row)
                chunk.suffixes()
                slot = np.sort(chunk.name >> np.uint64(shift))
                keep = np.ones(len(slot), bool)
                keep[PAGES:] = slot[PAGES:] != slot[:-PAGES]  # more of one slot say no more
                slot = slot[keep]
                cuts = np.searchsorted(slot, borders).tolist()
                own = [(i, _packed(np.diff(slot[a:z] & low, prepend=np.uint64(0))))
                       for i, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in own], pa.int32()), pa.array([row["chunk"]] * len(own), pa.int64()),
                     pa.array([x for _, x in own], pa.binary())], names=["part", "chunk", "slots"])

    def counted(table: pa.Table) -> pa.Table:
        held = [np.cumsum(_unpacked(x), dtype=np.int64) for x in table["slots"].to_pylist()]
        slot = np.sort(np.concatenate(held))
        often = np.unique(slot[PAGES - 1:][slot[PAGES - 1:] == slot[:max(0, len(slot) - PAGES + 1)]])
        held = [np.unique(x[np.isin(x, often)]) for x in held]
        answers = pa.table({"part": table["part"], "chunk": table["chunk"],
                            "slots": pa.array([_packed(np.diff(x, prepend=0)) for x in held], pa.binary())})
        return answers.filter(pa.array([len(x) > 0 for x in held], pa.bool_()))

    schema = "part int, chunk long, slots binary"
    return scratch_table(parsed.mapInArrow(tidy(sketch), schema).groupBy("part").applyInArrow(counted, schema)
                         .groupBy("chunk").agg(F.collect_list(F.struct("part", "slots")).alias("often")),
                         "html-often"), shift


def _slices(parsed: DataFrame, often: DataFrame) -> list[DataFrame]:
    """The chunks that have suffixes to look at, in shares, as the join sends the streams."""
    share = F.pmod(F.xxhash64("chunk"), F.lit(SLICES))
    return [parsed.where(share == i).join(often.where(share == i).hint("merge"), "chunk") for i in range(SLICES)]


def _heads(parsed: DataFrame, often: DataFrame, shift: int) -> list[DataFrame]:
    """(host, head, pages): the distinct suffixes of each chunk and host that may be repeated.

    pages adds up to the distinct pages over all suffixes of one ``SHARED`` tokens: of
    a page's suffixes that begin alike only the first counts it.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                chunk = Chunk(row)
                chunk.suffixes()
                nth = chunk.often(row["often"], shift)
                nth = nth[np.lexsort((chunk.name[nth], chunk.page[nth]))]
                name, page = chunk.name[nth], chunk.page[nth]
                fresh = np.ones(len(nth), np.int64)
                fresh[1:] = (name[1:] != name[:-1]) | (page[1:] != page[:-1])
                heads, hosts = chunk.heads(nth), chunk.hosts[page]
                _, first, same = np.unique(_names(heads, hosts), return_index=True, return_inverse=True)
                pages = np.bincount(same, weights=fresh, minlength=len(first)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hosts[first]), _binary(heads[first]), pa.array(pages)],
                                                 names=["host", "head", "pages"])

    return [scratch_table(x.mapInArrow(tidy(local), "host long, head binary, pages long"), "html-heads")
            for x in _slices(parsed, often)]


def repeats(parsed: DataFrame, often: DataFrame | None = None, shift: int = 0) -> DataFrame:
    """(host, begin, name, pages, longest, of): the repeated substrings of each host by
    their first ``SHARED`` tokens, on how many of its pages, the longest common prefix of
    neighbours among them (up to ``DEPTH``), and how many distinct pages the host has.
    """
    if often is None:
        often, shift = _often(parsed)

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # sorted by host and head; what a batch cuts is joined below
            if not b.num_rows:
                continue
            host = b.column("host").to_numpy()
            heads = np.frombuffer(b"".join(b.column("head").to_pylist()), TOKEN).reshape(-1, DEPTH)
            common = np.cumprod(heads[1:] == heads[:-1], axis=1).sum(axis=1) * (host[1:] == host[:-1])
            first = np.flatnonzero(np.concatenate([[True], common < SHARED]))
            longest = np.maximum.reduceat(np.concatenate([[0], common]) * np.concatenate([[False], common >= SHARED]),
                                          first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(host[first]), _binary(heads[first, :SHARED]),
                 pa.array(_names(heads[first, :SHARED], host[first]).view(np.int64)),
                 pa.array(np.add.reduceat(b.column("pages").to_numpy(), first)), pa.array(longest.astype(np.int32))],
                names=["host", "begin", "name", "pages", "longest"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for hosts, twins in zip(b.column("hosts").to_pylist(), b.column("twins").to_pylist()):
                own = np.delete(np.frombuffer(hosts, np.int64), twins or [])
                host, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(host), pa.array(n)], names=["host", "n"])

    heads = _heads(parsed, often, shift)
    array = (reduce(DataFrame.unionAll, heads).repartitionByRange("host", "head").sortWithinPartitions("host", "head")
             .mapInArrow(tidy(intervals), "host long, begin binary, name long, pages long, longest int"))
    found = (array.groupBy("host", "begin", "name")
             .agg(F.sum("pages").alias("pages"), F.max("longest").alias("longest")).where(F.col("pages") >= PAGES))
    hosts = (parsed.select("hosts", "twins").mapInArrow(tidy(distinct), "host long, n long")
             .groupBy("host").agg(F.sum("n").alias("of")))
    found = scratch_table(found.join(hosts, "host"), "html-repeats")
    for table in heads:
        discard(table)
    return found


def _hits(parsed: DataFrame, often: DataFrame, shift: int, repeated: DataFrame) -> list[DataFrame]:
    """(chunk, hits): the repeated substrings of each chunk that may decide a block.

    Within the main part that takes one that more than half of the host's pages have,
    and ``MAIN_PAGES`` at least.
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                chunk = Chunk(row)
                chunk.suffixes()
                nth = chunk.often(row["often"], shift)
                loose = ~chunk.main[nth]
                loose[loose] = chunk.undecided()[chunk.page[nth[loose]]]
                name = np.unique(chunk.name[nth[loose]])
                strict = np.setdiff1d(chunk.name[nth[chunk.main[nth]]], name)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(name) + len(strict), row["chunk"])),
                     pa.array(np.concatenate([name, strict]).view(np.int64)),
                     pa.array(np.arange(len(name) + len(strict)) >= len(name))], names=["chunk", "name", "strict"])

    asks = (x.mapInArrow(tidy(asked), "chunk long, name long, strict boolean") for x in _slices(parsed, often))
    return [scratch_table(x.join(repeated.select("name", "pages", "of").hint("merge"), "name")
                          .where(~F.col("strict") | (2 * F.col("pages") > F.col("of"))
                                 & (F.col("pages") >= MAIN_PAGES))
                          .groupBy("chunk").agg(F.collect_list(F.struct("name", "pages", "of")).alias("hits")),
                          "html-hits") for x in asks]


def dropped_blocks(kinds: np.ndarray, sizes: np.ndarray, level: np.ndarray, of: int) -> list[int]:
    """Numbers, furniture not counted, of the blocks that repetition drops.

    level: how many pages have the longest repeat over each token, 0 for a unique one;
    of: how many pages the host has.
    """
    cuts = np.cumsum(sizes)
    kept = [i for i, kind in enumerate(kinds.tolist()) if kind != _KINDS[FURNITURE]]
    main = [kinds[i] == _KINDS[MAIN] for i in kept]
    on = []  # pages that have each block, 0 for a unique one
    for i, in_main in zip(kept, main):
        own = np.sort(level[cuts[i] - sizes[i]:cuts[i]])
        if in_main:
            own = own * ((2 * own > of) & (own >= MAIN_PAGES))
        on.append(int(own[len(own) // 2]) if 2 * np.count_nonzero(own) > len(own) else 0)
    size = [int(sizes[i]) for i in kept]
    keep = {i for i, n in enumerate(on) if n == 0}
    if any(main):
        of_main = [i for i, in_main in enumerate(main) if in_main]
        if 2 * sum(size[i] for i in of_main if i not in keep) >= sum(size[i] for i in of_main):
            keep.update(of_main)  # a copied article
    elif len(keep) < len(on):  # unmarked, with boilerplate
        runs: list[list[int]] = []
        for i, n in enumerate(on):
            if runs and on[runs[-1][0]] == n:
                runs[-1].append(i)
            else:
                runs.append([i])
        longest = max(runs, key=lambda r: sum(size[i] for i in r))
        if not keep or 2 * on[longest[0]] <= of:
            keep.update(longest)
    return [i for i in range(len(on)) if i not in keep]


def _drops(parsed: DataFrame, hits: DataFrame) -> DataFrame:
    """(key, twin, drops): the pages of which repetition drops blocks, and which."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                chunk = Chunk(row)
                chunk.suffixes()
                names = np.array([x["name"] for x in row["hits"]], np.int64).view(np.uint64)
                order = np.argsort(names)
                names = names[order]
                place = np.minimum(np.searchsorted(names, chunk.name), len(names) - 1)
                nth = np.flatnonzero(names[place] == chunk.name)
                pages, of = (np.array([x[c] for x in row["hits"]], np.int64)[order][place[nth]]
                             for c in ("pages", "of"))
                level = np.zeros(len(chunk.tokens), np.int64)
                for j in range(SHARED):
                    inside = chunk.at[nth] + j < chunk.end[nth]
                    at = chunk.at[nth[inside]] + j
                    level[at] = np.maximum(level[at], pages[inside])
                host = dict(zip(chunk.page[nth].tolist(), of.tolist()))
                block, token = (np.concatenate([[0], np.cumsum(x)]) for x in (chunk.blocks, chunk.sizes))
                out: list[tuple[int, int, list[int]]] = []
                for page, pages_of in host.items():
                    a, z = block[page], block[page + 1]
                    drops = dropped_blocks(chunk.kinds[a:z], chunk.sizes[a:z], level[token[a]:token[z]], pages_of)
                    if drops:
                        out.append((*chunk.keys[page].tolist(), drops))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                     pa.array([x[2] for x in out], pa.list_(pa.int32()))], names=["key", "twin", "drops"])

    return parsed.join(hits, "chunk").mapInArrow(tidy(decide), "key long, twin long, drops array<int>")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship(pages.sparkSession)
    with _freeing(pages.sparkSession):
        parsed = _parsed(pages, id_col, url_col, html_col)
        often, shift = _often(parsed)
        repeated = repeats(parsed, often, shift)
        hits = _hits(parsed, often, shift, repeated)
        drops = scratch_table(_drops(parsed, reduce(DataFrame.unionAll, hits)), "html-drops")
        for table in (parsed, often, repeated, *hits):
            discard(table)
    joined = _keyed(pages, id_col, url_col, html_col).join(drops, ["key", "twin"], "left").select(
        "page_id", "url", "html", "drops")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for i in range(b.num_rows):
                drops = set(b.column("drops")[i].as_py() or ())
                blocks = [text for part, text in page_blocks(b.column("html")[i].as_py() or "") if part != FURNITURE]
                texts.append("\n".join(text for j, text in enumerate(blocks) if j not in drops))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(tidy(write), "page_id long, url string, text string, n_chars long")
