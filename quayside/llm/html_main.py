"""Main text of web pages by nearest-URL page differencing.

Pages of one host are put in the order of their URL paths, and each is paired
with its neighbours there.  Their lines (one per text block) are aligned by
longest common subsequence.  Shared lines are the site's, not the page's, and
are deleted, inside article elements too, except headings and sentences there.
Elements that are furniture by their tag (menus, footers) go; what only a word
in a name suggests is settled by the comparison.  A neighbour that copies the
page says nothing, and the nearest page that is none is compared instead.
"""

from __future__ import annotations

import html
import json
import re
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, prepare

# Elements whose content is never text of the page.
SILENT = "script style noscript template textarea select button iframe object svg math canvas audio video datalist head title"
# Elements that begin and end a block of text.
BLOCK = ("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
         "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul")
VOID = "area base br col embed hr img input link meta param source track wbr"
# Elements that a following block closes by itself.
SELF_CLOSING = "p li dt dd tr td th option h1 h2 h3 h4 h5 h6"
FURNITURE = "nav footer aside form dialog menu search fieldset"
# Words in class, id or role that name page furniture; the second list only
# where the name does not also speak of the article.
FURNITURE_NAMES = ("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
                   "gdpr login menu modal nav navbar navigation newsletter pager pagination popup promo promoted recommended related replies "
                   "respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets")
FURNITURE_NAMES_ALONE = "alert aside bar bottom contentinfo copyright footer form header legal masthead notice notices search tags top"
ARTICLE_NAMES = "article body content entry main post story text"

_SETS = {k: frozenset(v.split()) for k, v in {
    "silent": SILENT, "block": BLOCK, "void": VOID, "self_closing": SELF_CLOSING, "furniture": FURNITURE, "names": FURNITURE_NAMES,
    "alone": FURNITURE_NAMES_ALONE, "article": ARTICLE_NAMES}.items()}

_MARK = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+>", re.S | re.I)
_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>[^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# What the markup says of a line.  A heading line is one of an article.  Of an
# element with a furniture name, TOLD: a whole word of class, id or role is the
# name ("ad"); EDGE: the first or last part of one is ("comment-list"), and it
# does not say that there is none; NAMED, in or outside an article: a part
# between, or of a name that says so ("no-sidebar").
FURNITURE_LINE, ARTICLE_LINE, OPEN_LINE, HEADING_LINE, NAMED_LINE, NAMED_ARTICLE_LINE, TOLD_LINE, EDGE_LINE = range(8)
IN_ARTICLE = frozenset((ARTICLE_LINE, HEADING_LINE, NAMED_ARTICLE_LINE))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WITHOUT = frozenset("has hide hides no not with without".split())
_PART = re.compile(r"[-_:]+")
_SENTENCE = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")


def _role(tag: str, rest: str, inside: int) -> int:
    """What holds inside an element: what it says of its content, or what held outside."""
    if inside == FURNITURE_LINE:
        return inside
    in_article = inside in IN_ARTICLE
    names, whole, role = set(), set(), ""
    if rest:
        for m in _ATTRIBUTE.finditer(rest):
            key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return FURNITURE_LINE
            if key == "role":
                role = value.lower()
            if key in ("class", "id", "role") and not (in_article and (tag in _HEADINGS or tag == "section" and key == "id")):
                names |= {x.lower() for x in _NAME.findall(value)}
                whole |= set(value.lower().split())
    if tag in _SETS["furniture"] or tag == "header" and not in_article:
        return FURNITURE_LINE
    if tag in ("article", "main") or role in ("main", "article"):
        return ARTICLE_LINE
    if inside in (TOLD_LINE, EDGE_LINE):
        return inside
    if tag not in ("body", "html"):
        told = names & _SETS["names"] or names & _SETS["alone"] and not names & _SETS["article"]
        if told & whole if told else False:
            return TOLD_LINE
        if told:
            for word in whole:
                parts = [p for p in _PART.split(word) if p]
                if parts and (parts[0] in told or parts[-1] in told) and not _WITHOUT & set(parts):
                    return EDGE_LINE
            return NAMED_ARTICLE_LINE if in_article else NAMED_LINE
    return HEADING_LINE if inside == ARTICLE_LINE and tag in _HEADINGS else inside


def _marks(page: str):
    """Tags, comments and whole raw elements in order, each found from the place of
    its ``<``.  A ``<`` behind the last ``>`` opens nothing (but an unfinished
    comment).  Where quotes in a tag find no end, quotes mean nothing from there
    on and a tag ends at the next ``>``: no part is read twice over."""
    last, at, quoted = page.rfind(">"), page.find("<"), True
    while at >= 0:
        if at > last and not page.startswith("<!--", at):
            return
        m = _MARK.match(page, at)
        if m is None and at < last:
            m = _TAG.match(page, at) if quoted else None
            if m is None:
                m = _LOOSE_TAG.match(page, at)
                quoted = quoted and m is None
        if m is not None:
            yield m
        at = page.find("<", at + 1 if m is None else m.end())


class _Open:
    """Open elements with the role that holds inside each.  For every tag and for
    all blocks the places on the stack are kept, so that an end tag is settled
    without a walk, whatever is left open."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.stops: list[int] = []  # of blocks and of elements that close by themselves
        self.silent = 0

    def role(self) -> int:
        return self.stack[-1][1] if self.stack else OPEN_LINE

    def push(self, tag: str, role: int) -> None:
        k = len(self.stack)
        self.stack.append((tag, role))
        self.places.setdefault(tag, []).append(k)
        if tag in _SETS["block"]:
            self.blocks.append(k)
        if tag in _SETS["block"] or tag in _SETS["self_closing"]:
            self.stops.append(k)
        self.silent += tag in _SETS["silent"]

    def cut(self, k: int) -> None:
        """Closes the elements from place ``k`` on."""
        while len(self.stack) > k:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            for kept in (self.blocks, self.stops):
                if kept and kept[-1] == len(self.stack):
                    kept.pop()
            self.silent -= tag in _SETS["silent"]

    def end(self, tag: str) -> None:
        """An end tag; an inline one closes nothing outside its block."""
        places = self.places.get(tag)
        if places and (tag in _SETS["block"] or not self.blocks or places[-1] > self.blocks[-1]):
            self.cut(places[-1])

    def begin_block(self, tag: str) -> None:
        """Closes what a block closes by itself, with the inline elements left open in it."""
        if self.stops:
            t = self.stack[self.stops[-1]][0]
            if t in _SETS["self_closing"] and not (t in ("li", "dd", "dt", "tr", "td", "th") and tag not in (t, "dt", "dd", "td", "th", "tr")):
                self.cut(self.stops[-1])


def lines_of(page: str | None) -> tuple[list[str], list[int]]:
    """The text blocks of a page and what the markup says of each.

    Character references are decoded, white space inside a block is one space.
    The time taken grows with the length of the page, whatever its markup.
    """
    texts: list[str] = []
    roles: list[int] = []
    if not page:
        return texts, roles
    opened = _Open()
    held: list[str] = []

    def close_block() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                texts.append(text)
                roles.append(opened.role())

    at = 0
    for m in _marks(page):
        if m.start() > at and not opened.silent:
            held.append(page[at:m.start()])
        at = m.end()
        if m.re is _MARK:
            continue
        tag, ends, rest = m["tag"].lower(), m["end"], m["rest"]
        if tag in _SETS["silent"]:
            if ends:
                if opened.silent and opened.places.get(tag):
                    opened.cut(opened.places[tag][-1])
            elif not rest.endswith("/"):
                if not opened.silent and tag == "head":
                    close_block()
                opened.push(tag, opened.role())
            continue
        if tag == "body" and opened.silent and not ends:  # a head that was never closed
            opened.cut(0)
        if opened.silent:
            continue
        block = tag in _SETS["block"]
        if block:
            close_block()
        elif tag in ("br", "td", "th"):
            held.append(" ")
        if tag in _SETS["void"]:
            continue
        if ends:
            opened.end(tag)
        else:
            if block:
                opened.begin_block(tag)
            opened.push(tag, _role(tag, rest, opened.role()))
    if at < len(page) and not opened.silent:
        held.append(page[at:])
    close_block()
    return texts, roles


def _lcs_rows(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Bit-parallel table of the longest common subsequence, a row per element of ``a``."""
    where: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a.tolist():
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    return rows


TABLE_BITS = 1 << 27  # 16 MB


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indexes of the elements of ``a`` in one longest common subsequence with ``b``.

    Equal ends are taken first and elements without a partner are left out; a
    table too large to be held is halved along ``a`` as often as needed.
    """
    n, m = len(a), len(b)
    head = 0
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    ends = np.concatenate([np.arange(head), np.arange(n - tail, n)])
    ia = head + np.flatnonzero(np.isin(a[head:n - tail], b[head:m - tail]))
    jb = head + np.flatnonzero(np.isin(b[head:m - tail], a[head:n - tail]))
    if not len(ia):
        return ends
    return np.sort(np.concatenate([ends, ia[_lcs(a[ia], b[jb])]]))


def _lcs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(a) or not len(b):
        return np.zeros(0, np.int64)
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2
        front, back = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int((front + back).argmax())
        return np.concatenate([_lcs(a[:half], b[:cut]), half + _lcs(a[half:], b[cut:])])
    rows, out, j = _lcs_rows(a, b), [], len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        if j < 0:
            break
        # Bit k of a row is 0 where the length rises: the last rise up to j is the match to keep.
        zeros = ~rows[i] & ((1 << (j + 1)) - 1)
        if not zeros:
            break
        before = ~rows[i - 1] & ((1 << (j + 1)) - 1) if i else 0
        if zeros.bit_count() > before.bit_count():
            out.append(i)
            j = zeros.bit_length() - 1
            j -= 1
    return np.array(out[::-1], dtype=np.int64)


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every prefix of ``b``."""
    row, where, full = (1 << len(b)) - 1, {}, (1 << len(b)) - 1
    for j, x in enumerate(b.tolist()):
        where[x] = where.get(x, 0) | 1 << j
    for x in a.tolist():
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
    bits = np.unpackbits(np.frombuffer((~row & full).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(bits.astype(np.int64))])


RANGE_PAGES = 20_000  # pages that a task compares
COPY_SHARE = 0.9  # pages that share so much of the text of both are copies


def is_copy(a: np.ndarray, chars_a: np.ndarray, b: np.ndarray, chars_b: np.ndarray) -> bool:
    """Whether two whole pages are nearly equal."""
    most, least = max(chars_a.sum(), chars_b.sum()), min(chars_a.sum(), chars_b.sum())
    if least < COPY_SHARE * most:
        return False
    return np.array_equal(a, b) or bool(chars_a[common_lines(a, b)].sum() >= COPY_SHARE * most)


def others(lines: list[np.ndarray], chars: list[np.ndarray], hosts: list[str], step: int) -> list[int | None]:
    """For each page the nearest of its host in one direction that is no copy of
    it.  Past a copy, the search goes on where that copy's own ended."""
    n = len(lines)
    found: list[int | None] = [None] * n
    for k in range(n) if step < 0 else range(n - 1, -1, -1):
        j = k + step if 0 <= k + step < n and hosts[k + step] == hosts[k] else None
        while j is not None and is_copy(lines[k], chars[k], lines[j], chars[j]):
            j = found[j]
        found[k] = j
    return found


def shared_lines(lines: np.ndarray, neighbours: list[np.ndarray]) -> np.ndarray | None:
    """Indexes of the lines that the first neighbour that shares any shares;
    none without a neighbour."""
    for other in neighbours:
        found = common_lines(lines, other)
        if len(found):
            return found
    return np.zeros(0, np.int64) if neighbours else None


def main_text(texts: list[str], roles: list[int], shared) -> str:
    """Joins the lines that are neither furniture nor shared with a neighbour.

    A heading or sentence of an article stays though shared.  Where the article
    lines that are not shared are most of the text, they are all of it.  What a
    part of a name calls furniture stays where a neighbour was compared and does
    not share it, without neighbour only where it is most of the text; what the
    first or last part calls so, only where the page has no article and it is
    most of the text; what a whole name calls so never stays."""
    compared = shared is not None
    shared = set(shared if compared else ())
    size = [0] * 8
    for k, (t, r) in enumerate(zip(texts, roles)):
        size[r] += len(t) if k not in shared else 0
    in_article = size[ARTICLE_LINE] + size[HEADING_LINE]
    named = compared or size[NAMED_LINE] + size[NAMED_ARTICLE_LINE] > size[OPEN_LINE] + in_article
    article = {ARTICLE_LINE, HEADING_LINE} | ({NAMED_ARTICLE_LINE} if named else set())
    outside = {OPEN_LINE} | ({NAMED_LINE} if named else set())
    if not in_article and size[EDGE_LINE] > sum(size[r] for r in outside):
        outside = outside | {EDGE_LINE}
    wanted = article if sum(size[r] for r in article) > sum(size[r] for r in outside) else article | outside
    return "\n".join(t for k, (t, r) in enumerate(zip(texts, roles)) if r in wanted and (
        k not in shared or r == HEADING_LINE or r == ARTICLE_LINE and _SENTENCE.search(t)))


def _path_key():
    """Host and path of a URL in lower case, without scheme, query and fragment."""
    bare = F.regexp_replace(F.lower(F.coalesce(F.col("__url"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://|[?#].*$", "")
    return F.regexp_extract(bare, r"^[^/]*", 0), F.regexp_extract(bare, r"^[^/]*(/?.*?)(?:/|\.html?)?$", 1)


def extract_main_text(pages: DataFrame, html: str = "html", url: str = "url", id: str = "page_id") -> DataFrame:
    """Main text of every page: ``id, url, text, n_chars, n_lines, n_shared``.

    ``n_shared`` counts lines aligned with the chosen neighbour.  A null or empty
    page gives an empty text; pages without a URL count as one host; repeated
    rows give the same text each; an empty table gives an empty one.  A host may
    hold any share of the pages: pages are range-partitioned by (host, path, id)
    and only the first and last page of a partition are copied to the next.  What
    is sorted are line hashes, written once; the texts are parsed again at the end
    and shuffled once, compressed.
    """
    spark = pages.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "pages")
    rows = pages.select(F.col(id).alias("__id"), F.col(url).alias("__url"), F.col(html).alias("__html"))
    kind = rows.schema["__id"].dataType.simpleString()
    host, path = _path_key()
    keyed = rows.select("__id", "__url", "__html", host.alias("host"), path.alias("path"),
                        F.xxhash64(F.col("__id").cast("string"), "__url", "__html").alias("key"))

    def outline(batches):
        for batch in batches:
            found = [lines_of(p) for p in batch["__html"]]
            out = batch[["host", "path", "key"]].copy()
            out["lines"] = [[xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for t in ts] for ts, _ in found]
            out["chars"] = [[len(t) for t in ts] for ts, _ in found]
            yield out

    # Written, as a sort by ranges reads its input twice.
    outlines = scratch.keep(keyed.select("host", "path", "key", "__html").mapInPandas(
        outline, "host string, path string, key long, lines array<long>, chars array<int>"))
    order = ["host", "path", "key"]
    # As many ranges as the pages need: what a task compares does not grow with the table.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-outlines.count() // RANGE_PAGES))
    line = scratch.keep(outlines.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))

    # The first page of a partition also visits the partition before, the last the one after.
    one = F.struct(*order, "lines", "chars")
    edges = line.groupBy("part").agg(F.min(one).alias("first"), F.max(one).alias("last"))
    beside = Window.orderBy("part")
    edges = edges.withColumn("before", F.lag("part").over(beside)).withColumn("after", F.lead("part").over(beside))
    guests = edges.select(F.col("before").alias("part"), "first.*").unionAll(edges.select(F.col("after").alias("part"), "last.*")).filter("part IS NOT NULL")
    columns = ["part", *order, "lines", "chars"]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order + ["guest"], kind="stable")
        hosts, paths, lines = group["host"].tolist(), group["path"].tolist(), [np.asarray(x, np.int64) for x in group["lines"]]
        chars = [np.asarray(x, np.int64) for x in group["chars"]]
        out, sides = [], [others(lines, chars, hosts, step) for step in (-1, 1)]
        for k, (key, guest) in enumerate(zip(group["key"], group["guest"])):
            if guest:
                continue
            near = [side[k] for side in sides if side[k] is not None]
            near.sort(key=lambda j: -_same_start(paths[k], paths[j]))
            found = shared_lines(lines[k], [lines[j] for j in near])
            out.append((key, None if found is None else found.tolist()))
        return pd.DataFrame(out, columns=["key", "shared"])

    paired = (line.select(*columns, F.lit(False).alias("guest")).unionAll(guests.select(*columns, F.lit(True).alias("guest")))
              .groupBy("part").applyInPandas(compare, "key long, shared array<int>"))
    decided = paired.groupBy("key").agg(F.max("shared").alias("shared"))  # equal rows have one key

    def squeeze(batches):
        for batch in batches:
            out = batch[["__id", "__url", "key"]].copy()
            out["page"] = [zlib.compress(json.dumps(lines_of(p)).encode(), 6) for p in batch["__html"]]
            yield out

    def finish(batches):
        for batch in batches:
            texts, n_lines = [], []
            for page, shared in zip(batch["page"], batch["shared"]):
                lines, roles = json.loads(zlib.decompress(page))
                texts.append(main_text(lines, roles, shared))
                n_lines.append(len(lines))
            yield pd.DataFrame({id: batch["__id"], url: batch["__url"], "text": texts, "n_chars": [len(t) for t in texts],
                                "n_lines": n_lines, "n_shared": [0 if s is None else len(s) for s in batch["shared"]]})

    packed = keyed.select("__id", "__url", "key", "__html").mapInPandas(squeeze, f"__id {kind}, __url string, key long, page binary")
    return packed.join(decided, "key", "left").drop("key").mapInPandas(
        finish, f"`{id}` {kind}, `{url}` string, text string, n_chars long, n_lines long, n_shared long")


def _same_start(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)
