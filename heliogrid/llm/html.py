"""Main text of web pages, with the repeated token runs of each host.

A page is cut into blocks of text. Where the page marks its article (article, main, or their roles), the blocks inside
are its text, else all blocks but those in parts that are named as something else (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, reader comments). Then the host decides. The token streams of what stands outside of
articles, named parts included, are put one behind the other for each host, and their suffixes sorted: runs of RUN
tokens that stand on several pages are boilerplate. Blocks of which such runs cover most are removed from pages without
a marked article, and unique runs are kept. A block of a marked article goes only if it is no heading and is covered as
a whole by runs that stand outside of articles on most pages of the host (WIDE), like a notice of the site. What articles
share with each other never counts, be it a quotation or a whole copy, nor does an advert that quotes an article.

Suffixes are sorted up to RUN tokens, all that matters here, in the tasks that read the pages. What each task finds,
one row a run, meets by the hash of host and run, over all pages of the host at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from heliogrid.llm.common import slices, strings
from heliogrid.llm.urls import split_url
from heliogrid.session import may_broadcast, stage_table

RUN = 8  # tokens of a repeated run
PAGES = 2  # pages that must share it
WIDE = 0.5  # share of a host's pages from which a run belongs to the site, inside of articles too
COVERED = 0.5  # share of a block's tokens from which it is boilerplate

# Elements whose content is never text, and those that stand beside the article.
SILENT = frozenset("script style noscript template head title svg math canvas object iframe audio video select option textarea button datalist".split())
ASIDE = frozenset("nav header footer aside form menu dialog".split())
ARTICLE = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An end tag that comes late or never: these are closed by the next of their kind.
CLOSED_BY = {"p": BLOCK - {"br", "hr"} | {"hr"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog form".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments comment-list cookie cookies consent disqus footer header masthead menu nav navbar navigation newsletter notice pagination popup promo related replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Where a block stands; of each page the blocks of its highest place are the text, unless that is a named part.
NAMED, WRAPPED, PLAIN, WRAPPED_ARTICLE, MARKED = range(5)
SPACE = re.compile(r"\s+")


class _Page(HTMLParser):
    """Blocks of a page as (text, place).

    Forms and parts named like an aside may wrap the whole page, so their text is kept apart, and an article in them
    (a main part in any aside) counts anew. It is the text of pages that have no article outside of such parts.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None, dict[str, int] | None]] = []  # tag, what it begins, counts to return to
        self.tags: Counter[str] = Counter()  # open elements by tag
        self.levels: list[int] = []  # which open elements are blocks
        self.blocks: list[tuple[str, int, bool]] = []  # text, place, whether it is a heading
        self.words: list[str] = []
        self.wrapped: list[str] = []
        self.named: list[str] = []
        self.count = {"silent": 0, "aside": 0, "wrapper": 0, "article": 0, "anew": 0}

    def flush(self) -> None:
        place = PLAIN if not self.count["article"] else WRAPPED_ARTICLE if self.count["anew"] else MARKED
        heading = any(self.tags[t] for t in HEADINGS)
        for words, at in ((self.words, place), (self.wrapped, WRAPPED), (self.named, NAMED)):
            text = SPACE.sub(" ", "".join(words)).strip()
            words.clear()
            if text:
                self.blocks.append((text, at, heading))

    def close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, kind, before = self.open.pop()
            self.tags[tag] -= 1
            if before:
                self.count = before
            elif kind:
                self.count[kind] -= 1
        while self.levels and self.levels[-1] >= depth:
            self.levels.pop()

    def kind(self, tag: str, attrs: dict[str, str | None]) -> str | None:
        role = (attrs.get("role") or "").lower()
        if tag in SILENT or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
            return "silent"
        if tag == "form" or role == "form":
            return "wrapper"
        # A header or footer of the article itself still holds no main text, but its headings do.
        if tag in ASIDE and not (tag == "header" and self.count["article"]) or role in ASIDE_ROLES:
            return "aside"
        if tag in ARTICLE or role in ("main", "article"):
            return "article"
        if tag not in ("html", "body") and any(not ASIDE_NAMES.isdisjoint((attrs.get(a) or "").lower().split()) for a in ("class", "id")):
            return "wrapper"
        return None

    def begin(self, tag: str, attrs: dict[str, str | None]) -> None:
        kind, before = self.kind(tag, attrs), None
        main = tag == "main" or (attrs.get("role") or "").lower() == "main"
        if kind == "article" and not self.count["article"] and (self.count["wrapper"] and not self.count["aside"] or self.count["aside"] and main):
            before = self.count
            self.count = before | {"aside": 0, "wrapper": 0, "anew": 1}
        if tag in BLOCK or tag in CLOSED_BY:
            self.levels.append(len(self.open))
        self.tags[tag] += 1
        self.open.append((tag, kind, before))
        if kind:
            self.count[kind] += 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.flush()
        if tag in VOID:
            return
        for depth in reversed(self.levels):
            if tag in CLOSED_BY.get(self.open[depth][0], ()):
                self.close_to(depth)
                break
            if self.open[depth][0] != "p":
                break
        self.begin(tag, dict(attrs))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.tags[tag]:
            depth = len(self.open) - 1
            while self.open[depth][0] != tag:
                depth -= 1
            self.close_to(depth)

    def handle_data(self, data: str) -> None:
        if not self.count["silent"]:
            (self.named if self.count["aside"] else self.wrapped if self.count["wrapper"] else self.words).append(data)


class Found(NamedTuple):
    blocks: list[str]  # that may be text
    fixed: list[bool]  # whether the host has no say about a block: a heading in a marked article
    outside: list[str]  # all other blocks
    marked: bool


def find(page: str) -> Found:
    """What a page holds; markup that ends midway is read as far as it goes."""
    parser = _Page()
    parser.feed(page)
    parser.close()
    parser.flush()
    place = max((at for _, at, _ in parser.blocks if at != NAMED), default=PLAIN)
    marked = place >= WRAPPED_ARTICLE
    own = [(text, marked and heading) for text, at, heading in parser.blocks if at == place]
    return Found([t for t, _ in own], [f for _, f in own], [text for text, at, _ in parser.blocks if at != place], marked)


def blocks(page: str) -> tuple[list[str], bool]:
    """Blocks that may be text, and whether the page marks its article."""
    found = find(page)
    return found.blocks, found.marked


FOUND = StructType([StructField("blocks", ArrayType(StringType())), StructField("fixed", ArrayType(BooleanType())), StructField("outside", ArrayType(StringType())), StructField("marked", BooleanType())])


@F.arrow_udf(FOUND)
def _blocks(page: pa.Array) -> pa.Array:
    columns = list(zip(*map(find, strings(page)), strict=True)) or [[]] * 4
    kinds = [pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.string()), pa.bool_()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], FOUND.names)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _page_key(host: int, texts: list[str]) -> int:
    return _signed(xxhash.xxh3_64_intdigest("\n".join(texts).encode(), seed=host % (1 << 64)))


def _run_keys(host: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """(keys of the runs that start at each token of the page, block of each token, short blocks as (block, key, tokens))."""
    tokens, block, short = [], [], []
    for i, text in enumerate(texts):
        words = text.split()
        tokens += [xxhash.xxh3_64_intdigest(w) for w in words]
        block += [i] * len(words)
        if len(words) < RUN:
            short.append((i, _signed(xxhash.xxh3_64_intdigest("\n".join(words), seed=(host + 1) % (1 << 64))), len(words)))
    stream = np.array(tokens, dtype=np.uint64)
    n = max(len(stream) - RUN + 1, 0)
    keys = np.full(n, host % (1 << 64), dtype=np.uint64)
    for k in range(RUN if n else 0):
        keys = (keys ^ stream[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64), np.array(block, dtype=np.int64), short


def equal_suffixes(stream: np.ndarray, depth: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``stream`` cut at ``depth`` (a power of two), and the rank of each suffix.

    Prefix doubling: ranks of twice the length are ranks of pairs. Suffixes with equal ranks agree in ``depth`` tokens.
    """
    rank, step = np.unique(stream, return_inverse=True)[1].astype(np.int64) + 1, 1
    while step < depth:
        behind = np.r_[rank[step:], np.zeros(min(step, len(rank)), dtype=np.int64)]
        rank = np.unique(rank * (len(rank) + 1) + behind, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return np.argsort(rank, kind="stable"), rank


HOST_RUNS = ["key", "host", "a", "b", "rows", "n"]


def _host_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, a, b, rows, n): runs of n tokens outside of articles, with the least and the largest page and the
    number of rows that they stand on.

    Short blocks of pages without a marked article are runs of their own.
    """
    for batch in slices(batches, 1000):
        tokens, pages, keys, hosts, rows, out = [], [], [], [], [], []
        for row, (host, texts, outside, marked) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            page = _page_key(host, texts + outside)
            for part in ([outside] if marked else [texts, outside]):
                runs, block, short = _run_keys(host, part)
                if len(runs):
                    words = [w for text in part for w in text.split()]
                    tokens.append(np.array([xxhash.xxh3_64_intdigest(w, seed=host % (1 << 64)) for w in words], dtype=np.uint64))
                    keys.append(np.r_[runs, np.zeros(RUN - 1, dtype=np.int64)])
                    # A suffix of fewer tokens has no page.
                    pages.append(np.r_[np.full(len(runs), page), np.zeros(RUN - 1, dtype=np.int64)])
                    hosts.append(np.full(len(words), host, dtype=np.int64))
                    rows.append(np.full(len(words), row, dtype=np.int64))
                if not marked and part is texts:
                    out += [(key, host, page, page, 1, n) for _, key, n in short]
        if tokens:
            stream, page_of, key_of, host_of, row_of = map(np.concatenate, (tokens, pages, keys, hosts, rows))
            order, rank = equal_suffixes(stream)
            order = order[page_of[order] != 0]
            new = np.r_[True, np.diff(rank[order]) != 0]
            first = np.flatnonzero(new)
            # Equal suffixes stand in the order of their places, so a row is counted where it begins.
            n_rows = np.add.reduceat((new | np.r_[True, np.diff(row_of[order]) != 0]).astype(np.int64), first)
            columns = [key_of[order[first]], host_of[order[first]], *(f.reduceat(page_of[order], first) for f in (np.minimum, np.maximum)), n_rows, np.full(len(first), RUN)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], HOST_RUNS)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], HOST_RUNS)


def _page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, page, marked): the different runs and short blocks of each page's text."""
    for batch in slices(batches, 100):
        keys, pages, marks = [], [], []
        for host, texts, outside, marked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs, _, short = _run_keys(host, texts)
            keys.append(np.unique(np.r_[runs, np.array([key for _, key, _ in short], dtype=np.int64)]))
            pages.append(np.full(len(keys[-1]), _page_key(host, texts + outside), dtype=np.int64))
            marks.append(np.full(len(keys[-1]), marked, dtype=bool))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, pages, marks)], ["key", "page", "marked"])


def kept_blocks(host: int, texts: list[str], fixed: list[bool], marked: bool, repeated: np.ndarray) -> list[str]:
    """The blocks that repeated runs (sorted keys) do not cover."""
    keys, block, short = _run_keys(host, texts)
    steps = np.zeros(len(block) + 1, dtype=np.int64)
    starts = np.flatnonzero(_among(keys, repeated))
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + RUN, -1)
    covered = np.cumsum(steps)[:-1] > 0
    if short and not marked:
        for (i, _, _), known in zip(short, _among(np.array([key for _, key, _ in short]), repeated).tolist(), strict=True):
            if known:
                covered[block == i] = True
    share = np.bincount(block[covered], minlength=len(texts)) / np.maximum(np.bincount(block, minlength=len(texts)), 1)
    return [text for text, keep, x in zip(texts, fixed, share.tolist(), strict=True) if keep or (x < 1 if marked else x <= COVERED)]


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _kept(repeated: tuple[np.ndarray, np.ndarray] | None):
    """Column of texts without boilerplate.

    ``repeated`` holds the keys of all hosts, for pages without and with a marked article; None if the rows bring theirs.
    """

    @F.arrow_udf(ArrayType(StringType()))
    def kept(host: pa.Array, texts: pa.Array, fixed: pa.Array, marked: pa.Array, own: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (host, texts, fixed, marked, own)), strict=True)
        return pa.array([kept_blocks(*row, repeated[row[3]] if repeated else np.sort(np.array(keys or [], dtype=np.int64))) for *row, keys in rows], pa.list_(pa.string()))

    return kept.asNondeterministic()


@F.arrow_udf(LongType())
def _page(host: pa.Array, texts: pa.Array, outside: pa.Array) -> pa.Array:
    return pa.array([_page_key(h, t + o) for h, t, o in zip(host.to_pylist(), texts.to_pylist(), outside.to_pylist(), strict=True)], pa.int64())


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", result: str = "text") -> DataFrame:
    """``pages`` without ``html`` and with ``text`` (main text, empty if none); one row per row, all other columns kept.

    Character references are decoded, white space within a block becomes one space, blocks are joined by two line feeds
    in the order of the page. Null and empty pages have an empty text, null urls share one host. Rows of a host with the
    same blocks are one page, so repeated rows do not make each other boilerplate. An empty table gives an empty table.
    A column named like ``result`` is replaced; ValueError if _host, _found, _page or _repeated occurs.
    """
    taken = {"_host", "_found", "_page", "_repeated"} & set(pages.columns)
    if taken:
        raise ValueError(f"columns exist already: {', '.join(sorted(taken))}")
    host, _ = split_url(F.col(f"`{url}`"))
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in (html, result)]
    found = pages.select(*keep, F.xxhash64(host).alias("_host"), _blocks.asNondeterministic()(F.col(f"`{html}`")).alias("_found"))
    found = stage_table(found, "blocks")
    # The smallest and the largest page differ where a run is on PAGES pages, which are two. A block shorter than a run
    # needs as many pages as give the same number of tokens, as a word or two often come twice by chance.
    runs = found.select("_host", "_found.blocks", "_found.outside", "_found.marked").mapInArrow(_host_runs, ", ".join(f"{c} long" for c in HOST_RUNS))
    long = runs.filter(F.col("n") == RUN).groupBy("key", "host").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("rows").alias("rows")).filter("a != b")
    sizes = found.groupBy(F.col("_host").alias("host")).agg(F.count(F.lit(1)).alias("size"))
    long = long.join(sizes, "host").select("key", (F.col("rows") > F.col("size") * F.lit(WIDE)).alias("wide"))
    short = runs.filter(F.col("n") < RUN).select("key", "a", "n").distinct().groupBy("key").agg((F.count(F.lit(1)) * F.first("n")).alias("tokens"))
    shared = stage_table(long.unionByName(short.filter(F.col("tokens") >= RUN * PAGES).select("key", F.lit(False).alias("wide"))), "shared")
    if may_broadcast(9 * shared.count()):
        table = shared.toArrow()
        keys, wide = table.column("key").to_numpy(), table.column("wide").to_numpy()
        known = (np.sort(keys), np.sort(keys[wide.astype(bool)]))
        rows = found.withColumn("_repeated", F.lit(None).cast("array<long>"))
    else:
        known = None
        mine = found.select("_host", "_found.blocks", "_found.outside", "_found.marked").mapInArrow(_page_runs, "key long, page long, marked boolean")
        back = mine.join(shared, "key").filter("wide OR NOT marked").groupBy(F.col("page").alias("_page")).agg(F.collect_set("key").alias("_repeated"))
        rows = found.withColumn("_page", _page.asNondeterministic()("_host", "_found.blocks", "_found.outside")).join(back, "_page", "left")
    texts = _kept(known)("_host", "_found.blocks", "_found.fixed", "_found.marked", "_repeated")
    return rows.withColumn(result, F.array_join(texts, "\n\n")).drop("_host", "_found", "_page", "_repeated")
