"""HTML extraction: structure tells articles from menus, and suffix arrays over
all pages of a host find what repeats where structure leaves it open: in pages
that mark no article, and before and after the paragraphs of those that do.

A suffix array is made of some pages of a host at a time and tells how many of them
hold each run of tokens. Spark adds these numbers up for the host, so what is
cut depends on all its pages and not on which of them came together; pages stay
where they are, and no task has to hold a host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from weblode.llm.common import blank, mix64, read_table, share_code, stage
from weblode.llm.op05_decontaminate import suffix_array

NAME = "op6_html"

#: Tokens of a repeated run, and pages of a host that must hold it; tokens from
#: which on a block is taken for part of an article, which may repeat.
RUN, LEAST_PAGES, LONG_BLOCK = 8, 4, 40
#: Pages and tokens of one suffix array, and repeated runs that are sent to all
#: executors at most (16 MB; more are joined by a shuffle).
HOT_PAGES, HOT_TOKENS, MAX_BROADCAST_RUNS = 256, 1 << 20, 1_000_000

# Elements whose text is none, those that are no part of an
# article, those that begin a block, and names of classes, ids and roles.
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head title select textarea".split())
APART = frozenset("nav footer aside form button menu dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
# Elements of an article that hold notices as well as its text, and headings.
LOOSE = frozenset("div section center address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
APART_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promo(?:tion)?s?|banner|sidebar|side|widget|navbar|nav|"
    r"navigation|menu|breadcrumbs?|footer|footnav|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|trending|comments?|commentlist|respond|replies|disqus|complementary|"
    r"contentinfo|search|pagination|pager|toolbar|skip|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
APART_ARTICLES = frozenset("comment comments reply replies ad advert promo sponsored related teaser widget".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN_NOW = re.compile(r"(?:^|\s)(?:hidden(?:$|[\s=/])|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.IGNORECASE)

APART_ZONE, OPEN_ZONE, MAIN_ZONE, HEADING_ZONE, LOOSE_ZONE = 0, 1, 2, 3, 4
IN_MAIN = (MAIN_ZONE, HEADING_ZONE, LOOSE_ZONE)


class _Page:
    """Blocks of one page with their zones, in page order."""

    def __init__(self) -> None:
        self.blocks: list[tuple[int, str]] = []
        self.parts: list[str] = []
        self.main: list[str] = []  # open article and main elements
        self.apart: list[str] = []  # the element that is apart, and like ones in it
        self.seen_main = False
        self.element = ""  # that began the block

    def end_block(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        self.parts = []
        if text:
            of_main = HEADING_ZONE if self.element in HEADINGS else LOOSE_ZONE if self.element in LOOSE else MAIN_ZONE
            zone = APART_ZONE if self.apart else of_main if self.main else OPEN_ZONE
            self.blocks.append((zone, text))

    def open(self, name: str, rest: str) -> None:
        if name in BLOCKS:
            self.end_block()
            self.element = name
        elif name in ("br", "td", "th"):
            self.parts.append(" ")
        if name in VOID:
            return
        if self.apart:
            last = self.apart[0]
            if last in ("p", "li", "dt", "dd") and name in BLOCKS and (last == "p" or name == last):
                self.apart = []  # it ends here though it was not closed
            elif name in MAIN and not self.seen_main and not _is_apart(name, rest):
                self.apart = []  # an article inside means it was left open
            elif name == last:
                self.apart.append(name)
                return
            else:
                return
        if _is_apart(name, rest) or name == "header" and not self.main:
            self.apart = [name]
        elif name in MAIN or "main" in _names(rest):
            self.main.append(name)
            self.seen_main = True
        elif self.main and name == self.main[-1]:
            self.main.append("")  # a like element inside, to match its end

    def close(self, name: str) -> None:
        if name in BLOCKS:
            self.end_block()
            self.element = ""
        if self.apart:
            if name == self.apart[0]:
                self.apart.pop()
            elif name in MAIN and name in self.main:
                self.apart = []  # left open inside an article that ends
            else:
                return
        if name in MAIN and name in self.main:
            while self.main.pop() != name:
                pass
        elif self.main and self.main[-1] == "" and name not in VOID and name == self._outer():
            self.main.pop()
        elif self.main and self.main[-1] == name:
            self.main.pop()

    def _outer(self) -> str:
        return next((n for n in reversed(self.main) if n), "")


def _names(rest: str) -> list[str]:
    return [a or b or c for a, b, c in _NAMES.findall(rest)] if "=" in rest else []


def _is_apart(name: str, rest: str) -> bool:
    """Whether an element begins something apart from the article. An article
    element itself is only if its name says that it is a comment or the like;
    what a page has or lacks (has-sidebar, no-ads) says nothing."""
    if name in APART:
        return True
    if not rest or name in ("html", "body"):
        return False
    words = [w for n in _names(rest) for w in n.lower().split() if not w.startswith(("has-", "with-", "no-", "without-"))]
    if name in MAIN:
        return any(w in APART_ARTICLES or w.startswith("comment-") for w in words)
    return any(APART_NAMES.search(w) for w in words) or bool(_HIDDEN_NOW.search(rest))


def parse(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the blocks of a page: apart from any article, in no
    marked article, or in one (a heading, in a loose element, other). References are decoded, white space in a block
    is one blank, empty blocks are left out."""
    out = _Page()
    at, n = 0, len(page)
    while at < n:
        found = _TAG.search(page, at)
        if found is None:
            out.parts.append(page[at:])
            break
        out.parts.append(page[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            out.close(name)
        elif name in HIDDEN and not (found["rest"] or "").endswith("/"):
            out.parts.append(" ")
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                at = n
        else:
            out.open(name, found["rest"] or "")
    out.end_block()
    return out.blocks


def _runs(streams: list[list[str]], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of ``run`` tokens begin in the joined streams, in the order of
    the suffix array of all streams joined with a mark of its own after each;
    the group of equal runs of each, and how many distinct pages hold it; and
    where each stream begins. Marks differ, so a run with one in it, alone in
    its group, is that of no page."""
    sizes = np.array([len(s) for s in streams], np.int64)
    numbers: dict[str, int] = {}
    text = np.full(int(sizes.sum()) + len(streams), -1, np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    for k, stream in enumerate(streams):
        text[first[k] : first[k] + sizes[k]] = [numbers.setdefault(t, len(numbers)) for t in stream]
    marks = np.flatnonzero(text < 0)
    text[marks] = len(numbers) + np.arange(len(marks))
    if len(text) <= run:
        none = np.zeros(0, np.int64)
        return none, none, none, first
    page = np.repeat(np.arange(len(streams)), sizes + 1)
    order = suffix_array(text)
    order = order[order + run <= len(text)]
    same = np.ones(len(order) - 1, bool)
    for k in range(run):
        symbol = text[order + k]
        same &= symbol[1:] == symbol[:-1]
    group = np.cumsum(np.r_[True, ~same]) - 1
    in_group = np.unique(group * len(streams) + page[order]) // len(streams)
    pages = np.bincount(in_group, minlength=group[-1] + 1)
    return order, group, pages, first


def _covered(starts: np.ndarray, size: int, run: int = RUN) -> np.ndarray:
    """Which of ``size`` tokens lie in a run that begins at one of ``starts``."""
    change = np.zeros(size + run + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + run, -1)
    return np.cumsum(change)[:size] > 0


def repeated(streams: list[list[str]], run: int = RUN, pages: int = LEAST_PAGES) -> list[np.ndarray]:
    """For each page's tokens, which lie in a run of at least ``run`` tokens
    that ``pages`` distinct pages hold."""
    order, group, held, first = _runs(streams, run)
    sizes = [len(s) for s in streams]
    inside = _covered(order[held[group] >= pages], sum(sizes) + len(sizes), run)
    return [inside[a : a + n] for a, n in zip(first.tolist(), sizes, strict=True)]


def run_hashes(stream: list[str], run: int = RUN) -> np.ndarray:
    """64-bit hashes of the runs that begin at each token."""
    token = mix64(np.array([xxh3_64_intdigest(t) for t in stream], np.uint64))
    n = max(len(token) - run + 1, 0)
    out, odd = np.zeros(n, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for k in range(run):
        out = out * odd + token[k : k + n]
    return mix64(out).astype(np.int64)


def _tokens(texts: list[str]) -> list[str]:
    return [w for text in texts for w in text.split(" ")]


def _marked(zones: list[int]) -> bool:
    return any(zone in IN_MAIN for zone in zones)


def beside(zones: list[int]) -> list[int]:
    """Loose blocks of an article before its first paragraph and after its last. An
    article that has no paragraph has none."""
    body = [k for k, zone in enumerate(zones) if zone == MAIN_ZONE]
    return [k for k, zone in enumerate(zones) if zone == LOOSE_ZONE and body and not body[0] < k < body[-1]]


def _looked_up(zones: list[int], blocks: list[str]) -> list[str]:
    """The tokens that repetition decides about: all of a page without an article,
    of others those beside the paragraphs."""
    return _tokens([blocks[k] for k in beside(zones)] if _marked(zones) else blocks)


def _evidence(zones: list[int], blocks: list[str]) -> list[list[str]]:
    """The streams of a page that tell what its host repeats: all of a page without
    an article, of others what stands outside of the article, and beside its
    paragraphs."""
    if not _marked(zones):
        return [_tokens(blocks)]
    return [_tokens([t for zone, t in zip(zones, blocks, strict=True) if zone not in IN_MAIN]), _looked_up(zones, blocks)]


def main_text(blocks: list[tuple[int, str]], covered: np.ndarray) -> str:
    """The article's blocks; of a page without one, the tokens outside menus
    and the like that don't repeat on other pages of its host. Long blocks stay
    whole: articles repeat too. Of an article only loose blocks beside its
    paragraphs go, and only if they repeat as a whole. ``covered`` tells which
    of the tokens looked up repeat."""
    zones = [zone for zone, _ in blocks]
    if _marked(zones):
        gone, at = set(), 0
        for k in beside(zones):
            n = len(blocks[k][1].split(" "))
            own = covered[at : at + n]
            at += n
            if RUN <= n < LONG_BLOCK and len(own) and own.all():
                gone.add(k)
        return "\n".join(text for k, (zone, text) in enumerate(blocks) if zone in IN_MAIN and k not in gone)
    kept, at = [], 0
    for zone, text in blocks:
        words = text.split(" ")
        own = covered[at : at + len(words)]
        at += len(words)
        if zone == OPEN_ZONE and len(words) >= LONG_BLOCK:
            kept.append(text)
        elif zone == OPEN_ZONE and not own.all():
            own = _stretches(own)
            kept.append(" ".join(w for w, c in zip(words, own.tolist(), strict=True) if not c))
    return "\n".join(kept)


def _stretches(covered: np.ndarray, run: int = RUN) -> np.ndarray:
    """Without stretches shorter than a run: those are the ends of runs that
    lie in the blocks beside."""
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False]))
    out = np.zeros(len(covered), bool)
    for a, b in edges.reshape(-1, 2).tolist():
        out[a:b] = b - a >= run
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of pages."""
    for batch in batches:
        found = [parse(page) for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch["page_id"], batch["url"], batch["host"],
            pa.array([[zone for zone, _ in page] for page in found], pa.list_(pa.int32())),
            pa.array([[text for _, text in page] for page in found], pa.list_(pa.string()))],
            names=["page_id", "url", "host", "zones", "blocks"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, run, pages): of some pages of a host at a time, how many of them
    hold each run."""
    held: dict[int, list[list[list[str]]]] = {}
    sizes: dict[int, int] = {}

    def piece(host: int) -> pa.RecordBatch | None:
        pages = held.pop(host)
        sizes.pop(host)
        streams = [stream for page in pages for stream in page]
        order, group, _, first = _runs(streams, RUN)
        hashes = np.zeros(sum(map(len, streams)) + len(streams), np.int64)
        whole = np.zeros(len(hashes), bool)
        for at, stream in zip(first.tolist(), streams, strict=True):
            own = run_hashes(stream)
            hashes[at : at + len(own)] = own
            whole[at : at + len(own)] = True
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        heads = heads[whole[order[heads]]]
        if not len(heads):
            return None
        page = np.repeat(np.arange(len(pages)), [sum(len(s) + 1 for s in own) for own in pages])
        in_group = np.unique(group * len(pages) + page[order]) // len(pages)
        n_pages = np.bincount(in_group, minlength=group[-1] + 1)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(heads), host)), pa.array(hashes[order[heads]]), pa.array(n_pages[group[heads]])],
            names=["host", "run", "pages"])

    for batch in batches:
        for host, zones, blocks in zip(*(batch[c].to_pylist() for c in ("host", "zones", "blocks")), strict=True):
            held.setdefault(host, []).append(page := _evidence(zones, blocks))
            sizes[host] = sizes.get(host, 0) + sum(map(len, page))
            if len(held[host]) >= HOT_PAGES or sizes[host] >= HOT_TOKENS:
                if (out := piece(host)) is not None:
                    yield out
        while sum(sizes.values()) >= 4 * HOT_TOKENS:
            if (out := piece(max(sizes, key=sizes.__getitem__))) is not None:
                yield out
    for host in list(held):
        if (out := piece(host)) is not None:
            yield out


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, at, host, run) of all runs of a page that are looked up."""
    for batch in batches:
        for row, host, zones, blocks in zip(*(batch[c].to_pylist() for c in ("row", "host", "zones", "blocks")), strict=True):
            own = run_hashes(_looked_up(zones, blocks))
            if len(own):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(own), row)), pa.array(np.arange(len(own), dtype=np.int32)),
                    pa.array(np.full(len(own), host)), pa.array(own)], names=["row", "at", "host", "run"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for zones, blocks, starts in zip(*(batch[c].to_pylist() for c in ("zones", "blocks", "starts")), strict=True):
            covered = _covered(np.array(starts or [], np.int64), len(_looked_up(zones, blocks)))
            texts.append(main_text(list(zip(zones, blocks, strict=True)), covered))
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row per page.

    The text is that of the page's article or main elements, without what is
    marked as menu, footer, sidebar, notice, advert, form or comment. Pages
    that mark no article lose, besides, runs of 8 and more tokens that 4 or
    more pages of their host hold: blocks that lie in such runs whole, and
    8 and more tokens of others; but no block of 40 and more tokens,
    which is taken for part of an article. A marked article loses by repetition
    only blocks of 8 to 39 tokens that stand in a ``div`` or the like before its
    first paragraph or after its last, and lie in such runs whole: articles
    repeat too, so paragraphs, headings and all between them stay.

    Which runs repeat is counted over all pages of a host: what they have outside
    of articles and beside the paragraphs, and all of those that mark none. So the result
    does not depend on partitions. Null or empty html gives an empty text; null
    urls are a host of their own; a very long page is a suffix array of its own;
    repeated rows are pages of their own; other columns are not read; an empty
    table gives an empty table.
    """
    spark = pages.sparkSession
    share_code(spark)
    host = F.regexp_extract(blank(F.col("url")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)", 1)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", blank(F.col("html")).alias("html"),
        F.xxhash64(F.lower(host)).alias("host"))
    schema = "page_id long, url string, host long, zones array<int>, blocks array<string>"
    parsed = stage(rows.mapInArrow(_parsed, schema).withColumn("row", F.monotonically_increasing_id()))
    cut = parsed.join(_repeated_runs(parsed), "row", "left").select("page_id", "url", "zones", "blocks", "starts")
    found = cut.mapInArrow(_cut, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def _repeated_runs(pages: DataFrame) -> DataFrame:
    """``(row, starts)``: where repeated runs begin in what is looked up of a page."""
    runs = pages.select("host", "zones", "blocks").mapInArrow(_counted, "host long, run long, pages long")
    often = runs.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    often = stage(often.select("host", "run"))
    if often.count() <= MAX_BROADCAST_RUNS:
        often = F.broadcast(often)
    placed = pages.select("row", "host", "zones", "blocks").mapInArrow(_placed, "row long, at int, host long, run long")
    starts = stage(placed.join(often, ["host", "run"]).groupBy("row").agg(F.collect_list("at").alias("starts")))
    few = starts.agg(F.coalesce(F.sum(F.size("starts")), F.lit(0))).first()[0] <= MAX_BROADCAST_RUNS
    return F.broadcast(starts) if few else starts


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


SQL = None
