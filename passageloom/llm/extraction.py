"""Main text of web pages: what the pages of a host repeat, and markup.

Markup names what is never the article (scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, by element, role, class or id) and, on most pages, the article itself. What is left of a page, its
blocks, is its text.

All texts are compared as token streams, those with an article element and the others (open ones) apart. The streams of
different texts of a host are put together, and a suffix array finds the runs of RUN_TOKENS tokens that stand in
OPEN_TEXTS different texts and in OPEN_SHARE of them. The array has all suffixes in their full order; a token lies in a
repeated substring of RUN_TOKENS tokens or more exactly if it lies in such a run, so longer substrings are chains of runs.
A block that repeated substrings cover wholly is repeated; a block with a unique run is not, so a phrase that pages share
is not cut out of their sentences. Pages with the same text count as one text: a copy repeats nothing.

Markup has the last word: repeated blocks are boilerplate and go where no markup tells the article; blocks inside an
article or main element all stay, however often they are copied, and are only counted (``n_repeated``).

The different texts of a host are dealt by their hash into bins of about BIN_BYTES, of BIN_TEXTS texts at least, and a bin
is a task's unit. A run that has OPEN_SHARE of the texts of a host has that share of the texts in one of its bins at
least, so only runs that do are counted over the whole host. The result depends neither on the size of bins nor on how
the table is split, and no host meets in one task.

Defined cases: null or empty html, or html without text, gives an empty text; a null url is the host of the empty name;
equal rows give equal rows each; html that breaks off is read as far as it goes; quotes that are never closed end at the
next closing mark; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

BIN_BYTES = 1 << 22
#: With fewer texts in a bin, a share of them would be a single text, and all its runs would have to be counted.
BIN_TEXTS = 16
RUN_TOKENS = 8
#: Different texts of a host, and share of them, that have to have a run which counts as repeated.
OPEN_TEXTS, OPEN_SHARE = 3, 0.2

# Elements by their meaning in HTML, and names that pages give to what is not the article.
RAW = "script|style|template|noscript|textarea|title|svg|iframe|object|math|select"
NOT_TEXT = {"head", "nav", "footer", "aside", "form", "button", "dialog", "menu", "header"}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HINTS = re.compile(
    r"(?<![a-z])(?<!has[-_])(?<!no[-_])(?<!with[-_])(nav|navbar|navigation|menu|sidebar|footer|banner|ad|ads|adv|advert|advertisement|sponsor|sponsored|promo|cookie|cookies|consent|gdpr|notice|alert|popup|modal|overlay"
    r"|newsletter|subscribe|signup|share|sharing|social|related|recommended|comment|comments|respond|disqus|breadcrumb|breadcrumbs|pagination|pager|login|search|complementary|contentinfo|dialog)(?![a-z])"
)
HEADER_HINTS = re.compile(r"(?<![a-z])(header|masthead|topbar)(?![a-z])")
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
# Each of these is matched where it has to stand and never goes back over what it has read.
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
QUOTED = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>""")
RAW_NAMES = set(RAW.split("|"))
RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW_NAMES}


def tags_of(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of each tag; comments, declarations and raw elements have no name.

    One pass: after the first tag whose quotes are never closed, quotes count as plain characters.
    """
    at, quotes = page.find("<"), True
    final = page.rfind(">")
    while at >= 0:
        end, name, closing, attributes = -1, "", False, ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(page)
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1 or len(page)
        elif found := NAME.match(page, at + 1):
            whole = QUOTED.match(page, found.end()) if quotes and at < final else None
            quotes = quotes and (whole is not None or at >= final)
            closed = whole.end() if whole else page.find(">", at) + 1 if at < final else 0
            if not closed:  # a tag that breaks off is the end, unless there is another mark behind it
                closed = page.find("<", at + 1) if page.find("<", at + 1) >= 0 else len(page)
                yield at, closed, "", False, ""
                at = closed if closed < len(page) else -1
                continue
            end, name, closing, attributes = closed, found[2].lower(), bool(found[1]), page[found.end() : closed - 1]
            if name in RAW_NAMES and not closing:
                stop = RAW_END[name].search(page, closed)
                end, name = stop.end() if stop else len(page), ""
        elif page.startswith("</", at):
            end = page.find(">", at) + 1 or len(page)
        if end > 0:
            yield at, end, name, closing, attributes
        at = page.find("<", max(end, at + 1))


def blocks_of(page: str | None) -> tuple[list[str], bool]:
    """The blocks of text that may be the article, in page order, and whether an article or main element holds them."""
    stack: list[tuple[str, bool]] = []
    opened: Counter = Counter()
    outer: list[int] = []  # places in the stack of elements that are not inline
    found: list[tuple[str, bool]] = []
    text: list[str] = []
    dropped = inside = 0

    def flush() -> None:
        block = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if block:
            found.append((block, inside > 0))

    def leave(count: int) -> None:
        nonlocal dropped, inside
        for tag, drop in stack[len(stack) - count :]:
            opened[tag] -= 1
            dropped -= drop
            inside -= tag in ARTICLE and not drop
        del stack[len(stack) - count :]
        while outer and outer[-1] >= len(stack):
            outer.pop()

    at, page = 0, page or ""
    for start, end, tag, closing, attributes in tags_of(page):
        if not dropped and start > at:
            text.append(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            text.append(" ")
        if tag not in INLINE:
            flush()
        if closing:
            if opened[tag]:
                leave(1 + next(i for i, (name, _) in enumerate(reversed(stack)) if name == tag))
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in ARTICLE and dropped and not inside:
                leave(len(stack))  # what was left open before the article does not hold it
            shut = CLOSES.get(tag, set()) | (set() if tag in INLINE else {"p"})
            while outer and stack[outer[-1]][0] in shut:
                leave(len(stack) - outer[-1])
            names = " ".join(value.strip("\"'") for _, value in NAMES.findall(attributes)).lower() if attributes else ""
            drop = tag in NOT_TEXT and not (tag == "header" and inside)
            if names and tag not in ("body", "html") and (inside or tag not in ARTICLE):
                drop = drop or bool(HINTS.search(names)) or not inside and bool(HEADER_HINTS.search(names))
            drop = drop or bool(attributes) and bool(HIDDEN.search(attributes))
            stack.append((tag, drop))
            opened[tag] += 1
            if tag not in INLINE:
                outer.append(len(stack) - 1)
            dropped += drop
            inside += tag in ARTICLE and not drop
    if not dropped:
        text.append(page[at:])
    flush()
    has_article = any(within for _, within in found)
    return [block for block, within in found if within or not has_article], has_article


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """The places of all suffixes in their order. Tokens are small numbers from 0, of which the last stands only there.

    Suffixes are sorted by their first few tokens, as many as a key holds, and then by twice as many each time; only
    those that still have an equal are sorted again.
    """
    n = len(tokens)
    bits = int(tokens.max(initial=0) + 1).bit_length()
    width = max(1, min(62 // bits, n))
    key = np.zeros(n, dtype=np.int64)
    for i in range(width):
        key <<= bits
        key[: n - i] |= tokens[i:] + 1
    order = np.argsort(key, kind="stable")
    active, same = np.arange(n), key[order]
    rank = np.empty(n, dtype=np.int64)
    while len(active):
        first = np.ones(len(active), dtype=bool)
        first[1:] = same[1:] != same[:-1]
        heads = np.flatnonzero(first)
        rank[order[active]] = active[heads][np.cumsum(first) - 1]
        sizes = np.diff(heads, append=len(active))
        active = active[np.repeat(sizes > 1, sizes)]
        suffixes = order[active]
        after = suffixes + width
        same = rank[suffixes] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        again = np.argsort(same, kind="stable")
        order[active], same = suffixes[again], same[again]
        width *= 2
    return order


def suffix_runs(streams: list[list[list[str]]], run: int = RUN_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of many token streams by a suffix array: (text, block, place, number of the run) of each run.

    The streams are put one after the other, with a mark after each block and one that equals nothing after each text.
    Neighbours in the array that have ``run`` tokens in common begin with the same run. Runs lie within a block; a block
    shorter than ``run`` counts as a run of its own, with its mark.
    """
    sizes = np.array([len(b) for blocks in streams for b in blocks], dtype=np.int64)
    text_of = np.repeat(np.arange(len(streams)), [len(blocks) for blocks in streams])
    block_of = np.array([no for blocks in streams for no in range(len(blocks))], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1) + text_of
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(begin, sizes) + place
    words = pa.array([t for blocks in streams for b in blocks for t in b], pa.string()).dictionary_encode()
    mark = len(words.dictionary)
    tokens = np.full(sizes.sum() + len(sizes) + len(streams), mark, dtype=np.int64)
    tokens[at] = words.indices.to_numpy()
    texts_end = np.cumsum([sum(len(b) + 1 for b in blocks) + 1 for blocks in streams], dtype=np.int64) - 1
    tokens[texts_end] = mark + 1 + np.arange(len(streams))
    left = np.repeat(sizes, sizes) - place
    starts = (left >= run) | (place == 0)
    # Of each run its place in the stream, and how many tokens tell it: those of a short block and its mark.
    at, told = at[starts], np.minimum(left[starts] + 1, run)
    index = np.full(len(tokens), -1, dtype=np.int64)
    index[at] = np.arange(len(at))
    order = index[suffix_array(tokens)]
    order = order[order >= 0]
    equal = np.ones(max(0, len(order) - 1), dtype=bool)
    for i in range(run):
        one, other = (np.minimum(at[x] + i, len(tokens) - 1) for x in (order[:-1], order[1:]))
        equal &= (tokens[one] == tokens[other]) | (i >= told[order[:-1]])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(np.append(np.zeros(min(1, len(order)), dtype=np.int64), ~equal))
    return np.repeat(text_of, sizes)[starts], np.repeat(block_of, sizes)[starts], place[starts], number


def texts_by_run(texts: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one suffix of each run, and how many texts have it."""
    order = np.lexsort((texts, runs))
    if not len(order):
        return order, order
    new_run = np.ones(len(order), dtype=bool)
    new_run[1:] = runs[order][1:] != runs[order][:-1]
    fresh = new_run.copy()
    fresh[1:] |= texts[order][1:] != texts[order][:-1]
    return order[new_run], np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(new_run))


def covered_blocks(sizes: dict[int, int], hits: list[tuple[int, int]], run: int = RUN_TOKENS) -> list[int]:
    """The blocks (number: tokens) whose every token lies in a repeated run; hits are (block, place), sorted."""
    reach: dict[int, int] = {}
    for block, place in hits:
        if place <= reach.get(block, 0):
            reach[block] = min(sizes[block], place + run)
    return [block for block, end in reach.items() if end == sizes[block]]


@lru_cache(maxsize=256)
def numbered(runs: str) -> tuple[dict[str, int], set[str]]:
    """The runs of a list by their text, and the words they begin with."""
    names = runs.split("\n")
    return {name: i for i, name in enumerate(names)}, {name.split(" ", 1)[0] for name in names}


def standing_runs(blocks: list[list[str]], runs: str, run: int = RUN_TOKENS) -> list[tuple[int, int, int]]:
    """(block, place, number in the list) of the listed runs in a text, sorted."""
    known, heads = numbered(runs)
    found = []
    for no, words in enumerate(blocks):
        for i in range(max(1, len(words) - run + 1)):
            if words[i] in heads and (number := known.get(" ".join(words[i : i + run]))) is not None:
                found.append((no, i, number))
    return found


def repeated_blocks(blocks: list[str], runs: str) -> list[int]:
    """The blocks of a text that the listed runs cover wholly."""
    words = [b.split(" ") for b in blocks]
    return covered_blocks({i: len(w) for i, w in enumerate(words)}, [hit[:2] for hit in standing_runs(words, runs)])


def packed(blocks: list[str]) -> bytes:
    text = "\n".join(blocks).encode()
    return len(text).to_bytes(8) + pa.compress(text, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[str]:
    return pa.decompress(data[8:], int.from_bytes(data[:8]), codec="zstd", asbytes=True).decode().split("\n")


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """The other columns, and ``blocks`` and ``article`` in place of the html."""
    kept = [f for f in pages.schema.fields if f.name != "html"]
    schema = T.StructType([*kept, T.StructField("blocks", T.ArrayType(T.StringType())), T.StructField("article", T.BooleanType())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks_of(page.as_py()) for page in batch.column("html")]
            columns = [pa.array([b for b, _ in found], pa.list_(pa.string())), pa.array([a for _, a in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *columns], names=schema.names)

    return pages.mapInArrow(parse, schema)


def frequent_runs(texts: DataFrame) -> DataFrame:
    """host, bins, texts, run: what a bin of the different texts (key, host, texts, bins, blocks) has often enough.

    Of hosts of one bin these are the repeated runs, of others all that can be.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(c) for c in ("key", "host", "texts", "bins", "blocks"))):
                key, host, texts, bins = (v.as_py() for v in row[:4])
                if key not in seen:
                    seen.add(key)
                    rows.append({"key": key, "host": host, "texts": texts, "bins": bins, "bin": int.from_bytes(key[:7]) % bins, "text": packed(row[4].as_py())})
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    def frequent(rows: pa.Table) -> pa.Table:
        different = dict(zip(rows.column("key").to_pylist(), rows.column("text").to_pylist()))
        streams = [[b.split(" ") for b in unpacked(text)] for text in different.values()]
        host, texts, bins = (rows.column(c)[0].as_py() for c in ("host", "texts", "bins"))
        text, block, place, runs = suffix_runs(streams)
        one, counts = texts_by_run(text, runs)
        # A little less than the share, so that rounding loses no run.
        one = one[counts >= (max(OPEN_TEXTS, OPEN_SHARE * texts) if bins == 1 else OPEN_SHARE * len(streams) - 1e-6)]
        names = [" ".join(streams[t][b][p : p + RUN_TOKENS]) for t, b, p in zip(text[one].tolist(), block[one].tolist(), place[one].tolist())]
        return pa.table({"host": pa.array([host] * len(names), pa.string()), "bins": pa.array([bins] * len(names), pa.int64()), "texts": pa.array([texts] * len(names), pa.int64()), "run": pa.array(names, pa.string())})

    schema = pa.schema([("key", pa.binary()), ("host", pa.string()), ("texts", pa.int64()), ("bins", pa.int64()), ("bin", pa.int64()), ("text", pa.binary())])
    # Texts are shuffled packed, and equal ones of a task once.
    dealt = texts.mapInArrow(deal, "key binary, host string, texts long, bins long, bin long, text binary")
    return dealt.groupBy("host", "bin").applyInArrow(frequent, "host string, bins long, texts long, run string")


def repeated_runs(found: DataFrame, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """host, runs (a line each): the runs that the different texts of a host repeat, where there are any."""
    size = F.octet_length(F.array_join("blocks", "\n"))
    texts = found.where("key IS NOT NULL").select("key", "host", "blocks")
    different = texts.select("key", "host", size.cast("long").alias("size")).distinct()
    bins = F.least(F.ceil(F.sum("size") / bin_bytes), F.floor(F.count(F.lit(1)) / BIN_TEXTS))
    hosts = different.groupBy("host").agg(F.count(F.lit(1)).alias("texts"), F.greatest(F.lit(1), bins).cast("long").alias("bins"))
    dealt = lookup_join(texts, stage(hosts.where(F.col("texts") >= OPEN_TEXTS), "hosts"), "host")
    frequent = stage(frequent_runs(dealt), "frequent-runs")
    listed = F.array_join(F.sort_array(F.collect_set("run")), "\n").alias("runs")
    # Hosts of several bins: the texts that have a run are counted over all of them.
    asked = stage(frequent.where("bins > 1").groupBy("host").agg(F.max("texts").alias("texts"), listed), "asked-runs")

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [sorted({hit[2] for hit in standing_runs([b.split(" ") for b in blocks.as_py()], runs.as_py())}) for blocks, runs in zip(batch.column("blocks"), batch.column("runs"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("host"), pa.array(numbers, pa.list_(pa.int32()))], names=["key", "host", "numbers"])

    numbers = lookup_join(texts, asked, "host").mapInArrow(standing, "key binary, host string, numbers array<int>").where(F.size("numbers") > 0)
    counts = numbers.distinct().select("host", F.explode("numbers").alias("number")).groupBy("host", "number").agg(F.count(F.lit(1)).alias("n"))
    enough = F.col("n") >= F.greatest(F.lit(float(OPEN_TEXTS)), OPEN_SHARE * F.col("texts"))
    named = asked.select("host", "texts", F.posexplode(F.split("runs", "\n")).alias("number", "run"))
    large = counts.join(named, ["host", "number"]).where(enough).select("host", "run")
    return frequent.where("bins = 1").select("host", "run").unionByName(large).groupBy("host").agg(listed)


def without_repeated(found: DataFrame) -> DataFrame:
    """page_id, url, text, n_repeated of the pages (with blocks, article and the runs their host repeats)."""
    kept = [found.schema["page_id"], found.schema["url"]]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_repeated", T.LongType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for row in zip(*(batch.column(c) for c in ("blocks", "article", "runs"))):
                blocks, article, runs = (v.as_py() for v in row)
                repeated = set(repeated_blocks(blocks, runs)) if runs and blocks else set()
                numbers.append(len(repeated))
                # The exact check: what stands in an article element is the article.
                texts.append("\n\n".join(b for i, b in enumerate(blocks) if article or i not in repeated))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(numbers, pa.int64())], names=schema.names)

    return found.mapInArrow(join, schema)


def extract_text(pages: DataFrame, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """page_id, url, text of every page, and n_repeated: how many of its blocks the host repeats."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    layout = F.when(F.col("article"), "article ").otherwise("open ")
    found = parsed_pages(rows).withColumn("host", F.concat(layout, host_of(F.col("url"))))
    # The texts of one host are told apart by a digest, a text of another host is another text.
    key = F.when(F.size("blocks") > 0, F.unhex(F.sha2(F.concat_ws("\n", "host", F.array_join("blocks", "\n")), 256)))
    found = stage(found.withColumn("key", key), "blocks", "zstd")
    runs = stage(repeated_runs(found, bin_bytes), "repeated-runs")
    return without_repeated(lookup_join(found.drop("key"), runs, "host", "left", stored=True))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
