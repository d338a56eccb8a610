"""Main text of web pages by a site style tree.

Every page is read into element paths, each step a tag with its class and id. The paths of
all distinct pages of a host are merged into one tree, and every node gets an importance
from entropies over the pages,

    presentation: -sum p log_m p of the child sequences that the m pages show at the node
    content:      1 - mean over features a of -sum_j p_aj log_m p_aj over the pages j

where features are words, and all links are one feature. Both are weighed by the number of
children. Branches whose importance is below MIN_IMPORTANCE are removed from each page.

The markup is a check on what is left. Menus, headers, footers, asides, forms, adverts,
notices, comments and the like go, whatever their importance. Where a page has an article or
main element with text, only what stands in it stays; if the tree has left nothing of it, as
happens to copies of one article on a host, the marked text comes back.

Copies of a page count once in the tree. All sums are combined before the shuffle, which carries
words as 64-bit digests.

Cases: null and empty html give an empty text; markup that is cut off or not closed is read
to its end; tagless html and fragments are pages like others; a page that is alone on its host
keeps all that is not noise or links; a null url is a host of its own; repeated rows give
repeated rows; an empty table gives an empty result; only id, url and html are read, so other
columns cannot clash.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import BATCH_ROWS, map_batches, mixed, ready_workers, text_of, written

MIN_IMPORTANCE = 0.3
# A node on more than one in so many of the pages' paths is joined by broadcast.
HOT_SHARE = 256
CHILD_WEIGHT = 0.9  # how much of the importance content has, to the power of the children
LINK = "<a>"  # the one feature that all links are
# Nodes to remove that go to all tasks, with what each takes besides its names.
LOW_BYTES, NODE_BYTES = 8 << 20, 100
# Digests of copied pages that go to all tasks.
MOST_COPIED = 1_000_000
# Letters of html for each bucket of words, and words at nodes that a task adds up at a time.
BUCKET_LETTERS = 16 << 20
HELD_WORDS = 1_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# Element names of HTML by what they do to the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
SCOPE = frozenset(
    "html body article main section div nav aside header footer form table td th ul ol dl"
    " blockquote figure fieldset details dialog".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
# A start tag of the key ends an open element of the value, up to the next scope.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
NOISE_TAGS = frozenset(
    "head nav footer aside form script style noscript template button select option textarea"
    " input iframe svg canvas object dialog menu title".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar"
    " toolbar form".split()
)
# Words of class and id that mark noise anywhere, and those that do so outside the article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie"
    " cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription"
    " signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments"
    " commentlist disqus reply replies respond related recommended recommendations share"
    " sharing social pagination pager login search toolbar".split()
)
NOISE_WORDS_OUTSIDE = frozenset("header masthead banner topbar widget alert".split())
# What these hold is never shown, so it is not in the tree either.
UNSEEN_TAGS = RAW | {"head", "template", "svg", "canvas", "object"}
MAIN_TAGS = frozenset(["article", "main"])
MAIN_CLASSES = frozenset(
    "article-body article-content articlebody post-content post-body entry-content story-body".split()
)

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}
WORD_PARTS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")

ASK, CONTENT, NOISE = 0, 1, 2


def attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


class Element:
    __slots__ = ("tag", "path", "state", "seen", "children")

    def __init__(self, tag: str, path: str, state: int, seen: bool = True):
        self.tag, self.path, self.state, self.seen = tag, path, state, seen
        self.children: list[str] = []


def step(tag: str, found: dict[str, str]) -> str:
    """What an element is called in a path; numbers are left out of names."""
    name = f"{tag}.{found.get('class', '')}#{found.get('id', '')}" if found else tag
    return DIGITS.sub("", " ".join(name.split())).replace("/", "")


def state_of(tag: str, found: dict[str, str], above: int) -> int:
    """Noise stays noise for all that is inside; content stays content but for noise."""
    if above == NOISE or tag in NOISE_TAGS:
        return NOISE
    if tag == "header" and above != CONTENT:
        return NOISE
    if found:
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in NOISE_ROLES:
            return NOISE
        if "display:none" in found.get("style", "").replace(" ", ""):
            return NOISE
        label = f"{found.get('class', '')} {found.get('id', '')}".lower()
        if label != " ":
            words = set(WORD_PARTS.findall(label))
            if words & NOISE_WORDS and tag not in ("html", "body"):
                return NOISE
            if above != CONTENT and words & NOISE_WORDS_OUTSIDE and tag not in ("html", "body", *MAIN_TAGS):
                return NOISE
            if MAIN_CLASSES & set(label.split()):
                return CONTENT
        if found.get("role") == "main" or found.get("itemprop") == "articleBody":
            return CONTENT
    return CONTENT if tag in MAIN_TAGS else above


class Page:
    """The text runs of a page with the element each stands in, and the elements met."""

    def __init__(self, text: str):
        self.runs: list[tuple[Element, str, bool]] = []  # element, text, whether in a link
        self.noise: list[tuple[Element, str, bool]] = []  # the same of noise
        self.elements: list[Element] = []
        root = Element("", "", ASK)
        self.stack = [root]
        at = 0
        while (mark := MARKUP.search(text, at)) is not None:
            self._text(text[at : mark.start()])
            at = mark.end()
            if mark[2] is None:
                continue
            tag = mark[2].lower()
            if mark[1]:
                self._close(tag)
            else:
                self._open(tag, attributes(mark[3]))
                if tag in RAW:
                    end = RAW_END[tag].search(text, at)
                    stop = end.start() if end else len(text)
                    self._text(text[at:stop])
                    at = stop
        self._text(text[at:])

    def _text(self, text: str) -> None:
        element = self.stack[-1]
        if text and element.seen:
            linked = any(e.tag == "a" for e in self.stack[-3:])
            (self.noise if element.state == NOISE else self.runs).append((element, references.unescape(text), linked))

    def _break(self) -> None:
        if self.runs and self.runs[-1][1] != " ":
            self.runs.append((self.runs[-1][0], " ", False))

    def _open(self, tag: str, found: dict[str, str]) -> None:
        if tag not in INLINE:
            self._break()
            self._end(CLOSED_BY_BLOCK)
            if tag in CLOSED_BY:
                self._end(CLOSED_BY[tag])
        if tag in VOID:
            return
        above = self.stack[-1]
        name = step(tag, found)
        above.children.append(name)
        made = Element(tag, f"{above.path}/{name}", state_of(tag, found, above.state), above.seen and tag not in UNSEEN_TAGS)
        self.elements.append(made)
        self.stack.append(made)

    def _end(self, tags) -> None:
        """Ends open elements of these tags inside the nearest scope."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in SCOPE:
                return

    def _close(self, tag: str) -> None:
        if tag not in INLINE:
            self._break()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if self.stack[i].tag in SCOPE and tag not in SCOPE:
                return

    def main_text(self) -> str | None:
        """The text of the marked main elements; none where no such element has text."""
        text = joined(t for e, t, _ in self.runs if e.state == CONTENT)
        return text or None

    def blocks(self) -> list[tuple[str, str, int, bool]]:
        """Path, text, state and whether in a link, of consecutive runs with one path; noise comes last."""
        out: list[tuple[str, list[str], int, bool]] = []
        for element, text, linked in (*self.runs, *self.noise):
            if not out or (out[-1][0], *out[-1][2:]) != (element.path, element.state, linked):
                # A break belongs to what it follows.
                if text == " " and out and (out[-1][0], out[-1][2]) == (element.path, element.state):
                    out[-1][1].append(text)
                    continue
                out.append((element.path, [], element.state, linked))
            out[-1][1].append(text)
        return [(path, "".join(parts), state, linked) for path, parts, state, linked in out]

    def styles(self) -> list[tuple[str, int, int, int]]:
        """Path, digest of the sequence of children, their number, and how many elements are so."""
        shown = Counter((e.path, "\n".join(e.children), len(e.children)) for e in self.elements if e.seen)
        return [
            (path, xxhash.xxh3_64_intdigest(names.encode()) >> 1, children, n) for (path, names, children), n in shown.items()
        ]


def joined(texts) -> str:
    return " ".join("".join(texts).split())


BLOCK = {"path": pa.string(), "text": pa.string(), "state": pa.int8(), "linked": pa.bool_()}
PARSED = "url string, host string, blocks array<struct<path:string,text:string,state:tinyint,linked:boolean>>"


def _lists(rows: list[list[tuple]], fields: dict[str, pa.DataType]) -> pa.Array:
    """Lists of structs from lists of tuples."""
    flat = [x for row in rows for x in row]
    columns = zip(*flat, strict=True) if flat else [()] * len(fields)
    structs = pa.StructArray.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, fields.values(), strict=True)], list(fields)
    )
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(row) for row in rows])], pa.int32()), structs)


def _rows(lists: pa.Array) -> list[list[tuple]]:
    """The tuples of lists of structs."""
    flat = list(zip(*(c.to_pylist() for c in lists.flatten().flatten()), strict=True))
    ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def pages_of(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """``<id>, __url, __html, __host`` of the pages."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_column), F.lit("")), HOST.pattern, 1))
    return pages.select(
        id_column, F.col(url_column).alias("__url"), text_of(html_column).alias("__html"), host.alias("__host")
    )


def parse_pages(pages: DataFrame, id_column: str, low: Mapping[str, frozenset[str]] | None = None) -> DataFrame:
    """Pages as blocks of text; with ``low``, the nodes to remove of each host, also the ``removed`` paths of each page."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [Page(text).blocks() for text in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), batch.column(3), _lists(found, BLOCK)]
        names = [id_column, "url", "host", "blocks"]
        if low is not None:
            gone = [low.get(host, frozenset()) for host in batch.column(3).to_pylist()]
            removed = [list({path for path, *_ in blocks} & paths) for blocks, paths in zip(found, gone, strict=True)]
            columns.append(pa.array(removed, pa.list_(pa.string())))
            names.append("removed")
        return pa.RecordBatch.from_arrays(columns, names)

    kind = pages.schema[id_column].dataType.simpleString()
    return map_batches(pages, work, f"`{id_column}` {kind}, {PARSED}" + (", removed array<string>" if low is not None else ""))


def distinct_pages(pages: DataFrame) -> tuple[DataFrame, int]:
    """The pages with copies on a host once, and how many letters all pages have.

    Only pages that have a copy anywhere are shuffled, unless there are too many of them to
    send their digests to all tasks.
    """
    keyed = pages.select("__host", "__html", F.xxhash64("__html").alias("digest"))
    seen = written(
        keyed.groupBy("digest").agg(F.count("*").alias("n"), F.sum(F.length("__html")).alias("letters")), "pages-digests"
    )
    copied = seen.where("n > 1").select("digest")
    letters, copies = seen.agg(F.sum("letters"), F.count_if(F.col("n") > 1)).first()
    if copies > MOST_COPIED:
        return keyed.dropDuplicates(["__host", "digest"]), letters or 0
    again = keyed.join(F.broadcast(copied), "digest", "left_semi").dropDuplicates(["__host", "digest"])
    alone = keyed.join(F.broadcast(copied), "digest", "left_anti")
    return (alone.unionByName(again) if copies else keyed), letters or 0


def word_key(words: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The digest of a word at a node, from theirs."""
    return mixed(words * MULTIPLIER + nodes)


class TreeSums:
    """What pages say of the nodes of their hosts, added up: the words with n and n log n, the pages
    with words, and the child sequences. Words are kept by digest, sorted by where they meet others."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}
        self._clear()

    def _clear(self) -> None:
        self.nodes: dict[tuple[str, str], int] = {}
        self.pages, self.styles = Counter(), Counter()
        self.words: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, hosts: list[str], texts: list[str]) -> None:
        words: list[str] = []
        owners: list[int] = []
        sizes: list[int] = []
        for host, text in zip(hosts, texts, strict=True):
            page, found = Page(text), {}
            for path, shown, _, linked in page.blocks():
                if own := shown.split():
                    found.setdefault(path, []).extend([LINK] * len(own) if linked else own)
            for path, own in found.items():
                node = self.nodes.setdefault((host, path), len(self.nodes))
                self.pages[node] += 1
                words += own
                owners.append(node)
                sizes.append(len(own))
            for path, style, children, n in page.styles():
                self.styles[host, path, style, children] += n
        if not words:
            return
        coded = pa.array(words, pa.string()).dictionary_encode()
        spelt = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        width, of = len(spelt), np.repeat(np.arange(len(sizes)), sizes)
        # A word of a page at a node, then a word at a node.
        pairs, counts = np.unique(of * width + np.asarray(coded.indices), return_counts=True)
        both, at = np.unique(np.asarray(owners)[pairs // width] * width + pairs % width, return_inverse=True)
        nodes = self._digests()[both // width]
        n, nlogn = np.bincount(at, counts), np.bincount(at, counts * np.log(counts))
        self.words.append((word_key(spelt[both % width], nodes), nodes, n, nlogn))
        self.size += len(both)

    def _digests(self) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest("\n".join(node)) for node in self.nodes], np.uint64)

    def flush(self) -> Iterator[pa.RecordBatch]:
        digests, rows = self._digests().view(np.int64).tolist(), []
        for ((host, path), node), digest in zip(self.nodes.items(), digests, strict=True):
            rows.append((digest % self.buckets, digest, host, path, None, None, self.pages[node]))
        for (host, path, style, children), n in self.styles.items():
            rows.append((style % self.buckets, None, host, path, style, children, n))
        rows = [(*row, None, None, None, None, None) for row in rows]
        if self.words:
            key, node, n, nlogn = summed(*(np.concatenate(c) for c in zip(*self.words, strict=True)))
            bucket = (key % np.uint64(self.buckets)).astype(np.int64)
            order = np.lexsort((key, node, bucket))
            bucket, key, node, n, nlogn = bucket[order], key[order], node[order], n[order], nlogn[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
                runs = np.r_[0, np.flatnonzero(np.diff(node[low:high])) + 1]
                own = node[low:high][runs].view(np.int64), np.diff(np.r_[runs, high - low])
                rows.append((int(bucket[low]), *[None] * 6, *own, key[low:high].view(np.int64), n[low:high], nlogn[low:high]))
        self._clear()
        for at in range(0, len(rows), BATCH_ROWS):
            columns = zip(*rows[at : at + BATCH_ROWS], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, SUMS.values(), strict=True)], list(SUMS))


def summed(key: np.ndarray, node: np.ndarray, n: np.ndarray, nlogn: np.ndarray) -> tuple[np.ndarray, ...]:
    """The words once each, with their sums."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    add = lambda values: np.add.reduceat(values[order], first) if len(key) else values
    return key[first], node[order][first], add(n).astype(np.int64), add(nlogn)


LONGS, DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())
SUMS = {
    "bucket": pa.int64(), "node": pa.int64(), "host": pa.string(), "path": pa.string(), "style": pa.int64(),
    "children": pa.int32(), "n": pa.int64(), "nodes": LONGS, "words": LONGS, "keys": LONGS, "counts": LONGS, "nlogn": DOUBLES,
}
SUMS_SQL = (
    "bucket bigint, node bigint, host string, path string, style bigint, children int, n bigint,"
    " nodes array<bigint>, words array<bigint>, keys array<bigint>, counts array<bigint>, nlogn array<double>"
)
TREE = {**{name: SUMS[name] for name in ("node", "host", "path", "style", "children", "n")},
        "words": pa.int64(), "entropy": pa.float64(), "links": pa.int64()}
TREE_SQL = (
    "node bigint, host string, path string, style bigint, children int, n bigint, words bigint, entropy double, links bigint"
)


def _merged(table: pa.Table) -> pa.Table:
    """The sums of one bucket: ``words``, their ``entropy`` added up, ``n`` and ``links`` of each node; other rows as they are."""
    has_words = pc.is_valid(table["keys"])
    plain = table.filter(pc.invert(has_words))
    plain = pa.table([plain[c] if c in SUMS and c != "words" else pa.nulls(len(plain), kind) for c, kind in TREE.items()], list(TREE))
    packed = table.filter(has_words)
    flat = lambda c: np.asarray(packed[c].combine_chunks().flatten())
    nodes = np.repeat(flat("nodes"), flat("words")).view(np.uint64)
    key, node, n, nlogn = summed(flat("keys").view(np.uint64), nodes, flat("counts"), flat("nlogn"))
    owner, at = np.unique(node, return_inverse=True)
    linked = key == word_key(np.array([xxhash.xxh3_64_intdigest(LINK)], np.uint64), node)
    sums = lambda values: np.bincount(at, values, len(owner))
    columns = {
        "node": owner.view(np.int64), "n": sums(n).astype(np.int64), "words": np.bincount(at, minlength=len(owner)),
        "entropy": sums(np.log(n) - nlogn / n), "links": sums(n * linked).astype(np.int64),
    }
    found = [pa.array(columns[c], kind) if c in columns else pa.nulls(len(owner), kind) for c, kind in TREE.items()]
    return pa.concat_tables([plain, pa.table(found, list(TREE))])


def tree_of(pages: DataFrame) -> DataFrame:
    """The sums of all hosts' merged trees, in three kinds of rows: nodes with their pages, child sequences of
    nodes, and words of nodes. A word meets its like at the node in one of many buckets of even size."""
    once, letters = distinct_pages(pages)
    buckets = max(16, letters // BUCKET_LETTERS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = TreeSums(buckets)
        for batch in batches:
            sums.add(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if sums.size >= HELD_WORDS:
                yield from sums.flush()
        yield from sums.flush()

    ready_workers(pages.sparkSession)
    parts = once.select("__host", "__html").mapInArrow(work, SUMS_SQL)
    return written(parts.groupBy("bucket").applyInArrow(_merged, TREE_SQL), "pages-tree")


def importances(pages: DataFrame) -> DataFrame:
    """``host, path, importance`` of the nodes of every host's merged tree."""
    tree = tree_of(pages)
    shown = tree.where("style IS NOT NULL").groupBy("host", "path", "style").agg(
        F.sum("n").alias("n"), F.sum(F.col("children") * F.col("n")).alias("children")
    )
    presentation = shown.groupBy("host", "path").agg(
        F.sum("n").alias("shown"), (F.sum("children") / F.sum("n")).alias("children"), F.sum(F.col("n") * F.log("n")).alias("nlogn")
    ).select(
        "host", "path", "children", "shown",
        # -sum p log_m p with p = n / m.
        F.when(F.col("shown") > 1, 1 - F.col("nlogn") / (F.col("shown") * F.log("shown"))).otherwise(1.0).alias("presented"),
    )
    nodes = tree.where("style IS NULL AND path IS NOT NULL").groupBy("node", "host", "path").agg(F.sum("n").alias("m"))
    words = tree.where("words IS NOT NULL").groupBy("node").agg(
        (F.sum("entropy") / F.sum("words")).alias("entropy"), (F.sum("links") / F.sum("n")).alias("links")
    )
    spread = F.when(F.col("m") > 1, F.col("entropy") / F.log("m")).otherwise(0.0)
    content = nodes.join(words, "node").select("host", "path", ((1 - spread) * (1 - F.col("links"))).alias("content"))
    share = F.pow(F.lit(CHILD_WEIGHT), F.coalesce("children", F.lit(0.0)))
    return content.join(presentation, ["host", "path"], "left").select(
        "host", "path",
        (share * F.col("content") + (1 - share) * F.coalesce("presented", F.lit(1.0))).alias("importance"),
    )


def left_text(blocks: list[tuple[str, str, int, bool]], removed: Iterable[str]) -> str:
    """The text of a page when branches are removed and its markup is looked at."""
    gone = frozenset(removed)
    states = {state for _, text, state, _ in blocks if state != NOISE and text.strip()}
    marked = CONTENT in states
    checked = [(path, text) for path, text, state, _ in blocks if state == CONTENT or not marked and state == ASK]
    kept = joined(text if path not in gone else " " for path, text in checked)
    return kept if kept or not marked else joined(text for _, text in checked)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``<id>, url, text, n_chars``: the main text of every page.

    Pages are parsed again for their texts, so that no parsed table is kept. Nodes to remove go to all tasks
    up to LOW_BYTES; more of them meet the pages by joins.
    """
    source = pages_of(pages, id_column, url_column, html_column)
    low = written(importances(source).where(F.col("importance") < MIN_IMPORTANCE).select("host", "path"), "pages-removed")
    held = low.agg(F.sum(F.length("host") + F.length("path") + NODE_BYTES)).first()[0] or 0
    if held <= LOW_BYTES:
        nodes: dict[str, set[str]] = {}
        for host, path in low.collect():
            nodes.setdefault(host, set()).add(path)
        rows = parse_pages(source, id_column, {host: frozenset(paths) for host, paths in nodes.items()})
        return texts(rows.select(id_column, "url", "blocks", "removed"), id_column)
    parsed = written(parse_pages(source, id_column).withColumn("__row", F.monotonically_increasing_id()), "pages")
    removed = removed_of(parsed, low).withColumnRenamed("__row", "__at")
    rows = parsed.join(removed, F.col("__row") == F.col("__at"), "left").select(
        F.col(id_column), "url", "blocks", "removed"
    )
    return texts(rows, id_column)


def removed_of(parsed: DataFrame, low: DataFrame) -> DataFrame:
    """``__row, removed``: the paths of each page that are in ``low``, for pages that have any.

    The paths of pages meet those of their host. Nodes that stand on more than one in
    HOT_SHARE of all pages' paths, at most HOT_SHARE of them, are sent to all tasks; the others
    meet by host and path, so no host has to be held or read by one task.
    """
    shown = parsed.select("__row", "host", F.explode(F.array_distinct("blocks.path")).alias("path"))
    counts = shown.groupBy("host", "path").agg(F.count("*").alias("n"))
    total = parsed.agg(F.sum(F.size(F.array_distinct("blocks.path")))).first()[0] or 0
    marked = written(
        low.join(counts, ["host", "path"]).select("host", "path", (F.col("n") * HOT_SHARE > total).alias("hot")),
        "pages-nodes",
    )
    hot, rest = (marked.where(kept).select("host", "path") for kept in ("hot", "NOT hot"))
    # A path of a hot node finds nothing among the others; without it, no key has many rows.
    cold = shown.join(F.broadcast(hot), ["host", "path"], "left_anti")
    found = cold.join(rest, ["host", "path"]).unionByName(shown.join(F.broadcast(hot), ["host", "path"]))
    return found.groupBy("__row").agg(F.collect_list("path").alias("removed"))


def texts(rows: DataFrame, id_column: str) -> DataFrame:
    """``<id>, url, text, n_chars`` of ``<id>, url, blocks, removed``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            left_text(blocks, removed or ())
            for blocks, removed in zip(_rows(batch.column(2)), batch.column(3).to_pylist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            [id_column, "url", "text", "n_chars"],
        )

    kind = rows.schema[id_column].dataType.simpleString()
    return map_batches(rows, work, f"`{id_column}` {kind}, url string, text string, n_chars bigint")
