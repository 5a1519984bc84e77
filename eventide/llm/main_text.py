"""Main text of HTML pages, by what their hosts repeat.

The pages of a host are written one after another as one stream of tokens: a marker for each block, then its words. The
stream's suffixes are sorted (by their first LONG tokens, as no more is asked of them). Neighbours in that order that
agree in LONG tokens and stand in distinct pages are repeats; the tokens they cover are the host's boilerplate or text
that several of its pages share. What no other page has are the unique runs.

A page's article is where its unique runs are. An article or main element names it; without one it is the innermost
container with most of the unique text. From there repeated blocks are taken off at both ends, and repeated blocks of
links everywhere. A repeated paragraph between unique ones is part of the text. Containers that say what they are (menus,
headers, footers, sidebars, adverts, notices, forms, comments) go whether they repeat or not, as comments are unique too.

A host of any size is cut into groups of pages by a hash, each with a stream of its own. The groups of a host tell each
other which runs of LONG tokens they hold, as hashes by range, and learn which of them another group holds on a distinct
page. So what is repeated does not depend on how a host is cut. Hosts whose pages all have an article without lists of
links ask for no repeats and skip that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.page_blocks import CHROME, Block, Page, parse
from eventide.llm.tables import stored

#: Tokens from which on a repeat counts; 2 to the power of DOUBLINGS.
DOUBLINGS = 3
LONG = 1 << DOUBLINGS
#: Bytes of HTML whose token stream is sorted together.
GROUP_BYTES = 2 << 20
#: Groups of a host for each range of hashes.
RANGE_GROUPS = 16
#: A block with this share of its tokens repeated is repeated; with this share of its text in links it is a list of links.
REPEATED, LINKED = 0.5, 0.6
#: Share of a page's unique text that its article's container holds.
MOST = 0.7
#: An article element beside a larger one counts if it has this share of the larger one's text.
SIDE = 0.25
#: A repeated block weighs this much where the article is looked for.
FAINT = 0.1


def repeated_tokens(stream: np.ndarray, page: np.ndarray, doublings: int = DOUBLINGS, also: np.ndarray | None = None) -> np.ndarray:
    """Marks the tokens in a run of 2^doublings tokens that a distinct page has too. Token ids are 0 or more; a negative
    one parts pages and is in no run. `also` marks starts of runs that pages elsewhere have.

    The suffixes are ranked by their first 1, 2, 4 .. tokens; suffixes of one rank agree so far.
    """
    n = len(stream)
    if not n:
        return np.zeros(0, bool)
    rank = np.where(stream < 0, n + np.arange(n), stream)
    rank = np.unique(rank, return_inverse=True)[1]
    for i in range(doublings):
        after = np.full(n, -1, np.int64)
        following = rank[1 << i:]
        after[:len(following)] = following
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1]
    suffixes = np.argsort(rank, kind="stable")
    sorted_rank, at = rank[suffixes], page[suffixes]
    first = np.flatnonzero(np.r_[True, sorted_rank[1:] != sorted_rank[:-1]])
    several = np.minimum.reduceat(at, first) != np.maximum.reduceat(at, first)
    starts = suffixes[np.repeat(several, np.diff(np.r_[first, n]))]
    if also is not None:
        starts = np.union1d(starts, np.flatnonzero(also))
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + (1 << doublings), n), -1)
    return np.cumsum(change[:-1]) > 0


def _tokens(page: Page) -> Iterator[list[str]]:
    """The tokens of each block."""
    for block in page.blocks:
        yield [f"<{page.nodes[block.node].tag}/{block.tag}>", *block.text.split(" ")]


class Runs:
    """The runs of LONG tokens of pages, by hashes that agree among groups: the distinct ones in order, of each a page
    kind that has it and whether several do, and for each token the place of the run from there (-1: none). Pages with
    the same blocks are one kind."""

    def __init__(self, pages: list[Page]):
        hashes: dict[str, int] = {}
        stream: list[int] = []
        kind: list[np.ndarray] = []
        whole: list[np.ndarray] = []
        for page in pages:
            own = [hashes.setdefault(t, xxhash.xxh64_intdigest(t)) for tokens in _tokens(page) for t in tokens]
            stream += [*own, 0]
            n = len(own) + 1
            kind.append(np.full(n, xxhash.xxh64_intdigest(np.array(own, np.uint64).tobytes()), np.uint64))
            whole.append(np.arange(n) < n - LONG)
        values, kinds = np.array(stream, np.uint64), np.concatenate([*kind, np.zeros(0, np.uint64)])
        starts = np.flatnonzero(np.concatenate([*whole, np.zeros(0, bool)]))
        run = np.zeros(len(starts), np.uint64)
        for i in range(LONG):
            run = (run ^ values[starts + i]) * np.uint64(0x9E3779B97F4A7C15)
            run ^= run >> np.uint64(29)
        self.keys, place = np.unique(run, return_inverse=True)
        self.kind, high = np.full(len(self.keys), np.iinfo(np.uint64).max), np.zeros(len(self.keys), np.uint64)
        np.minimum.at(self.kind, place, kinds[starts])
        np.maximum.at(high, place, kinds[starts])
        self.several = self.kind != high
        self.place = np.full(len(values), -1, np.int64)
        self.place[starts] = place


def repeated_shares(pages: list[Page], elsewhere: np.ndarray | None = None) -> list[list[float]]:
    """For every block of every page the share of its tokens that are repeated. Pages with the same blocks are one page.
    `elsewhere` flags the runs (in the order of `Runs`) that distinct pages of other groups have."""
    words: dict[str, int] = {}
    kinds: dict[int, int] = {}
    stream: list[int] = []
    page_of: list[int] = []
    sizes: list[int] = []
    for page in pages:
        own = []
        for tokens in _tokens(page):
            own += [words.setdefault(token, len(words)) for token in tokens]
            sizes.append(len(tokens))
        kind = kinds.setdefault(hash(tuple(own)), len(kinds))
        stream += own
        stream.append(-1)
        page_of += [kind] * (len(own) + 1)
    also = None
    if elsewhere is not None:
        place = Runs(pages).place
        also = np.append(elsewhere, False)[place]
    marked = np.r_[0, np.cumsum(repeated_tokens(np.array(stream, np.int64), np.array(page_of, np.int64), also=also))]
    out, at, i = [], 0, 0
    for page in pages:
        shares = []
        for _ in page.blocks:
            shares.append(float(marked[at + sizes[i]] - marked[at]) / sizes[i])
            at += sizes[i]
            i += 1
        at += 1
        out.append(shares)
    return out


def main_blocks(page: Page, shares: list[float]) -> list[int]:
    """The blocks of the article."""
    left, here = _places(page)
    if here:
        heads = [i for i in left if page.blocks[i].tag == "h1" and i < here[0]]
        if any(page.blocks[i].tag == "h1" for i in here):
            heads = []
        return heads + [i for i in here if not (shares[i] >= REPEATED and page.blocks[i].linked >= LINKED)]
    return _by_repeats(page, shares, left)


def _places(page: Page) -> tuple[list[int], list[int]]:
    """The blocks outside containers that go, and of those the ones in an article or main element."""
    nodes = page.nodes
    gone, inside = _gone(page), [False] * len(nodes)
    left = [i for i, b in enumerate(page.blocks) if not gone[b.node]]
    named = _named(page, gone, left)
    for k, node in enumerate(nodes):
        inside[k] = k in named or (k > 0 and inside[node.parent])
    return left, [i for i in left if inside[page.blocks[i].node]]


def asks(page: Page) -> bool:
    """Whether it matters to the article what is repeated."""
    left, here = _places(page)
    return any(page.blocks[i].linked >= LINKED for i in here) if here else bool(left)


def _gone(page: Page) -> list[bool]:
    """Containers that are not the article's: by element, or by what their attributes say. One that holds most of the
    page's text and all its headings and articles is not what it says, but was never closed, or wraps the page."""
    nodes = page.nodes
    total, heads = nodes[0].chars, nodes[0].heads
    gone, in_article = [False] * len(nodes), [False] * len(nodes)
    for k, node in enumerate(nodes[1:], 1):
        in_article[k] = in_article[node.parent] or node.tag in ("article", "main")
        says = node.marked or node.tag in CHROME or node.tag == "form" or (node.tag == "header" and not in_article[node.parent])
        wraps = 2 * node.chars > total and heads and node.heads == heads
        gone[k] = gone[node.parent] or bool(says and not wraps)
    return gone


def _named(page: Page, gone: list[bool], left: list[int]) -> set[int]:
    """The article elements, or else the main element."""
    text = [0.0] * len(page.nodes)
    for i in left:
        block = page.blocks[i]
        text[block.node] += len(block.text) * (1 - block.linked)
    outer = [-1] * len(page.nodes)
    for k in range(len(page.nodes) - 1, 0, -1):
        text[page.nodes[k].parent] += text[k]
    found: dict[str, list[int]] = {"article": [], "main": []}
    for k, node in enumerate(page.nodes[1:], 1):
        outer[k] = outer[node.parent]
        if node.tag in found and not gone[k] and not node.marked and text[k] > 0:
            if node.tag == "main" or outer[k] < 0:
                found[node.tag].append(k)
            if node.tag == "article" and outer[k] < 0:
                outer[k] = k
    most = max((text[k] for k in found["article"]), default=0.0)
    articles = [k for k in found["article"] if text[k] >= SIDE * most]
    mains = found["main"]
    if articles and (not mains or 2 * sum(text[k] for k in articles) >= max(text[k] for k in mains)):
        return set(articles)
    return set(mains)


def _by_repeats(page: Page, shares: list[float], left: list[int]) -> list[int]:
    nodes, blocks = page.nodes, page.blocks
    weight = [0.0] * len(nodes)
    for i in left:
        weight[blocks[i].node] += len(blocks[i].text) * (1 - blocks[i].linked) * (FAINT if shares[i] >= REPEATED else 1)
    children: dict[int, list[int]] = {}
    for k in range(len(nodes) - 1, 0, -1):
        weight[nodes[k].parent] += weight[k]
        children.setdefault(nodes[k].parent, []).append(k)
    at = 0
    while True:
        best = max(children.get(at, ()), key=lambda k: weight[k], default=None)
        if best is None or weight[best] < MOST * weight[0] or not weight[best]:
            break
        at = best
    inside = [False] * len(nodes)
    for k, node in enumerate(nodes):
        inside[k] = k == at or (k > 0 and inside[node.parent])
    here = [i for i in left if inside[blocks[i].node]]
    heads = [i for i in left if blocks[i].tag == "h1" and shares[i] < REPEATED and not inside[blocks[i].node]]
    rich = [i for i in here if shares[i] < REPEATED and blocks[i].linked < LINKED]
    if not rich:
        return [i for i in here if blocks[i].linked < LINKED]
    places = {blocks[i].node for i in rich}
    kept = [i for i in here if rich[0] <= i <= rich[-1] and blocks[i].linked < LINKED
            and (shares[i] < REPEATED or blocks[i].node in places)]
    return sorted(heads + kept)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


_PAGE = "page_id long, url string, blocks array<string>"
_HELD = "host string, part long, range long, n long, keys binary, kind binary, kinds binary, several binary"
_SHARED = "host string, part long, range long, n long, shared binary"


def _parsed(group: pa.Table) -> list[Page]:
    return [parse(html or "") for html in group["html"].to_pylist()]


def _asking(pages: DataFrame) -> DataFrame:
    """The hosts with a page that asks for repeats."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = {h for h, html in zip(batch["host"].to_pylist(), batch["html"]) if asks(parse(html.as_py() or ""))}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(hosts), pa.string())], ["host"])

    return pages.select("host", "html").mapInArrow(ask, "host string").distinct()


def _held(group: pa.Table) -> pa.Table:
    """The distinct runs of a group, by range of their hashes."""
    host, part, parts = (group[c][0].as_py() for c in ("host", "part", "parts"))
    runs, ranges, rows = Runs(_parsed(group)), 1 + parts // RANGE_GROUPS, []
    of = (runs.keys >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)
    for r in np.unique(of).tolist():
        a, b = np.searchsorted(of, [r, r + 1]).tolist()
        kinds, kind = np.unique(runs.kind[a:b], return_inverse=True)
        rows.append((host, part, r, b - a, _small(runs.keys[a:b]), _small(kind.astype(np.uint64)), kinds.tobytes(),
                     np.packbits(runs.several[a:b]).tobytes()))
    return _rows(rows, _HELD)


def _shared(group: pa.Table) -> pa.Table:
    """For each group of a host, which of its runs in a range are on several kinds of pages."""
    rows = group.to_pylist()
    kind = np.concatenate([np.frombuffer(r["kinds"], np.uint64)[_large(r["kind"])] for r in rows])
    several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=r["n"]) for r in rows]).astype(bool)
    keys, place = np.unique(np.concatenate([_large(r["keys"]) for r in rows]), return_inverse=True)
    low, high = np.full(len(keys), np.iinfo(np.uint64).max), np.zeros(len(keys), np.uint64)
    np.minimum.at(low, place, kind)
    np.maximum.at(high, place, kind)
    found = low != high
    found[place[several]] = True
    flags, ends = found[place], np.cumsum([r["n"] for r in rows]).tolist()
    return _rows([(r["host"], r["part"], r["range"], r["n"], np.packbits(flags[e - r["n"]:e]).tobytes())
                  for r, e in zip(rows, ends)], _SHARED)


def _small(values: np.ndarray) -> bytes:
    """Numbers by byte significance, which compresses sorted and small ones well."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _large(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<u8").ravel()


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    fields = [field.split(" ") for field in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table([pa.array(list(c), _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def _extract(pages: pa.Table, marks: pa.Table) -> pa.Table:
    """The article's blocks of every page of a group."""
    parsed = _parsed(pages)
    elsewhere = None
    if marks.num_rows:
        elsewhere = np.concatenate([np.unpackbits(np.frombuffer(m["shared"], np.uint8), count=m["n"])
                                    for m in sorted(marks.to_pylist(), key=lambda m: m["range"])]).astype(bool)
    kept = [main_blocks(page, shares) for page, shares in zip(parsed, repeated_shares(parsed, elsewhere))]
    texts = [[page.blocks[i].text for i in found] for page, found in zip(parsed, kept)]
    return pages.select(["page_id", "url"]).append_column("blocks", pa.array(texts, pa.list_(pa.string())))


def main_text(pages: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """page_id, url, text, n_chars of every page: its article's blocks joined by two line feeds.

    A null or empty page, one without text outside markup and one that is all menus give an empty text; a null address
    counts as one host. Pages that repeat give a row each. A page is read whole, whatever its length, in one pass and
    alone in its group if it is large. Unclosed comments and scripts hide the page's rest, as in a browser. An empty
    table gives no rows. Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    bytes_of = F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long"))
    hosts = rows.groupBy("host").agg(bytes_of.alias("bytes"))
    hosts = stored(hosts.select("host", F.greatest(F.lit(1), F.ceil(F.col("bytes") / group_bytes)).cast("long").alias("parts")), "hosts")
    dealt = rows.join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), "parts").cast("long"))
    cut = dealt.where(F.col("parts") > 1)
    asking = stored(_asking(cut), "asking-hosts")
    held = cut.join(asking, "host", "left_semi").groupBy("host", "part").applyInArrow(_held, _HELD)
    shared = stored(held.groupBy("host", "range").applyInArrow(_shared, _SHARED), "shared-runs")
    found = (dealt.select("host", "part", "page_id", "url", "html").groupBy("host", "part")
             .cogroup(shared.groupBy("host", "part")).applyInArrow(_extract, _PAGE))
    text = F.array_join("blocks", "\n\n")
    return found.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
