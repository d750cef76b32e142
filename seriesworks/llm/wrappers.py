"""Main text of web pages by wrapper inference.

Pages of a host share a template.  A page's token stream, with side-by-side repeats
folded into groups, is a union-free regular expression for the page.  A host's wrapper
starts as the most common stream; every further stream is aligned with it: equal tokens
match, tokens that only one side has become optional groups, repeats are folded, texts
are slots.  Every stream takes part: a host with many is aligned in groups of streams,
and the groups' wrappers are aligned with each other, round by round, until one is left.
What a slot is, article or not, is then judged once for the wrapper: by
the elements around it, by the texts that it has on the host's pages, and, where a page
lacks the article's element, by the slots of other pages that it is aligned with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .arrow_text import lean
from .markup import fold, parse, roles
from .urls import host_of

#: Streams that one task aligns with each other, about, and wrappers of such groups.
STREAMS = 200
WRAPPERS = 16
#: Cells of an alignment that are held at a time, three bytes each.
CELLS = 1 << 24
#: Different pages with one text from which on a slot is template text.
CONSTANT_PAGES = 3
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold what authors write, and those of lists.
WRITTEN = {"p", "blockquote", "pre", "td", "th", "dt", "dd", "figcaption", "caption", "li"}
LISTS = {"li", "ul", "ol", "menu"}
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 32 << 20
BLOCKS = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))
STATS = pa.list_(pa.struct([("slot", pa.int32()), ("hash", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())]))


def _parsed(kept: list[str]):
    """Pages -> kept columns, host, stream hash, stream, choice without wrapper, blocks by slot, slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                keys, streams, alone, blocks, stats = [], [], [], [], []
                for html in part["__sw_html"]:
                    tokens, found = parse(html.as_py() or "")
                    signature, slots = fold(tokens, found)
                    stream = " ".join(signature)
                    keys.append(xxhash.xxh64_intdigest(stream) - (1 << 63))
                    streams.append(stream)
                    blocks.append([{"slot": s, "text": text} for s, (_, text, _) in zip(slots, found, strict=True)])
                    summary: dict[int, list] = {}
                    for s, (_, text, links) in zip(slots, found, strict=True):
                        own = summary.setdefault(s, [xxhash.xxh64(), 0, 0])
                        own[0].update(text + "\n")
                        own[1] += len(text)
                        own[2] += links
                    hashed = [(slot, h.intdigest() - (1 << 63), c, a) for slot, (h, c, a) in summary.items()]
                    whole, (mine,) = infer([(signature, 1, {slot: (1, h, h, c, a) for slot, h, c, a in hashed})])
                    alone.append(judge(signature, whole, mine))
                    stats.append([{"slot": slot, "hash": h, "chars": c, "links": a} for slot, h, c, a in hashed])
                columns = [part[c] for c in (*kept, "__sw_host")]
                columns += [pa.array(keys, pa.int64()), pa.array(streams, pa.string()), pa.array(alone, pa.string()), pa.array(blocks, BLOCKS), pa.array(stats, STATS)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "__sw_host", "__sw_key", "__sw_stream", "__sw_own", "__sw_blocks", "__sw_stats"])

    return run


def parsed(pages: DataFrame, url: str, html: str, kept: list[str]) -> DataFrame:
    """Pages with their token streams (see :func:`_parsed`); null markup is empty."""
    plain = pages.select(*kept, F.coalesce(host_of(F.col(url)), F.lit("")).alias("__sw_host"), F.col(html).alias("__sw_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*kept).schema)
    schema += f"{', ' if kept else ''}__sw_host string, __sw_key long, __sw_stream string, __sw_own string, __sw_blocks array<struct<slot: int, text: string>>, "
    schema += "__sw_stats array<struct<slot: int, hash: long, chars: long, links: long>>"
    return plain.mapInArrow(lean(_parsed(kept)), schema)


class Item:
    """A token of a wrapper and what is known of it."""

    FIELDS = "token string, pages long, optional boolean, core long, foreign long, chars long, links long, filled long, low long, high long"
    NAMES = [f.split()[0] for f in FIELDS.split(", ")]

    def __init__(self, token: str, pages: int = 0, optional: bool = False, core=0, foreign=0, chars=0, links=0, filled=0, low=None, high=None):
        self.token, self.pages, self.optional = token, pages, optional
        self.core, self.foreign, self.chars, self.links, self.filled = core, foreign, chars, links, filled
        self.low, self.high = low, high
        self.mark = 0

    def add(self, other: Item) -> None:
        """Take in what is known of an equal token of further streams."""
        self.optional |= other.optional
        for name in ("pages", "core", "foreign", "chars", "links", "filled"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.low is not None:
            self.low = other.low if self.low is None else min(self.low, other.low)
            self.high = other.high if self.high is None else max(self.high, other.high)


def read(tokens: list[str], pages: int, stats: dict) -> list[Item]:
    """The wrapper that is one stream, from its {slot: (pages, low, high, chars, links)}."""
    own = [Item(t, pages) for t in tokens]
    for i, (foreign, core) in roles(tokens).items():
        item = own[i]
        item.core, item.foreign = pages * (core and not foreign), pages * foreign
        item.filled, item.low, item.high, item.chars, item.links = stats.get(i, (0, None, None, 0, 0))
    return own


def blocks(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of equal runs, the longest ones chosen first."""
    return SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()


def longest(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """Like :func:`blocks`, by a longest common subsequence; of these, one with the fewest breaks.

    A wrapper that takes in streams this way gets little longer than its longest streams,
    however many they are, where chosen blocks let it grow with their number.
    """
    if len(a) > len(b):
        return [(i, j, n) for j, i, n in longest(b, a)]
    ids: dict[str, int] = {}
    x, y = (np.array([ids.setdefault(t, len(ids)) for t in tokens], np.int32) for tokens in (a, b))
    return [(i, j, 1) for i, j in _common(x, y)]


def _scores(x: np.ndarray, y: np.ndarray, unit: int, steps: tuple[np.ndarray, ...] = ()) -> np.ndarray:
    """Best score of all of x with each prefix of y: ``unit`` for a match, 1 for one right after another."""
    best, ends = np.zeros(len(y) + 1, np.int64), np.full(len(y) + 1, -1, np.int64)
    equal = {t: y == t for t in set(x.tolist())}
    for i, t in enumerate(x.tolist()):
        now = np.full(len(y) + 1, -1, np.int64)  # of alignments that end with this match
        np.maximum(best[:-1], ends[:-1] + 1, out=now[1:])
        now[1:] = np.where(equal[t], now[1:] + unit, -1)
        after = np.maximum.accumulate(np.maximum(best, now))
        if steps:
            taken, again, up = steps
            taken[i], again[i], up[i] = now[1:] == after[1:], ends[:-1] + 1 > best[:-1], best[1:] == after[1:]
        best, ends = after, now
    return best


def _common(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence."""
    unit, pairs = min(len(x), len(y)) + 1, []
    if len(x) > 1 and len(x) * len(y) > CELLS:  # the halves of x go with two parts of y
        half = len(x) // 2
        cut = int(np.argmax(_scores(x[:half], y, unit) + _scores(x[half:][::-1], y[::-1], unit)[::-1]))
        pairs = _common(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in _common(x[half:], y[cut:])]
    elif len(x) and len(y):
        taken, again, up = steps = tuple(np.zeros((len(x), len(y)), bool) for _ in range(3))
        _scores(x, y, unit, steps)
        i, j, held = len(x) - 1, len(y) - 1, False
        while i >= 0 and j >= 0:
            if held or taken[i, j]:
                pairs.append((i, j))
                held = again[i, j]
                i, j = i - 1, j - 1
            elif up[i, j]:
                i -= 1
            else:
                j -= 1
        pairs.reverse()
    return pairs


def merge(parts: list[list[Item]], matched: Callable) -> tuple[list[Item], list[list[Item]]]:
    """Align wrappers one after another: the wrapper of all, and its item of each item of each part."""
    wrapper: list[Item] = []
    placed: list[list[Item]] = []
    for own in parts:
        merged, mine, a, b = [], [], 0, 0
        found = matched([x.token for x in wrapper], [x.token for x in own]) if wrapper else []
        for i, j, size in [*found, (len(wrapper), len(own), 0)]:
            for item in wrapper[a:i]:
                item.optional = True
            for item in own[b:j]:
                item.optional |= bool(placed)
            for item, other in zip(wrapper[i : i + size], own[j : j + size], strict=True):
                item.add(other)
            merged += wrapper[a:i] + own[b:j] + wrapper[i : i + size]
            mine += own[b:j] + wrapper[i : i + size]
            a, b = i + size, j + size
        wrapper = merged
        placed.append(mine)
    return wrapper, placed


def infer(streams: list[tuple[list[str], int, dict]], matched: Callable = blocks) -> tuple[list[Item], list[list[Item]]]:
    """Align (tokens, pages, {slot: (pages, low, high, chars, links)}) one after another.

    Returns the wrapper and, for each stream, the wrapper's item of each token.
    """
    return merge([read(*stream) for stream in streams], matched)


def holders(tokens: list[str]) -> dict[int, str]:
    """Name of the innermost element around each text slot."""
    out, stack = {}, []
    for i, token in enumerate(tokens):
        if token == "#":
            out[i] = stack[-1].rstrip("!*") if stack else ""
        elif token[0] != "/":
            stack.append(token)
        elif token[1:] in stack:
            del stack[len(stack) - 1 - stack[::-1].index(token[1:]) :]
    return out


#: What a wrapper tells of a slot: it holds article texts; all its texts are equal while those of
#: other article slots, or of other slots that are not foreign, differ; that text also stands
#: outside of articles; it is mostly links.
ARTICLE, FIXED_IN_ARTICLE, FIXED, OUTSIDE, LINKED = 1, 2, 4, 8, 16


def mark(whole: list[Item]) -> None:
    """Set the marks of a host's whole wrapper."""
    texts = [x for x in whole if x.token == "#"]
    constant = lambda x: x.filled >= CONSTANT_PAGES and x.low == x.high
    outside = {x.low for x in texts if not x.core and constant(x)}
    fixed = FIXED_IN_ARTICLE * any(x.low != x.high for x in texts if x.core)
    fixed |= FIXED * any(x.low != x.high for x in texts if not x.foreign)
    for x in texts:
        x.mark = ARTICLE * bool(x.core) | fixed * constant(x) | OUTSIDE * (x.low in outside) | LINKED * (2 * x.links > x.chars)


def judge(tokens: list[str], whole: list[Item], items: list[Item]) -> str:
    """:func:`chosen` for a stream whose tokens are these items of the whole wrapper."""
    mark(whole)
    return chosen(tokens, [x.mark for x in items])


def chosen(tokens: list[str], marks: list[int]) -> str:
    """For each token ``1`` if it is a text of the article.

    A page with an article element has its texts there.  Of these go: texts that the host
    shows on all its pages, in plain containers or also outside of its articles, while other
    article slots differ; and list items that are mostly links.  Headings, paragraphs and
    the like that authors write stay, equal on all pages or not, and so do single links.

    Without an article element slots aligned with article texts of other pages count, and
    if there are none, all texts that are not foreign; slots that are mostly links on the
    host's pages are left out, and those with the same text on all pages.
    """
    own, inside = roles(tokens), holders(tokens)
    core = {i for i, (foreign, core) in own.items() if core and not foreign}
    plain = {i for i, (foreign, _) in own.items() if not foreign}
    kept = core or {i for i in plain if marks[i] & ARTICLE} or plain
    if core:
        template = lambda i: inside[i] not in HEADINGS and (inside[i] not in WRITTEN or marks[i] & OUTSIDE)
        kept = {
            i for i in kept if not (marks[i] & FIXED_IN_ARTICLE and template(i)) and not (inside[i] in LISTS and marks[i] & LINKED)
        }
    else:
        kept = {i for i in kept if not marks[i] & (FIXED | LINKED)}
    kept = kept or core  # an article of links alone is one
    return "".join("1" if i in kept else "0" for i in range(len(tokens)))


def expression(wrapper: list[Item]) -> str:
    """The wrapper as a regular expression over tokens; runs of optional tokens are one group."""
    out, open_ = [], False
    for item in wrapper:
        if item.optional != open_:
            out.append("(" if item.optional else ")?")
            open_ = item.optional
        out.append(item.token)
    return " ".join([*out, ")?"] if open_ else out)


ITEMS = f"array<struct<{', '.join(f.replace(' ', ': ') for f in Item.FIELDS.split(', '))}>>"


def _places(whole: list[Item], placed: list[list[Item]]) -> list[list[int]]:
    at = {id(x): i for i, x in enumerate(whole)}
    return [[at[id(x)] for x in mine] for mine in placed]


def _first(value, rows: int) -> list:
    return [value] + [None] * (rows - 1)


def _packed(whole: list[Item]) -> list[dict]:
    return [{name: getattr(x, name) for name in Item.NAMES} for x in whole]


def _of_streams(group: pd.DataFrame) -> pd.DataFrame:
    """Align a group of streams; they are judged if it has all streams of its host."""
    group = group.sort_values(["pages", "__sw_key"], ascending=[False, True])
    streams = []
    for stream, pages, slots in zip(group["stream"], group["pages"], group["slots"], strict=True):
        stats = {} if slots is None else {s["slot"]: (s["filled"], s["low"], s["high"], s["chars"], s["links"]) for s in slots}
        streams.append((stream.split(), int(pages), stats))
    out = pd.DataFrame({"host": group["__sw_host"], "key": group["__sw_key"], "node": group["node"], "nodes": group["nodes"]})
    rows, whole_host = len(out), out["nodes"].iloc[0] == 1
    whole, placed = infer(streams, blocks if whole_host else longest)
    if whole_host:
        mark(whole)
        out["wrapper"] = expression(whole)
        out["chosen"] = [chosen(tokens, [x.mark for x in mine]) for (tokens, _, _), mine in zip(streams, placed, strict=True)]
        out["stream"] = out["place"] = out["items"] = None
    else:
        out["wrapper"] = out["chosen"] = None
        out["stream"], out["place"] = group["stream"], _places(whole, placed)
        out["items"] = _first(_packed(whole), rows)
    return out


def _of_wrappers(group: pd.DataFrame) -> pd.DataFrame:
    """Align wrappers of groups; their items are marked if these are all groups of their host."""
    group = group.sort_values("child")
    whole, placed = merge([[Item(**dict(zip(Item.NAMES, (x[n] for n in Item.NAMES), strict=True))) for x in items] for items in group["items"]], longest)
    out = group[["host", "child", "node", "nodes"]].copy()
    if out["nodes"].iloc[0] == 1:
        mark(whole)
        out["wrapper"] = _first(expression(whole), len(out))
        out["marks"] = [[x.mark for x in mine] for mine in placed]
        out["place"] = out["items"] = None
    else:
        out["wrapper"] = out["marks"] = None
        out["place"] = _places(whole, placed)
        out["items"] = _first(_packed(whole), len(out))
    return out


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["chosen"] = [chosen(stream.split(), marks) for stream, marks in zip(b["stream"], b["marks"], strict=True)]
        yield b[["host", "key", "chosen"]]


def _passed_down(children: DataFrame, marks: DataFrame, *kept: str) -> DataFrame:
    """The marks of children's items, from those of the wrappers that these became part of."""
    joined = children.join(marks, ["host", "node"])
    return joined.select("host", *kept, F.transform("place", lambda i: F.get("marks", i)).alias("marks"))


def wrappers(marked: DataFrame, streams: int | None = None, group: int = STREAMS) -> DataFrame:
    """(host, key, wrapper, chosen) for the streams of each host, from the output of :func:`parsed`.

    Pages are summed up by host, stream and slot first, so there is one row for each
    stream of a host, whatever the number of its pages.  Hosts of more than ``group``
    streams are aligned in groups by the streams' hashes; the groups' wrappers are aligned
    with each other, sixteen in a task, until a host has one, and what it tells of
    its slots goes back the same way.  All streams count; ``streams`` is for callers who want
    each host's wrapper from so many of its most common ones, and no rows for others.
    """
    same = F.xxhash64(F.transform("__sw_stats", lambda x: F.struct(x["slot"], x["hash"])))
    # copies of a page say nothing about what is constant
    marked = marked.groupBy("__sw_host", "__sw_key", same.alias("__sw_same")).agg(F.first("__sw_stream").alias("__sw_stream"), F.first("__sw_stats").alias("__sw_stats"))
    counted = marked.groupBy("__sw_host", "__sw_key").agg(F.count(F.lit(1)).alias("pages"), F.max("__sw_stream").alias("stream"))
    if streams is not None:
        rank = F.row_number().over(Window.partitionBy("__sw_host").orderBy(F.desc("pages"), "__sw_key"))
        counted = counted.withColumn("__sw_rank", rank).filter(F.col("__sw_rank") <= streams).drop("__sw_rank")
    slots = (
        marked.select("__sw_host", "__sw_key", F.explode("__sw_stats").alias("s"))
        .groupBy("__sw_host", "__sw_key", "s.slot")
        .agg(F.count(F.lit(1)).alias("filled"), F.min("s.hash").alias("low"), F.max("s.hash").alias("high"),
             F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links"))
        .groupBy("__sw_host", "__sw_key")  # one row for each slot of a stream
        .agg(F.collect_list(F.struct("slot", "filled", "low", "high", "chars", "links")).alias("slots"))
    )
    many = counted.groupBy("__sw_host").agg(F.ceil(F.count(F.lit(1)) / group).alias("nodes")).filter("nodes > 1")
    many = cut_lineage(many)
    hosts, most = many.agg(F.count(F.lit(1)), F.max("nodes")).first()
    rows = counted.join(slots, ["__sw_host", "__sw_key"], "left")
    rows = rows.join(F.broadcast(many) if hosts <= BROADCAST_ROWS else many, "__sw_host", "left").withColumn("nodes", F.coalesce("nodes", F.lit(1)))
    rows = rows.withColumn("node", F.pmod("__sw_key", "nodes"))
    shape = f"host string, key long, node long, nodes long, wrapper string, chosen string, stream string, place array<int>, items {ITEMS}"
    first = rows.groupBy("__sw_host", "node").applyInPandas(_of_streams, shape)
    if not hosts:
        return first.select("host", "key", "wrapper", "chosen")

    first = cut_lineage(first)
    shape = f"host string, child long, node long, nodes long, wrapper string, place array<int>, marks array<int>, items {ITEMS}"
    rounds = [first]
    while most > 1:
        most = -(-most // WRAPPERS)
        below = rounds[-1].filter("items IS NOT NULL").select("host", F.col("node").alias("child"), F.ceil(F.col("nodes") / WRAPPERS).alias("nodes"), "items")
        below = below.withColumn("node", F.pmod("child", "nodes"))
        rounds.append(cut_lineage(below.groupBy("host", "node").applyInPandas(_of_wrappers, shape)))
    marks = None
    for done in reversed(rounds[1:]):
        whole = done.filter("marks IS NOT NULL").select("host", F.col("child").alias("node"), "marks")
        if marks is not None:
            inner = _passed_down(done.filter("place IS NOT NULL").select("host", "child", "node", "place"), marks, "child")
            whole = whole.unionByName(inner.withColumnRenamed("child", "node"))
        marks = whole
    known = _passed_down(first.filter("place IS NOT NULL").select("host", "key", "node", "stream", "place"), marks, "key", "stream")
    judged = known.mapInPandas(_judged, "host string, key long, chosen string")
    whole = rounds[1].filter("wrapper IS NOT NULL").select("host", "wrapper")
    for done in rounds[2:]:
        whole = whole.unionByName(done.filter("wrapper IS NOT NULL").select("host", "wrapper"))
    judged = judged.join(F.broadcast(whole) if hosts <= BROADCAST_ROWS else whole, "host").select("host", "key", "wrapper", "chosen")
    return first.filter("chosen IS NOT NULL").select("host", "key", "wrapper", "chosen").unionByName(judged)


def extract(pages: DataFrame, url: str = "url", html: str = "html", streams: int | None = None, group: int = STREAMS) -> DataFrame:
    """The columns of ``pages`` but the markup, with ``text`` and ``n_chars``.

    ``text`` joins the article's blocks by newlines; character references are decoded
    and white space within a block is one blank.  Null and empty pages have an empty
    text, and so have pages without an article; a null URL is the empty host.  Result
    columns replace columns of the same names.  ``streams`` and ``group`` are those of
    :func:`wrappers`; pages whose stream is left out by ``streams`` are judged by it alone.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    # written once, without texts: it is read for the streams and for their slots
    summary = cut_lineage(parsed(pages, url, html, []).select("__sw_host", "__sw_key", "__sw_stream", "__sw_stats"))
    found = cut_lineage(wrappers(summary, streams, group).select(F.col("host").alias("__sw_h"), F.col("key").alias("__sw_k"), F.col("chosen").alias("__sw_chosen")))
    rows, chars = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("__sw_chosen")), F.lit(0))).first()
    small = rows <= BROADCAST_ROWS and chars <= BROADCAST_CHARS
    marked = parsed(pages, url, html, kept)
    joined = marked.join(F.broadcast(found) if small else found, (F.col("__sw_host") == F.col("__sw_h")) & (F.col("__sw_key") == F.col("__sw_k")), "left")

    choice = F.coalesce("__sw_chosen", "__sw_own")
    kept_blocks = F.filter("__sw_blocks", lambda x: F.substring(choice, x["slot"] + 1, F.lit(1)) == "1")
    text = F.array_join(F.transform(kept_blocks, lambda x: x["text"]), "\n")
    return joined.withColumn("text", text).select(*kept, "text", F.length("text").cast("long").alias("n_chars"))
