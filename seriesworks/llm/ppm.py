"""Prediction by partial matching over bytes, with frozen counts.

A text's bytes are predicted from the longest known context of at most ``depth``
bytes.  A symbol not seen there is reached by an escape to the next shorter context, in
which the symbols of the longer one are excluded.  With counts n(c, s), kept symbols
S(c), a discount d (one half: method D) and escape weight E(c) = d for each symbol of
S(c) + the occurrences of other symbols,

    P(s | c) = (n(c, s) - d) / A(c)   if s is in S(c) and not excluded,
    P(escape | c) = E'(c) / A(c),   A(c) = E'(c) + the other numerators,

where E'(c) leaves out the excluded symbols.  Below the empty context all byte values
not seen are equally likely.  The byte 255, which UTF-8 never uses, stands before a
text's start and ends it, so the probabilities of all texts sum to one.

Since S(c) is a subset of the symbols of every shorter context, an escape's effect on
the next context depends on the context alone.  All of that is worked out once: a
lookup of the last bytes gives the logarithm of the probability.  Several models share
one trie, with a column each.  A single model with every gram of any corpus is dealt into
buckets of contexts instead: blocks of documents send their grams (:func:`block_packets`)
and get their probabilities back (:func:`packet_logs`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import LOWER, chunks, lean, mixed
from .packing import pack, pack_sorted, unpack, unpack_sorted

EDGE = 255
#: Taken off each kept symbol's count and given to the escape.
DISCOUNT = 0.5
#: Groups that the longest grams are dealt into; grams that a task holds at most.
BUCKETS, HELD = 128, 1 << 21
#: Context bytes of the table that all buckets share; the bucket number that its counts go by.
HEAD, SHORT = 2, -2
NODES = "model int, order int, gram long, n long, total long"
EMPTY = np.uint64(2**64 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mask(order: int) -> np.uint64:
    """Bits of a symbol and ``order`` bytes before it."""
    return np.uint64((1 << 8 * (order + 1)) - 1)


def gram_keys(raw: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, offsets): the last ``depth + 1`` bytes at each byte and at each row's end.

    The lowest byte of a key is the symbol, the one above it the byte before.
    """
    rows, gap = len(at) - 1, depth + 1
    padded = np.full(len(raw) + rows * gap + depth, EDGE, np.uint8)
    shift = np.repeat(np.arange(rows) * gap + depth, np.diff(at))
    own = np.arange(len(raw)) + shift
    padded[own] = raw
    keys = np.zeros(len(padded) - depth, np.uint64)
    for j in range(depth, -1, -1):
        keys <<= np.uint64(8)
        keys |= padded[depth - j : len(padded) - j]
    # keys[i] ends at padded[i + depth]; row r's symbols are at at[r] + r * gap .. at[r + 1] + r * gap
    starts = at[:-1] + np.arange(rows) * gap
    sizes = np.diff(at) + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    pick = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return keys[pick], offsets


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal keys; keys come sorted."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], np.add.reduceat(counts, cut) if len(cut) else counts


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys, by sorting: ``np.unique`` hashes instead, ten times slower on millions of keys."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def gram_counts(docs: DataFrame, depth: int, model: str, text: str = "text") -> DataFrame:
    """(bucket, model, grams, counts): packed counts of the longest grams, from each task.

    ``model`` is an integer column that tells which model learns from the row.  Letters
    A to Z are lower-cased.  A bucket has all grams with the same two bytes before the
    symbol, so contexts of two bytes and more lie in one bucket.
    """

    def packed(m: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, n = merged(parts)
        bucket = (mixed((keys >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(BUCKETS)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, n, bucket = keys[order], n[order], bucket[order]
        cut = np.searchsorted(bucket, np.arange(BUCKETS + 1))
        spans = [(i, slice(lo, hi)) for i, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False)) if hi > lo]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in spans], pa.int32()), pa.array([m] * len(spans), pa.int32()),
                pa.array([pack_sorted(keys[s]) for _, s in spans], pa.binary()),
                pa.array([pack(n[s].astype(np.int64)) for _, s in spans], pa.binary()),
            ],
            names=["bucket", "model", "grams", "counts"],
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            owner = b["__sw_model"].to_numpy(zero_copy_only=False)
            for m in np.unique(owner):
                rows = b["__sw_text"].filter(pa.array(owner == m))
                parts = held.setdefault(int(m), [])
                for _, _, raw, at in chunks(rows):
                    parts.append(np.unique(gram_keys(LOWER[raw], at, depth)[0], return_counts=True))
                    if len(parts) >= 8 and sum(len(k) for k, _ in parts[1:]) > max(1 << 19, len(parts[0][0])):
                        parts[:] = [merged(parts)]
                        if len(parts[0][0]) > HELD:
                            yield from packed(int(m), parts)
                            parts.clear()
        for m, parts in held.items():
            if parts:
                yield from packed(m, parts)

    plain = docs.select(F.col(model).cast("int").alias("__sw_model"), F.coalesce(F.col(text), F.lit("")).alias("__sw_text"))
    return plain.mapInArrow(lean(counted), "bucket int, model int, grams binary, counts binary")


def learn(docs: DataFrame, depth: int, least: float, model: str, text: str = "text") -> pa.Table:
    """The trie's nodes: (model, order, gram, n, total), n being at least ``least`` of the model's symbols.

    ``total`` are the occurrences of the node's context, whatever symbol follows.  All
    documents are counted.  A threshold relative to the corpus bounds the nodes of a
    model: at most ``1 / least`` for each order, and 65,536 for contexts of one byte.
    """
    size = F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1)
    sizes = {r[model]: r["n"] for r in docs.groupBy(model).agg(size.alias("n")).collect()}  # one row a model

    def nodes_of(group: pa.Table) -> pa.Table:
        owner, out = group["model"].to_numpy(), []
        for m in np.unique(owner):
            rows = np.flatnonzero(owner == m).tolist()
            keys, n = merged([
                (unpack_sorted(group["grams"][i].as_py(), np.uint64), unpack(group["counts"][i].as_py(), np.int64)) for i in rows
            ])
            for order in range(depth, 0, -1):
                keys, n = merged([(keys & mask(order), n)])
                # a context of one byte may have symbols in other buckets
                out.append(_nodes(int(m), order, keys, n, least * sizes[int(m)] if order > 1 else 0))
        return pa.concat_tables(out)

    found = gram_counts(docs, depth, model, text).groupBy("bucket").applyInArrow(nodes_of, NODES).toArrow()
    short = found["order"].to_numpy() == 1
    parts = [found.filter(pa.array(~short))]
    for m, whole in sizes.items():
        mine = short & (found["model"].to_numpy() == m)
        keys, n = merged([(found["gram"].to_numpy()[mine].view(np.uint64), found["n"].to_numpy()[mine])])
        for order in (1, 0) if depth else (0,):
            keys, n = merged([(keys & mask(order), n)])
            parts.append(_nodes(m, order, keys, n, least * whole))
    return pa.concat_tables(parts)


def _nodes(model: int, order: int, keys: np.ndarray, n: np.ndarray, least: float) -> pa.Table:
    """Nodes of one order with at least ``least`` occurrences; keys are sorted and distinct."""
    cut = np.flatnonzero(np.r_[True, (keys[1:] ^ keys[:-1]) > 255]) if len(keys) else np.zeros(0, np.int64)
    total = np.repeat(np.add.reduceat(n, cut), np.diff(np.append(cut, len(keys)))) if len(cut) else n
    kept = n >= least
    rows = int(kept.sum())
    columns = [np.full(rows, model, np.int32), np.full(rows, order, np.int32), keys[kept].view(np.int64), n[kept], total[kept]]
    return pa.table(dict(zip(("model", "order", "gram", "n", "total"), columns, strict=True)))


def reversed_contexts(keys: np.ndarray) -> np.ndarray:
    """Keys of :func:`gram_keys` (at most six bytes before the symbol) with the last byte of the context first.

    The symbol stays lowest, so the keys of a context and of all longer ones are neighbours when sorted.
    """
    return (keys.byteswap() & np.uint64((1 << 56) - 1)) | (keys & np.uint64(255))


def shorter(keys: np.ndarray, order: int) -> np.ndarray:
    """Reversed keys cut to ``order`` bytes of context."""
    return (keys & ~np.uint64((1 << 56 - 8 * order) - 1)) | (keys & np.uint64(255))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Reversed keys that agree in one byte more than ``HEAD`` share a bucket."""
    return (mixed(keys >> np.uint64(48 - 8 * HEAD)) % np.uint64(buckets)).astype(np.int32)


def root_level(keys: np.ndarray, n: np.ndarray) -> dict:
    """Probabilities after the empty context, for each byte value of ``keys``."""
    total, types = n.sum(), (n > 0).sum()
    left = np.log(DISCOUNT * types / total) if total else 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        log = np.where(n > 0, np.log((n - DISCOUNT) / total), left - np.log(max(256 - types, 1)))
    escape = np.full(len(keys), DISCOUNT * types)
    return {"keys": keys, "n": n, "log": log, "kept": total - escape, "escape": escape}


def next_level(below: dict, keys: np.ndarray, n: np.ndarray, order: int) -> dict:
    """Probabilities of the sorted keys of one order, from those with a context shorter by one byte.

    ``log`` is the natural logarithm of a symbol's probability after its context, ``kept``
    and ``escape`` are the context's.
    """
    if not len(keys):
        return {"keys": keys, "n": n, "log": np.zeros(0), "kept": np.zeros(0), "escape": np.zeros(0)}
    up = np.searchsorted(below["keys"], shorter(keys, order - 1))
    context = keys >> np.uint64(56 - 8 * order)
    cut = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    size, first, seen, up_n = np.diff(np.append(cut, len(keys))), up[cut], n > 0, below["n"][up]
    total, types = np.add.reduceat(n, cut), np.add.reduceat(seen.astype(np.int64), cut)
    excluded = np.add.reduceat(np.where(seen, up_n - DISCOUNT, 0.0), cut)
    escape = DISCOUNT * types
    kept, up_kept, up_escape = total - escape, below["kept"][first], below["escape"][first]
    rest = np.maximum(up_escape - escape, DISCOUNT / 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        leave = np.log(escape / total) + np.log((up_kept + up_escape) / (np.maximum(up_kept - excluded, 0.0) + rest))
        past = leave + np.log(rest / up_escape)
        direct = np.log((n - DISCOUNT) / np.repeat(total, size))
    known = total > 0  # an unknown context costs nothing
    leave, past = np.repeat(np.where(known, leave, 0.0), size), np.repeat(np.where(known, past, 0.0), size)
    log = np.where(seen, direct, below["log"][up] + np.where(up_n > 0, leave, past))
    return {"keys": keys, "n": n, "log": log, "kept": np.repeat(kept, size), "escape": np.repeat(escape, size)}


def block_packets(keys: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, keys, counts) of a block's distinct reversed keys, and the counts of its short ones as bucket ``SHORT``."""
    yield SHORT, *_packed(*merged([(shorter(keys, HEAD), n)]))
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, n, bucket = keys[order], n[order], bucket[order]
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, np.int64)
    for lo, hi in zip(cut, np.append(cut[1:], len(keys)), strict=True):
        yield int(bucket[lo]), *_packed(keys[lo:hi], n[lo:hi])


def _packed(keys: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return pack_sorted(keys), pack(n.astype(np.int64))


def _unpacked(keys: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    return unpack_sorted(keys, np.uint64), unpack(n, np.int64)


def head(packets: DataFrame, depth: int) -> dict:
    """Probabilities after all contexts of ``HEAD`` bytes, or of ``depth`` where that is less.

    UTF-8 has about four million windows of three bytes, a text corpus some hundred thousand:
    that bounds what the driver holds and sends to the workers, whatever the input.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for b in batches:
            parts += [_unpacked(k.as_py(), c.as_py()) for k, c in zip(b["keys"], b["counts"], strict=True)]
            parts = [merged(parts)] if parts else []
        for keys, n in parts:
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["g", "n"])

    short = packets.filter(F.col("bucket") == SHORT).select("keys", "counts").mapInArrow(counts, "g long, n long")
    found = short.groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    keys, n = merged([(found["g"].to_numpy().view(np.uint64), found["n"].to_numpy())])
    below = root_level(*merged([(shorter(keys, 0), n)]))
    for order in range(1, min(HEAD, depth) + 1):
        below = next_level(below, *merged([(shorter(keys, order), n)]), order)
    return below


def packet_logs(packets: DataFrame, depth: int) -> DataFrame:
    """(block, bucket, logs): log probabilities for the keys of every packet, in their order.

    A bucket has all longer contexts of its own, so all orders are worked out in one
    group, with no gram left out.  Packets stay compressed but for the one being merged.
    """
    first = packets.sparkSession.sparkContext.broadcast(head(packets, depth))

    def solve(group: pa.Table) -> pa.Table:
        owner, held = group["block"], list(zip(group["keys"].to_pylist(), group["counts"].to_pylist(), strict=True))
        parts: list = []
        for packet in held:
            parts.append(_unpacked(*packet))
            if len(parts) >= 8 and sum(len(k) for k, _ in parts[1:]) > max(1 << 19, len(parts[0][0])):
                parts = [merged(parts)]
        levels = [merged(parts)]
        for order in range(depth - 1, HEAD, -1):
            levels.append(merged([(shorter(levels[-1][0], order), levels[-1][1])]))
        below = first.value
        for order in range(HEAD + 1, depth + 1):
            below = next_level(below, *levels.pop(), order)
        logs = below["log"].astype(np.float32)
        # whole values, not their planes, since few values are frequent
        out = [pack(logs[np.searchsorted(below["keys"], unpack_sorted(keys, np.uint64))].view(np.uint8), 3) for keys, _ in held]
        return pa.table({"block": owner, "bucket": group["bucket"], "logs": pa.array(out, pa.binary())})

    return packets.filter("bucket >= 0").groupBy("bucket").applyInArrow(solve, "block long, bucket int, logs binary")


class Lookup:
    """Open addressing, at most half full: the row of each key, or -1."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2))))
        self.slots = np.full((1 << self.bits) + 1, EMPTY, np.uint64)
        self.rows = np.full((1 << self.bits) + 1, -1, np.int32)
        todo = np.arange(len(keys))
        at = self._home(keys)
        while len(todo):
            free = self.slots[at[todo]] == EMPTY
            self.slots[at[todo[free]]] = keys[todo[free]]
            self.rows[at[todo[free]]] = todo[free]
            todo = todo[self.slots[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        held = self.slots[at]
        out = np.where(held == keys, self.rows[at], np.int32(-1))
        todo = np.flatnonzero((held != keys) & (held != EMPTY))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            held = self.slots[at[todo]]
            good = held == keys[todo]
            out[todo[good]] = self.rows[at[todo[good]]]
            todo = todo[~good & (held != EMPTY)]
        return out


class Trie:
    """Log probabilities (natural) of bytes after their contexts, a column for each model."""

    def __init__(self, nodes: pa.Table, models: int, depth: int):
        """``nodes`` as returned by :func:`learn`, models numbered from zero."""
        self.depth, self.models = depth, models
        column = {c: nodes[c].to_numpy() for c in nodes.column_names}
        self.grams, self.logs, self.seen = [None], [], []
        self.contexts, self.escape_seen, self.escape_past = [None], [None], [None]
        below = None
        for order in range(depth + 1):
            mine = np.flatnonzero(column["order"] == order)
            keys, slot = np.unique(column["gram"][mine].view(np.uint64), return_inverse=True)
            n = np.zeros((len(keys), models))
            n[slot, column["model"][mine]] = column["n"][mine]
            contexts, first = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kept, types = (np.zeros((len(contexts), models)) for _ in range(3))
            where = (first[slot], column["model"][mine])
            total[where] = column["total"][mine]
            np.add.at(kept, first, n)
            np.add.at(types, first, n > 0)
            kept -= DISCOUNT * types
            n = n - DISCOUNT * (n > 0)
            escape = total - kept
            if order == 0:
                below = self._root(keys, n, kept, escape, types)
                continue
            parent = np.searchsorted(below["keys"], keys & mask(order - 1))
            up = np.searchsorted(below["contexts"], contexts & (mask(order - 1) >> np.uint64(8)))
            excluded = np.zeros_like(kept)
            np.add.at(excluded, first, np.where(n > 0, below["n"][parent], 0))  # both discounted
            known = total > 0
            open_ = np.maximum(below["kept"][up] - excluded, 0)
            escape_up = below["escape"][up]
            rest = np.maximum(escape_up - DISCOUNT * types, DISCOUNT / 2)
            with np.errstate(divide="ignore", invalid="ignore"):
                leave = np.log(escape / (kept + escape))
                whole = np.log((below["kept"][up] + escape_up) / (open_ + rest))
                seen_up = np.where(known, leave + whole, 0.0)
                past_up = np.where(known, leave + whole + np.log(rest / escape_up), 0.0)
                direct = np.log(n / (kept + escape)[first])
            passed = np.where(below["seen"][parent], seen_up[first], past_up[first]) + below["logs"][parent]
            logs = np.where(n > 0, direct, passed)
            self.grams.append(Lookup(keys))
            self.logs.append(logs.astype(np.float32))
            self.seen.append(n > 0)
            self.contexts.append(Lookup(contexts))
            none = np.zeros((1, models))  # row -1: an unknown context costs nothing
            self.escape_seen.append(np.concatenate([seen_up, none]).astype(np.float32))
            self.escape_past.append(np.concatenate([past_up, none]).astype(np.float32))
            below = {"keys": keys, "n": n, "contexts": contexts, "kept": kept, "escape": escape, "seen": n > 0, "logs": logs}

    def _root(self, keys, n, kept, escape, types) -> dict:
        """The empty context over all byte values, and equal shares of what it leaves."""
        shape = (256, self.models)
        counts, whole = np.zeros(shape), np.zeros((1, self.models))
        counts[keys.astype(np.int64)] = n
        if len(kept):
            whole = kept + escape
        else:
            kept = escape = types = np.zeros((1, self.models))
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.log(counts / whole)
            leave = np.where(whole > 0, np.log(np.maximum(escape, 1e-300) / whole), 0.0)
            past = leave - np.log(np.maximum(256 - types, 1))
        logs = np.where(counts > 0, direct, past)
        self.logs.append(logs.astype(np.float32))
        self.seen.append(counts > 0)
        return {"keys": np.arange(256, dtype=np.uint64), "n": counts, "contexts": np.zeros(1, np.uint64), "kept": kept,
                "escape": np.maximum(escape, 1e-9), "seen": counts > 0, "logs": logs}

    def arrays(self) -> dict:
        """Plain arrays, to be sent to the workers."""
        table = lambda t: t and (t.bits, t.slots, t.rows)
        return vars(self) | {"grams": [table(t) for t in self.grams], "contexts": [table(t) for t in self.contexts]}

    @classmethod
    def from_arrays(cls, held: dict) -> Trie:
        trie = cls.__new__(cls)
        trie.__dict__.update(held)
        for name in ("grams", "contexts"):
            tables = []
            for parts in held[name]:
                table = parts and Lookup.__new__(Lookup)
                if table:
                    table.bits, table.slots, table.rows = parts
                tables.append(table)
            setattr(trie, name, tables)
        return trie

    def log_probability(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(rows, models): log probability of each row's bytes and its end."""
        keys, offsets = gram_keys(LOWER[raw], at, self.depth)
        out = np.zeros((len(keys), self.models), np.float32)
        todo, seen_up, past_up = np.arange(len(keys)), None, None
        for order in range(self.depth, 0, -1):
            mine = keys[todo] & mask(order) if len(todo) < len(keys) or order < self.depth else keys
            row = self.grams[order].find(mine)
            hit = row >= 0
            found, own = row[hit], todo[hit]
            if seen_up is None:
                out[own] = self.logs[order][found]
            else:
                out[own] += self.logs[order][found] + np.where(self.seen[order][found], seen_up[hit], past_up[hit])
                out[todo[~hit]] += past_up[~hit]
            todo, mine = todo[~hit], mine[~hit]
            row = self.contexts[order].find(mine >> np.uint64(8))
            seen_up, past_up = self.escape_seen[order][row], self.escape_past[order][row]
        symbol = (keys[todo] & np.uint64(255)).astype(np.int64)
        last = self.logs[0][symbol]
        if seen_up is not None:
            last = last + np.where(self.seen[0][symbol], seen_up, past_up)
        out[todo] += last
        return np.add.reduceat(out, offsets[:-1], axis=0, dtype=np.float64)
