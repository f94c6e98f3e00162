"""Repeated-substring dedup by bucket-pointer refinement.

Every byte covered by an ``n``-byte string that also starts in a document with a smaller id is
removed; strings are judged on the input, overlaps count.  In a suffix array that question is: which
suffixes share a bucket of depth n.  Suffixes first fall into buckets by a q-gram; a bucket is then
refined by sorting on the bucket identifiers at a later offset, and the refined identifiers are used again in the
next step, so the depth doubles (8, 16, 32, 50 bytes).

Only some suffixes are listed.  Among the q-grams inside an n-byte string the one with the smallest hash
is its anchor, so equal strings have equal anchors: two documents share an n-byte string only
if an anchor of it is in both.

1. Copies: equal texts are one bucket at any depth; all but the smallest id go whole.
2. Initial buckets: the anchors' q-grams, repartitioned and sorted; a streaming reducer keeps those
   that two documents share.
3. Each kept anchor takes the bytes around it that n-byte strings through it can reach.  Equal
   surroundings of one task are one bucket already: only their smallest id goes on.
4. Refinement: in the rows of whole anchor buckets, every offset of every surrounding is a suffix.  Their buckets
   are refined up to depth n, and the smallest id in a string's bucket decides.  An anchor that stands for over ``max_bucket`` rows is never routed by its q-gram: step 2
   counts them, their rows are dealt evenly, tasks compare the strings they hold, and the strings with a
   task's smallest id become rows keyed by 128 bits of hash for an aggregate with map-side combine.
5. The removed ranges meet their documents, and the remaining bytes are put together.

Defined results: a null text is empty; texts under n bytes lose nothing; rows that repeat an id repeat its
text and do not remove each other; a row with a null id loses nothing and removes nothing; an empty
table gives an empty result; other columns are not read; the ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.llm.shingles import mix, texts_of
from indexforge.llm.text import dropped, stored

Q = 24
#: Bytes of the grams that name the initial buckets of the refinement.
START = 8
_RNG = np.random.default_rng(20261)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)
_K = [np.uint64(pow(0x9E3779B97F4A7C15, 2 ** k, 2 ** 64)) for k in range(5)]
#: Rows of refinement sorted at once.
ROWS_AT_ONCE = 30_000


def qgrams(b: np.ndarray) -> np.ndarray:
    """Hashes of the 24-byte strings at every position."""
    h = [_BYTE[b]]
    for k in range(4):  # 2, 4, 8 and 16 bytes
        h.append(h[-1][:-(1 << k)] * _K[k] + h[-1][1 << k:])
    return mix(h[4][:len(b) - Q + 1] * _K[3] + h[3][16:16 + len(b) - Q + 1])


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours."""
    m, have = x, 1
    while have * 2 <= width:
        m, have = op(m[:-have], m[have:]), have * 2
    return op(m[:len(x) - width + 1], m[width - have:]) if have < width else m


def anchors(b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the q-grams that are the smallest in some n-byte string."""
    if len(b) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, w = qgrams(b), n - Q + 1
    low = _slide(h, w, np.minimum)
    # a q-gram is an anchor if the largest of the minima over it is its own hash
    pad = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([pad, low, pad]), w, np.maximum) == h)
    return at, h[at]


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = texts_of(column)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield data[a:b]


def _all_anchors(n: int, flush: int = 300_000):
    """(g, id, t, n) of every anchor.  A q-gram that two documents of the task's last ``flush`` rows share is
    known to be shared: its rows only pass through the shuffle, spread evenly (marked by t < 0), and
    the smallest and largest id stand for them under g, with their number n, however many documents hold it."""
    def rows(g: np.ndarray, ids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(g, kind="stable")
        g, ids, at = g[order], ids[order], at[order].astype(np.int32)
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        low, high = np.minimum.reduceat(ids, start), np.maximum.reduceat(ids, start)
        two = low < high
        known = np.repeat(two, np.diff(np.append(start, len(g))))
        own = np.where(known, mix(ids.view(np.uint64) * np.uint64(31) + at.astype(np.uint64)), g)
        # any position of the two ids will do: their rows are there already
        both = [np.flatnonzero(known & (ids == np.repeat(x, np.diff(np.append(start, len(g)))))) for x in (low, high)]
        both = [x[np.unique(g[x], return_index=True)[1]] for x in both]
        extra, size = np.concatenate(both), np.repeat(np.diff(np.append(start, len(g))), np.diff(np.append(start, len(g))))
        many = np.concatenate([np.where(known, 0, 1), size[both[0]], np.zeros(len(both[1]), np.int64)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([own, g[extra]]).view(np.int64)), pa.array(np.concatenate([ids, ids[extra]])),
             pa.array(np.concatenate([np.where(known, -at - 1, at), at[extra]]).astype(np.int32)),
             pa.array(many.astype(np.int32))], names=["g", "id", "t", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, g, ids, at, count = set(), [], [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), _texts(b.column(1)), strict=True):
                if len(t) < n:
                    continue
                name = hashlib.blake2b(t, digest_size=16).digest()
                if name in seen:  # a copy in this task
                    continue
                seen.add(name)
                p, h = anchors(t, n)
                g.append(h)
                at.append(p)
                ids.append(np.full(len(p), i, np.int64))
                count += len(p)
                if count >= flush:
                    yield rows(*map(np.concatenate, (g, ids, at)))
                    g, ids, at, count = [], [], [], 0
        if count:
            yield rows(*map(np.concatenate, (g, ids, at)))
    return run


def _shared(max_bucket: int):
    """From rows sorted by (g, id): (id, t) of the buckets that hold two ids or more, and (g, -1) of those that
    stand for more than ``max_bucket`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last bucket, while it has one id only
        open_, passed = None, 0  # the last bucket, once it has two, and the rows of it that went by
        for b in batches:
            known = pc.less(b.column(2), 0)
            x = [c.to_numpy() for c in b.filter(known).columns[1:3]]
            if len(x[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(-x[1] - 1)], names=["id", "t"])
            x = [c.to_numpy() for c in b.filter(pc.invert(known)).columns]
            if held is not None:
                x = [np.concatenate(p) for p in zip(held, x, strict=True)]
                held = None
            g, ids, t, n = x
            if not len(g):
                continue
            start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            end = np.append(start[1:], len(g))
            two, many = ids[start] != ids[end - 1], np.add.reduceat(n.astype(np.int64), start)
            before = np.zeros(len(start), np.int64)
            if open_ is not None and g[0] == open_:
                two[0], before[0] = True, passed
            keep = np.repeat(two, end - start)
            heavy = g[start[(many + before > max_bucket) & (before <= max_bucket)]]
            open_, passed = (g[-1], int(many[-1] + before[-1])) if two[-1] else (None, 0)
            if not two[-1]:
                held = [c[start[-1]:] for c in x]
                heavy = heavy[heavy != g[-1]]  # its rows come again
            if keep.any() or len(heavy):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[keep], heavy])),
                     pa.array(np.concatenate([t[keep], np.full(len(heavy), -1)]).astype(np.int32))], names=["id", "t"])
    return run


def _around(n: int):
    """(kind 0, g, id, t, around) of anchors to refine; (kind 1, id, s, e) of ranges already decided."""
    left = n - Q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, tuple[int, int]] = {}
        rows: list[tuple] = []
        for b in batches:
            for i, t, ats in zip(b.column(0).to_pylist(), _texts(b.column(1)), b.column(2), strict=True):
                raw, h = t.tobytes(), qgrams(t)
                spread = i  # decided ranges only pass through the next shuffle
                for p in np.unique(ats.values.to_numpy()).tolist():
                    s, e = max(0, p - left), min(len(raw), p + n)
                    around = bytes([p - s]) + raw[s:e]
                    old = first.get(around)
                    if old is None:
                        first[around] = (i, p)
                        rows.append((0, int(h[p]) - (1 << 63), i, p, 0, around))
                    elif i > old[0]:
                        rows.append((1, spread, i, s, e, None))
                    # i == old[0]: strings repeated inside one document do not count here
                    elif i < old[0]:  # the smaller id goes on instead; the one before is covered
                        q = old[1]
                        rows.append((1, spread, old[0], q - (p - s), q - (p - s) + e - s, None))
                        first[around] = (i, p)
                        rows.append((0, int(h[p]) - (1 << 63), i, p, 0, around))
                    else:
                        rows.append((0, int(h[p]) - (1 << 63), i, p, 0, around))
                if len(rows) >= 20_000:  # a batch of long texts has many
                    yield rows_of(rows)
                    rows = []
                if len(first) > 100_000:  # bounds the memory of a large task
                    first = {}
        if rows:
            yield rows_of(rows)

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
            names=["kind", "g", "id", "s", "e", "around"])
    return run


def refined(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of the n-byte strings at every offset of ``rows`` (uint8 matrix), and for each
    identifier the place, row by row, where it comes first.

    The initial buckets are the 8-grams.  A bucket is refined by sorting on the identifier found at the offset
    behind it, which the step before has refined alike, so every step doubles the length that identifiers name.
    """
    grams = np.lib.stride_tricks.sliding_window_view(rows, START, axis=1)
    key, width = np.ascontiguousarray(grams).view(np.uint64)[..., 0], START
    while width < n:
        ids = np.unique(key, return_inverse=True)[1].reshape(key.shape)
        step = min(width, n - width)
        key, width = ids[:, :-step] * (int(ids.max()) + 1) + ids[:, step:], width + step
    first, ids = np.unique(key, return_index=True, return_inverse=True)[1:]
    return ids.reshape(key.shape), first


def _decide(g, ids, at, around, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, s, e): the range of each row that strings of a smaller id in its bucket cover."""
    left = n - Q
    # equal surroundings are one bucket: rows come sorted by (g, around, id)
    size = np.array([len(x) for x in around])
    same = np.array([False] + [x == y for x, y in zip(around[1:], around[:-1], strict=True)]) & np.concatenate(
        [[False], g[1:] == g[:-1]])
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(g))))
    before = np.array([x[0] for x in around])
    s, e = at - before, at - before + size - 1
    gone = same & (ids[lead] < ids)
    yield ids[gone], s[gone], e[gone]
    pick = np.flatnonzero(~gone)  # with repeats of a surrounding inside its document
    if len(pick) < 2:
        return
    new = np.concatenate([[True], g[pick][1:] != g[pick][:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    pick = pick[many]
    if not len(pick):
        return
    pick = pick[np.argsort(ids[pick], kind="stable")]
    # 0 pads beyond a text's ends; UTF-8 has no byte 255, so bytes count from 1
    full = np.zeros((len(pick), left + n), np.uint8)
    for r, k in enumerate(pick):
        x = np.frombuffer(around[k], np.uint8)[1:]
        full[r, left - before[k]:left - before[k] + len(x)] = x + np.uint8(1)
    names, first = refined(full, n)
    own = ids[pick]
    lowest = own[first // names.shape[1]]  # rows are in the order of ids
    low, high = np.full(len(pick), left + 1), np.full(len(pick), -1)
    for o in range(left + 1):
        inside = (o >= left - before[pick]) & (o + n <= left - before[pick] + size[pick] - 1)
        hit = inside & (lowest[names[:, o]] < own)
        low = np.where(hit & (low > o), o, low)
        high = np.where(hit, o, high)
    hit = high >= 0
    p = at[pick][hit] - left
    yield own[hit], p + low[hit], p + high[hit] + n


def _refined(n: int, max_bucket: int):
    """From the rows of ``_around`` sorted by (g, around, id): (kind 1, id, s, e) of decided ranges and
    (kind 2, id, s, around) of buckets too large to gather, known (kind 3, dealt evenly) or found to be."""
    def ranges(parts) -> Iterator[pa.RecordBatch]:
        for i, s, e in parts:
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), 1, np.int32)), pa.array(i), pa.array(s.astype(np.int32)),
                     pa.array(e.astype(np.int32)), pa.nulls(len(i), pa.binary())],
                    names=["kind", "id", "s", "e", "around"])

    def large(rows) -> pa.RecordBatch:
        k = len(rows[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, 2, np.int32)), pa.array(rows[1]), pa.array(rows[2].astype(np.int32)),
             pa.array(np.zeros(k, np.int32)), pa.array(rows[3], pa.binary())],
            names=["kind", "id", "s", "e", "around"])

    def split(x) -> Iterator[pa.RecordBatch]:
        """Whole buckets: the large ones go on as they are, the others are decided."""
        _, where, size = np.unique(x[0], return_inverse=True, return_counts=True)
        big = size[where] > max_bucket
        if big.any():
            yield large([c[big] for c in x])
        if not big.all():
            yield from ranges(_decide(*[c[~big] for c in x], n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count, over = [], 0, None
        for b in batches:
            yield b.filter(pc.equal(b.column(0), 1)).select(["kind", "id", "s", "e", "around"])
            heavy = b.filter(pc.equal(b.column(0), 3))
            yield heavy.set_column(0, "kind", pa.array(np.full(len(heavy), 2, np.int32))).select(
                ["kind", "id", "s", "e", "around"])
            b = b.filter(pc.equal(b.column(0), 0)).select(["g", "id", "s", "around"])
            x = [b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.int64),
                 np.array([*b.column(3).to_pylist(), None], object)[:-1]]
            if over is not None and len(x[0]):  # more of a large bucket
                cut = np.searchsorted(x[0], over, side="right")
                if cut:
                    yield large([c[:cut] for c in x])
                    x = [c[cut:] for c in x]
                over = None if len(x[0]) else over
            parts.append(x)
            count += len(x[0])
            if count < ROWS_AT_ONCE:
                continue
            x = [np.concatenate(p) for p in zip(*parts, strict=True)]
            start = np.searchsorted(x[0], x[0][-1])  # the last bucket may go on
            if start:
                yield from split([c[:start] for c in x])
            x = [c[start:] for c in x]
            if len(x[0]) > max_bucket:
                over = x[0][0]
                yield large(x)
                x = [c[:0] for c in x]
            parts, count = [x], len(x[0]) if len(x[0]) < ROWS_AT_ONCE else 0
        if parts:
            x = [np.concatenate(p) for p in zip(*parts, strict=True)]
            if len(x[0]):
                yield from split(x)
    return run


def _strings(n: int, at_once: int = 20_000):
    """The n-byte strings of the rows (id, t, around), a bounded number of rows at a time: (k1, k2, id, s, e) of
    those with the smallest id that the rows hold, and (null, null, id, s, e) of the ranges that the others cover."""
    def found(rows: list[tuple]) -> pa.RecordBatch:
        low: dict[bytes, int] = {}
        names = []
        for i, t, x in rows:
            own = []
            for o in range(min(x[0], len(x) - 1 - n) + 1):
                d = hashlib.blake2b(x[1 + o:1 + o + n], digest_size=16).digest()
                own.append((o, d))
                if i < low.get(d, i + 1):
                    low[d] = i
            names.append(own)
        out = []
        for (i, t, x), own in zip(rows, names, strict=True):
            for o, d in own:
                s = t - x[0] + o
                if low[d] == i:
                    out.append((int.from_bytes(d[:8], "little", signed=True),
                                int.from_bytes(d[8:], "little", signed=True), i, s, s + n))
                elif out and out[-1][0] is None and out[-1][2] == i and out[-1][3] <= s <= out[-1][4]:
                    out[-1] = (None, None, i, out[-1][3], s + n)
                else:
                    out.append((None, None, i, s, s + n))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
            + [pa.array([r[k] for r in out], pa.int32()) for k in (3, 4)], names=["k1", "k2", "id", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            rows += zip(*[c.to_pylist() for c in b.columns], strict=True)
            if len(rows) >= at_once:
                yield found(rows)
                rows = []
        if rows:
            yield found(rows)
    return run


def merged(s: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs of overlapping or touching ranges."""
    order = np.argsort(s, kind="stable")
    out: list[tuple[int, int]] = []
    for a, b in zip(s[order].tolist(), e[order].tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, removed, spans, kept = [], [], [], []
        for t, x in zip(_texts(b.column(1)), b.column(2), strict=True):
            x = x.values
            runs = merged(x.field("s").to_numpy(), x.field("e").to_numpy()) if x is not None else []
            raw, at, out = t.tobytes(), 0, []
            for s, e in runs:
                out.append(raw[at:s])
                at = e
            kept.append(b"".join([*out, raw[at:]]))
            sizes.append(len(raw))
            removed.append(sum(e - s for s, e in runs))
            spans.append(len(runs))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def _restricted(docs: DataFrame, ids: DataFrame, max_rows: int) -> DataFrame:
    """Rows of ``docs`` with an id in ``ids`` (stored, distinct); broadcast only within ``max_rows``."""
    side = ids.withColumnRenamed("id", "__id")
    if ids.count() <= max_rows:
        side = F.broadcast(side)
    return docs.join(side, F.col("id") == F.col("__id"), "left_semi")


def repeated_ranges(d: DataFrame, n: int = 50, *, max_bucket: int = 20_000,
                    max_broadcast_rows: int = 500_000) -> DataFrame:
    """(id, s, e) of byte ranges of ``d`` (id, text) covered by strings of smaller ids."""
    found = d.mapInArrow(_all_anchors(n), "g long, id long, t int, n int")
    shared = stored(found.repartition("g").sortWithinPartitions("g", "id").mapInArrow(
        _shared(max_bucket), "id long, t int"), "shared_anchors")
    heavy = stored(shared.filter("t < 0").select(F.col("id").alias("heavy")).distinct(), "heavy_anchors")
    kept = shared.filter("t >= 0")
    by_doc = kept.groupBy("id").agg(F.collect_list("t").alias("ts"))
    ids = stored(kept.select("id").distinct(), "anchored")
    own = _restricted(d, ids, max_broadcast_rows).dropDuplicates(["id"])
    near = own.join(by_doc, "id").select("id", "text", "ts").mapInArrow(
        _around(n), "kind int, g long, id long, s int, e int, around binary")
    # the rows of a heavy anchor are dealt evenly and never meet under it: their strings are compared below
    side = F.broadcast(heavy) if heavy.count() <= max_broadcast_rows else heavy
    near = near.join(side, (F.col("g") == F.col("heavy")) & (F.col("kind") == 0), "left").select(
        F.when(F.col("heavy").isNotNull(), F.lit(3)).otherwise(F.col("kind")).alias("kind"),
        F.when(F.col("heavy").isNotNull(), F.xxhash64("id", "s")).otherwise(F.col("g")).alias("g"), "id", "s", "e", "around")
    decided = stored(near.repartition("g").sortWithinPartitions("g", "around", "id").mapInArrow(
        _refined(n, max_bucket), "kind int, id long, s int, e int, around binary"), "refined")
    dropped(shared, heavy, ids)
    strings = stored(decided.filter("kind = 2").select("id", F.col("s").alias("t"), "around").mapInArrow(
        _strings(n), "k1 long, k2 long, id long, s int, e int"), "strings")
    low = strings.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter(
        "low < high").select("k1", "k2", "low")
    late = strings.join(low, ["k1", "k2"]).filter("low < id").select("id", "s", "e")
    return decided.filter("kind = 1").select("id", "s", "e").unionByName(late).unionByName(
        strings.filter("k1 IS NULL").select("id", "s", "e"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", *, n: int = 50,
                   max_bucket: int = 20_000, max_broadcast_rows: int = 500_000) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, the sha256 of what is kept and
    ``kept`` itself (bytes; null where nothing was removed: the text as it is)."""
    d = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    info = stored(d.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("h"),
                           F.sha2("text", 256).alias("sha")), "text_info")
    first = info.filter(F.col("n_bytes") >= n).groupBy("sha", "n_bytes").agg(
        F.min("id").alias("rep"), F.max("id").alias("last")).filter("rep < last")
    copies = stored(info.join(first, ["sha", "n_bytes"]).filter("id > rep").select("id").distinct(), "copies")
    side = copies.withColumnRenamed("id", "__id")
    if copies.count() <= max_broadcast_rows:
        side = F.broadcast(side)
    single = d.filter("id is not null").join(side, F.col("id") == F.col("__id"), "left_anti")
    ranges = stored(repeated_ranges(single, n, max_bucket=max_bucket, max_broadcast_rows=max_broadcast_rows)
                    .distinct(), "ranges")
    ids = stored(ranges.select("id").distinct(), "ranged")
    own = _restricted(single, ids, max_broadcast_rows).dropDuplicates(["id"])
    cut = own.join(ranges.groupBy("id").agg(F.collect_list(F.struct("s", "e")).alias("r")), "id").select(
        "id", "text", "r").mapInArrow(
        _cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary").select(
        F.col("id").alias("__cut"), F.col("n_removed").alias("r"), F.col("n_spans").alias("k"),
        F.sha2("kept", 256).alias("s"), "kept")
    out = info.join(cut, F.col("id") == F.col("__cut"), "left").join(
        copies.select(F.col("id").alias("__id")), F.col("id") == F.col("__id"), "left")
    copy, zero = F.col("__id").isNotNull(), F.lit(0).cast("long")
    return out.select(
        F.col("id").alias(key), "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("r", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("k", zero)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("s", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
