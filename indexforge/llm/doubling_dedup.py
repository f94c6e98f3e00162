"""Repeated word windows by level-wise doubling.

A word goes if a window of ``n`` consecutive words of one document covers it whose word sequence also
starts anywhere else, the same document included.  Windows are judged on the input.

Lengths double from about ``least`` words up to ``n`` (35: 9, 18, 35).  At a length L every n-word window
that is still a candidate is represented by one L-word window inside it, the one with the smallest hash,
which equal windows choose alike.  Only windows whose representative is repeated at L stay candidates for
2L; a level without survivors ends the search.  At the last length a window represents itself.  So
the first level lists about 2 in n - L words, and later levels only what is still in question.

1. Texts are written once, bucketed by their fingerprint: later levels join positions to them and shuffle
   no text.  A task passes a text on once, and equal texts lie next to each other in their bucket, so a group
   of copies is read once from there.
2. A level emits (hash, fingerprint, run of candidate starts).  Windows that a task sees twice are
   repeated already: their runs only pass through the shuffle, spread evenly, and one mark stands for
   all of them under the hash, so a frequent window sends a row or two per block of a task and no
   reducer gets a frequent key's rows.  The reducer streams rows sorted by hash.
3. Runs of repeated windows meet their texts and the covered words go.  Texts of two rows or more lose
   every word if they have ``n``.

Windows are named by 128 bits of hash at the last level and by 64 at those that only filter; texts by 96.

Defined results: every row is a document of its own, whatever its key (null, repeated), so two equal rows
remove each other; a null text has no words; texts under ``n`` words lose nothing; kept words are joined by
one space; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexforge.llm.shingles import mix, texts_of
from indexforge.llm.text import dropped, stored, ws_words
from indexforge.session import scratch_path

_RNG = np.random.default_rng(35)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers of the byte hash and of the two window hashes.
_K = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93]
#: Bytes or words hashed at once, bytes of text in a slice (a longer text is a slice of its own), rows folded
#: at once and fingerprints a task remembers.
PIECE, SLICE_BYTES, FLUSH_ROWS, REMEMBER = 1 << 18, 1 << 21, 300_000, 200_000
LEVEL = "g long, g2 long, kind byte, a long, b int, s int, e int"


def level_lengths(n: int, least: int = 8) -> list[int]:
    """n and its halves, rounded up, down to ``least``; the shortest first."""
    out = [n]
    while out[0] > 1 and (out[0] + 1) // 2 >= least:
        out.insert(0, (out[0] + 1) // 2)
    return out


@functools.lru_cache(maxsize=6)
def _powers(k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    def run(x: int) -> np.ndarray:
        p = np.full(size, x, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)
    return run(_K[k]), run(pow(_K[k], -1, 1 << 64))


def _hashes(x: np.ndarray, value, s: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of the ranges [s, e) of ``value(x)``, independent of where they stand."""
    out, i = np.zeros(len(s), np.uint64), 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(e, s[i] + PIECE, side="right")))
        lo, size = s[i], e[j - 1] - s[i]
        up, down = _powers(k, max(PIECE, int(size)))
        c = np.zeros(size + 1, np.uint64)
        np.cumsum(value(x[lo:lo + size]) * up[:size], out=c[1:])
        out[i:j] = (c[e[i:j] - lo] - c[s[i:j] - lo]) * down[s[i:j] - lo]
        i = j
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of the first word of every text and of the end)."""
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] |= word[inner]
    last[inner - 1] |= word[inner - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return mix(_hashes(data, _BYTE.take, s, e, 0) + (e - s).astype(np.uint64)), np.searchsorted(s, offsets)


def window_hashes(w: np.ndarray, length: int, k: int) -> np.ndarray:
    """The k-th hash of all windows of ``length`` neighbours."""
    s = np.arange(max(0, len(w) - length + 1))
    return mix(_hashes(w, lambda x: mix(x + np.uint64(k)), s, s + length, k))


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbours the place of the leftmost smallest."""
    at, have = np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at, have = np.where(h[a] <= h[b], a, b), have + step
    return at


def represented(w: np.ndarray, starts: np.ndarray, length: int, n: int) -> tuple[np.ndarray, ...]:
    """(h1, h2, s, e): the runs [s, e) of neighbouring n-word windows that one window of ``length`` represents."""
    h = window_hashes(w, length, 1)
    rep = starts if length == n else smallest(h, n - length + 1)[starts]
    cut = np.flatnonzero(np.concatenate([[True], (rep[1:] != rep[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.append(cut[1:], len(starts)) - 1
    at = rep[cut]
    h2 = window_hashes(w, length, 2)[at] if length == n else np.zeros(len(at), np.uint64)
    return h[at], h2, starts[cut], starts[last] + 1


def _slices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Whole texts of about ``SLICE_BYTES``: (bytes, offsets, first row, row after the last)."""
    data, offsets = texts_of(b.column("text"))
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], at, to
        at = to


def _ranges(s: np.ndarray, size: np.ndarray) -> np.ndarray:
    """s[0], s[0] + 1, ... s[0] + size[0] - 1, s[1], ..."""
    return np.repeat(s - np.cumsum(size) + size, size) + np.arange(size.sum())


def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, s, e) of the column ``runs``, in the order of rows and starts."""
    runs = batch.column("runs")
    row = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).fill_null(0).to_numpy())
    s, e = (runs.flatten().field(k).to_numpy().astype(np.int64) for k in (0, 1))
    order = np.lexsort((s, row))
    return row[order], s[order], e[order]


def _fold(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Rows of kind 0 for runs in question, 1 for runs known to be repeated (spread evenly), 2 for the marks
    that stand for those under their hash."""
    h1, h2, a, b, s, e = map(np.concatenate, zip(*parts, strict=True))
    order = np.lexsort((h2, h1))
    x, y = h1[order], h2[order]
    start = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
    size = np.diff(np.append(start, len(x)))
    known = np.zeros(len(x), bool)
    known[order] = np.repeat(size > 1, size)
    one, i, mark = ~known, np.flatnonzero(known), start[size > 1]
    join = (s[i][1:] == e[i][:-1]) & (a[i][1:] == a[i][:-1]) & (b[i][1:] == b[i][:-1])
    head = i[np.concatenate([[True], ~join])[:len(i)]]  # neighbouring known runs of a text are one
    tail = i[np.concatenate([~join, [True]])[:len(i)]]
    spread = mix(a[head].view(np.uint64) + s[head].astype(np.uint64))
    none = np.zeros(len(mark), np.int64)
    columns = (np.concatenate([h1[one], spread, x[mark]]).view(np.int64),
               np.concatenate([h2[one], np.zeros(len(head), np.uint64), y[mark]]).view(np.int64),
               np.repeat(np.array([0, 1, 2], np.int8), [np.count_nonzero(one), len(head), len(mark)]),
               np.concatenate([a[one], a[head], none]), np.concatenate([b[one], b[head], none]).astype(np.int32),
               np.concatenate([s[one], s[head], none]).astype(np.int32),
               np.concatenate([e[one], e[tail], none]).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["g", "g2", "kind", "a", "b", "s", "e"])


def _level(length: int, n: int, narrowed: bool):
    """The rows of one level from texts (a, b, text) sorted by (a, b), with ``runs`` of candidates if narrowed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count, before = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(k).to_numpy() for k in ("a", "b"))
            again = np.concatenate([[before == (a[0], b[0])], (a[1:] == a[:-1]) & (b[1:] == b[:-1])])
            before = (a[-1], b[-1])
            if narrowed:
                row, rs, re = _runs(batch)
            for data, offsets, lo, hi in _slices(batch):
                w, at = word_hashes(data, offsets)
                if narrowed:
                    k = np.arange(*np.searchsorted(row, (lo, hi)))
                    k = k[~again[row[k]]]
                    starts = _ranges(at[row[k] - lo] + rs[k], re[k] - rs[k])
                else:
                    starts = _ranges(at[:-1], np.where(again[lo:hi], 0, np.maximum(np.diff(at) - n + 1, 0)))
                if not len(starts):
                    continue
                h1, h2, s, e = represented(w, starts, length, n)
                d = np.searchsorted(at, s, side="right") - 1
                parts.append((h1, h2, a[lo + d], b[lo + d], s - at[d], e - at[d]))
                count += len(s)
                if count >= FLUSH_ROWS:
                    yield _fold(parts)
                    parts, count = [], 0
        if parts:
            yield _fold(parts)
    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (g, g2): (a, b, s, e) of the runs whose window is repeated."""
    names = ["a", "b", "s", "e"]
    held, open_ = None, None  # the last hash's only row; the last hash, once it is repeated
    for batch in batches:
        known = pc.equal(batch.column("kind"), 1)
        yield batch.filter(known).select(names)
        x = [c.to_numpy() for c in batch.filter(pc.invert(known)).columns]
        if held is not None:
            x = [np.concatenate(p) for p in zip(held, x, strict=True)]
        g, g2, kind = x[:3]
        if not len(g):
            continue
        start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (g2[1:] != g2[:-1])]))
        size = np.diff(np.append(start, len(g)))
        two = (size > 1) | (np.maximum.reduceat(kind, start) == 2)
        two[0] |= open_ == (g[0], g2[0])
        open_ = (g[-1], g2[-1]) if two[-1] else None
        held = None if two[-1] else [c[-1:] for c in x]
        keep = np.repeat(two, size) & (kind == 0)
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in x[3:]], names=names)


def _once_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()
    for b in batches:
        keep = []
        for f in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            keep.append(f not in seen)
            seen.add(f)
        if len(seen) > REMEMBER:
            seen = set()
        yield b.filter(pa.array(keep, pa.bool_()))


def _cut(n: int):
    """(a, b, n_removed, kept) of texts sorted by (a, b) with runs of repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            row, rs, re = _runs(batch)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            out = []
            for k, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                if (a, b) == before:
                    continue
                before = (a, b)
                # bytes.split() parts words at \x20 and \x09-\x0D only
                words = batch.column("text")[k].as_buffer().to_pybytes().split()
                kept, at, gone = [], 0, 0
                for s, e in zip(rs[bounds[k]:bounds[k + 1]].tolist(), re[bounds[k]:bounds[k + 1]].tolist(), strict=True):
                    kept += words[at:s]
                    gone += e - 1 + n - max(at, s)
                    at = e - 1 + n
                out.append((a, b, gone, b" ".join(kept + words[at:])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                names=["a", "b", "n_removed", "kept"])
    return run


def _fingerprint(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("a"), (F.crc32(text) - F.lit(1 << 31)).cast("int").alias("b")]


def bucketed(texts: DataFrame, name: str) -> DataFrame:
    """``texts`` (a, b, ...) written to the shared folder in buckets of (a, b): a join on them
    shuffles the other side only."""
    spark = texts.sparkSession
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex[:12]}"
    (texts.repartition(n, "a", "b").write.bucketBy(n, "a", "b").sortBy("a", "b")
     .option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table))
    return spark.table(table)


def repeated_windows(texts: DataFrame, n: int = 35, least: int = 8) -> DataFrame | None:
    """(a, b, runs) of the starts of ``n``-word windows that are repeated in ``texts`` (a, b, text; bucketed),
    or None if there are none."""
    runs = alive = None
    for length in level_lengths(n, least):
        before, rows = alive, texts if runs is None else texts.join(runs, ["a", "b"]).select("a", "b", "text", "runs")
        found = rows.sortWithinPartitions("a", "b").mapInArrow(_level(length, n, runs is not None), LEVEL)
        alive = stored(found.repartition("g", "g2").sortWithinPartitions("g", "g2").mapInArrow(
            _repeated, "a long, b int, s int, e int"), f"windows_{length}")
        if before is not None:
            dropped(before)
        if alive.isEmpty():
            return None
        runs = alive.groupBy("a", "b").agg(F.collect_list(F.struct("s", "e")).alias("runs"))
    return runs


def remove_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", *, n: int = 35,
                            least: int = 8) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept (the words left, joined by one space) and
    its sha256."""
    if n < 2:
        raise ValueError("a window has two words at least")
    t = F.coalesce(F.col(text), F.lit(""))
    # a text of n words has 2n - 1 bytes at least
    long = docs.select(t.alias("text")).filter(F.octet_length("text") >= 2 * n - 1).select(
        *_fingerprint(F.col("text")), "text")
    texts = bucketed(long.mapInArrow(_once_in_task, "a long, b int, text string"), "texts")
    runs = repeated_windows(texts, n, least)
    plain = docs.select(F.col(key).alias("key"), *_fingerprint(t), ws_words(t).alias("w")).select(
        "key", "a", "b", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("kept"))
    plain = plain.withColumn("sha", F.sha2("kept", 256))
    copies = docs.filter(F.octet_length(F.col(text)) >= 2 * n - 1).select(*_fingerprint(t)).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("k")).filter("k > 1").select("a", "b", F.lit(True).alias("copy"))
    out = plain.join(copies, ["a", "b"], "left")
    if runs is not None:
        cut = texts.join(runs, ["a", "b"]).select("a", "b", "text", "runs").sortWithinPartitions("a", "b").mapInArrow(
            _cut(n), "a long, b int, n_removed long, kept binary").select(
            "a", "b", "n_removed", F.decode("kept", "UTF-8").alias("left"), F.sha2("kept", 256).alias("left_sha"))
        out = out.join(cut, ["a", "b"], "left")
    else:
        out = out.withColumns({"n_removed": F.lit(None).cast("long"), "left": F.lit(None).cast("string"),
                               "left_sha": F.lit(None).cast("string")})
    copy = F.col("copy") & (F.col("n_words") >= n)
    return out.select(
        F.col("key").alias(key), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit("")).otherwise(F.coalesce("left", "kept")).alias("kept"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"))
