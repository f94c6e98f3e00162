"""N-gram Jaccard join by parity sketches.

A text's set holds its distinct 5-word shingles.  Sets A and B with Jaccard similarity s or more
differ in at most d = (1 - s) / (1 + s) * (|A| + |B|) shingles.  Sizes fall into bands that grow by 1 / s,
so a pair's sizes lie in one band or in two neighbours, and each band has its d.

A sketch of a band XORs every shingle's hash into one of k > d cells (ranges of the hash space).
A differing shingle changes one cell, so the number of different cells - the Hamming distance of the
sketches - is at most the symmetric difference: of k cells at least k - d are equal.
That pigeonhole gives the join: texts meet where a cell is equal.  A text may leave out its emptiest
cells as long as it leaves out fewer than k - d of them; equal cells hold equally many
shingles, so a pair that leaves out up to the larger of two such limits still meets.

1. Copies (equal sets) become one representative: the smallest id.
2. Cells are repartitioned and sorted by value; the reducer streams each group and names the
   smallest id as hub of the others: groups cost their rows, not their pairs.  A cell that many texts of
   one map task share is split off before the shuffle and represented by its smallest id.
3. Each text is verified against the hub it shares most cells with; verified links form components.
4. Groups that hold texts of different components are completed: what is not joined
   yet is compared inside the group by fixed-width bit-parity sketches (their Hamming distance bounds the
   symmetric difference from below as well) and what passes is verified.  A group over ``max_cell`` texts
   is dealt to blocks, and block meets block in tasks of their own: a task holds two blocks at most.
   So no link between different texts is lost to the choice of hubs, at any group size.
5. Components come from alternating stars over the verified links.

Nothing about all documents reaches the driver.  A broadcast is used for candidate ids only if their
count is within ``max_broadcast_rows``; the plain join replaces it beyond.

Defined results: null, empty and wordless texts have the empty set and are linked with nothing; a text
of fewer than five words is one shingle; repeated rows of one id count once (the ids must be integers);
a row with a null id is linked with nothing: it gets a row of its own with 0 shingles and a null component;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.llm.fit_sample import small_batches
from indexforge.llm.graph import components
from indexforge.llm.shingles import mix, shingle_sets
from indexforge.llm.text import stored

#: Least bits of a bit-parity sketch; it has 2 to 4 bits a shingle beyond that.
SKETCH_BITS = 1024


class Bands:
    """Size bands for a similarity of num / den."""

    def __init__(self, num: int = 80, den: int = 100):
        self.num, self.den = num, den
        self.tops = [1]

    def of(self, n: int) -> int:
        while self.tops[-1] < n:
            # pairs of sizes over a top reach down to its share num / den at most
            self.tops.append(max(self.tops[-1] + 1, self.tops[-1] * self.den // self.num))
        return int(np.searchsorted(self.tops, n))

    def shape(self, band: int) -> tuple[int, int]:
        """(d, k): the largest symmetric difference of a pair whose larger set is in the band."""
        while len(self.tops) <= band:
            self.of(self.tops[-1] + 1)
        d = 2 * self.tops[band] * (self.den - self.num) // (self.den + self.num)
        return d, d + 1 + (max(4, -(-3 * d // 20) + 3) if d else 0)


def cells(s: np.ndarray, band: int, d: int, k: int) -> np.ndarray:
    """Join keys of a set's cells in a band, without the emptiest ones it may leave out."""
    # s is sorted: a cell is a run
    part = (s // np.uint64((1 << 64) // k + 1)).astype(np.int64) if k > 1 else np.zeros(len(s), np.int64)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    value = np.bitwise_xor.reduceat(mix(s + np.uint64(1)), starts)
    index, count = part[starts], np.diff(np.append(starts, len(s)))
    out, limit, empty = -1, k - d - 1, k - len(starts)
    if empty <= limit:
        out, left, c = 0, empty, 1
        while left + (count == c).sum() <= limit and c < 64:
            left, out, c = left + (count == c).sum(), c, c + 1
    if out < 0:
        gone = np.setdiff1d(np.arange(k), index)
        index, value = np.concatenate([index, gone]), np.concatenate([value, np.zeros(len(gone), np.uint64)])
    else:
        index, value = index[count > out], value[count > out]
    return mix(value * np.uint64(31) + mix(index.astype(np.uint64) + np.uint64(band << 40)))


def bit_sketch(s: np.ndarray) -> bytes:
    """Parities: bit i tells whether an odd number of shingles falls on it.  The width is a power of two
    that grows with the set, so that the distance of large sets does not saturate."""
    bits = max(SKETCH_BITS, 1 << (2 * len(s) - 1).bit_length())
    n = np.bincount((mix(s + np.uint64(7)) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((n & 1).astype(np.uint8)).tobytes()


def fold(x: np.ndarray, width: int) -> np.ndarray:
    """The sketch at a smaller width: its halves XORed."""
    while len(x) > width:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def sketch_distance(x: np.ndarray, y: np.ndarray) -> int:
    """Hamming distance of two sketches at the width of the narrower."""
    width = min(len(x), len(y))
    return int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum())


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    if not len(a) or not len(b) or den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


def _long(x) -> pa.Array:
    return pa.array(np.asarray(x, np.int64) if not isinstance(x, np.ndarray) else x.astype(np.int64))


def _sets_info(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = shingle_sets(b.column(1))
        sums = [(int(mix(s).sum(dtype=np.uint64)) if len(s) else 0,
                 int(np.bitwise_xor.reduce(mix(s + np.uint64(3)))) if len(s) else 0) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), _long([len(s) for s in sets]),
             _long(np.array([x for x, _ in sums], np.uint64).view(np.int64)),
             _long(np.array([x for _, x in sums], np.uint64).view(np.int64))], names=["id", "n", "s1", "s2"])


def _all_cells(num: int, den: int, split: int, flush: int = 300_000):
    """(cell, id, root) of every text.  A cell that more than ``split`` texts of the task's last
    ``flush`` rows share becomes a cell of this task (its ``root`` tells which), and only its smallest id
    goes on under the cell itself: a cell shared by a third of all texts sends one row per flush."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen, keys, ids, salt = Bands(num, den), set(), [], [], [TaskContext.get().partitionId() << 32]

        def rows() -> pa.RecordBatch:
            c, i = np.concatenate(keys), np.concatenate(ids)
            keys.clear()
            ids.clear()
            salt[0] += 1
            order = np.argsort(c, kind="stable")
            c, i = c[order], i[order]
            start = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            size = np.diff(np.append(start, len(c)))
            hot = np.repeat(size > split, size)
            own = np.where(hot, mix(c ^ mix(np.full(1, salt[0], np.uint64))), c)
            first = size > split
            lows = np.minimum.reduceat(i, start)[first]
            cell = np.concatenate([own, c[start[first]]]).view(np.int64)
            root = pa.array(np.concatenate([c, c[start[first]]]).view(np.int64),
                            mask=np.concatenate([~hot, np.ones(len(lows), bool)]))
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.concatenate([i, lows])), root],
                                              names=["cell", "id", "root"])

        n = 0
        for b in batches:
            for i, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1)), strict=True):
                if not len(s):
                    continue
                name = (len(s), int(mix(s).sum(dtype=np.uint64)))
                if name in seen:  # a copy in this task: its representative's cells are there
                    continue
                seen.add(name)
                own = bands.of(len(s))
                for band in (own, own + 1):
                    keys.append(cells(s, band, *bands.shape(band)))
                    ids.append(np.full(len(keys[-1]), i, np.int64))
                    n += len(ids[-1])
            if n >= flush:
                yield rows()
                n = 0
        if keys:
            yield rows()
    return run


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (cell, id): (root, hub, id) for all but the first row of each cell."""
    cell0 = hub0 = None
    for b in batches:
        c, i = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(c):
            continue
        new = np.concatenate([[cell0 is None or c[0] != cell0], c[1:] != c[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(len(c)), -1))
        hub = np.where(at >= 0, i[np.maximum(at, 0)], hub0 if hub0 is not None else 0)
        cell0, hub0 = c[-1], hub[-1]
        keep = ~new & (hub != i)
        if keep.any():
            root = b.column(2).filter(pa.array(keep))
            root = pc.coalesce(root, pa.array(c[keep]))
            yield pa.RecordBatch.from_arrays([root, pa.array(hub[keep]), pa.array(i[keep])],
                                             names=["cell", "a", "b"])


def _with_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = shingle_sets(b.column(1))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), _long([len(s) for s in sets]),
             pa.array([bit_sketch(s) for s in sets], pa.binary())], names=["id", "text", "n", "sketch"])


def _near_sketches(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy() + b.column(3).to_numpy()
            far = np.array([sketch_distance(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(
                b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
                pa.array(far * (den + num) <= n * (den - num)))
    return run


def _verified(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [similar(x, y, num, den) for x, y in zip(
                shingle_sets(b.column(2)), shingle_sets(b.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(good))
    return run


def _spread(rows: DataFrame, max_cell: int) -> DataFrame:
    """``rows`` (cell, k, m and others) by (cell, i, j): the members of a cell of k rows are dealt to
    ceil(k / max_cell) blocks ``blk``, and every two blocks i <= j meet as a group of their own."""
    n = F.ceil(F.col("k") / F.lit(max_cell)).cast("int")
    rows = rows.withColumn("blk", F.pmod(F.xxhash64("m", "cell"), n).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")).drop("other", "k")


def _crossing(num: int, den: int):
    """From rows (cell, i, j, id, component, n, sketch, block) sorted by cell, i and j: pairs of different
    components whose sizes and sketches allow the similarity.  Members of one block meet where i = j."""
    def pairs(group: list[tuple], one: bool) -> Iterator[tuple[int, int]]:
        ids, comp, n = (np.array([g[k] for g in group], np.int64) for k in range(3))
        block = np.array([g[4] for g in group])
        if len(ids) < 2 or (comp == comp[0]).all():
            return
        # sizes of a cell lie in two bands, so folding to the narrowest sketch halves a width at most twice
        bits = [np.frombuffer(g[3], np.uint64) for g in group]
        width = min(map(len, bits))
        bits = np.array([fold(x, width) for x in bits])
        for x in range(len(ids) - 1):
            y = np.arange(x + 1, len(ids))
            y = y[(one | (block[y] != block[x])) & (comp[y] != comp[x])
                  & (den * np.minimum(n[y], n[x]) >= num * np.maximum(n[y], n[x]))]
            far = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1)
            for j in y[far * (den + num) <= (n[y] + n[x]) * (den - num)]:
                yield (min(ids[x], ids[j]), max(ids[x], ids[j]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple[list[tuple], bool]]:
            at, group = None, []
            for b in batches:
                for c, i, j, *row in zip(*[x.to_pylist() for x in b.columns], strict=True):
                    if (c, i, j) != at:
                        if group:
                            yield group, at[1] == at[2]
                        at, group = (c, i, j), []
                    group.append(tuple(row))
            if group:
                yield group, at[1] == at[2]

        out = []
        for group, one in groups():
            for pair in pairs(group, one):
                out.append(pair)
                if len(out) > 50_000:
                    yield _pair_batch(out)
                    out = []
        yield _pair_batch(out)
    return run


def _pair_batch(out) -> pa.RecordBatch:
    out = sorted(set(out))
    return pa.RecordBatch.from_arrays([_long([x for x, _ in out]), _long([y for _, y in out])], names=["a", "b"])


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", *, num: int = 80, den: int = 100,
                    split: int = 64, max_cell: int = 10_000, max_broadcast_rows: int = 500_000) -> DataFrame:
    """(key, n_shingles, component_id) for every distinct key of ``docs`` and every row without one."""
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    unnamed = d.filter("id is null").select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_shingles"),
                                            F.col("id").alias("component_id"))
    d = d.filter("id is not null")
    info = stored(d.mapInArrow(_sets_info, "id long, n long, s1 long, s2 long"), "set_info")
    some = info.filter("n > 0")
    first = some.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    rep = stored(some.join(first.filter("copies > 1"), ["s1", "s2", "n"]).filter("id <> rep").select(
        "id", "rep").distinct(), "copies")
    # 2: cells and hubs
    rows = d.mapInArrow(_all_cells(num, den, split), "cell long, id long, root long")
    hubs = stored(rows.repartition("cell").sortWithinPartitions("cell", "id").mapInArrow(
        _hubs, "cell long, a long, b long"), "hubs")
    of = lambda df, c: df.join(rep.select(F.col("id").alias("__id"), F.col("rep").alias("__rep")),
                               F.col(c) == F.col("__id"), "left").withColumn(
        "r" + c, F.coalesce("__rep", c)).drop("__id", "__rep")
    pairs = of(of(hubs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")), "a"), "b").filter("ra <> rb")
    pairs = stored(pairs.select("a", "b", "shared", F.least("ra", "rb").alias("x"),
                                F.greatest("ra", "rb").alias("y")), "pairs")
    # texts of the candidates, with their sketches
    ids = stored(pairs.select(F.col("x").alias("__id")).union(pairs.select("y")).distinct(), "candidates")
    n = ids.count()
    side = F.broadcast(ids) if n <= max_broadcast_rows else ids
    own = d.join(side, F.col("id") == F.col("__id"), "left_semi")
    texts = stored(own.mapInArrow(_with_sketch, "id long, text string, n long, sketch binary"), "candidate_texts")
    texts = texts.dropDuplicates(["id"]) if n != texts.count() else texts

    def verify(p: DataFrame) -> DataFrame:
        def both(p: DataFrame, column: str, table: DataFrame = texts) -> DataFrame:
            for c in ("a", "b"):
                p = p.join(table.select(F.col("id").alias(c), F.col(column).alias(column + c)), c)
            return p

        # sizes and sketches first: only pairs that may be similar meet their texts
        p = both(p, "n").filter(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
        p = both(p, "sketch").select("a", "b", "na", "nb", "sketcha", "sketchb").mapInArrow(
            _near_sketches(num, den), "a long, b long")
        p = stored(p, "near_pairs")
        ids = stored(p.select(F.col("a").alias("__id")).union(p.select("b")).distinct(), "near_ids")
        side = F.broadcast(ids) if ids.count() <= max_broadcast_rows else ids
        own = texts.join(side, F.col("id") == F.col("__id"), "left_semi")
        return both(p, "text", own).select("a", "b", "texta", "textb").mapInArrow(
            _verified(num, den), "a long, b long")

    # 3: the best hub of each text
    best = pairs.groupBy("x", "y").agg(F.sum("shared").alias("shared")).groupBy("y").agg(
        F.max_by("x", F.struct("shared", -F.col("x"))).alias("x"))
    tried = stored(best.select(F.col("x").alias("a"), F.col("y").alias("b")), "tried")
    links = stored(verify(tried), "verified")
    comp = stored(components(links), "components")
    label = lambda df, c: df.join(comp.select(F.col("node").alias("__n"), F.col("component").alias("__c")),
                                  F.col(c) == F.col("__n"), "left").withColumn(
        "c" + c, F.coalesce("__c", c)).drop("__n", "__c")
    # 4: groups that are not one component yet
    open_ = stored(label(label(pairs, "x"), "y").filter("cx <> cy"), "open_pairs")
    if open_.limit(1).count():
        again = open_.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        cell = hubs.join(open_.select("a", "b").distinct(), ["a", "b"], "left_semi").select("cell").distinct()
        # cells of two texts have had their only pair; the others are completed
        cell = hubs.join(cell, "cell", "left_semi").groupBy("cell").agg(F.count(F.lit(1)).alias("k")).filter(
            "k > 1").select("cell")
        rows = hubs.join(cell, "cell", "left_semi")
        rows = rows.select("cell", F.explode(F.array("a", "b")).alias("m")).distinct()
        rows = stored(of(rows, "m").select("cell", F.col("rm").alias("m")).distinct(), "open_cells")
        # near copies share many cells: of cells with the same texts one is enough
        same = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("m")).alias("x"),
                                        F.bit_xor(F.xxhash64("m", F.lit(1))).alias("y"))
        one = same.filter("k > 2").groupBy("k", "x", "y").agg(F.min("cell").alias("cell")).select("cell", "k")
        rows = rows.join(one, "cell")
        rows = label(rows, "m").join(texts.select(F.col("id").alias("m"), "n", "sketch"), "m")
        more = _spread(rows.select("cell", "k", "m", "cm", "n", "sketch"), max_cell).select(
            "cell", "i", "j", "m", "cm", "n", "sketch", "blk").repartition("cell", "i", "j").sortWithinPartitions(
            "cell", "i", "j", "m").mapInArrow(_crossing(num, den), "a long, b long")
        again = again.unionByName(more).distinct().join(tried, ["a", "b"], "left_anti")
        again = stored(again, "untried")
        late = stored(verify(again), "verified")
        if late.limit(1).count():
            comp = stored(components(links.unionByName(late)), "components")
    out = of(info.groupBy("id").agg(F.max("n").alias("n_shingles")), "id")
    out = out.join(comp, F.col("rid") == F.col("node"), "left")
    return out.select(F.col("id").alias(key), "n_shingles",
                      F.coalesce("component", "rid").alias("component_id")).unionByName(unnamed)


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` with the document of the smallest key of each component."""
    gone = near_components(docs, key, text, **params).filter(F.col(key) != F.col("component_id")).select(
        F.col(key).alias("__key"))
    return docs.join(gone, F.col(key) == F.col("__key"), "left_anti")
