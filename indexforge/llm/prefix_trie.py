"""Conversation prefix trie by whole-sequence collapse.

Conversations share prompts and openings.  The trie has a node per distinct sequence of first d turns, a
textless root (d = 0) above all; a conversation is a member of every node it starts with.

1. Turns are ordered and named: a turn's name is the md5 of its role and text, and a prefix's key the XOR of two
   64-bit hashes of (place, name) over its turns, a running aggregate of a sorted window.  Texts
   are not shuffled again.
2. Conversations with equal keys at their full length collapse into one weighted sequence with its end list.
   Only one conversation of each, the smallest, goes on.
3. Sequences that are proper prefixes of others are found by their key among the inner prefixes; the
   anti-join leaves the leaves.
4. Prefixes are aggregated with the weights: members, smallest member, leaves.  The sum over a subtree needs no
   second pass over the tree: each node belongs to the sequence of its smallest member, whose
   running sum from the end adds what it owns, and a node adds up the sums of the sequences through it.

A frequent opening or the root is a key of many rows only where partial aggregates combine them before
the shuffle, or in plain joins that Spark may split.  End lists are pieces of at most ``PIECE`` neighbouring ids,
hashed one after the other, so no list is held whole.

Rebuilding (``rebuilt``): conversation c takes the first h turns of the first conversation of its block of ids
and then its own turns after its first h, with h from a hash of its id.

Defined results: turns are ordered by number, null first; turns of equal number by their name; null role
and text are empty; rows without a conversation id belong to no conversation and are left out; a conversation may lose
every turn and end in the root; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indexforge.llm.text import dropped, stored, ws_words

#: Ids of an end list joined at once: the span of ids, and so the most rows, of a piece.
PIECE = 4096


def named_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """(c, at, name, words): every turn with its place from 1 in its conversation."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t).cast("binary")).alias("name"),
        F.size(ws_words(t)).cast("long").alias("words"))
    order = Window.partitionBy("c").orderBy(F.asc_nulls_first("turn"), "name")
    return rows.withColumn("at", F.row_number().over(order)).select("c", "at", "name", "words")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """(c, at, name, words) after rebuilding, and for every conversation a row of place 0."""
    h = (F.crc32(F.col("c").cast("string")) % most).cast("int")
    first = F.col("c") - F.col("c") % block
    openings = turns.filter((F.col("c") % block == 0) & (F.col("at") < most)).select(
        F.col("c").alias("base"), F.col("at").alias("base_at"), "name", "words")
    ids = turns.filter("at = 1").select("c", h.alias("h"), first.alias("base"))
    taken = ids.join(openings, "base").filter("base_at <= h").select(
        "c", F.col("base_at").alias("at"), "name", "words")
    many = openings.groupBy("base").agg(F.max("base_at").alias("there"))
    own = turns.withColumn("h", h).filter("at > h").withColumn("base", first).join(many, "base", "left").select(
        "c", (F.col("at") - F.col("h") + F.least("h", F.coalesce("there", F.lit(0)))).alias("at"), "name", "words")
    roots = ids.select("c", F.lit(0).alias("at"), F.lit(None).cast("string").alias("name"), F.lit(0).cast("long").alias("words"))
    return roots.unionByName(taken).unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(c, at, words, k1, k2, p1, p2, last): a row per prefix with its key and its parent's, and whether it is the whole."""
    whole = Window.partitionBy("c").orderBy("at")
    key = [F.when(F.col("at") > 0, F.xxhash64(F.lit(k), "at", "name")).otherwise(F.lit(0).cast("long")) for k in (1, 2)]
    rows = turns.withColumns({"x1": key[0], "x2": key[1]}).withColumns({
        "k1": F.expr("bit_xor(x1)").over(whole), "k2": F.expr("bit_xor(x2)").over(whole),
        "last": F.lead("at").over(whole).isNull()})
    up = [F.when(F.col("at") > 0, F.col(f"k{k}").bitwiseXOR(F.col(f"x{k}"))).alias(f"p{k}") for k in (1, 2)]
    return rows.select("c", "at", "words", "k1", "k2", *up, "last")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, k1, k2, weight, c, ends) from the pieces of end lists, sorted by (at, k1, k2, piece)."""
    key, sha, weight, low, out = None, None, 0, 0, []
    for b in batches:
        for *k, n, c, ids in zip(*(col.to_pylist() for col in b.columns), strict=True):
            if k != key:
                if key:
                    out.append((*key, weight, low, sha.hexdigest()))
                key, sha, weight, low = k, hashlib.sha256(ids.encode()), n, c
            else:
                sha.update(b"," + ids.encode())
                weight += n
        yield _lists(out)
        out = []
    if key:
        yield _lists([(*key, weight, low, sha.hexdigest())])


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                      names=["at", "k1", "k2", "weight", "c", "ends"])


def collapsed(rows: DataFrame) -> DataFrame:
    """(at, k1, k2, weight, c, ends): the distinct whole sequences, their copies, the smallest id and the sha256 of
    all ids, ascending and joined by commas."""
    span = F.floor(F.col("c") / F.lit(PIECE)).alias("piece")
    pieces = rows.filter("last").groupBy("at", "k1", "k2", span).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    pieces = pieces.select("at", "k1", "k2", "piece", F.size("ids").cast("long").alias("n"),
                           F.get("ids", F.lit(0)).alias("c"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    return pieces.repartition("at", "k1", "k2").sortWithinPartitions("at", "k1", "k2", "piece").select(
        "at", "k1", "k2", "n", "c", "ids").mapInArrow(
        _hash_lists, "at int, k1 long, k2 long, weight long, c long, ends string")


def prefix_trie(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", block: int = 20, most: int = 4) -> DataFrame:
    """A row per node: smallest member, depth, parent's smallest member, members, children, leaves, the tokens its
    subtree saves when every node is computed once, and the sha256 of the ids that end in it."""
    node = ["at", "k1", "k2"]
    rows = stored(prefixes(rebuilt(named_turns(conversations, conv, turn, role, text), block, most)), "prefixes")
    sequences = stored(collapsed(rows), "sequences")
    kept = rows.join(sequences.select("c", "weight"), "c")
    inner = kept.filter("not last").select(*node).distinct()
    leaves = sequences.join(inner, node, "left_anti").select("c", F.lit(1).cast("long").alias("leaf"))
    kept = stored(kept.join(leaves, "c", "left").na.fill(0, ["leaf"]), "weighted")
    dropped(rows)
    nodes = stored(kept.groupBy(*node).agg(
        F.min("c").alias("low"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.first("words").alias("words"), F.first("p1").alias("p1"), F.first("p2").alias("p2")), "nodes")
    cost = nodes.select(F.col("low").alias("c"), "at", ((F.col("n_convs") - 1) * F.col("words")).alias("cost"))
    back = Window.partitionBy("c").orderBy(F.desc("at"))
    saved = kept.join(cost, ["c", "at"], "left").withColumn(
        "below", F.sum(F.coalesce("cost", F.lit(0))).over(back)).groupBy(*node).agg(F.sum("below").alias("saved_tokens"))
    children = nodes.filter("at > 0").groupBy((F.col("at") - 1).alias("at"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("at") + 1).alias("at"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("low").alias("up"))
    out = nodes.join(above, ["at", "p1", "p2"], "left").join(saved, node).join(children, node, "left").join(
        sequences.select(*node, "ends"), node, "left")
    return out.select(
        F.col("low").alias("conv_id"), F.col("at").cast("long").alias("depth"), F.col("up").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
