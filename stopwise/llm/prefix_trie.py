"""The trie of conversation prefixes, with counts over whole subtrees.

1. Each turn becomes 128 bits of a SHA-256 of its role and text and a number of words; texts move
   no further. A prefix's key is the exclusive or, in two lanes, of hashes of its turns with their
   places. Both places and keys are prefix sums over range-sorted blocks, so one conversation may
   span any number of tasks.
2. The distinct keys are the nodes. Grouping them verifies them: all occurrences of a key must have
   the same parent key and the same last turn, so that by induction they are the same prefix.
3. A node's weight, the turns its members have from there on, bounds its subtree. Nodes heavier
   than a limit are the crown; below it each subtree lies whole in one shard.
4. A shard puts its nodes in a table by a minimal perfect hash: every key has a slot of its own, a
   key that is looked up is compared with the one in its slot. Counts are scattered to flat arrays
   by slot and, from the greatest depth upwards, added to the slots of the parents.
5. What subtrees add to the crown is summed by parent, and the crown goes through the same tables
   in bands of depth, the deepest first, none larger than twice the limit.

The limit grows with the square root of the turns, as does the number of crown nodes of one depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.hashing import GOLDEN, mixed
from stopwise.llm.text import count_words, written

LIMIT = 2_000
IDS_A_PIECE = 50_000
MOST_LEVELS = 200
KEY = ("at", "key_a", "key_b")


# ---------------------------------------------------------------- prefix sums over sorted blocks


def _within(kind: str, keys: np.ndarray, values: np.ndarray, carried: int, goes_on: bool) -> np.ndarray:
    """Inclusive prefix sums of ``values`` within runs of equal ``keys``; the first run adds to
    ``carried`` if it goes on from the batch before."""
    total = np.bitwise_xor.accumulate(values) if kind == "xor" else np.cumsum(values)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    before = np.where(starts > 0, total[starts - 1], 0)
    if goes_on:
        before[0] = carried if kind == "xor" else -carried
    before = np.repeat(before, np.diff(np.append(starts, len(keys))))
    return total ^ before if kind == "xor" else total - before


def _blocks(df: DataFrame, order: list[str], sums: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` range-sorted by ``conv`` and ``order``, with ``block`` and each of ``sums`` (name ->
    column, "sum" or "xor") over the rows of a conversation up to a row, all blocks counted."""
    spark = df.sparkSession
    carry = df.columns
    by = [F.asc_nulls_first(c) for c in ("conv", *order)]
    # Rows equal in all that is sorted by are the same; the draw only lets them part.
    sorted_rows = (
        df.withColumn("_draw", F.rand(7))
        .repartitionByRange(*by, F.col("_draw"))
        .sortWithinPartitions(*by)
        .select(*carry, F.spark_partition_id().alias("block"))
    )
    at = {name: carry.index(column) for name, (column, _) in sums.items()}
    key_at = carry.index("conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tail = None, dict.fromkeys(sums, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key_at).to_numpy(zero_copy_only=False)
            arrays = []
            for name, (_, kind) in sums.items():
                values = batch.column(at[name]).to_numpy(zero_copy_only=False)
                found = _within(kind, keys, values, tail[name], last == keys[0])
                tail[name] = int(found[-1])
                arrays.append(pa.array(found))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *sums])

    kinds = T.StructType(
        [*sorted_rows.schema.fields, *[T.StructField(name, T.LongType()) for name in sums]]
    )
    rows = written(spark, sorted_rows.mapInArrow(run, kinds), "trie-blocks")
    last_of = F.struct(*order, *sums)
    ends = rows.groupBy("conv", "block").agg(
        *[
            (F.max(name) if kind == "sum" else F.max_by(name, last_of)).alias(name)
            for name, (_, kind) in sums.items()
        ]
    )
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A block goes on with one conversation at most: no more rows than blocks.
    offsets = ends.select(
        F.col("conv").alias("_conv"),
        F.col("block").alias("_block"),
        F.count(F.lit(1)).over(earlier).alias("_blocks"),
        *[
            (F.sum(name) if kind == "sum" else F.bit_xor(name)).over(earlier).alias(f"_{name}")
            for name, (_, kind) in sums.items()
        ],
    ).where("_blocks > 0")

    def whole(name: str, kind: str):
        if kind == "sum":
            return F.col(name) + F.coalesce(f"_{name}", F.lit(0))
        return F.col(name).bitwiseXOR(F.coalesce(f"_{name}", F.lit(0)))

    joined = rows.join(
        F.broadcast(offsets), (F.col("conv") == F.col("_conv")) & (F.col("block") == F.col("_block")), "left"
    )
    return joined.select(*carry, *[whole(n, kind).alias(n) for n, (_, kind) in sums.items()])


# ---------------------------------------------------------------- conversations as sequences


def sequences(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, turn, role, text`` -> turns ``conv, at, said, words`` and ``conv, size``.

    Turns go by number, null first; those of one number by the digest of role and text. A null role
    or text is empty. Rows without a conv_id belong to no conversation. Other columns are not read.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(said), 1, 16).alias("said"),
        count_words(text).alias("words"),
        F.lit(1).cast("long").alias("one"),
    )
    # Sorting into ranges reads its input twice: digests, not texts.
    turns = written(spark, turns, "trie-turns")
    placed = _blocks(turns, ["turn", "said"], {"at": ("one", "sum")})
    sizes = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    return placed.select("conv", "at", "said", "words"), written(spark, sizes, "trie-sizes")


def branched(turns: DataFrame, sizes: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another: the first ``h`` turns of ``c`` are replaced by the
    first ``h`` of ``c - c % every`` (of the sign of c, as in SQL), h being the CRC-32 of c in decimal
    modulo ``most``."""
    spark = turns.sparkSession
    heads = sizes.select(F.col("conv").alias("_base"), F.col("size").alias("_base_size"))
    takes = (
        sizes.withColumn("base", F.col("conv") - F.col("conv") % every)
        .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % most)
        .join(heads, F.col("base") == F.col("_base"), "left")
        .withColumn("lent", F.least("h", F.coalesce("_base_size", F.lit(0))))
        .select(
            F.col("conv").alias("of"), "base", "h", "lent",
            (F.col("lent") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("size"),
        )
    )
    takes = written(spark, takes, "trie-takes")
    own = (
        turns.join(takes, F.col("conv") == F.col("of"))
        .where("at > h")
        .select("conv", (F.col("at") - F.col("h") + F.col("lent")).alias("at"), "size", "said", "words")
    )
    first = turns.where((F.col("at") < most) & (F.col("conv") % every == 0))
    borrowed = (
        takes.join(first, (F.col("base") == F.col("conv")) & (F.col("at") <= F.col("lent")))
        .select(F.col("of").alias("conv"), "at", "size", "said", "words")
    )
    return own.unionByName(borrowed), takes.select(F.col("of").alias("conv"), "size")


# ---------------------------------------------------------------- node tables


class NodeTable:
    """Distinct 128-bit keys in slots from 0 to their number, none empty.

    Level by level, keys that are alone in their place of an array twice as long as there are keys
    left keep it; the rank of the place is the slot. A lookup compares the key in the slot.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[np.ndarray] = []
        left, taken = np.arange(len(a)), 0
        while len(left):
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("a key occurs twice in a node table")
            place = self._place(a[left], b[left], len(self.levels), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            slot = np.where(alone, np.cumsum(alone) - 1 + taken, -1)
            self.levels.append(slot)
            taken += int(alone.sum())
            left = left[~alone[place]]
        self.a, self.b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        slots = self._slots(a, b)
        self.a[slots], self.b[slots] = a, b
        self.slot_of_rows = slots

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * int(GOLDEN) & (2**64 - 1))
        spread = mixed(a.view(np.uint64) ^ mixed(b.view(np.uint64) + salt))
        return (spread % np.uint64(size)).astype(np.int64)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, slots in enumerate(self.levels):
            found = slots[self._place(a[left], b[left], level, len(slots))]
            out[left] = found
            left = left[found < 0]
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slots of keys, -1 for those the table has not."""
        if not len(self.a):
            return np.full(len(a), -1, np.int64)
        slots = self._slots(a, b)
        same = (slots >= 0) & (self.a[slots] == a) & (self.b[slots] == b)
        return np.where(same, slots, -1)


DONE = (
    "at long, key_a long, key_b long, parent_a long, parent_b long, conv long, n long, "
    "parent_conv long, children long, leaves long, saved long"
)


def accumulated(nodes: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one table with what their subtrees hold. ``children``, ``leaves`` and ``saved``
    come in as what nodes outside the table add; a parent outside it gives a null parent_conv."""
    column = {name: nodes[name].to_numpy(np.int64) for name in nodes.columns if name != "shard"}
    table = NodeTable(column["key_a"], column["key_b"])
    slots = table.slot_of_rows
    by_slot = {name: np.empty_like(values) for name, values in column.items()}
    for name, values in column.items():
        by_slot[name][slots] = values
    depth, children, leaves = by_slot["at"], by_slot["children"], by_slot["leaves"]
    saved = by_slot["saved"] + (by_slot["n"] - 1) * by_slot["words"]
    parent = table.find(by_slot["parent_a"], by_slot["parent_b"])
    parent[depth == 0] = -1
    inside = parent >= 0
    np.add.at(children, parent[inside], 1)
    leaves = leaves + (children == 0)
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[inside[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    out = {name: by_slot[name] for name in ("at", "key_a", "key_b", "parent_a", "parent_b", "conv", "n")}
    above = pd.array(by_slot["conv"][parent], dtype="Int64")
    above[~inside] = pd.NA
    return pd.DataFrame({**out, "parent_conv": above, "children": children, "leaves": leaves, "saved": saved})


def _in_tables(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("shard").applyInPandas(accumulated, DONE)


def _added(done: DataFrame) -> DataFrame:
    """What nodes whose parent lies outside their table add to it."""
    return (
        done.where("parent_conv is null and at > 0")
        .groupBy(F.col("parent_a").alias("_a"), F.col("parent_b").alias("_b"))
        .agg(
            F.count(F.lit(1)).alias("children"),
            F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
        )
    )


ADDS = ("children", "leaves", "saved")


def _with_added(nodes: DataFrame, added: DataFrame) -> DataFrame:
    given = added.groupBy("_a", "_b").agg(*[F.sum(c).alias(f"_{c}") for c in ADDS])
    joined = nodes.join(given, (F.col("key_a") == F.col("_a")) & (F.col("key_b") == F.col("_b")), "left")
    return joined.select(*nodes.columns, *[F.coalesce(f"_{c}", F.lit(0)).alias(c) for c in ADDS])


def _banded(crown: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The crown with its bands of depth as ``shard``, and their number. A depth has at most about
    ``limit`` crown nodes, as their weights come to no more than all turns; a band twice as many."""
    depths = crown.groupBy("at").agg(F.count(F.lit(1)).alias("k"))
    reached = _blocks(depths.withColumn("conv", F.lit(0).cast("long")), ["at"], {"upto": ("k", "sum")})
    bands = written(
        crown.sparkSession,
        reached.select(
            F.col("at").alias("_at"), F.floor((F.col("upto") - F.col("k")) / limit).alias("shard")
        ),
        "trie-bands",
    )
    most = bands.agg(F.coalesce(F.max("shard") + 1, F.lit(0))).first()[0]
    return crown.join(bands, F.col("at") == F.col("_at")).drop("_at"), most


# ---------------------------------------------------------------- the trie


def _prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the key of the prefix they end and that of its parent."""
    hashed = turns.select(
        "conv", "at", "size", "said", "words",
        F.xxhash64("at", "said").alias("own_a"),
        F.xxhash64("said", "at", F.lit(1)).alias("own_b"),
    )
    keyed = _blocks(hashed, ["at"], {"key_a": ("own_a", "xor"), "key_b": ("own_b", "xor")})
    return keyed.select(
        "conv", "at", "size", "said", "words", "key_a", "key_b",
        F.col("key_a").bitwiseXOR(F.col("own_a")).alias("parent_a"),
        F.col("key_b").bitwiseXOR(F.col("own_b")).alias("parent_b"),
    )


def _nodes(prefixes: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per distinct prefix, the empty one included if there is any conversation."""
    spark = prefixes.sparkSession
    zero = F.lit(0).cast("long")
    same = F.struct("parent_a", "parent_b", "said", "words")
    found = (
        prefixes.groupBy(*KEY)
        .agg(
            F.min("conv").alias("conv"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("size") - F.col("at") + 1).alias("weight"),
            F.min(same).alias("_least"),
            F.max(same).alias("_greatest"),
        )
        .select(
            *KEY, "_least.parent_a", "_least.parent_b", "conv", "n", "_least.words", "weight",
            (F.col("_least") != F.col("_greatest")).alias("clash"),
        )
    )
    root = sizes.agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight")
    ).where("n > 0")
    root = root.select(
        *[zero.alias(c) for c in (*KEY, "parent_a", "parent_b")], "conv", "n",
        zero.alias("words"), "weight", F.lit(False).alias("clash"),
    )
    nodes = written(spark, found.unionByName(root), "trie-nodes")
    if not nodes.where("clash").isEmpty():
        raise ValueError("two different prefixes have the same digest")
    return nodes.drop("clash")


def _ends(prefixes: DataFrame, sizes: DataFrame, ids: int = IDS_A_PIECE) -> DataFrame:
    """Per node where conversations end, the SHA-256 of their ids in ascending order.

    Ids are range-sorted by node, so those of one node may span many tasks, each of which joins its
    own into pieces of text. A digest takes its input in order: one task reads the pieces of a node,
    one batch at a time, and keeps nothing but the digest's state.
    """
    zero = F.lit(0).cast("long")
    ending = prefixes.where("at = size").select(*KEY, "conv").unionByName(
        sizes.where("size = 0").select(*[zero.alias(c) for c in KEY], "conv")
    )

    def runs(batch: pa.RecordBatch) -> list[tuple[tuple[int, int, int], int, int]]:
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.flatnonzero(new).tolist()
        stops = [*starts[1:], batch.num_rows]
        return [(tuple(int(k[a]) for k in keys), a, b) for a, b in zip(starts, stops) if b > a]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs = batch.column(3).to_pylist()
            rows = [
                (*key, convs[k], ",".join(map(str, convs[k : min(k + ids, b)])))
                for key, a, b in runs(batch)
                for k in range(a, b, ids)
            ]
            kinds = [pa.int64()] * 4 + [pa.string()]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], [*KEY, "first", "ids"]
            )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def put(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], [*KEY, "ends_sha256"]
            )

        for batch in batches:
            texts, rows = batch.column(4), []
            for key, a, b in runs(batch):
                if key != now:
                    if now is not None:
                        rows.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(texts[a].as_py().encode())
                    a += 1
                for k in range(a, b):
                    state.update(b"," + texts[k].as_py().encode())
            yield put(rows)
        if now is not None:
            yield put([(*now, state.hexdigest())])

    pieces = (
        ending.repartitionByRange(*KEY, "conv")
        .sortWithinPartitions(*KEY, "conv")
        .mapInArrow(joined, "at long, key_a long, key_b long, first long, ids string")
    )
    return (
        pieces.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first")
        .mapInArrow(digested, "at long, key_a long, key_b long, ends_sha256 string")
    )


def trie(turns: DataFrame, sizes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Turns ``conv, at, size, said, words`` and ``conv, size`` of all conversations, those without
    turns included -> one row per distinct prefix:

    ``conv_id`` (the least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. No conversation, no rows.
    Conversations of the same turns are members of the same nodes.
    """
    spark = turns.sparkSession
    prefixes = written(spark, _prefixes(turns), "trie-prefixes")
    nodes = _nodes(prefixes, sizes)
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    limit = max(limit, isqrt(total))
    heavy = (F.col("weight") > limit) | (F.col("at") == 0)
    crown = written(spark, nodes.where(heavy).drop("weight"), "trie-crown")

    # Each conversation leaves the crown at one prefix, the top of the subtree it goes on in.
    marks = crown.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.lit(True).alias("_in_crown"))
    at_crown = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_{c}") for c in KEY])
    tops = (
        prefixes.select(*KEY, "conv")
        .join(marks, at_crown, "left")
        .where("_in_crown is null")
        .groupBy(F.col("conv").alias("_conv"))
        .agg(F.min(F.struct(*KEY)).alias("_top"))
    )
    shards = max(1, -(-total // limit))
    sharded = (
        nodes.where(~heavy)
        .join(tops, F.col("conv") == F.col("_conv"))
        .withColumn("shard", F.pmod(F.xxhash64("_top.key_a", "_top.key_b"), F.lit(shards)))
        .drop("weight", "_conv", "_top")
        .select("*", *[F.lit(0).cast("long").alias(c) for c in ADDS])
    )
    done = [written(spark, _in_tables(sharded), "trie-shards")]
    added = written(spark, _added(done[0]), "trie-added")

    from_below = added
    crown, bands = _banded(crown, limit)
    for band in range(bands - 1, -1, -1):
        rows = _with_added(crown.where(F.col("shard") == band), from_below)
        done.append(written(spark, _in_tables(rows), "trie-band"))
        from_below = added.unionByName(_added(done[-1]))

    whole = reduce(DataFrame.unionByName, done)
    above = crown.select(
        F.col("key_a").alias("_a"), F.col("key_b").alias("_b"), F.col("conv").alias("_above"), F.col("at").alias("_at")
    )
    outside = whole.where("parent_conv is null and at > 0").join(
        above,
        (F.col("parent_a") == F.col("_a"))
        & (F.col("parent_b") == F.col("_b"))
        & (F.col("at") - 1 == F.col("_at")),
    )
    outside = outside.withColumn("parent_conv", F.col("_above")).select(*whole.columns)
    complete = whole.where("parent_conv is not null or at = 0").unionByName(outside)
    ends = _ends(prefixes, sizes).select(
        *[F.col(c).alias(f"_{c}") for c in KEY], "ends_sha256"
    )
    return complete.join(ends, at_crown, "left").select(
        F.col("conv").alias("conv_id"),
        F.col("at").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
