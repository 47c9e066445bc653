"""The prefix trie of conversations: which openings are shared, by whom, and what sharing saves.

Turns become ids of a dictionary, conversations are dealt out by ranges of their id sequences, and every shard builds a
ternary search tree, the median sequence first.  Only the paths to a shard's first and last sequence can
go on in other shards; these are merged in one sweep over the shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import shuffle_partitions
from tidemill.plans.shared import run_dir

#: turns that one shard holds, about
SHARD_TURNS = 200_000
#: rows of a result batch
BATCH_ROWS = 20_000
FIRST, LAST = 0, 1

_SHARD = (
    "shard long, side int, depth long, turn long, size long, conv long, up_conv long, up_side int, "
    "n_convs long, n_children long, n_leaves long, saved long, ends string"
)
_SWEPT = (
    "shard long, side int, depth long, node_shard long, node_side int, conv long, up_shard long, up_side int, "
    "n_convs long, n_children long, n_leaves long, saved long, ends string"
)
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _batches(rows: Iterable[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    fields = [f.split() for f in ddl.split(", ")]
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in fields])
    some: list[tuple] = []

    def made():
        columns = zip(*some)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        some.append(row)
        if len(some) == BATCH_ROWS:
            yield made()
            some.clear()
    if some:
        yield made()


class Tree:
    """A ternary search tree: below a node's middle link come the turns that follow it, and among these
    the lower and upper links search.  Node 0 is the textless root."""

    def __init__(self):
        self.turn, self.size, self.up, self.depth = [-1], [0], [-1], [0]
        self.low, self.middle, self.high = [-1], [-1], [-1]
        self.members: list[list[int]] = [[]]

    def _new(self, turn: int, size: int, up: int) -> int:
        self.turn.append(turn)
        self.size.append(size)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        for link in (self.low, self.middle, self.high):
            link.append(-1)
        self.members.append([])
        return len(self.turn) - 1

    def add(self, turns: list[int], sizes: list[int], members: list[int]) -> None:
        node = 0
        for turn, size in zip(turns, sizes):
            links, at = self.middle, node
            while (found := links[at]) >= 0 and self.turn[found] != turn:
                links, at = (self.low if turn < self.turn[found] else self.high), found
            if found < 0:
                found = links[at] = self._new(turn, size, node)
            node = found
        self.members[node] = members

    @classmethod
    def balanced(cls, sequences: list[tuple[list[int], list[int], list[int]]]) -> Tree:
        """Of ascending sequences the median goes in first, then those of both halves."""
        tree, halves = cls(), [(0, len(sequences))]
        while halves:
            a, b = halves.pop()
            if a < b:
                median = (a + b) // 2
                tree.add(*sequences[median])
                halves += [(median + 1, b), (a, median)]
        return tree

    def walk(self) -> list[int]:
        """All nodes in the order of their sequences, a node before those below it."""
        out, open_ = [], [(0, False)]
        while open_:
            node, ready = open_.pop()
            if ready:
                out.append(node)
                if self.middle[node] >= 0:
                    open_.append((self.middle[node], False))
                continue
            if self.high[node] >= 0:
                open_.append((self.high[node], False))
            open_.append((node, True))
            if self.low[node] >= 0:
                open_.append((self.low[node], False))
        return out

    def path(self, turns: list[int]) -> list[int]:
        node, out = 0, [0]
        for turn in turns:
            node = self.middle[node]
            while self.turn[node] != turn:
                node = self.low[node] if turn < self.turn[node] else self.high[node]
            out.append(node)
        return out


def _digest(members: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, members)).encode()).hexdigest()


def shard_rows(shard: int, sequences: list[tuple[list[int], list[int], list[int]]]) -> Iterator[tuple]:
    """Rows of ``_SHARD``: finished nodes (no ``side``), and what the shard knows of the nodes on its first and last path."""
    tree = Tree.balanced(sequences)
    n = len(tree.turn)
    side: list[int | None] = [None] * n
    for which, (turns, _, _) in ((LAST, sequences[-1]), (FIRST, sequences[0])):
        for node in tree.path(turns):
            side[node] = which
    conv = [min(m, default=None) for m in tree.members]
    n_convs = [len(m) for m in tree.members]
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    order = tree.walk()
    for node in reversed(order):
        up = tree.up[node]
        if side[node] is None:
            leaves[node] += not children[node]
            saved[node] += (n_convs[node] - 1) * tree.size[node]
        if up >= 0:
            n_convs[up] += n_convs[node]
            if conv[up] is None or conv[node] < conv[up]:
                conv[up] = conv[node]
            if side[node] is None:  # otherwise the sweep hands on what it finds
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
    for node in order:
        up, own = tree.up[node], side[node]
        inner_up = up >= 0 and side[up] is None
        ends = _digest(tree.members[node]) if own is None else ",".join(map(str, tree.members[node]))
        yield (
            shard, own, tree.depth[node], tree.turn[node], tree.size[node], conv[node], conv[up] if inner_up else None,
            side[up] if up >= 0 else None, n_convs[node], children[node], leaves[node], saved[node], ends,
        )


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sequences: list[tuple[list[int], list[int], list[int]]] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("turns", "sizes", "conv"))
        for turns, sizes, conv in zip(*columns):
            if not sequences or sequences[-1][0] != turns:
                sequences.append((turns, sizes, []))
            sequences[-1][2].append(conv)
    if sequences:
        yield from _batches(shard_rows(TaskContext.get().partitionId(), sequences), _SHARD)


class _Open:
    """A node of the sweep that may still get members."""

    def __init__(self, shard: int, side: int, turn: int, size: int):
        self.shard, self.side, self.turn, self.size = shard, side, turn, size
        self.conv: int | None = None
        self.n_convs = self.children = self.leaves = self.saved = 0
        self.ends, self.any = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        self.conv = row["conv"] if self.conv is None else min(self.conv, row["conv"])
        self.n_convs += row["n_convs"]
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved"]
        if row["ends"]:
            self.ends.update(("," * self.any + row["ends"]).encode())
            self.any = True


def swept(rows: Iterable[dict]) -> Iterator[tuple]:
    """Path rows by shard, side and depth to rows of ``_SWEPT``: for each path row its node, and every node once it is complete.

    Consecutive shards meet in the common part of the last path of one and the first path of the next;
    memory is one path."""
    stack: list[_Open] = []

    def close(depth: int) -> Iterator[tuple]:
        while len(stack) > depth:
            node = stack.pop()
            node.leaves += not node.children
            node.saved += (node.n_convs - 1) * node.size
            up = stack[-1] if stack else None
            if up:
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
            yield (
                None, None, len(stack), node.shard, node.side, node.conv, up and up.shard, up and up.side,
                node.n_convs, node.children, node.leaves, node.saved, node.ends.hexdigest(),
            )

    for row in rows:
        depth = row["depth"]
        if depth >= len(stack) or stack[depth].turn != row["turn"]:
            yield from close(depth)
            stack.append(_Open(row["shard"], row["side"], row["turn"], row["size"]))
        node = stack[depth]
        node.add(row)
        yield (row["shard"], row["side"], depth, node.shard, node.side, *[None] * 8)
    yield from close(0)


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(swept(row for batch in batches for row in batch.to_pylist()), _SWEPT)


def numbered_turns(
    table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv``, ``pos`` (from 1, by turn with null first, then by role and text), ``key`` (SHA-256 of role and text) and
    ``size`` (code points of the text).  Null role and text are empty; rows without a conversation are left out."""
    said = table.filter(table[conv_col].isNotNull()).select(
        table[conv_col].cast("long").alias("conv"),
        table[turn_col].alias("turn"),
        F.coalesce(table[role_col].cast("string"), F.lit("")).alias("role"),
        F.coalesce(table[text_col].cast("string"), F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    key = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return said.select("conv", place.cast("long").alias("pos"), key.alias("key"), F.char_length("text").cast("long").alias("size"))


def prefix_nodes(turns: DataFrame, conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row for each distinct sequence of first turns, from the root (no turns) on.

    ``turns`` has ``conv``, ``pos``, ``key`` and ``size`` as :func:`numbered_turns` gives them; ``conversations`` names in ``conv`` all
    members once, also those without a turn.  Columns: ``id_col`` (the smallest member), ``depth``,
    ``parent_<id_col>``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree, the code points of each
    node's last turn for every member but one) and ``ends_sha256`` (of the members that end at the node, ascending, with commas).

    * Keys tell turns apart; a null key or size is a turn of its own kind, of size 0.  Equal conversations are members of the same nodes.
    * No conversations: no node, not even a root.  Without turns: the root alone.
    * A conversation's ids (8 bytes a turn) are one unit; a group of equal conversations, however large, is cut between shards
      by id.  The sweep is one task that reads two paths for each shard, and the ids of members only where they
      end on such a path; its memory is one path.
    """
    spark = turns.sparkSession
    folder = run_dir(spark, "trie")
    # the dictionary is written, so that ids never change
    key = F.coalesce(F.col("key").cast("binary"), F.lit(b"null").cast("binary")).alias("key")
    turns = turns.select("conv", "pos", key, F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    words = turns.groupBy("key").agg(F.max("size").alias("size"))
    words.withColumn("turn", F.monotonically_increasing_id()).write.parquet(f"{folder}/turns")
    words = spark.read.parquet(f"{folder}/turns")
    coded = turns.drop("size").join(words, "key").select("conv", F.struct("pos", "turn", "size").alias("t"))
    none = F.lit(None).cast("struct<pos:long,turn:long,size:long>").alias("t")
    both = coded.withColumn("t", F.col("t").cast("struct<pos:long,turn:long,size:long>")).unionByName(conversations.select("conv", none))
    ordered = both.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    ordered = ordered.select("conv", F.col("t.turn").alias("turns"), F.col("t.size").alias("sizes"))
    shards = max(shuffle_partitions(spark), -(-turns.count() // SHARD_TURNS))
    dealt = ordered.repartitionByRange(shards, "turns", "conv").sortWithinPartitions("turns", "conv")
    dealt.mapInArrow(_build, _SHARD).write.parquet(f"{folder}/shards")
    built = spark.read.parquet(f"{folder}/shards")

    paths = built.filter(F.col("side").isNotNull()).repartition(1).sortWithinPartitions("shard", "side", "depth")
    paths.mapInArrow(_sweep, _SWEPT).write.parquet(f"{folder}/swept")
    merged = spark.read.parquet(f"{folder}/swept")
    node = ("conv", "depth", "up_conv", "n_convs", "n_children", "n_leaves", "saved", "ends")
    nodes = merged.filter(F.col("n_convs").isNotNull()).drop("shard", "side")
    names = nodes.select(F.col("node_shard").alias("up_shard"), F.col("node_side").alias("up_side"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv").alias("up_conv"))
    shared = nodes.join(names, ["up_shard", "up_side", "depth"], "left").select(*node)
    inner = built.filter(F.col("side").isNull())
    # finished nodes whose parent is on a path of their shard
    places = merged.filter(F.col("n_convs").isNull()).select("shard", "side", (F.col("depth") + 1).alias("depth"), "node_shard", "node_side")
    parents = places.join(
        names.withColumnsRenamed({"up_shard": "node_shard", "up_side": "node_side", "up_conv": "path_conv"}), ["node_shard", "node_side", "depth"]
    ).select("shard", F.col("side").alias("up_side"), "depth", "path_conv")
    hung = inner.filter(F.col("up_side").isNotNull()).join(parents, ["shard", "up_side", "depth"], "left")
    hung = hung.withColumn("up_conv", F.col("path_conv")).select(*node)
    deep = inner.filter(F.col("up_side").isNull()).select(*node)
    return shared.unionByName(hung).unionByName(deep).toDF(
        id_col, "depth", f"parent_{id_col}", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
