"""Conversation prefix trie over sorted sequences.

All conversations are sorted by their turns' digests.  The members of a prefix then lie side by side,
and two neighbours share as many first turns as their LCP says.  Each distinct prefix is a candidate at
the first conversation that has it.  A sparse table answers the least LCP of any range, so every
candidate finds its left and its right extent by a binary search of its own, without a stack and
without the other candidates.  What a node reports follows from its extent by running sums.

The order is cut into blocks, one per partition.  An extent that reaches the end of a block is a piece;
pieces of one prefix are added up by the prefix's digest, of which a block has no more than it shares
turns with its two neighbours.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import cut, map_batches

TURNS = 1 << 18                      # turns of a block, about
_PIECE = ("pid int, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
          "n_children bigint, n_leaves bigint, saved_tokens bigint, ends string")


def turn_arrays(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """conv_id, turns: each conversation's turns in order as (digest, size) of role and text.

    Turns go by ``turn``, null first, equal ones by their digest.  Null role or text counts as empty.
    ``size`` is the code points of the text; texts themselves are not gathered.  Rows that repeat are turns
    of their own.  Rows without conversation id are left out, as they belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
                                digest.alias("digest"), F.length(text).cast("bigint").alias("size")).where("conv_id IS NOT NULL")
    turns = F.sort_array(F.collect_list(F.struct("turn", "digest", "size")))
    return rows.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["digest"], t["size"])).alias("turns"))


def shared_heads(arrays: DataFrame, stride: int = 100, modulus: int = 6) -> DataFrame:
    """``arrays`` with the first h turns of conversation c - c % stride, then c's own after its first h;
    h is the unsigned CRC-32 of the decimal c modulo ``modulus``."""
    arrays = cut(arrays)
    base = F.col("conv_id") - F.col("conv_id") % stride
    heads = (arrays.where(F.col("conv_id") % stride == 0)
             .select(F.col("conv_id").alias("base"), F.slice("turns", 1, modulus - 1).alias("head")))
    h = (F.crc32(F.col("conv_id").cast("string")) % modulus).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    return arrays.join(heads, base == F.col("base"), "left").select("conv_id", F.concat(head, own).alias("turns"))


def common_turns(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common prefix of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("bigint")


class RangeLeast:
    """Sparse table: the least of any range of an array by two lookups."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value of [first, last], both included and not empty."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][first[at]], self.rows[k][last[at] - (1 << int(k)) + 1])
        return out

    def right(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The largest r with all of (start, r] at least ``bound``: a binary search by halving steps."""
        at = start.copy()
        for k in reversed(range(len(self.rows))):
            row = self.rows[k]
            fits = at + (1 << k) < len(self.rows[0])
            step = fits & (row[np.where(fits, at + 1, 0)] >= bound)
            at[step] += 1 << k
        return at

    def left(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest l with all of (l, start] at least ``bound``."""
        at = start.copy()
        for k in reversed(range(len(self.rows))):
            row = self.rows[k]
            fits = at - (1 << k) >= 0
            step = fits & (row[np.where(fits, at - (1 << k) + 1, 0)] >= bound)
            at[step] -= 1 << k
        return at


def _prefix_keys(digests: list[bytes], depth: int) -> list[bytes]:
    """A digest of each of the prefixes of up to ``depth`` turns."""
    state, keys = hashlib.sha256(), []
    for d in range(depth + 1):
        keys.append(state.digest())
        if d < depth:
            state.update(digests[d])
    return keys


class Block:
    """One run of the sorted order, with the LCP to the conversation before (``before``) and after it
    (``after``); -1 stands for none."""

    def __init__(self, ids: np.ndarray, digests: list[list[bytes]], sizes: list[np.ndarray], before: int, after: int):
        self.ids, self.digests, self.n = ids, digests, len(ids)
        self.lens = np.array([len(x) for x in digests], np.int64)
        self.starts = np.cumsum(self.lens + 1) - self.lens - 1          # sums[starts[i] + d]: first d turns of i
        self.sums = np.concatenate([np.concatenate([[0], np.cumsum(s)]) for s in sizes]).astype(np.int64)
        self.lcp = np.empty(self.n + 1, np.int64)
        self.lcp[0], self.lcp[-1] = before, after
        for i in range(1, self.n):
            a, b = digests[i - 1], digests[i]
            m = min(len(a), len(b))
            self.lcp[i] = m if a[:m] == b[:m] else next(j for j in range(m) if a[j] != b[j])
        self.range = RangeLeast(self.lcp[:-1])
        self.first_id = RangeLeast(ids)
        total = self.prefix(np.arange(self.n), self.lens)
        self.total = np.concatenate([[0], np.cumsum(total)])
        new = total - self.prefix(np.arange(self.n), np.maximum(self.lcp[:-1], 0))
        self.new = np.concatenate([[0], np.cumsum(new)])                # texts of the nodes that a row is first to have
        self.leaves = np.concatenate([[0], np.cumsum(self.lcp[1:] < self.lens)])
        branch = np.flatnonzero(self.lens > self.lcp[:-1])
        branch = branch[branch > 0]
        self.branches = np.sort(self.lcp[branch] * self.n + branch)
        same = np.flatnonzero((self.lcp[1:-1] != self.lens[:-1]) | (self.lcp[1:-1] != self.lens[1:]))
        self.run_end = np.append(same, self.n - 1)                      # last row of each run of equal sequences

    def prefix(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.sums[self.starts[row] + depth]

    def extents(self, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.range.left(row, depth), self.range.right(row, depth)

    def nodes(self) -> dict[str, np.ndarray]:
        """Every prefix that the block has, once: its extent and what follows from it."""
        since = np.where(np.arange(self.n) > 0, self.lcp[:-1] + 1, 0)
        count = self.lens - since + 1
        row = np.repeat(np.arange(self.n), count)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + since[row]
        left, right = self.extents(row, depth)
        goes_on = (left == 0) & (self.lcp[0] >= depth)                  # from the block before
        open_ = goes_on | ((right == self.n - 1) & (self.lcp[-1] >= depth))
        up = np.maximum(depth - 1, 0)
        before = self.prefix(row, up)
        n = right - left + 1
        new = self.new[right + 1] - self.new[left + 1] + np.where(goes_on, self.new[1], self.total[left + 1] - self.total[left] - before)
        children = (np.searchsorted(self.branches, depth * self.n + right, "right")
                    - np.searchsorted(self.branches, depth * self.n + left, "right")
                    + (np.where(goes_on, self.lcp[0] == depth, True) & (self.lens[left] > depth)))
        above_left, above_right = self.extents(row, up)
        above_open = ((above_left == 0) & (self.lcp[0] >= up)) | ((above_right == self.n - 1) & (self.lcp[-1] >= up))
        last = self.run_end[np.searchsorted(self.run_end, left)]
        return {"depth": depth, "left": left, "right": right, "open": open_, "n_convs": n,
                "conv_id": self.first_id.least(left, right), "n_children": children,
                "n_leaves": self.leaves[right + 1] - self.leaves[left],
                "saved_tokens": self.total[right + 1] - self.total[left] - n * before - new,
                "goes_on": goes_on, "above_goes_on": (above_left == 0) & (self.lcp[0] >= up),
                "above_open": above_open & (depth > 0), "parent_conv_id": self.first_id.least(above_left, above_right),
                "ends": np.where(self.lens[left] == depth, last + 1, left)}


def _blocks(shared):
    def run(batches):
        ids, digests, sizes, pid = [], [], [], None
        for batch in batches:
            if batch.num_rows:
                pid = batch.column(0)[0].as_py()
                ids.append(batch.column(1).to_numpy())
                digests += batch.column(2).to_pylist()
                flat, at = batch.column(3).flatten().to_numpy(), np.asarray(batch.column(3).offsets)
                sizes += np.split(flat, at[1:-1] - at[0])
        if pid is None:
            return
        block = Block(np.concatenate(ids), digests, sizes, *shared.value[pid])
        nodes = block.nodes()
        low, high = _prefix_keys(digests[0], max(block.lcp[0], 0)), _prefix_keys(digests[-1], max(block.lcp[-1], 0))
        for first in range(0, len(nodes["depth"]), 1 << 13):
            some = {k: v[first:first + (1 << 13)] for k, v in nodes.items()}
            keys, above, ends = [], [], []
            for d, o, f, u, g, a, b in zip(*(some[k].tolist() for k in (
                    "depth", "open", "goes_on", "above_open", "above_goes_on", "left", "ends"))):
                line = ",".join(map(str, block.ids[a:b].tolist()))
                keys.append((low if f else high)[d] if o else None)
                above.append((low if g else high)[d - 1] if u else None)
                ends.append((line if b > a else None) if o else hashlib.sha256(line.encode()).hexdigest())
            known = (some["depth"] > 0) & ~some["above_open"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), pid, np.int32)), pa.array(keys, pa.binary()), pa.array(above, pa.binary()),
                 pa.array(some["conv_id"]), pa.array(some["depth"]), pa.array(some["parent_conv_id"], mask=~known),
                 *(pa.array(some[k].astype(np.int64)) for k in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
                 pa.array(ends, pa.string())],
                [c.split()[0] for c in _PIECE.split(", ")])
    return run


def _joined(batches):
    """SHA-256 of each key's comma-joined strings; rows come sorted by key and place."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(part.encode())
            else:
                state.update(b"," + part.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())],
                                         ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def _neighbours(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """For each partition that has rows, the LCP over its first and over its last edge; -1 at the ends."""
    spark = ordered.sparkSession
    edges = cut(ordered.groupBy("pid").agg(F.min(F.struct("key", "conv_id"))["key"].alias("first"),
                                           F.max(F.struct("key", "conv_id"))["key"].alias("last")))
    pids = sorted(r["pid"] for r in edges.select("pid").collect())              # one number per partition
    out = {p: [-1, -1] for p in pids}
    if len(pids) > 1:
        follows = F.broadcast(spark.createDataFrame(list(zip(pids, pids[1:])), "pid int, then int"))
        pairs = (edges.select("pid", "last").join(follows, "pid")
                 .join(edges.select(F.col("pid").alias("then"), "first"), "then")
                 .select("pid", "then", common_turns("last", "first").alias("lcp")))
        for r in pairs.collect():
            out[r["pid"]][1] = out[r["then"]][0] = r["lcp"]
    return {p: tuple(x) for p, x in out.items()}


def prefix_trie(sequences: DataFrame, block_turns: int = TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``sequences`` has a distinct conv_id and ``turns``, an array of (digest, size).  Each distinct sequence of
    first d turns is a node of depth d, the root has depth 0; its members are the conversations that
    start so.  ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (root: null),
    ``n_leaves`` counts the childless nodes of the subtree, the node included, ``saved_tokens`` sums each
    node's (n_convs - 1) times its last turn's size over the subtree, and ``ends_sha256`` digests the ids of the members
    without further turn, ascending and comma-joined.

    Sequences without turns are members of the root.  Many equal sequences are spread over blocks by
    their ids, and no task holds a whole group: pieces are sums, and ids of one end are digested as a stream.  A task holds
    the digests of about ``block_turns`` turns, or of one longer conversation.  No sequences give no rows.
    """
    spark = sequences.sparkSession
    rows = cut(sequences.select("conv_id", F.col("turns.digest").alias("key"), F.col("turns.size").alias("sizes")))
    turns = rows.agg(F.sum(F.size("key") + F.lit(1).cast("bigint"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // block_turns))
    ordered = cut(rows.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
                  .select(F.spark_partition_id().alias("pid"), "conv_id", "key", "sizes"))
    shared = spark.sparkContext.broadcast(_neighbours(ordered))                  # two numbers per partition
    pieces = cut(map_batches(ordered, _blocks(shared), _PIECE))
    report = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = pieces.where("key IS NULL").withColumnRenamed("ends", "ends_sha256")
    parts = pieces.where("key IS NOT NULL")
    ends = map_batches(parts.where("ends IS NOT NULL").repartition("key").sortWithinPartitions("key", "pid").select("key", "ends"),
                       _joined, "key binary, ends_sha256 string")
    merged = parts.groupBy("key", "depth").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    merged = cut(merged.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))))
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    # each block looks up its own few open prefixes, so that a common parent is no hot key
    here = parts.select("pid", F.col("key").alias("parent_key")).join(named, "parent_key")
    return (whole.where("parent_key IS NULL").select(report)
            .unionByName(whole.where("parent_key IS NOT NULL").drop("parent_conv_id").join(here, ["pid", "parent_key"]).select(report))
            .unionByName(merged.join(named, "parent_key", "left").select(report)))


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", block_turns: int = TURNS) -> DataFrame:
    """``prefix_trie`` of the conversations as they are; ``turn_arrays`` says what nulls and repeated rows give.
    Other columns are ignored."""
    return prefix_trie(turn_arrays(conversations, conv_col, turn_col, role_col, text_col), block_turns)
