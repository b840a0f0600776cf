"""Trie of conversation prefixes, by union-find over the edges between sorted neighbours.

A conversation is the sequence of the digests of its turns.  Sorted, conversations with a
common prefix are neighbours, and each neighbouring pair is an edge whose depth is the
length of their longest common prefix (LCP).

1. Tasks get ranges of the sorted order and work in blocks of bounded size.  A block joins
   its conversations by union-find along the edges in descending depth.  A merge at depth
   d creates the branching node of depth d, or adds a child to one; the turns between two
   branching nodes are a chain of nodes with the same members.
2. Only the paths of the first and of the last conversation of a block can go on beyond
   it.  All other nodes are finished in the block; the forest is contracted to these two
   paths, whose nodes carry counts of what hangs below them.
3. The contracted forests of all blocks are merged in order, on a stack that holds one
   path.  Its input is two paths a block, not the conversations.

The members that end in a node are neighbours too, in the order of their ids, so their
list is hashed as it passes by and never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.llm.batches import bounded

BORROWED = 9
FAMILY = 5
BLOCK = 20_000
BLOCK_TURNS = 200_000
DIGEST = 16
STATISTICS = ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PATH = "place long, part int, block int, side int, above int, digest binary, size long, ends string, parent long"
NO_ENDS = hashlib.sha256().hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): digests and bytes of the turns in order, a conversation a row.

    A null role or text is empty.  Turns come by ``turn``, null first; equal ones by digest.
    Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    family = F.expr(f"conv_id - conv_id % {FAMILY}").alias("family")
    # dealt by family once: neither the grouping nor the look at the family's head needs another shuffle
    together = own.select(family, "conv_id", "t").repartition("family")
    return together.groupBy("family", "conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of every conversation, rebuilt.

    The first h turns are those of conversation c - c % 5 (all if it has fewer, none if
    absent), then come c's own turns after its first h; h = crc32(c) % 9.  ``key`` is the
    16 bytes of each turn's digest, one after the other.
    """
    head = F.first(F.expr(f"CASE WHEN conv_id = family THEN slice(turns, 1, {BORROWED - 1}) END"), ignorenulls=True)
    h = F.expr(f"CAST(crc32(CAST(CAST(conv_id AS string) AS binary)) % {BORROWED} AS int)")
    own = turns(conversations).select("*", head.over(Window.partitionBy("family")).alias("head"), h.alias("h"))
    made = F.expr("concat(CASE WHEN head IS NULL THEN slice(turns, 1, 0) ELSE slice(head, 1, h) END, slice(turns, h + 1, size(turns)))")
    whole = own.select("conv_id", made.alias("t"))
    return whole.select("conv_id", F.expr("unhex(array_join(t.digest, ''))").alias("key"), F.expr("t.size").alias("sizes"))


def neighbour_lcp(keys: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Common turns of each conversation and the one before it; -1 for the first."""
    out = np.minimum(lengths, np.append(0, lengths[:-1]))
    raw = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    row = np.repeat(np.arange(len(out)), out)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(out) - out, out)
    differs = (raw[begins[row] + inner] != raw[begins[row - 1] + inner]).any(axis=1)
    at = np.flatnonzero(differs)[::-1]
    out[row[at]] = inner[at]  # the first difference of a row is written last
    out[0] = -1
    return out


class Forest:
    """Components of sorted neighbours, joined along edges of descending depth.

    Node i < n is the place where conversation i ends, the others branch.  ``parent`` is
    -1 at the top and -2 for a conversation that ends where the one before it does.
    """

    def __init__(self, lengths: np.ndarray, lcp: np.ndarray, ids: list[int]) -> None:
        n = len(lengths)
        self.depth, self.least = lengths.tolist(), list(ids)
        self.low, self.high, self.parent = list(range(n)), list(range(1, n + 1)), [-1] * n
        up, node, depths = list(range(n)), list(range(n)), lcp.tolist()  # node: the top of a component, by its root

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for i in (np.argsort(-lcp[1:], kind="stable") + 1).tolist():
            a, b, depth = find(i - 1), find(i), depths[i]
            x, y = node[a], node[b]
            if self.depth[x] > depth:
                top = len(self.depth)
                for of, value in ((self.depth, depth), (self.least, self.least[x]), (self.low, self.low[x]), (self.high, 0), (self.parent, -1)):
                    of.append(value)
                self.parent[x] = top
            else:
                top = x
            # edges of one depth come from the left, so a right side of this depth is a single copy of the left one's text
            self.parent[y] = top if self.depth[y] > depth else -2
            self.high[top], self.least[top] = self.high[y], min(self.least[top], self.least[y])
            up[b], node[a] = a, top

    def path(self, node: int) -> list[int]:
        """The nodes from the top down to this one."""
        out = [node]
        while self.parent[out[-1]] >= 0:
            out.append(self.parent[out[-1]])
        return out[::-1]


def ids_text(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def block_nodes(keys: list[bytes], ids: list[int], sizes: np.ndarray, part: int, block: int, place: int) -> tuple[dict, dict]:
    """Finished nodes of a block of sorted conversations, and the nodes of its first and last path.

    ``sizes`` are the bytes of all turns, conversation by conversation; the nodes of the
    paths have the places from ``place`` on.
    """
    n = len(keys)
    lengths = np.array([len(k) // DIGEST for k in keys])
    lcp = neighbour_lcp(keys, lengths)
    forest = Forest(lengths, lcp, ids)
    total = np.append(0, np.cumsum(sizes))
    begins = np.cumsum(lengths) - lengths
    depth, low, high, parent, least = (np.array(x) for x in (forest.depth, forest.low, forest.high, forest.parent, forest.least))
    above = np.where(parent >= 0, depth[parent], -1)
    copy = parent == -2
    run = np.flatnonzero(~copy[:n])  # a conversation and its copies
    run_end = np.append(run[1:], n)
    end_of = dict(zip(run.tolist(), run_end.tolist()))
    first, last = forest.path(0), forest.path(int(run[-1]))
    is_open = np.zeros(len(depth), bool)
    is_open[first + last] = True

    members = high - low
    own_saved = (members - 1) * (total[begins[low] + depth] - total[begins[low] + np.maximum(above, 0)])
    children, leaves, saved = np.zeros((3, len(depth)), np.int64).tolist()
    for v in np.argsort(-depth, kind="stable").tolist():
        if not copy[v] and not is_open[v]:
            p = forest.parent[v]
            leaves[v] = leaves[v] or 1
            children[p] += 1
            leaves[p] += leaves[v]
            saved[p] += saved[v] + int(own_saved[v])
    children, leaves, saved = (np.array(x, np.int64) for x in (children, leaves, saved))

    # the first path takes all its places, the last path goes on below the deepest node of both
    forks = max(set(first) & set(last), key=lambda v: depth[v])
    length, fork = int(lengths[0]), int(depth[forks])
    place_of = np.zeros(len(depth), np.int64)
    place_of[first] = place + depth[first]
    lower = [v for v in last if depth[v] > fork]
    place_of[lower] = place + length + depth[lower] - fork

    def chains(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Node, depth and whether the node's own depth is reached, of every turn of the chains above the nodes."""
        count = depth[nodes] - above[nodes]
        of = np.repeat(nodes, count)
        at = above[of] + 1 + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        return of, at, at == depth[of]

    of, at, end = chains(np.flatnonzero(~is_open & ~copy))
    top = at == above[of] + 1
    hung = top & is_open[parent[of]]
    ends = np.full(len(of), NO_ENDS, object)
    for k in np.flatnonzero(end & (of < n)).tolist():
        ends[k] = hashlib.sha256(ids_text(ids[of[k] : end_of[of[k]]]).encode()).hexdigest()
    done = {
        "conv_id": least[of],
        "depth": at,
        "parent_conv_id": pa.array(np.where(top, least[parent[of]], least[of]), pa.int64(), mask=hung),
        "n_convs": members[of],
        "n_children": np.where(end, children[of], 1),
        "n_leaves": leaves[of],
        "saved_tokens": saved[of] + (members[of] - 1) * (total[begins[low[of]] + depth[of]] - total[begins[low[of]] + at - 1]),
        "ends_sha256": ends,
        "parent": pa.array(place_of[parent[of]], pa.int64(), mask=~hung),
    }

    of, at, end = chains(np.array([*first, *lower]))
    side = (np.arange(len(of)) > length).astype(int)
    conversation = np.where(side == 0, 0, run[-1])
    turn = begins[conversation] + at - 1
    raw = [keys[c][DIGEST * (d - 1) : DIGEST * d] if d else b"" for c, d in zip(conversation.tolist(), at.tolist())]
    paths = {
        "place": place + np.arange(len(of)),
        "part": np.full(len(of), part),
        "block": np.full(len(of), block),
        "side": side,
        "above": np.full(len(of), fork),
        "digest": raw,
        "size": np.where(at > 0, np.append(sizes, 0)[turn], 0),
        "ends": [ids_text(ids[v : end_of[v]]) if e and v < n else None for v, e in zip(of.tolist(), end.tolist())],
        "conv_id": least[of],
        "depth": at,
        "n_convs": members[of],
        "n_children": np.where(end, children[of], 0),
        "n_leaves": np.where(end, leaves[of], 0),
        "saved_tokens": np.where(end, saved[of], 0),
    }
    return done, paths


class Path:
    """The open path of the merged forests: what is known of each of its nodes so far."""

    def __init__(self) -> None:
        self.nodes: list[dict] = []
        self.out: list[dict] = []

    def close(self, length: int) -> None:
        """Finish the nodes beyond the first ``length``, the deepest first."""
        while len(self.nodes) > length:
            node = self.nodes.pop()
            leaves = node["n_leaves"] if node["n_children"] else 1
            saved = node["saved_tokens"] + (node["n_convs"] - 1) * node["size"]
            ends = node.pop("ends").hexdigest()
            row = {c: node[c] for c in ("place", "conv_id", "depth", "n_convs", "n_children")}
            self.out.append(row | {"n_leaves": leaves, "saved_tokens": saved, "ends_sha256": ends, "parent": self.nodes[-1]["place"] if self.nodes else None})
            if self.nodes:
                above = self.nodes[-1]
                above["n_children"] += 1
                above["n_leaves"] += leaves
                above["saved_tokens"] += saved

    def add(self, row: dict) -> None:
        """The next node of a block's path: one that is open already, or a new one."""
        depth = row["depth"]
        if row["side"] and depth == row["above"] + 1:
            self.close(depth)
        if depth < len(self.nodes) and self.nodes[depth]["digest"] == row["digest"]:
            node = self.nodes[depth]
            node["conv_id"] = min(node["conv_id"], row["conv_id"])
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[c] += row[c]
            self.out.append({"same": row["place"], "parent": node["place"]})
        else:
            self.close(depth)
            node = row | {"ends": hashlib.sha256(), "any": False}
            self.nodes.append(node)
        if row["ends"]:
            node["ends"].update(("," * node.get("any", False) + row["ends"]).encode())
            node["any"] = True


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, down to the empty one at depth 0.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): the least member and that of the parent (null at the root), the numbers
    of members, children and childless nodes below, the bytes saved by keeping each last
    text of the nodes below once, and the SHA-256 of the ids of the members that end here,
    ascending and joined by commas.

    Turns come by ``turn``, null first, equal ones by the digest of role and text; repeated
    rows are turns each.  A null role or text is empty, rows with a null conv_id are left
    out, other columns are not read.  An empty table has no node, not even a root.  Two
    unequal turns share a digest with a chance of 2^-128.

    A conversation is one record of 24 bytes a turn in the sort; its texts are read once.
    Copies of a conversation differ by their ids, so a group of any size is dealt out
    over the ranges.
    """
    ordered = rebuilt(conversations).repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    schema = f"{NODE}, {PATH}"
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"depth": pa.int32(), "part": pa.int32(), "block": pa.int32(), "side": pa.int32(), "above": pa.int32(), "digest": pa.binary(), "ends_sha256": pa.string(), "ends": pa.string()}

    def batch_of(columns: dict) -> pa.RecordBatch:
        rows = len(columns["depth"])
        arrays = []
        for c in names:
            kind, values = types.get(c, pa.int64()), columns.get(c)
            arrays.append(pa.nulls(rows, kind) if values is None else values if isinstance(values, pa.Array) else pa.array(values, kind))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        place = part << 40
        keys, ids, sizes, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, place, held
            done, paths = block_nodes(keys, ids, np.concatenate(sizes), part, block, place)
            block, place, held = block + 1, place + len(paths["depth"]), 0
            keys.clear(), ids.clear(), sizes.clear()
            for columns in (done, paths):
                yield batch_of(columns)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys += batch.column(0).to_pylist()
            ids += batch.column(1).to_pylist()
            sizes.append(batch.column(2).flatten().to_numpy(zero_copy_only=False))
            held += len(sizes[-1])
            if len(keys) >= BLOCK or held >= BLOCK_TURNS:
                yield from flush()
        if keys:
            yield from flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = Path()
        kinds = pa.schema([("same", pa.int64()), ("place", pa.int64()), ("parent", pa.int64()), *((c, types.get(c, pa.int64())) for c in ("conv_id", "depth", *STATISTICS))])
        for batch in batches:
            for row in batch.to_pylist():
                path.add(row)
            if path.out:
                yield pa.RecordBatch.from_pylist(path.out, schema=kinds)
                path.out.clear()
        path.close(0)
        if path.out:
            yield pa.RecordBatch.from_pylist(path.out, schema=kinds)

    forests = materialize(bounded(ordered).select("key", "conv_id", "sizes").mapInArrow(grow, schema))
    spines = forests.where("place IS NOT NULL").select(*(c.split()[0] for c in PATH.split(", ")[:-1]), "conv_id", "depth", *STATISTICS[:-1])
    in_order = spines.repartition(1).sortWithinPartitions("part", "block", "side", "depth")
    merged = materialize(in_order.mapInArrow(join, "same long, place long, parent long, conv_id long, depth int, " + ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in STATISTICS)))
    opened = merged.where("same IS NULL").drop("same")
    known = opened.select(F.col("place").alias("node"), F.col("conv_id").alias("of"))
    alike = merged.where("same IS NOT NULL").select("same", F.col("parent").alias("node"))
    places = known.select(F.col("node").alias("parent"), "of").unionAll(alike.join(known, "node").select(F.col("same").alias("parent"), "of"))
    result = ["conv_id", "depth", "parent_conv_id", *STATISTICS]
    done = forests.where("place IS NULL")
    inner = done.where("parent IS NULL").select(*result)
    hung = done.where("parent IS NOT NULL").drop("parent_conv_id").join(places, "parent").withColumnRenamed("of", "parent_conv_id").select(*result)
    paths = opened.join(known.withColumnRenamed("node", "parent"), "parent", "left").withColumnRenamed("of", "parent_conv_id").select(*result)
    return inner.unionAll(hung).unionAll(paths)
