"""Prefix trie of conversations: union-find over common prefixes of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.words import spaced_count
from flowsift.session import stage

#: Bytes that stand for a turn in a sequence: an MD5 of role and text.
TURN = 16
#: Bytes of sequences that one task turns into a forest: at most, and while there are fewer tasks than partitions.
MOST_BYTES, LEAST_BYTES = 4 << 20, 1 << 19
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "open boolean, key binary, parent_key binary, top_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string"
)
_NODE = pa.schema(
    [("open", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("top_key", pa.binary())]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")]
    + [("ends_sha256", pa.string())]
)


def numbered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, digest, words``: the turns of each conversation from 1, NULL numbers first.

    Turns of one number come in the order of their digest; NULL role and text are empty. Rows without a
    conversation id belong to none and are left out.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    # the length keeps role and text apart whatever characters they hold
    digest = F.unhex(F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said)))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), spaced_count(said).alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.withColumn("pos", F.row_number().over(order)).drop("turn")


def sequences(numbered: DataFrame) -> DataFrame:
    """``conv_id, path, words``: the digests of a conversation as one binary, and the words of its turns."""
    parts = F.array_sort(F.collect_list(F.struct("pos", "digest", "words")))
    rows = numbered.groupBy("conv_id").agg(parts.alias("parts"))
    return rows.select("conv_id", _path("parts").alias("path"), F.transform("parts", lambda p: p["words"]).alias("words"))


def _path(parts: str) -> Column:
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["digest"])), ""))


def with_shared_heads(paths: DataFrame, family: int = 20, longest: int = 4) -> DataFrame:
    """Conversations that begin as the first one of their family does.

    The first h turns of conversation ``c`` are those of conversation ``c - c % family`` (all if it has
    fewer, none if it is missing), then its own after its first h; h is the CRC-32 of the id modulo
    ``longest``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    heads = paths.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first"),
        F.substring("path", 1, TURN * (longest - 1)).alias("head"),
        F.slice("words", 1, longest - 1).alias("head_words"),
    )
    joined = paths.withColumns({"h": h.cast("int"), "first": F.col("conv_id") - F.col("conv_id") % family}).join(heads, "first", "left")
    none = F.array().cast("array<bigint>")
    path = F.concat(
        F.coalesce(F.substring("head", F.lit(1), F.col("h") * TURN), F.unhex(F.lit(""))),
        F.substring("path", F.col("h") * TURN + 1, F.length("path")),
    )
    words = F.concat(
        F.coalesce(F.slice("head_words", F.lit(1), F.col("h")), none),
        F.slice("words", F.col("h") + 1, F.size("words")),
    )
    return joined.select("conv_id", path.alias("path"), words.alias("words"))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of every key; keys and ids arrive in order, so only a state is kept."""
    key, state = None, None
    for batch in batches:
        keys = batch.column("key").to_pylist()
        ids = batch.column("conv_id").cast(pa.string()).to_pylist()
        done: list[tuple[bytes, str]] = []
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            joined = ",".join(ids[start:i]).encode()
            if keys[start] == key:
                state.update(b"," + joined)
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = keys[start], hashlib.sha256(joined)
            start = i
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def distinct_paths(paths: DataFrame) -> DataFrame:
    """``path, words, n, conv_id, ends_sha256``: equal conversations as one row.

    Copies are counted before the shuffle. Only 24 bytes of each conversation go on to the digest of
    ids, which streams them in order.
    """
    counted = paths.groupBy("path").agg(F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    key = F.unhex(F.md5("path")).alias("key")
    ids = paths.select(key, "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = ids.mapInArrow(_joined_ids, "key binary, ends_sha256 string")
    return counted.withColumn("key", key).join(ends, "key").drop("key")


def common_turns(paths: list[bytes]) -> np.ndarray:
    """Whole turns that each path shares with the one before it; the first has none."""
    out = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            out[i] = n // TURN
            continue
        low, high = 0, n // TURN  # turns known to be equal, turns known not to be
        while high - low > 1:
            mid = (low + high) // 2
            if a[low * TURN : mid * TURN] == b[low * TURN : mid * TURN]:
                low = mid
            else:
                high = mid
        out[i] = low
    return out


class Forest:
    """Branching nodes over sorted distinct paths, by joining neighbours in descending depth.

    Node i < m is the leaf of path i. An edge between neighbours joins their components at the depth of
    their common prefix: a new branching node, or the one that a component already has there.
    """

    def __init__(self, lengths: np.ndarray, common: np.ndarray) -> None:
        m = len(lengths)
        self.depth: list[int] = lengths.tolist()
        self.parent: list[int] = [-1] * m
        self.first, self.last = list(range(m)), list(range(m))
        group, top = list(range(m)), list(range(m))  # union-find over paths; the node above each component

        def root(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        # of equal depths the leftmost edge comes first, so the right component's top is always deeper
        for i in (np.argsort(-common[1:], kind="stable") + 1).tolist():
            a, b, depth = root(i - 1), root(i), int(common[i])
            node, right = top[a], top[b]
            if self.depth[node] != depth:
                left, node = node, len(self.depth)
                self.depth.append(depth)
                self.parent.append(-1)
                self.first.append(self.first[left])
                self.last.append(self.last[left])
                self.parent[left] = node
            self.parent[right] = node
            self.last[node] = self.last[right]
            group[b] = a
            top[a] = node


def forest_rows(paths: list[bytes], words: list[np.ndarray], n: np.ndarray, ids: np.ndarray, ends: list[str]) -> pa.RecordBatch | None:
    """Nodes of one task's sorted paths at every depth.

    Prefixes of its first and last path may go on in neighbouring tasks: they come out ``open``, with
    what hangs below them in this task and is not open itself. All other nodes are complete.
    """
    m = len(paths)
    if not m:
        return None
    lengths = np.array([len(p) // TURN for p in paths])
    forest = Forest(lengths, common_turns(paths))
    depth, parent = np.array(forest.depth), np.array(forest.parent)
    first, last = np.array(forest.first), np.array(forest.last)
    total = np.concatenate([[0], np.cumsum(n)])
    convs = total[last + 1] - total[first]
    smallest = np.zeros(len(depth), np.int64)
    smallest[:m] = ids
    children = np.zeros(len(depth), np.int64)
    leaves = np.zeros(len(depth), np.int64)
    below = np.zeros(len(depth), np.int64)  # tokens saved in complete subtrees under the node, itself not counted
    is_open = (first == 0) | (last == m - 1)
    smallest[m:] = np.iinfo(np.int64).max
    sums = [np.concatenate([[0], np.cumsum(w)]).astype(np.int64) for w in words]
    out: dict[str, list] = {name: [] for name in _NODE.names}
    rows: list[tuple[int, int, int]] = []  # node, and the depths of its chain up to its parent
    for node in np.argsort(-depth, kind="stable").tolist():
        d, up = int(depth[node]), int(parent[node])
        above = int(depth[up]) if up >= 0 else -1
        rows.append((node, above, d))
        if not is_open[node] and not children[node]:
            leaves[node] = 1
        if up < 0:
            continue
        smallest[up] = min(smallest[up], smallest[node])
        if not is_open[node]:
            w = sums[first[node]]
            saved = below[node] + (convs[node] - 1) * (w[d] - w[above])
            children[up] += 1
            leaves[up] += leaves[node]
            below[up] += saved
    add = out.__getitem__
    for node, above, d in rows:
        w, path, c = sums[first[node]], paths[first[node]], int(convs[node])
        up = int(parent[node])
        depths = range(d, above, -1)
        k = len(depths)
        whole = is_open[node]
        add("open").extend([bool(whole)] * k)
        add("conv_id").extend([int(smallest[node])] * k)
        add("depth").extend(depths)
        add("n_convs").extend([c] * k)
        add("ends_sha256").extend([ends[node] if node < m else None] + [None] * (k - 1))
        add("words").extend(int(w[x] - w[x - 1]) if x else 0 for x in depths)
        if whole:
            keys = [hashlib.md5(path[: TURN * x]).digest() for x in range(above if above >= 0 else 0, d + 1)][::-1]
            add("key").extend(keys[:k])
            add("parent_key").extend((keys[1:] + [None])[:k])
            top = hashlib.md5(path[:TURN]).digest()
            add("top_key").extend(top if x else None for x in depths)
            add("parent_conv_id").extend([None] * k)
            for name, at_node in (("n_children", children), ("n_leaves", leaves), ("saved_tokens", below)):
                add(name).extend([int(at_node[node])] + [0] * (k - 1))
            continue
        add("key").extend([None] * k)
        open_above = up >= 0 and is_open[up]
        add("parent_key").extend([None] * (k - 1) + [hashlib.md5(path[: TURN * above]).digest() if open_above else None])
        add("top_key").extend([None] * k)
        add("parent_conv_id").extend([int(smallest[node])] * (k - 1) + [None if open_above else int(smallest[up])])
        add("n_children").extend([int(children[node])] + [1] * (k - 1))
        add("n_leaves").extend([int(leaves[node])] * k)
        add("saved_tokens").extend(int(below[node] + (c - 1) * (w[d] - w[x - 1])) for x in depths)
    return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _NODE], schema=_NODE)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All sorted paths of a task, which the number of ranges keeps bounded."""
    paths: list[bytes] = []
    words: list[np.ndarray] = []
    ids, n, ends = [], [], []
    for batch in batches:
        paths += batch.column("path").to_pylist()
        column = batch.column("words")
        flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
        offsets = offsets - offsets[0]
        words += [flat[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:])]
        ids += batch.column("conv_id").to_pylist()
        n += batch.column("n").to_pylist()
        ends += batch.column("ends_sha256").to_pylist()
    rows = forest_rows(paths, words, np.array(n, np.int64), np.array(ids, np.int64), ends)
    if rows is not None:
        step = 10_000
        for a in range(0, rows.num_rows, step):
            yield rows.slice(a, step)


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """Leaves and saved tokens of the merged open nodes below one first turn, from the deepest up."""
    group = group.sort_values("depth", ascending=False, kind="stable").reset_index(drop=True)
    at = {key: i for i, key in enumerate(group["key"])}
    leaves, saved = group["n_leaves"].tolist(), group["saved_tokens"].tolist()
    children, convs, words = group["n_children"].tolist(), group["n_convs"].tolist(), group["words"].tolist()
    for i, above in enumerate(group["parent_key"]):
        leaves[i] += children[i] == 0
        saved[i] += (convs[i] - 1) * words[i]
        up = at.get(above)
        if up is not None:
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    return group.assign(n_leaves=leaves, saved_tokens=saved)


def merge_open(parts: DataFrame) -> DataFrame:
    """Open nodes of all tasks as whole nodes.

    Equal prefixes are added up, which joins the forests across their borders. A task has only the
    prefixes of two paths open, so what is left is a tree of a few nodes a task; its sums are taken for
    each first turn, those of the root from them.
    """
    whole = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("top_key").alias("top_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        F.max("ends_sha256").alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    whole = stage(whole, "trie-open")
    parents = whole.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("open_children"))
    whole = whole.join(parents, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).drop("open_children")
    below = stage(whole.where("depth > 0").groupBy("top_key").applyInPandas(_summed, whole.schema), "trie-merged")
    tops = below.where("depth = 1").groupBy(F.col("parent_key").alias("key")).agg(F.sum("n_leaves").alias("top_leaves"), F.sum("saved_tokens").alias("top_saved"))
    root = whole.where("depth = 0").join(tops, "key", "left")
    root = root.withColumn("n_leaves", F.col("n_leaves") + F.coalesce("top_leaves", F.lit(0)) + F.when(F.col("n_children") == 0, 1).otherwise(0))
    root = root.withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("top_saved", F.lit(0)))
    return stage(below.unionByName(root.select(*below.columns)), "trie-open-whole")


def prefix_trie(paths: DataFrame) -> DataFrame:
    """Every distinct prefix of conversations as a node of their trie.

    ``paths`` has ``conv_id, path, words`` as ``sequences`` makes them, one row a conversation. Columns
    of the result: ``conv_id`` (smallest member), ``depth`` (turns, 0 for the root), ``parent_conv_id``
    (NULL for the root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of the
    subtree), ``saved_tokens`` (over the subtree, words of a node's last turn that members after the
    first repeat) and ``ends_sha256`` (digest of the ids of members that end here).

    Equal conversations are one path. Paths are sorted into ranges of bounded size; each task joins
    neighbours in descending order of their common prefix, where every merge of components is a
    branching node, and chains between branching nodes are filled in. Prefixes that reach a border of
    the range are contracted to their sums and merged with those of the neighbours.

    Ties: of equal conversations the smallest id names the node. Turnless conversations end at the
    root. An empty table has no node. A conversation is one value of 16 bytes a turn and must fit a
    task; its texts need not.
    """
    distinct = stage(distinct_paths(paths), "trie-paths")
    size = distinct.agg(F.coalesce(F.sum(F.length("path") + 64), F.lit(0))).first()[0]
    wanted = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-size // MOST_BYTES), min(wanted, -(-size // LEAST_BYTES)))
    ordered = distinct.repartitionByRange(ranges, "path").sortWithinPartitions("path")
    parts = stage(ordered.mapInArrow(_forest, NODE), "trie-parts")
    opened = merge_open(parts.where("open"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    ends = F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    names = opened.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"))
    inner = parts.where("NOT open").select(*columns, "parent_key", "parent_conv_id", ends).join(names, "parent_key", "left")
    outer = opened.select(*columns, "parent_key", F.lit(None).cast("bigint").alias("parent_conv_id"), ends).join(names, "parent_key", "left")
    parent = F.coalesce("open_parent", "parent_conv_id").alias("parent_conv_id")
    return inner.unionByName(outer).select("conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """``prefix_trie`` of a table of turns ``conv_id, turn, role, text``; other columns are not read.

    ``rebuild`` gives conversations of a family a common beginning first, see ``with_shared_heads``.
    NULL and repeated turns: see ``numbered_turns``.
    """
    paths = sequences(numbered_turns(turns))
    return prefix_trie(stage(with_shared_heads(paths) if rebuild else paths, "trie-conversations"))
