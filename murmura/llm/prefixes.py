"""The prefix trie of conversations, by ROLLUP over positional columns of turns.

Turns become digests in columns ``t1``, ``t2``, ... One ROLLUP over them groups all prefixes of all conversations
together: the grouping id tells the length of the prefix, so each group is a node. A second ROLLUP, over the nodes,
sums each node's subtree. Conversations longer than a block of columns go on in further blocks, keyed by the node
that they reached in the block before; sums come back from block to block. Below a node from where all its
conversations agree to the end there is one path without a branch, which needs no rollup and is read off place by
place, so that long conversations that are alone or copies don't ask for a block for every few turns.

Texts are hashed where they are read and never shuffled. Nothing is gathered by conversation or node: places are
counted range by range, hot prefixes are reduced on the map side by the rollups, and the members that end at a node
are hashed from sorted pieces in order.

Cases: null roles and texts are empty; null turns come first; equal turn numbers are ordered by the digests of
their rows, and repeated rows are as many turns. Rows without conv_id belong to no conversation. Other columns
don't matter. An empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm.common import stored

#: Positional columns of the first block and of each further one.
FIRST, FURTHER = 8, 32
ROOT = bytes(16)
GROUP, HEADS = 5, 9


def _digest(*parts: Column) -> Column:
    """Sixteen bytes of the SHA-256 of binary columns put together."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 1, ``key`` (a digest of role and text) and ``n_bytes`` of the text.

    A conversation may span many ranges of the sorted rows: a place is the one within the range plus the turns
    in the ranges before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("key")]
    ranged = stored(turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    sums = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    inner = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    return (
        ranged.withColumn("inner", inner)
        .join(sums.select("conv_id", "part", before.alias("before")), ["conv_id", "part"])
        .select("conv_id", (F.col("before") + F.col("inner")).alias("place"), "key", "n_bytes")
    )


def lengths(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``n``, the number of its turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n"))


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The turns and lengths of conversations of which every ``group`` begin alike.

    Conversation c has the first h turns of conversation ``c - c % group``, then its own after its first h,
    with h the crc32 of c in decimals modulo ``heads``. All keep a length, also those left without turns.
    """
    own = stored(lengths(turns), "lengths")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    plans = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head.alias("head"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least(F.coalesce("n_base", F.lit(0)), F.col("head")).alias("taken")
    plans = stored(plans.join(bases, "base", "left").select("conv_id", "n", "base", "head", taken), "plans")
    starts = turns.where(F.col("place") < heads).withColumnRenamed("conv_id", "base")
    first = plans.join(starts, "base").where("place <= taken").select("conv_id", "place", "key", "n_bytes")
    rest = plans.join(turns, "conv_id").where("place > head")
    rest = rest.select("conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "key", "n_bytes")
    n = F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    return first.unionByName(rest), plans.select("conv_id", n.alias("n"))


def _names(width: int) -> list[str]:
    return [f"t{i}" for i in range(1, width + 1)]


def _node(depth: Column, names: list[str]) -> Column:
    """The node of the first ``depth`` turns of a block below ``prior``; at depth 0 that is ``prior`` itself."""
    path = [F.when(depth >= i, F.col(t)["key"]).otherwise(F.lit(b"")) for i, t in enumerate(names, 1)]
    return F.when(depth <= 0, F.col("prior")).otherwise(_digest(F.col("prior"), *path))


def _level(names: list[str]) -> Column:
    """How many of the positional columns a row of the rollup groups by; -1 for the grand total."""
    grouped = [1 - F.grouping(t) for t in names]
    return (sum(grouped[1:], grouped[0]) - F.grouping("prior")).cast("int")


def _wide(open_: DataFrame, turns: DataFrame, done: int, names: list[str]) -> DataFrame:
    """One row a conversation: ``conv_id``, ``n``, ``prior`` and its next turns in positional columns."""
    block = turns.where((F.col("place") > done) & (F.col("place") <= done + len(names)))
    turn = F.struct("key", "n_bytes")
    columns = [F.max(F.when(F.col("place") == done + i, turn)).alias(t) for i, t in enumerate(names, 1)]
    return open_.join(block.groupBy("conv_id").agg(*columns), "conv_id", "left")


def _block_nodes(wide: DataFrame, done: int, names: list[str]) -> DataFrame:
    """Every prefix in the block, with its members, whether it is a leaf, and what its members save at its last turn."""
    groups = wide.rollup("prior", *names).agg(
        _level(names).alias("d"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("n").alias("longest")
    )
    last = F.get(F.array(*names), F.col("d") - 1)
    d = F.col("d")
    # Shorter conversations have nulls beyond their end, which are no nodes; the root only comes with the first block.
    nodes = groups.where((d >= 1) & last.isNotNull() | (d == 0) & F.lit(done == 0))
    return nodes.select(
        "prior",
        *names,
        "d",
        "n_convs",
        "conv_id",
        (F.col("longest") == d + done).cast("long").alias("n_leaves"),
        F.when(d > 0, (F.col("n_convs") - 1) * last["n_bytes"]).otherwise(0).alias("saved_tokens"),
    )


def _subtrees(nodes: DataFrame, below: DataFrame | None, done: int, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """The nodes of a block with the sums of their subtrees, and the sums of all that hangs under each ``prior``.

    ``below`` has the sums of what hangs under the block's last nodes.
    """
    if below is not None:
        nodes = nodes.withColumn("node", F.when(F.col("d") == len(names), _node(F.col("d"), names)))
        nodes = nodes.join(below.withColumnsRenamed({"prior": "node", "n_leaves": "more_leaves", "saved_tokens": "more_saved"}), "node", "left")
        nodes = nodes.withColumns(
            {
                "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
                "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
            }
        )
    # In the group of a prefix its own node has the least depth, the most members and the smallest of them.
    sums = nodes.rollup("prior", *names).agg(
        _level(names).alias("level"),
        F.min("d").alias("d"),
        F.max("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )
    level = F.col("level")
    own = sums.where("d = level").select(
        _node(level, names).alias("node"),
        F.when(level > 0, _node(level - 1, names)).alias("parent"),
        (level + done).cast("long").alias("depth"),
        "n_convs",
        "conv_id",
        "n_leaves",
        "saved_tokens",
    )
    return own, sums.where("level = 0").select("prior", "n_leaves", "saved_tokens")


def _unbranched(open_: DataFrame, turns: DataFrame, done: int) -> DataFrame:
    """The rest of the conversations below each ``prior`` where all of them agree to their end, as nodes with sums."""
    rest = turns.where(F.col("place") > done).join(open_.select("conv_id", "prior"), "conv_id")
    places = rest.groupBy("prior", "place").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min(F.struct("key", "n_bytes")).alias("low"),
        F.max(F.struct("key", "n_bytes")).alias("high"),
    )
    places = stored(places, "places")
    alike = places.groupBy("prior").agg(
        F.bool_and(F.col("low") == F.col("high")).alias("alike"), F.min("n_convs").alias("least"), F.max("n_convs").alias("most")
    )
    paths = places.join(alike.where("alike and least = most").select("prior"), "prior")
    saved = F.sum((F.col("n_convs") - 1) * F.col("low.n_bytes"))
    return paths.select(
        "prior",
        _path_node(F.col("place")).alias("node"),
        F.when(F.col("place") == done + 1, F.col("prior")).otherwise(_path_node(F.col("place") - 1)).alias("parent"),
        F.col("place").alias("depth"),
        "n_convs",
        "conv_id",
        F.lit(1).cast("long").alias("n_leaves"),
        saved.over(Window.partitionBy("prior").orderBy(F.desc("place"))).alias("saved_tokens"),
    )


def _path_node(place: Column) -> Column:
    return _digest(F.col("prior"), F.lit(b"/"), place.cast("string").cast("binary"))


def _ends(rows: DataFrame) -> DataFrame:
    """Per ``node``: the SHA-256 of the ids that end there, ascending and comma-joined, as ``ends_sha256``.

    A node may have very many: sorted ranges of ids become pieces of text in parallel, and a node's pieces
    are fed to its hash in order, one at a time.
    """
    ranged = stored(rows.repartitionByRange("node", "conv_id").withColumn("part", F.spark_partition_id()), "ends")
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    pieces = ranged.groupBy("node", "part").agg(F.array_join(ids, ",").alias("ids"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for at, ids in zip(batch["node"], batch["ids"]):
                if at == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = at, hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])

    return pieces.repartition("node").sortWithinPartitions("node", "part").mapInPandas(hashed, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, first: int = FIRST, further: int = FURTHER) -> DataFrame:
    """Per node: its smallest member, depth, parent's smallest member, members, children, leaves, saved bytes, ends.

    ``turns`` has ``conv_id``, ``place`` from 1 without gaps, ``key`` and ``n_bytes``; ``members`` every
    ``conv_id`` once with its number of turns ``n``. Both are read several times: pass stored tables.
    """
    longest = members.agg(F.max("n")).first()[0]
    open_, done, blocks, paths, ends = members.withColumn("prior", F.lit(ROOT)), 0, [], [], []
    while longest is not None:
        names = _names(further if done else first)
        wide = stored(_wide(open_, turns, done, names), "wide")
        nodes = stored(_block_nodes(wide, done, names), "nodes")
        inside = F.col("n") <= done + len(names)
        ends.append(wide.where(inside).select(_node(F.col("n") - done, names).alias("node"), "conv_id"))
        blocks.append((nodes, done, names))
        done += len(names)
        if longest <= done:
            break
        open_ = stored(wide.where(~inside).select("conv_id", "n", _node(F.lit(len(names)), names).alias("prior")), "open")
        path = stored(_unbranched(open_, turns, done), "paths")
        paths.append(path)
        settled = path.select("prior").distinct()
        agreed = open_.join(settled, "prior", "left_semi")
        ends.append(agreed.select(_path_node(F.col("n")).alias("node"), "conv_id"))
        open_ = stored(open_.join(settled, "prior", "left_anti"), "open")
        longest = open_.agg(F.max("n")).first()[0]
    done_nodes, below = [], None
    for at in range(len(blocks) - 1, -1, -1):
        if at < len(paths):
            # A path's first place has the sums of all of it.
            under = paths[at].groupBy("prior").agg(F.lit(1).cast("long").alias("n_leaves"), F.max("saved_tokens").alias("saved_tokens"))
            below = under if below is None else below.unionByName(under)
        own, below = _subtrees(blocks[at][0], below, *blocks[at][1:])
        done_nodes.append(own)
        below = stored(below, "below") if at else None
    done_nodes += [p.drop("prior") for p in paths]
    if not done_nodes:
        schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return turns.sparkSession.createDataFrame([], schema)
    nodes = done_nodes[0]
    for more in done_nodes[1:]:
        nodes = nodes.unionByName(more)
    nodes = stored(nodes, "all-nodes")
    ending = ends[0]
    for more in ends[1:]:
        ending = ending.unionByName(more)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    # The many children of one node stay many rows of the left side, which Spark splits where it is skewed.
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    own = nodes.join(children, "node", "left").join(_ends(ending), "node", "left")
    return own.join(parents, "parent", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def trie_of(conversations: DataFrame, first: int = FIRST, further: int = FURTHER) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = stored(numbered(conversations), "numbered")
    return prefix_trie(turns, stored(lengths(turns), "lengths"), first, further)


def trie_of_rebuilt(conversations: DataFrame, first: int = FIRST, further: int = FURTHER) -> DataFrame:
    """The trie of the conversations that `rebuilt` makes of them."""
    turns, members = rebuilt(stored(numbered(conversations), "numbered"))
    return prefix_trie(stored(turns, "rebuilt"), stored(members, "members"), first, further)


# DuckDB has no crc32: a reduction over the digits, each followed by eight shifts.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""

REBUILT_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns,
         {_CRC} % {HEADS} AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {GROUP}
),
prefixes AS (SELECT conv_id, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = depth AS leaf,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(turns[depth].text)) END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY turns[1:depth], depth
),
sums AS (
  SELECT path[1:d] AS path, d AS depth, CAST(sum(CAST(leaf AS INT)) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens,
         count(*) FILTER (depth = d + 1) AS n_children
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM nodes) GROUP BY path[1:d], d
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (path, depth) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
