"""The prefix trie of conversations as intervals of a sorted list.

Conversations are sorted by their turns, a shorter one before those that go on
from it. With ``lcp`` the number of first turns that a conversation shares with
the one before it, those that share a prefix of ``d`` turns are the ranks from
one whose lcp is below ``d`` up to the next such one. A prefix is new at the
rank where ``d`` exceeds the lcp; each such candidate finds both ends by itself,
by binary search on a sparse table of range minima.

The list is cut into blocks of ranks, a table each, and a table of the blocks'
minima joins them (at most ``MOST_BLOCKS``, beyond which blocks grow). An
interval that leaves its block ends in another one, where it covers all before
the first lcp below its depth; that is looked up by (block, depth). Sums over an
interval are differences of prefix sums over ranks: the subtree of a node is its
interval from its depth on, and each rank brings the turns that are new there.

A conversation is never one row: turns are numbered, compared and summed as rows
of their own. Only for sorting, ``PART`` turns at a time are one array; of longer
conversations these arrays are sorted and named by their rank, and names are put
together in the same way until a conversation is one array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import saved
from strata.llm.ordering import numbered

#: A conversation shares up to ``SHARED`` - 1 turns with the first of its family of ``FAMILY``.
FAMILY, SHARED = 5, 9
#: Turns, or names, in an array.
PART = 64
#: Turns summed in one window.
SUMMED = 1024
#: Ranks of a block.
BLOCK = 4096
MOST_BLOCKS = 16384
#: Candidates that meet a block in one group.
MEET = 100_000
#: Conversation ids joined to one string.
IDS = 4096

_EDGE = "right boolean, block long, low long, high long, at long, conv long, total long, fresh long, leaf long"
_FOUND = (
    "kind int, rank long, depth long, before long, own_total long, total_0 long, fresh_0 long, leaf_0 long, left long, "
    "left_block long, last long, conv long, total long, fresh long, leaf long, right_block long"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, bytes): 128 bits of a digest of role and text, and the text's bytes; no rows of null ids."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(framed.cast("binary"), 256)), 1, 16).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def borrowed(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its family's first."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, key, bytes) of all rebuilt conversations, and (conv_id, length) of each; written."""
    placed = saved(numbered(rows, ["conv_id"], ["turn", "key"], "trie-numbered"), "trie-placed")
    every = placed.groupBy("conv_id").agg(F.max("size").alias("n"))
    every = every.withColumns({"first": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": borrowed(F.col("conv_id"))})
    firsts = every.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    convs = every.join(firsts, "first", "left").withColumn("taken", F.least("h", F.coalesce("n_first", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = saved(convs.select("conv_id", "first", "h", "taken", length.alias("length")), "trie-convs")
    own = placed.withColumn("h", borrowed(F.col("conv_id"))).where("pos >= h").join(convs.select("conv_id", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "key", "bytes")
    lent = placed.where((F.col("pos") < SHARED - 1) & (F.col("conv_id") % FAMILY == 0))
    lent = lent.select(F.col("conv_id").alias("first"), "pos", "key", "bytes").join(convs, "first").where("pos < h")
    lent = lent.select("conv_id", (F.col("pos") + 1).alias("depth"), "key", "bytes")
    return saved(own.unionByName(lent), "trie-turns"), convs.select("conv_id", "length")


def sorted_convs(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``convs`` with their ``rank`` by turns, shorter ones first, equal ones by id; written."""
    rows = turns.select("conv_id", (F.col("depth") - 1).alias("at"), F.col("key").alias("name"))
    while True:
        of = F.transform(F.sort_array(F.collect_list(F.struct("at", "name"))), lambda x: x["name"])
        parts = rows.groupBy("conv_id", F.floor(F.col("at") / PART).alias("part")).agg(of.alias("names"))
        parts = saved(parts, "trie-parts")
        if not parts.agg(F.max("part")).first()[0]:
            break
        named = numbered(parts.select("names").distinct(), [], ["names"], "trie-names")
        rows = parts.join(named, "names").select("conv_id", F.col("part").alias("at"), F.col("pos").alias("name"))
    paths = convs.join(parts.select("conv_id", "names"), "conv_id", "left")
    paths = paths.withColumn("names", F.coalesce("names", F.array().cast(parts.schema["names"].dataType)))
    ranked = numbered(paths, [], ["names", "conv_id"], "trie-ranks")
    return saved(ranked.select("conv_id", "length", F.col("pos").alias("rank")), "trie-ranked")


def shared_turns(turns: DataFrame, ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rank, depth, bytes, before, lcp) of turns; (rank, conv_id, length, lcp, total, fresh, leaf) of conversations; written.

    ``before`` are the bytes of the turns before it, ``total`` all of a
    conversation, ``fresh`` those of turns after the shared ones; ``leaf`` is 1
    for the last of the conversations that equal it, unless others go on from it.
    """
    rows = saved(turns.join(ranked.select("conv_id", "rank"), "conv_id").drop("conv_id"), "trie-turns-ranked")
    others = rows.select((F.col("rank") + 1).alias("rank"), "depth", F.col("key").alias("other"))
    differ = rows.join(others, ["rank", "depth"], "left").where(~F.col("key").eqNullSafe(F.col("other")))
    common = differ.groupBy("rank").agg((F.min("depth") - 1).alias("lcp"))
    convs = ranked.join(common, "rank", "left").withColumn("lcp", F.coalesce("lcp", "length"))
    convs = saved(convs, "trie-common")
    part = F.floor((F.col("depth") - 1) / SUMMED).alias("part")
    sums = rows.groupBy("rank", part).agg(F.sum("bytes").alias("sum"))
    so_far = Window.partitionBy("rank").orderBy("part")
    offsets = sums.select("rank", "part", (F.sum("sum").over(so_far) - F.col("sum")).alias("offset"))
    within = Window.partitionBy("rank", "part").orderBy("depth")
    rows = rows.withColumn("part", part).withColumn("within", F.sum("bytes").over(within) - F.col("bytes"))
    rows = rows.join(offsets, ["rank", "part"]).join(convs.select("rank", "lcp"), "rank")
    rows = rows.select("rank", "depth", "bytes", (F.col("offset") + F.col("within")).alias("before"), "lcp")
    rows = saved(rows, "trie-turns-summed")
    sizes = rows.groupBy("rank").agg(
        F.sum("bytes").alias("total"), F.sum(F.when(F.col("depth") > F.col("lcp"), F.col("bytes"))).alias("fresh")
    )
    following = convs.select((F.col("rank") - 1).alias("rank"), F.col("lcp").alias("next_lcp"))
    convs = convs.join(sizes, "rank", "left").join(following, "rank", "left")
    leaf = F.coalesce(F.col("next_lcp") < F.col("length"), F.lit(True)).cast("long")
    convs = convs.select(
        "rank", "conv_id", "length", "lcp", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "fresh")], leaf.alias("leaf")
    )
    return rows, saved(convs, "trie-summed")


class Minima:
    """Least values of ranges: a row per power of two, of the minima of so many values from each place on."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [np.asarray(values, np.int64)]
        while 2 << (len(self.rows) - 1) <= len(values):
            low, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(low[:-step], low[step:]))
        self.size = len(values)

    def ahead(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from ``start`` on whose value is below ``least``; the size if none is."""
        at = np.array(start, np.int64)
        for k in range(len(self.rows) - 1, -1, -1):
            row, end = self.rows[k], at + (1 << k)
            go = end <= self.size
            go[go] = row[at[go]] >= least[go]
            at = np.where(go, end, at)
        return at

    def behind(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to ``start`` whose value is below ``least``; -1 if none is."""
        at = np.array(start, np.int64) + 1
        for k in range(len(self.rows) - 1, -1, -1):
            row, low = self.rows[k], at - (1 << k)
            go = low >= 0
            go[go] = row[low[go]] >= least[go]
            at = np.where(go, low, at)
        return at - 1

    def within(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value from ``low`` to ``high``, both included."""
        k = np.frexp((high - low + 1).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for level in np.unique(k):
            of = k == level
            row = self.rows[level]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(level)) + 1])
        return out


class Blocks:
    """What is known of all blocks: their minima, and sums of what lies before them."""

    def __init__(self, table: pd.DataFrame) -> None:
        table = table.sort_values("block")
        self.start = table["start"].to_numpy(np.int64)
        self.head = table["head"].to_numpy(np.int64)  # the first lcp
        self.least = Minima(table["least"].to_numpy())
        self.conv = Minima(table["conv"].to_numpy())
        self.sums = {c: np.cumsum(np.append(0, table[c].to_numpy(np.int64))) for c in ("total", "fresh", "leaf")}
        self.ranks = int(table["ranks"].sum())


def _edges(blocks: Blocks, block: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Where intervals end that come from other blocks, by spans (low, high] of depths.

    From the left, an interval of depth d covers all before the first lcp below
    d, so each lcp below all before it begins a span; from the right likewise.
    """
    lcp, conv = rows["lcp"].to_numpy(np.int64), rows["conv_id"].to_numpy(np.int64)
    out = []
    least = np.minimum.accumulate(lcp)
    first = np.flatnonzero(np.append(False, least[1:] < least[:-1]))  # at each, depths down to its lcp end before it
    if len(first):
        sums = {c: blocks.sums[c][block] + np.cumsum(rows[c].to_numpy(np.int64)) for c in ("total", "fresh", "leaf")}
        out.append(
            pd.DataFrame({"right": True, "low": lcp[first], "high": least[first - 1], "at": blocks.start[block] + first - 1})
            .assign(conv=np.minimum.accumulate(conv)[first - 1], **{c: v[first - 1] for c, v in sums.items()})
        )
    if block + 1 < len(blocks.start):
        back = np.minimum.accumulate(lcp[::-1])[::-1]
        above = np.append(back[1:], blocks.head[block + 1])
        last = np.flatnonzero(lcp < above)
        spans = {"right": False, "low": lcp[last], "high": above[last], "at": blocks.start[block] + last}
        out.append(pd.DataFrame(spans).assign(conv=0, total=0, fresh=0, leaf=0))
    if not out:
        return pd.DataFrame(columns=[c.split()[0] for c in _EDGE.split(", ")])
    return pd.concat(out).assign(block=block)[[c.split()[0] for c in _EDGE.split(", ")]]


def _found(blocks: Blocks, block: int, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Both ends of each candidate and the sums up to its last rank, or the block in which an end lies; -1 is none."""
    lcp = Minima(rows["lcp"].to_numpy())
    conv = Minima(rows["conv_id"].to_numpy())
    own = {c: rows[c].to_numpy(np.int64) for c in ("total", "fresh", "leaf")}
    sums = {c: blocks.sums[c][block] + np.cumsum(v) for c, v in own.items()}
    start, n = blocks.start[block], len(rows)
    at = asked["rank"].to_numpy(np.int64) - start
    depth, want = asked["depth"].to_numpy(np.int64), asked["want"].to_numpy(np.int64)
    first = lcp.behind(at, want)
    near = first >= 0
    left_block = blocks.least.behind(np.full(len(at), block - 1), want)
    end = lcp.ahead(at + 1, depth)
    last = end - 1
    best = conv.within(at, last)
    out = {c: sums[c][last] for c in sums}
    rank = start + last
    over = np.flatnonzero(end == n)
    right_block = np.full(len(at), -1)
    if len(over):
        stop = blocks.least.ahead(np.full(len(over), block + 1), depth[over])
        for c in out:
            out[c][over] = blocks.sums[c][stop]
        rank[over] = np.where(stop < len(blocks.start), blocks.start[np.minimum(stop, len(blocks.start) - 1)], blocks.ranks) - 1
        crossed = stop > block + 1
        best[over[crossed]] = np.minimum(
            best[over[crossed]], blocks.conv.within(np.full(crossed.sum(), block + 1), stop[crossed] - 1)
        )
        inside = stop < len(blocks.start)
        inside[inside] = blocks.head[stop[inside]] >= depth[over][inside]
        right_block[over[inside]] = stop[inside]
    return pd.DataFrame(
        {
            "kind": asked["kind"].to_numpy(), "rank": start + at, "depth": depth, "before": asked["before"].to_numpy(),
            "own_total": own["total"][at], "total_0": sums["total"][at] - own["total"][at], "fresh_0": sums["fresh"][at],
            "leaf_0": sums["leaf"][at] - own["leaf"][at], "left": np.where(near, start + first, -1),
            "left_block": np.where(near, -1, left_block), "last": rank, "conv": best, **out,
            "right_block": right_block,
        }
    )


def intervals(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Candidates with their interval's last rank and sums, and the first rank of the prefix asked for.

    Of kind 0 are the new prefixes, which ask for the one a turn shorter; of
    kind 1 the conversations, which ask for the prefix that is all of them.
    """
    spark = rows.sparkSession
    count = convs.count()
    size = max(BLOCK, -(-count // MOST_BLOCKS))
    block = F.floor(F.col("rank") / size)
    convs = convs.withColumn("block", block)
    table = convs.groupBy("block").agg(
        F.count(F.lit(1)).alias("ranks"), F.min("rank").alias("start"), F.min_by("lcp", "rank").alias("head"),
        F.min("lcp").alias("least"), F.min("conv_id").alias("conv"), *[F.sum(c).alias(c) for c in ("total", "fresh", "leaf")],
    )
    known = spark.sparkContext.broadcast(Blocks(table.toPandas()))

    def edges(group: pd.DataFrame) -> pd.DataFrame:
        return _edges(known.value, int(group["block"].iloc[0]), group.sort_values("rank"))

    edge = convs.groupBy("block").applyInPandas(edges, _EDGE)
    edge = saved(edge.withColumn("depth", F.explode(F.sequence(F.col("low") + 1, "high"))), "trie-edges")
    asked = rows.where("depth > lcp").select(F.lit(0).alias("kind"), "rank", "depth", (F.col("depth") - 1).alias("want"), "before")
    whole = convs.where("length > 0").select(F.lit(1).alias("kind"), "rank", F.col("length").alias("depth"), F.col("length").alias("want"), F.lit(0).alias("before"))
    asked = asked.unionByName(whole).withColumn("block", block)
    # at most MOST_BLOCKS rows
    shares = [(r["block"], 1 + r["count"] // MEET) for r in asked.groupBy("block").count().collect()]
    dealt = lambda: F.broadcast(spark.createDataFrame(shares, "block long, shares long"))
    salted = asked.join(dealt(), "block").withColumn("share", F.pmod(F.xxhash64("rank", "depth"), "shares"))
    copied = convs.join(dealt(), "block").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))

    def search(key: tuple, group: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        return _found(known.value, int(key[0]), group.sort_values("rank"), some)

    keys = ["block", "share"]
    found = copied.groupBy(*keys).cogroup(salted.groupBy(*keys)).applyInPandas(search, _FOUND)
    found = saved(found, "trie-found")
    to_right = edge.where("right").select(F.col("block").alias("right_block"), "depth", *[F.col(c).alias(f"e_{c}") for c in ("at", "conv", "total", "fresh", "leaf")])
    to_left = edge.where(~F.col("right")).select(F.col("block").alias("left_block"), F.col("depth").alias("want"), F.col("at").alias("e_left"))
    found = found.withColumn("want", F.col("depth") - (F.col("kind") == 0).cast("long"))
    found = found.join(to_right, ["right_block", "depth"], "left").join(to_left, ["left_block", "want"], "left")
    return found.select(
        "kind", "rank", "depth", "before", "own_total", "total_0", "fresh_0", "leaf_0",
        F.coalesce("e_left", F.when(F.col("left") >= 0, F.col("left"))).alias("left"), F.coalesce("e_at", "last").alias("last"), F.least("conv", "e_conv").alias("conv"),
        *[F.coalesce(f"e_{c}", c).alias(c) for c in ("total", "fresh", "leaf")],
    )


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the strings of each (rank, depth), which come sorted, comma-joined."""
    key, state = None, None
    for batch in batches:
        out = []
        for rank, depth, ids in zip(batch["rank"], batch["depth"], batch["ids"], strict=True):
            if (rank, depth) != key:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (rank, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pd.DataFrame(out, columns=["rank", "depth", "ends_sha256"])
    if key:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["rank", "depth", "ends_sha256"])


def _ends(convs: DataFrame, found: DataFrame) -> DataFrame:
    """(rank, depth, ends_sha256) of the nodes at which conversations end; equal ones follow each other by rising id."""
    first = found.where("kind = 1").select(F.col("rank").alias("own"), "left")
    of = convs.join(first, F.col("rank") == F.col("own"), "left").select(
        F.coalesce("left", F.lit(0)).alias("left"), F.col("length").alias("depth"), "rank", "conv_id"
    )
    ids = F.transform(F.sort_array(F.collect_list(F.struct("rank", "conv_id"))), lambda x: x["conv_id"].cast("string"))
    parts = of.groupBy("left", "depth", F.floor((F.col("rank") - F.col("left")) / IDS).alias("part")).agg(F.array_join(ids, ",").alias("ids"))
    parts = parts.withColumnRenamed("left", "rank")
    return parts.repartition("rank", "depth").sortWithinPartitions("rank", "depth", "part").select("rank", "depth", "ids").mapInPandas(_hashed, "rank long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation. Turns of equal number are
    ordered by their digest, null numbers first; repeated rows are turns of
    their own. Null roles and texts are empty. Families of negative ids are
    those of ``conv_id - conv_id % 5`` as SQL has it, towards zero. No
    conversations have no nodes. Other columns are ignored.
    """
    turns, convs = rebuilt(turn_rows(conversations))
    rows, convs = shared_turns(turns, sorted_convs(turns, convs))
    found = saved(intervals(rows, convs), "trie-intervals")
    n = F.col("last") - F.col("rank") + 1
    with_all = F.col("total") - F.col("total_0") - n * F.col("before")
    once = F.col("own_total") - F.col("before") + F.col("fresh") - F.col("fresh_0")
    nodes = found.where("kind = 0").select(
        "rank", "depth", F.col("conv").alias("conv_id"), "left", n.alias("n_convs"),
        (F.col("leaf") - F.col("leaf_0")).alias("n_leaves"), (with_all - once).alias("saved_tokens"),
    )
    root = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        (F.sum("total") - F.sum("fresh")).alias("saved_tokens"),
    ).where("n_convs > 0")
    root = root.withColumns({c: F.lit(0).cast("long") for c in ("rank", "depth")}).withColumn("left", F.lit(None).cast("long"))
    nodes = saved(nodes.unionByName(root), "trie-nodes")
    # depth 1 is new at many ranks, but has one parent, of rank 0
    up = F.when(F.col("depth") == 1, F.lit(0)).otherwise(F.col("left"))
    nodes = nodes.withColumn("left", up)
    children = nodes.where("depth > 0").groupBy(F.col("left").alias("rank"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("rank").alias("left"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    made = nodes.join(children, ["rank", "depth"], "left").join(above, ["left", "depth"], "left").join(_ends(convs, found), ["rank", "depth"], "left")
    return made.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
