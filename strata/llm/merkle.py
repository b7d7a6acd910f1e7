"""A Merkle manifest of a table, by pivoting children into slot columns.

Rows are leaves, in trees of one group each; the roots of these are the leaves
of one more tree. At each level ``FANOUT`` nodes in a row share a parent: one
conditional aggregate per slot spreads them into columns, the columns joined are
what the parent hashes, and without a node's own column they are its siblings.

Proofs are made from the root down: a row of slots knows the siblings of all
levels above it, and hands each of its nodes these and its own columns. A level
has an eighth of the rows of the one below, so all levels together move little
more than the leaves; texts are hashed where they are read and move never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import saved
from strata.llm.ordering import numbered

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts joined, lowercase hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    return digest(*[framed(fields[name]) for name in FIELDS])


def tampered(docs: DataFrame) -> Column:
    """Whether a document counts as tampered with: 3 divides the CRC-32 of its id as text; not for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """A text whose letters A to Z are lower case, all others kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _pivoted(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, pos, size, digest, c0 ... c7) of the parents; a slot is (digest, carried) or null."""
    slot = F.col("pos") % FANOUT
    child = F.struct("digest", *carried)
    columns = [F.max(F.when(slot == i, child)).alias(f"c{i}") for i in range(FANOUT)]
    parents = nodes.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos"), "size").agg(*columns)
    digests = [F.coalesce(F.col(f"c{i}.digest"), F.lit("")) for i in range(FANOUT)]
    return parents.withColumns({"size": F.ceil(F.col("size") / FANOUT), "digest": digest(*digests)})


def _handed(rows: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes in the slots of rows that know the ``steps`` above them, each with its own."""
    digests = [F.coalesce(F.col(f"c{i}.digest"), F.lit("")) for i in range(FANOUT)]

    def step(i: int) -> Column:
        left = F.concat(F.lit(""), *digests[:i])
        return F.struct(left.alias("left"), F.concat(F.lit(""), *digests[i + 1 :]).alias("right"))

    nodes = F.array(
        *[
            F.when(
                F.col(f"c{i}").isNotNull(),
                F.struct(
                    (F.col("pos") * FANOUT + i).alias("pos"),
                    F.concat(F.array(step(i)), F.col("steps")).alias("steps"),
                    *[F.col(f"c{i}.{c}").alias(c) for c in ("digest", *carried)],
                ),
            )
            for i in range(FANOUT)
        ]
    )
    return rows.select("tree", F.explode(F.array_compact(nodes)).alias("n")).select("tree", "n.*")


def _grown(leaves: DataFrame, carried: list[str], name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, digest) of the roots, and the pivoted levels, lowest first; written."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    level, roots, levels = leaves, [], []
    while True:
        roots.append(level.where("size = 1").select("tree", "digest"))
        if most <= 1:
            break
        level = saved(_pivoted(level.where("size > 1"), carried if not levels else []), name)
        levels.append(level)
        most = -(-most // FANOUT)
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return out, levels


def _proved(leaves: DataFrame, levels: list[DataFrame], carried: list[str]) -> DataFrame:
    """(tree, digest, carried, steps): the leaves with the siblings that lead to their root, lowest first."""
    none = F.array().cast(_STEPS)
    above = None
    for no in range(len(levels) - 1, -1, -1):
        level = levels[no]
        top = level.where("size = 1").withColumn("steps", none)
        if above is not None:
            known = above.select("tree", "pos", "steps")
            match = level["tree"].eqNullSafe(known["tree"]) & (level["pos"] == known["pos"])
            lower = level.where("size > 1").join(known, match).select(level["*"], known["steps"])
            top = top.unionByName(lower)
        above = _handed(top, carried if no == 0 else [])
    alone = leaves.where("size = 1").select("tree", "digest", *carried, none.alias("steps"))
    return alone if above is None else alone.unionByName(above.select("tree", "digest", *carried, "steps"))


def siblings(steps: Column) -> Column:
    """All siblings on the way, joined."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    A tree per lang, null being one; its leaves rise by doc_id, nulls first, and
    leaves of one id by their digest, so repeated rows are leaves of their own
    and reruns agree. A tree of one leaf has it as subroot, and one tree's
    subroot is the root; proofs may then be empty. No documents have no root and
    no rows. Columns other than the five hashed are ignored; one of these that
    is missing counts as null.
    """
    fields = {n: F.col(n) if n in docs.columns else F.lit(None).cast("string") for n in FIELDS}
    changed = leaf(fields | {"text": lowered(fields["text"].cast("string"))})
    rows = docs.select(
        fields["doc_id"].alias("doc_id"),
        fields["lang"].alias("tree"),
        leaf(fields).alias("digest"),
        # only where it may differ, so that little moves
        F.when(tampered(docs), changed).alias("changed"),
    )
    carried = ["doc_id", "changed"]
    leaves = saved(numbered(rows, ["tree"], ["doc_id", "digest"], "merkle-leaves"), "merkle-placed")
    subroots, levels = _grown(leaves, carried, "merkle-level")
    subroots = saved(subroots.withColumnRenamed("tree", "lang"), "merkle-subroots")
    tops = numbered(subroots.withColumn("tree", F.lit(0)), [], ["lang"], "merkle-tops")
    tops = saved(tops, "merkle-tops-placed")
    root, top_levels = _grown(tops, ["lang"], "merkle-top-level")
    found = root.first()
    of_tree = _proved(tops, top_levels, ["lang"]).select(
        "lang", F.col("digest").alias("subroot"), F.col("steps").alias("top")
    )
    proved = _proved(leaves, levels, carried).join(of_tree, F.col("tree").eqNullSafe(F.col("lang")))
    made = proved.withColumn("steps", F.concat("steps", "top"))
    return made.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(found["digest"] if found else None).cast("string").alias("root"),
        F.sha2(siblings(F.col("steps")).cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "digest"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
