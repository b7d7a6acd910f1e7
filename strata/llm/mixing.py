"""Mixing sources to target weights by systematic sampling.

A source's words shall come near its target. Every document of a source is
expected ``target / size of the source`` times, at most ``MOST`` times. Those
expectations are summed up along the source, one offset below 1 is added, and a
document is emitted once per whole number its stretch crosses. Documents stand
in order of size class, so each class is thinned or repeated alike and the words
taken follow the copies taken.

The running sum of equal expectations is the rank times the expectation, and
ranks come from three levels of counts: class within source, slot within class,
row within slot. No window holds more than one slot, or the counts of one level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import saved, shielded, words
from strata.llm.quality import bin_of

WEIGHTS = (5, 2, 1)
#: No source takes more than so many times its size, and no document either.
MOST = 3
#: Documents per slot, about.
SLOT = 4096
SALTS = 16
SEED = 7


def sized(docs: DataFrame) -> DataFrame:
    """Document, source and number of words; a null text has none."""
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources in order of name, null last, weigh ``weights`` over and over. The
    targets share all words by weight, but stop at ``most`` times a source's
    size, and what is cut off is shared anew. That ends at one level: target =
    least of the stop and level times weight. Sources are ranked by stop over
    weight; the first so many stop, and the level follows from the rest.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = per.withColumn(
        "_weight", F.lit(list(weights))[(place % len(weights)).cast("int")].cast("double")
    )
    stop = (most * F.col("source_size")).cast("double")
    by_stop = Window.orderBy(stop / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    gone = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    left = weighed.withColumns(
        {
            "_stop": stop,
            "_order": F.row_number().over(by_stop),
            # the level if all before this source stop and no later one does
            "_level": (F.sum(F.col("source_size").cast("double")).over(every) - gone(stop))
            / (F.sum("_weight").over(every) - gone(F.col("_weight"))),
        }
    )
    fits = F.col("_level") * F.col("_weight") <= F.col("_stop")
    first = F.min(F.when(fits, F.struct("_order", "_level"))).over(every)
    return left.withColumn("_first", first).select(
        "source",
        "source_size",
        F.least(F.col("_stop"), F.coalesce(F.col("_first._level") * F.col("_weight"), F.col("_stop"))).alias("target"),
    )


def _digits(value: Column, n: int) -> Column:
    """A whole number from the first ``n`` hexadecimal digits of a value's MD5."""
    return F.conv(F.substring(F.md5(value), 1, n), 16, 10).cast("bigint")


def ranked(sizes: DataFrame, slot: int = SLOT) -> DataFrame:
    """(doc_id, source, size) rows and, as ``rank``, each one's place in its source from 1.

    The order is size class, then MD5 of doc_id, then doc_id, then size.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = sizes.withColumns({"_class": bin_of(F.col("size")), "_md5": F.md5(key), "_at": _digits(key, 8)})
    classes = rows.groupBy("source", "_class").agg(F.count(F.lit(1)).alias("_rows"))
    slots = F.greatest(F.lit(1), F.ceil(F.col("_rows") / slot)).cast("bigint")
    null_safe = lambda a, b: a.eqNullSafe(b)
    upto = Window.partitionBy("source").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(
        F.col("source").alias("_s"),
        F.col("_class").alias("_c"),
        slots.alias("_slots"),
        F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before"),
    )
    # a source has a few hundred classes; each is repeated for a salted join with its many rows
    salted = classes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = (
        rows.withColumn("_own", (F.col("_at") % SALTS).cast("int"))
        .join(
            salted,
            null_safe(F.col("source"), F.col("_s"))
            & (F.col("_class") == F.col("_c"))
            & (F.col("_own") == F.col("_salt")),
        )
        .withColumn("_slot", F.expr("(_at * _slots) div 4294967296"))
        .select("doc_id", "source", "size", "_class", "_md5", "_slot", "_before")
    )
    within = Window.partitionBy("source", "_class", "_slot")
    place = F.row_number().over(within.orderBy("_md5", "doc_id", "size"))
    below = (
        Window.partitionBy("source", "_class").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = rows.groupBy("source", "_class", "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select(
        F.col("source").alias("_s"),
        F.col("_class").alias("_c"),
        F.col("_slot").alias("_t"),
        F.coalesce(F.sum("_rows").over(below), F.lit(0)).alias("_start"),
    )
    return (
        rows.withColumn("_place", place)
        .join(
            starts,
            null_safe(F.col("source"), F.col("_s"))
            & (F.col("_class") == F.col("_c"))
            & (F.col("_slot") == F.col("_t")),
        )
        .select(
            "doc_id", "source", "size", (F.col("_before") + F.col("_start") + F.col("_place")).alias("rank")
        )
    )


def plan_mix(
    docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per document.

    A null source is a source; null texts have no words and are thinned like
    others of their class; a source without words takes none. Repeated rows are
    documents of their own, equal rows change places freely. The same rows give
    the same mix. The narrow table of sizes is written to the shared folder.
    """
    sizes = saved(sized(docs), "mix-sizes")
    share = targets(sizes, weights, most).select(
        F.col("source").alias("_s"), "source_size", "target"
    )
    salted = share.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = ranked(sizes).join(
        salted,
        F.col("source").eqNullSafe(F.col("_s")) & ((F.col("rank") % SALTS).cast("int") == F.col("_salt")),
    )
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        F.lit(0.0)
    )
    # so few binary digits that adding them to a whole multiple stays exact
    offset = _digits(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("")))  , 5) / F.lit(1 << 20)
    upto = lambda rank: F.floor(expected * rank + offset)
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (upto(F.col("rank")) - upto(F.col("rank") - 1)).cast("bigint").alias("copies"),
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents themselves, each as often as the mix emits it.

    Rows of one id, source and size are told apart by number, in order of text.
    Columns stay as they are.
    """
    docs, named = shielded(docs, {"doc_id", "source", "text"})
    plan = (
        plan_mix(docs, seed)
        .withColumn("_no", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("copies")))
        .select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), "_no", "copies")
        .where(F.col("copies") > 0)
    )
    sizes = F.size(words(F.col("text"))).cast("long")
    numbered = docs.withColumn("_size", sizes).withColumn(
        "_number",
        F.row_number().over(Window.partitionBy("doc_id", "source", "_size").orderBy("text")),
    )
    return named(
        numbered.join(
            plan,
            F.col("doc_id").eqNullSafe(F.col("_d"))
            & F.col("source").eqNullSafe(F.col("_s"))
            & (F.col("_size") == F.col("_z"))
            & (F.col("_number") == F.col("_no")),
        )
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
