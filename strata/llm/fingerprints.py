"""Bottom-k fingerprints of documents.

A document's shingles are its runs of five words (all its words, if fewer; none
for no words). Its fingerprint holds the ``K`` least distinct 64-bit hashes of
shingles, rising. Fingerprints merge: the least ``K`` of the union of two are
the fingerprint of both texts' shingles together. While a fingerprint holds
fewer than ``K`` hashes it holds all, and what is estimated from it is exact.

Everything is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bind, words

K = 128
SHINGLE = 5
#: Documents per ordered bucket when each document is shown its neighbour.
BUCKET = 1024
#: Beyond this many buckets they grow, and their windows spill.
MOST_BUCKETS = 16384
_SPAN = float(2**64)


def fingerprint(text: Column, k: int = K) -> Column:
    """The bottom-k sketch of a text as a rising array of longs."""

    def of(codes: Column) -> Column:
        shingles = F.transform(
            F.slice(codes, 1, F.size(codes) - (SHINGLE - 1)),
            lambda h, i: F.xxhash64(h, *[codes[i + j] for j in range(1, SHINGLE)]),
        )
        all_words = F.when(F.size(codes) > 0, F.array(F.xxhash64(codes))).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.when(F.size(codes) < SHINGLE, all_words).otherwise(
            F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)
        )

    return bind(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    kth = sketch[k - 1].cast("double") + F.lit(_SPAN / 2)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(
        F.lit((k - 1) * _SPAN) / kth
    )


def _shared(a: Column, b: Column, k: int) -> Column:
    """Of the least hashes of the union: how many, and how many both sides hold."""
    return bind(
        merged(a, b, k),
        lambda u: F.struct(
            F.size(u).alias("n"), F.size(F.array_intersect(F.array_intersect(u, a), b)).alias("both")
        ),
    )


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either text that both have; 1 if both are empty."""
    return bind(
        _shared(a, b, k),
        lambda s: F.when(s["n"] == 0, F.lit(1.0)).otherwise(s["both"] / s["n"]),
    )


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none.

    The shingles of both are the resemblance times those of the union; the
    estimate is held within 0 and 1.
    """
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k))
    )


def with_next(rows: DataFrame, carried: list[str], bucket: int = BUCKET) -> DataFrame:
    """``rows`` and, as a struct ``next``, what the next row by falling doc_id carries.

    The last row is shown the first. Null ids come last, equal ids go by text.
    Rows are dealt into buckets whose upper ends are quantiles of doc_id, so a
    window holds one bucket; the topmost row of each bucket is given to the
    bucket above it as well, which it follows. Only the ends, at most
    ``MOST_BUCKETS``, come to the driver.
    """
    count, least, most = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    parts = max(1, min(MOST_BUCKETS, -(-count // bucket)))
    least = 0 if least is None else least
    rows = rows.withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(least - 1)))
    shares = [i / parts for i in range(1, parts)]
    ends = []
    if shares:
        ends = rows.agg(F.percentile_approx("_id", shares, 10 * parts)).first()[0]
    ends = sorted({*ends, least - 1 if most is None else most})
    # the number of ends below the id, by binary search
    steps = [1 << i for i in reversed(range(len(ends).bit_length()))]
    tops = F.lit(ends)
    below = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda low, step: F.when(
            F.try_element_at(tops, low + step) < F.col("_id"), low + step
        ).otherwise(low),
    )
    rows = rows.withColumn("_bucket", below)
    topmost = F.try_element_at(tops, F.col("_bucket") + 1) == F.col("_id")
    above = (F.col("_bucket") + 1) % len(ends)
    dealt = rows.withColumn(
        "_to",
        F.explode(
            F.when(
                topmost,
                F.array(
                    F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest")),
                    F.struct(above.alias("bucket"), F.lit(True).alias("guest")),
                ),
            ).otherwise(
                F.array(F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest")))
            )
        ),
    )
    falling = Window.partitionBy("_to.bucket").orderBy("_to.guest", F.col("_id").desc(), "text")
    return (
        dealt.withColumn("next", F.lead(F.struct(*carried)).over(falling))
        .where(~F.col("_to.guest"))
        .drop("_id", "_bucket", "_to")
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.left(text, F.length(text) - third), F.left(following, third))


def as_text(sketch: Column) -> Column:
    """A fingerprint as hexadecimal hashes, comma-joined."""
    return F.concat_ws(",", F.transform(sketch, lambda h: F.lower(F.hex(h))))


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness.

    A null text counts as empty, and two texts without words are alike. Repeated
    rows are documents of their own. Other columns are ignored. The texts move
    once, with the fingerprint made where they were read.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", body.alias("text")).withColumn("sketch", fingerprint(F.col("text"), k))
    shown = with_next(rows, ["text", "sketch"])
    with_edit = shown.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "sketch",
        F.col("next.sketch").alias("_next"),
        bind(
            edited(F.col("text"), F.col("next.text")),
            lambda e: F.struct(F.sha2(e.cast("binary"), 256).alias("sha"), fingerprint(e, k).alias("sketch")),
        ).alias("_edit"),
    )
    return with_edit.select(
        "doc_id",
        "n_chars",
        F.col("_edit.sha").alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("_edit.sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("_edit.sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("_next"), k).alias("near_next"),
        containment(F.col("sketch"), F.col("_edit.sketch"), k).alias("within_edited"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"),
    )
