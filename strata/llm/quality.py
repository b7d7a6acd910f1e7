"""Quality rules with thresholds learnt per language and source.

Each rule compares one integer rate of a document with a fence that follows
from the quartiles of that rate among the documents of its language and source.
Quartiles come from a mergeable sketch: a histogram whose bins have 32 steps
per power of two, so a quartile is at most one part in 32 too low, whatever the
order in which parts are added. A group with few documents uses the merged
sketch of its language, and that of all documents if the language has few too.

Everything is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bind, saved, words

SYMBOL = "[#*$%&|<>]"
#: Below so many documents, a group takes the thresholds of the level above.
LEAST = 100
#: Rate: the least spread that its fence allows for.
SLACK = {"symbol_rate": 20, "dup_line_rate": 150, "repeat_rate": 130, "word_length": 50}
#: A fence lies so many spreads beyond its quartile.
REACH = 3
STEPS = 32
SALTS = 16


def _repeat_words(found: Column) -> Column:
    """Words within 3-word windows that occur twice or more."""

    def covered(windows: Column) -> Column:
        def ends(order: Column) -> Column:
            last = F.size(order) - 1
            again = F.filter(
                order,
                lambda x, i: ((i > 0) & (order[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]))
                | ((i < last) & (order[F.least(i + 1, last)]["h"] == x["h"])),
            )
            return F.sort_array(F.transform(again, lambda x: x["p"]))

        keyed = F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
        starts = bind(F.sort_array(keyed), ends)
        return bind(
            starts,
            lambda s: F.aggregate(
                F.transform(
                    s,
                    lambda p, i: F.when(i == F.size(s) - 1, F.lit(3)).otherwise(
                        F.least(F.lit(3), s[F.least(i + 1, F.size(s) - 1)] - p)
                    ),
                ),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    def of(codes: Column) -> Column:
        windows = F.transform(
            F.slice(codes, 1, F.size(codes) - 2),
            lambda h, i: F.xxhash64(h, codes[i + 1], codes[i + 2]),
        )
        return bind(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
                covered(w)
            ),
        )

    none = F.lit(0).cast("long")
    return F.when(F.size(found) < 4, none).otherwise(
        bind(F.transform(found, lambda w: F.xxhash64(w)), of)
    )


def base_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the counts that the rules are made of.

    A null text counts as empty. Windows are compared by a 64-bit hash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rest = [c for c in docs.columns if c != text]
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.select(
        *rest,
        (F.size(F.split(body, SYMBOL)) - 1).cast("long").alias("n_symbols"),
        bind(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            ),
        ).alias("_lines"),
        bind(
            words(F.col(text)),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n"),
                F.length(F.concat_ws("", w)).cast("long").alias("chars"),
                _repeat_words(w).alias("again"),
            ),
        ).alias("_words"),
    ).select(
        *rest,
        F.col("_words.n").alias("n_words"),
        F.col("_words.chars").alias("word_chars"),
        "n_symbols",
        F.col("_lines.dup").alias("n_dup_lines"),
        F.col("_words.again").alias("n_repeat_words"),
        F.col("_lines.n").alias("n_lines"),
    )


def _rates(signals: DataFrame) -> DataFrame:
    def per(part: str, whole: str, scale: int) -> Column:
        return F.expr(f"CASE WHEN {whole} > 0 THEN ({scale} * {part}) div {whole} ELSE 0 END")

    return signals.withColumns(
        {
            "symbol_rate": per("n_symbols", "n_words", 1000),
            "dup_line_rate": per("n_dup_lines", "n_lines", 1000),
            "repeat_rate": per("n_repeat_words", "n_words", 1000),
            "word_length": per("word_chars", "n_words", 100),
            "base_failed": F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"),
        }
    )


def bin_of(value: Column) -> Column:
    """The histogram bin of a whole number from 0 on: itself below 64, then 32 per doubling."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 2 * STEPS, value).otherwise(
        (shift * STEPS + F.call_function("shiftright", value, shift)).cast("long")
    )


def bin_start(bin_no: Column) -> Column:
    """The least value in a bin."""
    shift = (F.floor(bin_no / STEPS) - 1).cast("int")
    return F.when(bin_no < 2 * STEPS, bin_no).otherwise(
        F.call_function("shiftleft", bin_no - shift * STEPS, shift)
    )


def sketch(rates: DataFrame, keys: list[str]) -> DataFrame:
    """Per group, rate and bin its number of documents; parts merge by adding."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rate"), bin_of(F.col(r)).alias("bin")) for r in SLACK])
    ).alias("p")
    return (
        rates.where(F.col("n_words") > 0)
        .select(*keys, pairs)
        .groupBy(*keys, "p.rate", "p.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))


def fences(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Per group a map from rate to (n, low, high)."""
    from pyspark.sql import Window

    of = Window.partitionBy(*keys, "rate")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    spread = F.create_map(*[x for r, s in SLACK.items() for x in (F.lit(r), F.lit(s))])
    counted = parts.withColumns(
        {"upto": F.sum("n").over(upto), "total": F.sum("n").over(of), "start": bin_start(F.col("bin"))}
    )
    quartile = lambda q: F.min(
        F.when(F.col("upto") >= F.expr(f"({q} * total + 3) div 4"), F.col("start"))
    )
    return (
        counted.groupBy(*keys, "rate")
        .agg(F.max("total").alias("n"), quartile(1).alias("q1"), quartile(3).alias("q3"))
        .withColumn("reach", REACH * F.greatest(F.col("q3") - F.col("q1"), spread[F.col("rate")]))
        .groupBy(*keys)
        .agg(
            F.max("n").alias("n"),
            F.map_from_entries(
                F.collect_list(
                    F.struct(
                        "rate",
                        F.struct(
                            (F.col("q1") - F.col("reach")).alias("low"),
                            (F.col("q3") + F.col("reach")).alias("high"),
                        ),
                    )
                )
            ).alias("fence"),
        )
    )


def thresholds(parts: DataFrame) -> DataFrame:
    """(lang, source, fence): that of the first level with enough documents."""
    own = fences(parts, ["lang", "source"])
    wide = fences(merge(parts, ["lang"]), ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("n").alias("_n"), F.col("fence").alias("_fence")
    )
    every = fences(merge(parts.withColumn("_all", F.lit(1)), ["_all"]), ["_all"]).select(
        "_all", F.col("fence").alias("_every")
    )
    return (
        own.join(wide, F.col("lang").eqNullSafe(F.col("_lang")))
        .withColumn("_all", F.lit(1))
        .join(every, "_all")
        .select(
            "lang",
            "source",
            F.when(F.col("n") >= LEAST, F.col("fence"))
            .when(F.col("_n") >= LEAST, F.col("_fence"))
            .otherwise(F.col("_every"))
            .alias("fence"),
        )
    )


def quality_filter(docs: DataFrame) -> DataFrame:
    """One row per document: its counts and rates, ``base_failed`` and ``kept``.

    ``docs`` needs doc_id, text, lang and source; null languages and sources
    are groups of their own, null or empty texts fail, repeated rows each get a
    row, other columns are ignored. The narrow table of counts is written to
    the shared folder, as sketch and join both read it. Thresholds are repeated
    per salt, so that the documents of one large source meet them in many tasks.
    """
    kept = docs.select("doc_id", "lang", "source", "text")
    rates = saved(_rates(base_signals(kept)), "quality-signals")
    salted = thresholds(sketch(rates, ["lang", "source"])).select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        "fence",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    own = F.pmod(F.xxhash64("doc_id", "word_chars", "n_symbols"), F.lit(SALTS)).cast("int")
    joined = rates.join(
        salted,
        F.col("lang").eqNullSafe(F.col("_lang"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (own == F.col("_salt")),
        "left",
    )
    inside = F.lit(True)
    for rate in SLACK:
        fence = F.col("fence")[rate]
        inside = inside & (F.col(rate) <= fence["high"])
        if rate == "word_length":
            inside = inside & (F.col(rate) >= fence["low"])
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        *SLACK,
    )
