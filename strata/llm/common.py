"""What several operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What parts words: blank, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of rows that a Python worker is sent at once.
BATCH_BYTES = 4 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share, under ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this machine, as in tests,
    may leave that setting out; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strata-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Lets at most about ``BATCH_BYTES`` of rows go to a Python worker at once, unless the session asks for less.

    The default of 10,000 rows is tens of megabytes of texts, which the executor
    and each worker hold several times over.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = re.match(r"(-?\d+)([kmgtp]?)", spark.conf.get(key).lower())
    scale = 1024 ** " kmgtp".index(given[2] or " ") if given else 0
    if not given or not 0 < int(given[1]) * scale <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps in a Python worker from task to task; what others kept there is let go.

    Workers are used again by later stages, which would otherwise hold the
    memory of all operators before them.
    """
    for other in [k for k in _KEPT if k != owner]:
        del _KEPT[other]
    return _KEPT.setdefault(owner, {})


def shielded(docs: DataFrame, used: set[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with numbered names for all columns but those ``used``, and what gives a result the old names back.

    So no column of the user's can clash with one that an operator makes.
    """
    inner = {c: c if c in used else f"_own{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    return named, lambda df: df.select(*[F.col(n).alias(c) for c, n in inner.items()])


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def word_lists(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a long text in lists of about ``size`` bytes of it each."""
    at = 0
    while at < len(data):
        gap = _BLANK.search(data, at + size) if len(data) - at > size else None
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Sorted batches cut anew so that no group is parted, small ones joined to about ``rows``."""
    kept: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if not len(batch):
            continue
        kept.append(batch)
        size += len(batch)
        if size < rows:
            continue
        joined = pd.concat(kept, ignore_index=True)
        same = np.ones(len(joined), bool)
        for key in keys:
            same &= joined[key].to_numpy() == joined[key].iloc[-1]
        cut = int(np.argmax(same))  # the last group may go on in the next batch
        if cut:
            yield joined.iloc[:cut].reset_index(drop=True)
        kept = [joined.iloc[cut:]]
        size = len(kept[0])
    if kept:
        yield pd.concat(kept, ignore_index=True)
