"""What the text operators share: null-safe text, held-out folds, and Arrow texts as byte arrays."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.session import send_package

#: Python passes work through an Arrow batch in runs of about so many text bytes.
RUN_BYTES = 2_000_000
#: Rows in an Arrow batch, at most, and the setting that says so.
MOST_ROWS, ARROW_ROWS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's decimal text modulo ``folds``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def with_columns_after(
    docs: DataFrame,
    work: Callable[[pa.Array, pa.StructArray], dict],
    schema: str,
    extra: dict[str, Column] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (all columns, or those of ``keep``) as a struct ``row``, next to what ``work`` computes.

    ``work(texts, given)`` sees the texts of a run of rows (nulls as empty) and the columns of
    ``extra``. The row travels as one struct, so no column of ``docs`` can clash with a computed one.
    """
    row = F.struct(*(keep or docs.columns)).alias("row")
    has_text = "text" in (keep or docs.columns)
    given = F.struct(F.lit(0).alias("_"), *(c.alias(k) for k, c in (extra or {}).items())).alias("given")
    rows = docs.select(row, given, *([] if has_text else [whole_text().alias("text")]))
    names = [f.name for f in T._parse_datatype_string(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, given = batch.column("row"), batch.column("given")
            text = pc.fill_null(row.field("text") if has_text else batch.column("text"), "")
            for lo, hi in runs(text):
                part = work(text.slice(lo, hi - lo), given.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([row.slice(lo, hi - lo), *(part[n] for n in names)], ["row", *names])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {schema}")


def runs(texts: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``most`` bytes of text each; a longer text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)
    lo, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > lo and total + size > most:
            yield lo, i
            lo, total = i, 0
        total += size
    if len(sizes):
        yield lo, len(sizes)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and the n + 1 positions where they begin and end."""
    binary = pc.fill_null(texts, "").cast(pa.large_string()).cast(pa.large_binary())
    _, where, data = binary.buffers()
    at = np.frombuffer(where, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    if not len(at):
        at = np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


_CACHES: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None]) -> None:
    """Say whose cache this worker process fills; ``clear`` empties it.

    Workers go on to other stages, and what an earlier stage cached is no use to them: the caches of
    others are emptied, and freed memory is given back.
    """
    others = [n for n in _CACHES if n != name]
    for n in others:
        _CACHES.pop(n)()
    if others:
        give_back()
    _CACHES[name] = clear


def give_back() -> None:
    """Return memory that Arrow and the C library hold but do not use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def bounded_sample(rows: DataFrame, label: Column, key: Column, most: int) -> DataFrame:
    """About ``most`` rows of every label, at most, chosen by a hash of ``key``.

    The counts per label decide a share of the hash's range, so that no label is sorted or gathered.
    """
    marked = rows.withColumn("sample_label", label).filter(F.col("sample_label").isNotNull())
    counts = marked.groupBy("sample_label").agg(F.count("*").alias("sample_of"))
    spot = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return (
        marked.join(F.broadcast(counts.orderBy(F.desc("sample_of"), "sample_label").limit(1000)), "sample_label")
        .filter(spot < F.lit(float(most)) / F.col("sample_of"))
        .drop("sample_of")
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, and bound the rows of an Arrow batch.

    Rows here hold whole texts, and a batch is held by the executor and by its Python worker, coming
    and going.
    """
    if int(spark.conf.get(ARROW_ROWS)) > MOST_ROWS:
        spark.conf.set(ARROW_ROWS, str(MOST_ROWS))
    send_package(spark)
