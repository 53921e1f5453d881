"""What the text operators share: tables, batches, written steps, word shingles."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from sensorstar.session import broadcast_up_to, shared_folder

# Rows and bytes of one Arrow batch: texts may be very long.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20

# Shingles are five words; near copies share three quarters of them.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 75

# Words whose hashes a task remembers before it starts anew.
CACHED_WORDS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, so that long texts do not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by columns, and
    still there when an executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Each Arrow batch through a function that ``make`` builds once per task."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)


def rows_by_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """The same with the columns ``df`` has: batches lose rows or change values."""
    small_batches(df.sparkSession)
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)


def without_ids(df: DataFrame, ids: DataFrame, limit: int) -> DataFrame:
    """``df`` without the rows whose ``doc_id`` is among ``ids``: sent to every task if
    they are at most ``limit``, else joined by a shuffle."""
    ids = stored(ids.select("doc_id").distinct())
    return df.join(broadcast_up_to(ids, ids.count(), limit), "doc_id", "left_anti").select(df.columns)


class WordHashes(dict):
    """64-bit hashes of words as bytes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


# Odd multipliers, one for each place in a shingle.
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    shift, factor = np.uint64(32), np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> shift)) * factor
    values = (values ^ (values >> shift)) * factor
    return values ^ (values >> shift)


def shingle_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text, A-Z in lower
    case; a shorter text is one shingle; no words, no shingles."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    found = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    if n < SHINGLE_WORDS:
        values = (found * _PLACES[:n]).sum(keepdims=True) + np.uint64(n)
    else:
        values = found[: n - 4] * _PLACES[0]
        for place in range(1, SHINGLE_WORDS):
            values += found[place : n - 4 + place] * _PLACES[place]
    values = np.sort(mixed(values))
    return values[np.concatenate(([True], values[1:] != values[:-1]))]
