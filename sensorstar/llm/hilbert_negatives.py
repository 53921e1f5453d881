"""Hard negatives from blocks along a Hilbert curve.

Vectors are sorted by label and then along a Hilbert curve, and cut into blocks of bounded
size, written as Parquet. A block's zone map holds its labels and, for each dimension, its
smallest and largest component. For an anchor, interval arithmetic on a zone map gives the
least and the largest score any row of the block can have; only blocks that may hold a
score in one of the anchor's windows are read.

Positives have one open window, which the anchor's own block narrows from the start. Each
positive then gives a window for negatives. The most promising block is read first; its
fifth score in a window raises the window's lower end before the other blocks are chosen.
Whatever could still enter is read, so the results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstar.llm.common import small_batches, stored
from sensorstar.llm.vectors import as_matrix, floored, list_of, longest, products
from sensorstar.operators.numbering import number_rows
from sensorstar.session import literal_rows

# Rows of a block and numbers in it at most; blocks read together (one bit of a mask each);
# anchors asked together; zone maps looked at together. Work depends on them, results do not.
BLOCK = 1024
BLOCK_NUMBERS = 1 << 20
CHUNK = 32
ANCHORS = 8192
ZONES = 8192
# Anchors whose bounds are computed at once.
STEP = 256
# Bits of a component on the curve.
BITS = 6

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
WINDOWS = "windows array<struct<slot:int, low:bigint, high:bigint>>"
_WINDOWS = pa.list_(pa.struct([("slot", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]))
BLOCKS = (
    "block bigint, chunk bigint, ids array<bigint>, labels array<bigint>, entries array<bigint>, "
    "first_label bigint, last_label bigint, low array<bigint>, high array<bigint>"
)
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def curve_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of cells, a row of coordinates below ``2 ** bits``
    each, as rows of bytes that sort in the curve's order.

    Skilling's transformation (2004) turns coordinates into the index's bits, dealt to
    the dimensions; they are then read across.
    """
    cells = cells.astype(np.int64).copy()
    count, width = cells.shape
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for n in range(width):
            high = (cells[:, n] & bit) != 0
            swap = np.where(high, 0, (cells[:, 0] ^ cells[:, n]) & below)
            cells[:, 0] ^= np.where(high, below, swap)
            cells[:, n] ^= swap
        bit >>= 1
    for n in range(1, width):
        cells[:, n] ^= cells[:, n - 1]
    flip = np.zeros(count, np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        if width:
            flip ^= np.where(cells[:, -1] & bit, bit - 1, 0)
        bit >>= 1
    cells ^= flip[:, None]
    across = (cells[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return np.packbits(across.reshape(count, bits * width).astype(np.uint8), axis=1)


def _keys(width: int, largest: int):
    """Batches with the place of each vector on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = as_matrix(batch.column("vector"), width).astype(np.float64)
            cells = (vectors + largest) / (2.0 * largest + 1) * (1 << BITS)
            keys = curve_keys(np.clip(cells, 0, (1 << BITS) - 1))
            yield batch.append_column("key", pa.array([k.tobytes() for k in keys], pa.binary()))

    return run


def _blocks(width: int, size: int):
    """Sorted rows to blocks with their zone maps."""

    def made(table: pa.Table, number: int) -> pa.RecordBatch:
        vectors = as_matrix(table.column("vector"), width)
        labels = table.column("label").to_numpy()
        block = (TaskContext.get().partitionId() << 33) | number
        lists = [table.column("vec_id").to_numpy(), labels, vectors.ravel(), vectors.min(axis=0), vectors.max(axis=0)]
        ids, labels_list, entries, low, high = [list_of(pa.array(values, pa.int64())) for values in lists]
        scalars = [block, block // CHUNK, int(labels.min()), int(labels.max())]
        block_column, chunk, first, last = [pa.array([value], pa.int64()) for value in scalars]
        columns = [block_column, chunk, ids, labels_list, entries, first, last, low, high]
        return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = number = 0
        for batch in batches:
            waiting.append(batch)
            rows += len(batch)
            if rows >= size:
                table = pa.Table.from_batches(waiting)
                for start in range(0, rows - rows % size, size):
                    yield made(table.slice(start, size), number)
                    number += 1
                rows %= size
                waiting = table.slice(len(table) - rows).to_batches()
        if rows:
            yield made(pa.Table.from_batches(waiting), number)

    return run


def _anchors(width: int, every: int, wanted: int):
    """The anchors of each block, each with one window: at least the last of the wanted
    scores that rows of its label in the block itself have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                ids, labels, entries = [np.asarray(batch.column(c)[n].values) for c in ("ids", "labels", "entries")]
                vectors = entries.reshape(len(ids), width)
                at = np.flatnonzero(ids % every == 0)
                scores = products(vectors[at], vectors)
                other = (labels[at][:, None] == labels[None, :]) & (ids[at][:, None] != ids[None, :])
                scores = np.sort(np.where(other, scores, LEAST), axis=1)
                lows = scores[:, -wanted] if scores.shape[1] >= wanted else np.full(len(at), LEAST)
                windows = [[{"slot": 0, "low": int(low), "high": MOST}] for low in lows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), batch.column("block")[n].as_py()), pa.int64()), pa.array(at, pa.int32())]
                    + [pa.array(ids[at], pa.int64()), pa.array(labels[at], pa.int64())]
                    + [list_of(pa.array(vectors[at].ravel(), pa.int64()), len(at)), pa.array(windows, _WINDOWS)],
                    ["block", "place", "anchor_id", "label", "vector", "windows"],
                )

    return run


def _window_matrix(windows: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, lower and upper ends, a row for each anchor; windows that are missing hold
    nothing."""
    windows = windows.combine_chunks()
    counts = windows.value_lengths().to_numpy(zero_copy_only=False)
    shape = len(windows), int(counts.max(initial=0))
    there = np.arange(shape[1])[None, :] < counts[:, None]
    found = []
    for name, nothing in (("slot", -1), ("low", MOST), ("high", LEAST)):
        matrix = np.full(shape, nothing, np.int64)
        matrix[there] = windows.flatten().field(name).to_numpy(zero_copy_only=False)
        found.append(matrix)
    return tuple(found)


def score_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest inner product of each query with any vector whose
    components lie between those of ``low`` and ``high``, for each pair of these."""
    above, below = np.maximum(queries, 0), np.minimum(queries, 0)
    return products(above, low) + products(below, high), products(above, high) + products(below, low)


def _choose(width: int, same_label: bool, most_promising: bool):
    """Which blocks of a page of zone maps each anchor of a group must read: a mask for
    each chunk."""

    def run(zones: pa.Table, anchors: pa.Table) -> pa.Table:
        names = ["part", "chunk", "anchor", "anchor_id", "label", "vector", "windows", "mask"]
        zones = zones.sort_by("block")
        low, high = as_matrix(zones.column("low"), width), as_matrix(zones.column("high"), width)
        first, last, block, chunk = [zones.column(c).to_numpy() for c in ("first_label", "last_label", "block", "chunk")]
        starts = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1]))) if len(chunk) else np.array([], int)
        bit = np.left_shift(np.int64(1), block % CHUNK)
        queries, labels = as_matrix(anchors.column("vector"), width), anchors.column("label").to_numpy()
        _, floor, ceiling = _window_matrix(anchors.column("windows"))
        asking, chunks, masks = [np.array([], np.int64)], [np.array([], np.int64)], [np.array([], np.int64)]
        for start in range(0, len(queries) if len(zones) else 0, STEP):
            rows = slice(start, start + STEP)
            least, largest = score_bounds(queries[rows], low, high)
            own = labels[rows][:, None]
            labelled = (first <= own) & (own <= last) if same_label else (first != own) | (last != own)
            within = np.zeros(least.shape, bool)
            for slot in range(floor.shape[1]):
                within |= (largest >= floor[rows, slot][:, None]) & (least <= ceiling[rows, slot][:, None])
            within &= labelled
            if most_promising:
                best = np.where(within, largest, LEAST).argmax(axis=1)
                chosen = np.zeros_like(within)
                chosen[np.arange(len(best)), best] = True
                within &= chosen
            bits = np.bitwise_or.reduceat(np.where(within, bit[None, :], 0), starts, axis=1)
            row, group = np.nonzero(bits)
            asking.append(row + start)
            chunks.append(chunk[starts[group]])
            masks.append(bits[row, group])
        found = anchors.take(np.concatenate(asking))
        found = found.set_column(found.column_names.index("windows"), "windows", found.column("windows").cast(_WINDOWS))
        found = found.append_column("chunk", pa.array(np.concatenate(chunks), pa.int64()))
        return found.append_column("mask", pa.array(np.concatenate(masks), pa.int64())).select(names)

    return run


def first_hits(hits: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows ``(anchor, slot, score, id)`` the first ``wanted`` of each anchor and slot,
    higher scores and then smaller ids first, and their ranks from 0."""
    order = np.lexsort((hits[:, 3], ~hits[:, 2], hits[:, 1], hits[:, 0]))
    hits = hits[order]
    new = np.concatenate(([True], (hits[1:, :2] != hits[:-1, :2]).any(axis=1)))[: len(hits)]
    starts = np.flatnonzero(new)
    rank = np.arange(len(hits)) - np.repeat(starts, np.diff(np.append(starts, len(hits))))
    return hits[rank < wanted], rank[rank < wanted]


def _scan(width: int, same_label: bool, wanted: int):
    """The first rows in each window of each anchor of a group, from the blocks of a
    chunk. What earlier blocks gave narrows the windows."""

    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        queries, labels = as_matrix(asked.column("vector"), width), asked.column("label").to_numpy()
        own_ids, masks = asked.column("anchor_id").to_numpy(), asked.column("mask").to_numpy()
        slots, floor, ceiling = _window_matrix(asked.column("windows"))
        floor, hits = floor.copy(), np.empty((0, 4), np.int64)
        for block in blocks.sort_by("block").to_pylist() if len(asked) else []:
            rows = np.flatnonzero(masks >> (block["block"] % CHUNK) & 1)
            ids, theirs = np.array(block["ids"], np.int64), np.array(block["labels"], np.int64)
            scores = products(queries[rows], np.array(block["entries"], np.int64).reshape(len(ids), width))
            fits = (scores >= floor[rows].min(axis=1)[:, None]) & (scores <= ceiling[rows].max(axis=1)[:, None])
            fits &= (labels[rows][:, None] == theirs[None, :]) == same_label
            fits &= own_ids[rows][:, None] != ids[None, :]
            row, column = np.nonzero(fits)
            score, row = scores[row, column], rows[row]
            new = [hits]
            for slot in range(slots.shape[1]):
                into = np.flatnonzero((score >= floor[row, slot]) & (score <= ceiling[row, slot]))
                new.append(np.stack([row[into], np.full(len(into), slot), score[into], ids[column[into]]], axis=1))
            if sum(map(len, new)) > len(hits):
                hits, rank = first_hits(np.concatenate(new), wanted)
                last = hits[rank == wanted - 1]
                floor[last[:, 0], last[:, 1]] = np.maximum(floor[last[:, 0], last[:, 1]], last[:, 2])
        anchor, slot = asked.column("anchor").to_numpy(), slots[hits[:, 0], hits[:, 1]] if len(hits) else hits[:, 1]
        return pa.table(
            {
                "anchor": pa.array(anchor[hits[:, 0]], pa.int64()),
                "slot": pa.array(slot, pa.int32()),
                "vec_id": pa.array(hits[:, 3], pa.int64()),
                "score": pa.array(hits[:, 2], pa.int64()),
            }
        )

    return run


def _each(count: int) -> Column:
    """A row for each number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


class Blocks:
    """Vectors in blocks, and the searches in them."""

    def __init__(self, rows: DataFrame, width: int, largest: int, size: int) -> None:
        small_batches(rows.sparkSession)
        size = max(1, min(size, BLOCK_NUMBERS // max(1, width)))
        order = ["label", "key", "vec_id"]
        keyed = rows.mapInArrow(_keys(width, largest), "vec_id bigint, label bigint, vector array<bigint>, key binary")
        along = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        self.width = width
        self.blocks = stored(along.mapInArrow(_blocks(width, size), BLOCKS))
        self.pages = max(1, -(-self.blocks.count() // ZONES))

    def anchors(self, every: int, wanted: int) -> DataFrame:
        """``(anchor, part, anchor_id, label, vector, windows)``: rows whose id ``every``
        divides, numbered along the curve and cut into parts of bounded size."""
        source = self.blocks.select("block", "ids", "labels", "entries")
        schema = f"block bigint, place int, anchor_id bigint, label bigint, vector array<bigint>, {WINDOWS}"
        found = source.mapInArrow(_anchors(self.width, every, wanted), schema)
        numbered = number_rows(found, ["block", "place"], "anchor")
        return stored(numbered.withColumn("part", F.expr(f"(anchor - 1) div {ANCHORS}")).drop("block", "place"))

    def choose(self, anchors: DataFrame, parts: int, same_label: bool, most_promising: bool) -> DataFrame:
        """The blocks each anchor must read, as a row for each chunk of blocks."""
        page = F.pmod(F.xxhash64("chunk"), F.lit(self.pages)).alias("page")
        zones = self.blocks.select("block", "chunk", "first_label", "last_label", "low", "high", page, _each(parts).alias("part"))
        asking = anchors.select("part", "anchor", "anchor_id", "label", "vector", "windows", _each(self.pages).alias("page"))
        schema = f"part bigint, chunk bigint, anchor bigint, anchor_id bigint, label bigint, vector array<bigint>, {WINDOWS}, mask bigint"
        chosen = _choose(self.width, same_label, most_promising)
        return stored(zones.groupBy("part", "page").cogroup(asking.groupBy("part", "page")).applyInArrow(chosen, schema))

    def search(self, anchors: DataFrame, parts: int, same_label: bool, wanted: int, most_promising: bool = False) -> DataFrame:
        """``(anchor, slot, rank, vec_id, score)``: the first rows of each window among the
        blocks that may hold some."""
        asked = self.choose(anchors, parts, same_label, most_promising)
        masks = asked.groupBy(*[F.col(c).alias(c) for c in ("part", "chunk")]).agg(F.bit_or("mask").alias("mask"))
        needed = self.blocks.select("block", "chunk", "ids", "labels", "entries").join(masks, "chunk")
        needed = needed.where(F.expr(f"(shiftright(mask, cast(block % {CHUNK} as int)) & 1) = 1")).drop("mask")
        hits = needed.groupBy("part", "chunk").cogroup(asked.groupBy("part", "chunk"))
        hits = hits.applyInArrow(_scan(self.width, same_label, wanted), "anchor bigint, slot int, vec_id bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id"))
        return stored(hits.withColumn("rank", rank.cast("int")).where(F.col("rank") <= wanted))


def _with_windows(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Anchors with these windows ``(anchor, slot, low, high)``, at most one a positive;
    without a window they ask for nothing."""
    lists = windows.groupBy("anchor").agg(F.collect_list(F.struct("slot", "low", "high")).alias("windows"))
    return anchors.drop("windows").join(lists, "anchor")


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80, block: int = BLOCK
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from
    ``rows (vec_id, label, vector)`` with whole numbers.

    Anchors are rows whose id ``every`` divides. A row's score is its inner product with the
    anchor; higher scores come first, ties by smaller id. Positives are the anchor's first
    rows of its label; for each, the first rows of other labels follow whose score is at
    most the positive's and at least ``percent`` of it. A positive score below zero has none.

    Rows with a null id, label or vector take no part. A shorter vector counts as filled up
    with zeros. Where an id repeats, each of its rows is a row and may be an anchor, and none
    of them meets its own id. Fewer rows than asked for give fewer; an empty table gives an
    empty one. Other columns are not read. Scores, and 100 times a score, must fit 64 bits.
    Blocks have at most ``block`` rows.
    """
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "vector").dropna()
    component = F.aggregate("vector", F.lit(0).cast("long"), lambda most, x: F.greatest(most, F.abs(x)))
    count, width, largest = rows.agg(F.count("*"), longest("vector"), F.coalesce(F.max(component), F.lit(0))).first()
    if not count:
        return literal_rows(rows.sparkSession, RESULT, [])
    blocks = Blocks(rows, width, largest, block)
    anchors = blocks.anchors(every, positives)
    parts = max(1, -(-anchors.count() // ANCHORS))

    found = blocks.search(anchors, parts, True, positives)
    pairs = found.select("anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    low = F.expr(f"({percent} * positive_score + 99) div 100")
    windows = pairs.where("positive_score >= 0").select("anchor", "slot", low.alias("low"), F.col("positive_score").alias("high"))

    early = blocks.search(_with_windows(anchors, windows), parts, False, negatives, most_promising=True)
    last = early.where(F.col("rank") == negatives).select("anchor", "slot", "score")
    raised = windows.join(last, ["anchor", "slot"], "left").withColumn("low", F.greatest("low", "score")).drop("score")
    final = blocks.search(_with_windows(anchors, raised), parts, False, negatives)
    return (
        final.join(pairs, ["anchor", "slot"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def embedding_negatives(embeddings: DataFrame) -> DataFrame:
    """The same for ``embeddings (vec_id, embedding, label)`` on ``floor(256 * x)`` of each
    component; where 7 divides the id, the label counts as ``(label + 1) % 10``. Rows with a
    null or non-finite component take no part."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", label.alias("label"), floored("embedding", 256).alias("vector")))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
