"""Codes of vectors: each part as the number of its nearest codebook entry, with codebooks
improved in rounds over metric trees.

The rows of a task are cut into shards of bounded size. In a shard each part position has
one tree of balls, built from the middle: anchors take over the points that are nearer to
them, points are met from the far end and the search stops where the triangle inequality
rules out the rest; balls of the anchors are joined two by two up to the root, and a large
anchor is built in the same way below. Every ball keeps the sum and the count of its points.

In a round each tree is walked from the root with the list of entries that may own points
of a ball. A child inherits the list; an entry that is farther from all of the ball than
some other entry leaves it. A ball with one entry left is wholly owned: its sum and count
are taken, its points are not read. Bottom balls compare their points with what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import small_batches, stored
from sensorstar.llm.vectors import as_matrix, floored, list_of, longest, products
from sensorstar.session import broadcast_up_to

PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Rows of a shard at most, and numbers; points of a bottom ball.
SHARD = 2048
SHARD_NUMBERS = 1 << 20
LEAF = 32
# Share of a distance that rounding may change, and more.
SLACK = 1e-9

TREE = (
    "places array<int>, points array<bigint>, first array<int>, last array<int>, left array<int>, right array<int>, "
    "radius array<double>, sums array<bigint>"
)
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_TREE = pa.struct(
    [("places", _INTS), ("points", _LONGS), ("first", _INTS), ("last", _INTS), ("left", _INTS), ("right", _INTS)]
    + [("radius", pa.list_(pa.float64())), ("sums", _LONGS)]
)


class Ball:
    """Points ``rows`` of a shard with their sum, around their mean."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, children: tuple[Ball, ...] = ()) -> None:
        self.rows, self.children = rows, children
        self.sums = sum(c.sums for c in children) if children else points[rows].sum(axis=0)
        self.centre = self.sums / len(rows)
        self.radius = float(_distances(points[rows], self.centre).max())


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2.0).sum(axis=1))


def anchors(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` dealt to about as many anchors as the root of their number, each to the
    nearest. Fewer where points are equal: one where all are."""
    pivots, owned = points[rows[:1]], [rows]
    far = [_distances(points[rows], points[rows[0]])]
    order = np.argsort(-far[0], kind="stable")
    owned[0], far[0] = rows[order], far[0][order]
    while len(owned) < np.sqrt(len(rows)):
        radii = np.array([f[0] for f in far])
        widest = int(radii.argmax())
        if radii[widest] == 0:
            break
        pivot = points[owned[widest][0]]
        half = _distances(pivots, pivot) / 2
        taken, taken_far = [], []
        for n in np.flatnonzero(radii >= half):
            # Points nearer to their anchor than half the way to the new one stay.
            reach = len(far[n]) - int(np.searchsorted(far[n][::-1], half[n], side="left"))
            distance = _distances(points[owned[n][:reach]], pivot)
            nearer = distance < far[n][:reach]
            taken.append(owned[n][:reach][nearer])
            taken_far.append(distance[nearer])
            stay = np.concatenate((~nearer, np.ones(len(far[n]) - reach, bool)))
            owned[n], far[n] = owned[n][stay], far[n][stay]
        new, distance = np.concatenate(taken), np.concatenate(taken_far)
        order = np.argsort(-distance, kind="stable")
        pivots = np.concatenate((pivots, pivot[None, :]))
        owned.append(new[order])
        far.append(distance[order])
    return owned


def _joined(points: np.ndarray, balls: list[Ball]) -> Ball:
    """Two balls that fit in the smallest ball become one, until one is left."""
    balls = list(balls)
    centres = np.array([b.centre for b in balls])
    radii = np.array([b.radius for b in balls])

    def around(n: int) -> np.ndarray:
        """Radii of the balls around ball ``n`` and each other one."""
        both = (_distances(centres, centres[n]) + radii + radii[n]) / 2
        size = np.maximum(both, np.maximum(radii, radii[n]))
        size[[m for m, ball in enumerate(balls) if ball is None or m == n]] = np.inf
        return size

    sizes = np.array([around(n) for n in range(len(balls))])
    for _ in range(len(balls) - 1):
        one, other = divmod(int(sizes.argmin()), len(balls))
        pair = balls[one], balls[other]
        ball = Ball(points, np.concatenate([b.rows for b in pair]), pair)
        balls[one], balls[other] = ball, None
        centres[one], radii[one] = ball.centre, ball.radius
        sizes[other], sizes[:, other] = np.inf, np.inf
        sizes[one] = sizes[:, one] = around(one)
    return next(b for b in balls if b is not None)


def build_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """The tree of a shard's points as rows of numbers: ``places`` are the rows in the
    order of the tree, ``points`` stand in it, a ball holds those from ``first`` to before
    ``last``. ``left`` and ``right`` are -1 in a bottom ball."""

    def build(rows: np.ndarray) -> Ball:
        parts = anchors(points, rows) if len(rows) > LEAF else [rows]
        if len(parts) == 1:
            return Ball(points, rows)
        return _joined(points, [build(part) for part in parts])

    balls, places, at = [], [], 0
    todo = [(build(np.arange(len(points))), -1, 0)]
    left, right, first, last = [], [], [], []
    while todo:
        ball, parent, side = todo.pop()
        number = len(balls)
        if parent >= 0:
            (left, right)[side][parent] = number
        balls.append(ball)
        left.append(-1)
        right.append(-1)
        first.append(at)
        last.append(at + len(ball.rows))
        if ball.children:
            todo += [(ball.children[1], number, 1), (ball.children[0], number, 0)]
        else:
            places.append(ball.rows)
            at += len(ball.rows)
    places = np.concatenate(places)
    return {
        "places": places,
        "points": points[places],
        "first": np.array(first),
        "last": np.array(last),
        "left": np.array(left),
        "right": np.array(right),
        "radius": np.array([b.radius for b in balls]),
        "sums": np.array([b.sums for b in balls]),
    }


class Walk:
    """One tree against one codebook: who owns which points."""

    def __init__(self, tree: dict[str, np.ndarray], book: np.ndarray) -> None:
        self.tree, self.book = tree, book
        self.centres = tree["sums"] / (tree["last"] - tree["first"])[:, None]
        self.squares = (book * book).sum(axis=1)
        #: Pairs of points and entries compared, for measurements.
        self.compared = 0

    def _left_over(self, ball: int, entries: np.ndarray) -> np.ndarray:
        """Entries that may be nearest to some point of the ball. Equal ones stay."""
        distance = _distances(self.book[entries], self.centres[ball])
        nearest, radius = distance.min(), self.tree["radius"][ball]
        return entries[distance - radius <= nearest + radius + SLACK * (1 + nearest + radius)]

    def run(self) -> Iterator[tuple[int, int, np.ndarray | int, bool]]:
        """``(first, last, entries, ball)``: the entry of a wholly owned ball, which is
        given, or those of the points of a bottom ball, with -1."""
        tree, points = self.tree, self.tree["points"]
        todo = [(0, np.arange(len(self.book)))]
        while todo:
            ball, entries = todo.pop()
            entries = self._left_over(ball, entries)
            first, last = tree["first"][ball], tree["last"][ball]
            if len(entries) == 1:
                yield first, last, int(entries[0]), ball
            elif tree["left"][ball] >= 0:
                todo += [(tree["left"][ball], entries), (tree["right"][ball], entries)]
            else:
                mine = points[first:last]
                self.compared += len(mine) * len(entries)
                height = self.squares[entries][None, :] - 2 * products(mine, self.book[entries])
                yield first, last, entries[height.argmin(axis=1)], -1

    def totals(self, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add what each entry owns."""
        for first, last, entries, ball in self.run():
            if ball >= 0:
                sums[entries] += self.tree["sums"][ball]
                counts[entries] += last - first
            else:
                np.add.at(sums, entries, self.tree["points"][first:last])
                np.add.at(counts, entries, 1)

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Entry and exact squared distance of each row, in the order of the rows."""
        count = len(self.tree["places"])
        owner = np.empty(count, np.int64)
        for first, last, entries, _ in self.run():
            owner[first:last] = entries
        codes, errors = np.empty(count, np.int64), np.empty(count, np.int64)
        gap = self.tree["points"] - self.book[owner]
        codes[self.tree["places"]] = owner
        errors[self.tree["places"]] = (gap * gap).sum(axis=1)
        return codes, errors


def _trees(row: pa.StructScalar | dict, width: int) -> dict[str, np.ndarray]:
    """A stored tree as numbers again."""
    tree = {name: np.asarray(row[name].values) for name in ("places", "first", "last", "left", "right", "radius")}
    for name, rows in (("points", len(tree["places"])), ("sums", len(tree["first"]))):
        tree[name] = np.asarray(row[name].values).reshape(rows, width)
    return tree


def _build(width: int, shard: int):
    """Batches of rows to shards: ids, labels and a tree for each part."""

    def tree(points: np.ndarray) -> dict[str, np.ndarray]:
        return {name: values.ravel() for name, values in build_tree(points).items()}

    def made(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        vectors = as_matrix(table.column("vector"), PARTS * width)
        trees = [tree(vectors[:, part * width : (part + 1) * width]) for part in range(PARTS)]
        columns = [list_of(pa.concat_arrays(table.column(name).chunks)) for name in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*columns, pa.array([trees], pa.list_(_TREE))], ["ids", "labels", "parts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        rows = 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            rows += len(batch)
            if rows >= shard:
                table = pa.concat_tables(waiting)
                for start in range(0, rows - rows % shard, shard):
                    yield made(table.slice(start, shard))
                rows %= shard
                waiting = [table.slice(len(table) - rows)]
        if rows:
            yield made(pa.concat_tables(waiting))

    return run


def _totals(books: list[np.ndarray]):
    """What each entry of each part owns in the trees of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            for parts in batch.column("parts"):
                for part in range(PARTS):
                    Walk(_trees(parts[part], width), books[part]).totals(sums[part], counts[part])
        for part in range(PARTS):
            used = np.flatnonzero(counts[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), part), pa.int32()),
                    pa.array(used, pa.int32()),
                    pa.array(counts[part][used], pa.int64()),
                    list_of(pa.array(sums[part][used].ravel(), pa.int64()), len(used)),
                ],
                ["part", "entry", "points", "sums"],
            )

    return run


def _codes(books: list[np.ndarray]):
    """Codes and errors of the rows of each tree."""
    digits = [f"{n:02x}" for n in range(ENTRIES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        for batch in batches:
            for number, parts in enumerate(batch.column("parts")):
                found = [Walk(_trees(parts[part], width), books[part]).codes() for part in range(PARTS)]
                codes = ["".join([digits[c] for c in row]) for row in np.stack([f[0] for f in found], axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[number].values, batch.column("labels")[number].values]
                    + [pa.array(codes), pa.array(sum(f[1] for f in found), pa.int64())],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def _improved(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: each entry becomes the mean of its points, rounded down. What comes to
    the driver is as large as the codebooks."""
    width = books[0].shape[1]
    sent = trees.sparkSession.sparkContext.broadcast(books)
    totals = trees.select("parts").mapInArrow(
        lambda batches: _totals(sent.value)(batches), "part int, entry int, points bigint, sums array<bigint>"
    )
    sums = [F.sum(F.col("sums")[n]).alias(f"sum{n}") for n in range(width)]
    books = [book.copy() for book in books]
    for part, entry, points, *components in totals.groupBy("part", "entry").agg(F.sum("points"), *sums).collect():
        books[part][entry] = [component // points for component in components]
    return books


def vector_codes(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` for each row of ``vectors
    (vec_id, label, vector)`` with whole numbers.

    Vectors are cut into 4 equal parts. The codebook of a part position starts as that
    part of the 256 smallest ids, ascending (all, if fewer), and is improved in 4 rounds.
    ``code`` has two hex digits a part, ``error`` is the squared distance to the entries,
    ``label_error`` its sum over rows of equal label, nulls together.

    Rows with a null vector take no part. A null id comes after all others; of equal ids
    the smaller vector comes first, and each row has its own code. Shorter vectors, and
    lengths that 4 does not divide, are filled up with zeros. Ties go to the lower entry;
    entries that own nothing stay. Squared distances and sums must fit 64 bits. An empty
    table gives an empty one. Other columns are not read. A shard has at most ``shard``
    rows and never more than a million numbers; results do not depend on it.
    """
    spark = small_batches(vectors.sparkSession)
    vectors = vectors.select("vec_id", "label", "vector").where(F.col("vector").isNotNull())
    width = -(-vectors.agg(longest("vector")).first()[0] // PARTS)
    smallest = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").collect()
    start = np.zeros((len(smallest), PARTS * width), np.int64)
    for n, (vector,) in enumerate(smallest):
        start[n, : len(vector)] = vector
    books = [start[:, part * width : (part + 1) * width] for part in range(PARTS)]

    kinds = {name: vectors.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    shard = max(1, min(shard, SHARD_NUMBERS // max(1, PARTS * width)))
    trees = stored(
        vectors.mapInArrow(
            _build(width, shard), f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, parts array<struct<{_typed(TREE)}>>"
        )
    )
    for _ in range(ROUNDS if smallest else 0):
        books = _improved(trees, books)

    sent = spark.sparkContext.broadcast(books)
    coded = stored(
        trees.mapInArrow(
            lambda batches: _codes(sent.value)(batches), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
        )
    )
    labels = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    labels = broadcast_up_to(labels, labels.count(), 1_000_000)
    numbers = ",".join(str(n) for book in books for n in book.ravel().tolist())
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256")
    )


def _typed(fields: str) -> str:
    """``name type, …`` as the fields of a struct."""
    return ", ".join(":".join(field.split(" ")) for field in fields.split(", "))


def embedding_codes(embeddings: DataFrame) -> DataFrame:
    """The same for ``embeddings (vec_id, embedding, label)``, on ``floor(1024 * x)`` of
    each component; rows with a null or non-finite component take no part."""
    return vector_codes(embeddings.select("vec_id", "label", floored("embedding", 1024).alias("vector")))


def oracle(rounds: int = ROUNDS) -> str:
    """The same as SQL, round by round."""
    steps = [
        f"""v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x
  FROM v CROSS JOIN (SELECT unnest(range({PARTS})) AS part)
),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES}
)"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, part, any_value(p.x) AS x, min(CAST(list_inner_product(p.x, p.x)
    + list_inner_product(b.x, b.x) - 2 * list_inner_product(p.x, b.x) AS BIGINT) * {ENTRIES} + entry) AS k
  FROM p JOIN b{n} b USING (part) GROUP BY vec_id, part
)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT part, k % {ENTRIES} AS entry, place, sum(CAST(x[place] AS BIGINT)) AS s, count(*) AS c
  FROM a{n} CROSS JOIN (SELECT unnest(range(1, (SELECT max(len(x)) + 1 FROM p))) AS place) GROUP BY ALL
),
b{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(any_value(w.x), any_value(b.x)) AS x FROM b{n} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % c) + c) % c) // c AS DOUBLE) ORDER BY place) AS x FROM m{n} GROUP BY ALL
  ) w USING (part, entry) GROUP BY b.part, b.entry
)""")
    return f"""WITH {", ".join(steps)},
c AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', k % {ENTRIES}), '' ORDER BY part) AS code,
    CAST(sum(k // {ENTRIES}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY part, entry))
   FROM b{rounds}) AS codebooks_sha256
FROM c"""
