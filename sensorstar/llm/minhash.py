"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

One permutation ``sigma`` (a hash onto the places of a ring) scatters shingles; a
second one, ``pi``, gives each place a rank. Coordinate ``k`` of a signature is the
smallest ``pi`` at the places shifted by ``k``: all coordinates come from these two
permutations. Coordinates are cut into bands; documents that agree on a whole band
are candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import SIMILAR_PERCENT, WordHashes, by_batch, mixed, shingle_hashes, stored, without_ids
from sensorstar.llm.components import components
from sensorstar.session import broadcast_up_to

# A pair at the threshold of 0.75 misses all 64 bands of 6 with probability 4e-6.
BANDS = 64
ROWS = 6
RING_BITS = 20
SEED = 20240229
# Shingles whose windows are taken at once.
WINDOW_ROWS = 2048
# Documents that meet in one task when a bucket is compared; larger buckets are cut.
BLOCK = 256
# Ids that may be broadcast to pick documents: 8 bytes each.
BROADCAST_IDS = 1_000_000


class CirculantMinHash:
    """Signatures and band keys of shingle sets."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        self.bands, self.rows = bands, rows
        pi = np.random.default_rng(seed).permutation(1 << RING_BITS).astype(np.uint32)
        ring = np.concatenate([pi, pi[: bands * rows]])
        self.windows = np.lib.stride_tricks.sliding_window_view(ring, bands * rows)
        self.factors = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        self.salt = mixed(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (shingles >> np.uint64(64 - RING_BITS)).astype(np.int64)
        least = self.windows[places[0]]
        for start in range(0, len(places), WINDOW_ROWS):
            least = np.minimum(least, self.windows[places[start : start + WINDOW_ROWS]].min(axis=0))
        return least

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        parts = self.signature(shingles).reshape(self.bands, self.rows).astype(np.uint64)
        return mixed((parts * self.factors).sum(axis=1) + self.salt).view(np.int64)


def sketches(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, digest, bands)`` per row; no shingles, no digest, no bands."""

    def make():
        hashes, minhash = WordHashes(), CirculantMinHash()

        def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, digests, bands = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_hashes(text, hashes)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                bands.append(minhash.band_keys(found) if len(found) else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"]
            )

        return sketch

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return by_batch(source, make, "doc_id long, n_shingles long, digest binary, bands array<bigint>")


def shingle_sets(documents: DataFrame) -> DataFrame:
    """``(doc_id, digest, shingles, bands)``: the full set of hashes of each document."""

    def make():
        hashes, minhash = WordHashes(), CirculantMinHash()

        def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingle_hashes(text, hashes) for text in batch.column("text").to_pylist()]
            kind = pa.list_(pa.int64())
            shingles = pa.array([x.view(np.int64) for x in found], kind)
            bands = pa.array([minhash.band_keys(x) if len(x) else None for x in found], kind)
            digests = pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in found], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), digests, shingles, bands], ["doc_id", "digest", "shingles", "bands"])

        return sets

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return by_batch(source, make, "doc_id long, digest binary, shingles array<bigint>, bands array<bigint>")


def _similar(shared, a, b):
    """Shared shingles are enough for the threshold, in whole numbers."""
    return shared * 100 >= (a + b - shared) * SIMILAR_PERCENT


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two sets share; both are nearly in order, so sorting merges them."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _stars(links: DataFrame) -> DataFrame:
    """The same components with about one link a node. A class may be linked with the
    leader of each band, so a group of near copies has up to ``BANDS`` links a class: each
    class keeps its smallest leader, which is linked with its others, each pair once."""
    # as many leaders at most as there are bands
    led = links.groupBy("b").agg(F.collect_set("a").alias("leaders"))
    ends = F.explode(F.concat("leaders", F.array("b")))
    return led.select(F.array_min("leaders").alias("a"), ends.alias("b")).where("a <> b").distinct()


def _bucket_links(members: DataFrame) -> DataFrame:
    """Links between components inside buckets, ``(a, b)``.

    ``members`` has ``key, rep, component, shingles, bands, size``. A bucket of more
    than ``BLOCK`` members is cut into blocks, and each pair of blocks is one group.
    A pair is compared in the first band it shares, unless its components have met.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    sent = placed.withColumn("other", F.explode(others)).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket, low, high = (x.as_py() for x in key)
        reps, components_, block = (table.column(n).to_pylist() for n in ("rep", "component", "block"))
        sets = [x.values.to_numpy() for x in table.column("shingles")]
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        block = np.array(block)
        here = int(np.flatnonzero(bands[0] == bucket)[0])
        parent = {c: c for c in components_}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        found = []
        for x in range(1, len(reps)):
            size = sizes[x]
            earlier = slice(0, x)
            possible = np.minimum(sizes[earlier], size) * 100 >= np.maximum(sizes[earlier], size) * SIMILAR_PERCENT
            if low != high:
                possible &= block[earlier] != block[x]
            near = np.flatnonzero(possible)
            if here and len(near):
                near = near[~(bands[near, :here] == bands[x, :here]).any(axis=1)]
            for y in near.tolist():
                mine, theirs = root(components_[x]), root(components_[y])
                if mine != theirs and _similar(_shared(sets[x], sets[y]), sizes[x], sizes[y]):
                    parent[mine] = theirs
                    found.append((reps[x], reps[y]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    columns = ["key", "low", "high", "block", "rep", "component", "shingles", "bands"]
    return sent.select(*columns).groupBy("key", "low", "high").applyInArrow(compare, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when ``100 * shared >= 75 * all`` of their distinct
    five-word shingles. Equal sets are one class from the start, with a number of its
    own, as an id may repeat with other texts. In each bucket of a band, every class is
    first compared with the bucket's smallest one; only
    where a bucket still holds several components, its members are compared with
    each other, in blocks. So a group of copies costs one pair per copy and band,
    and no link that shares a band is lost.

    Texts that are null, empty or without words have no shingles and stay alone.
    A row without an id takes no part and is kept, with no component. Rows that
    repeat an id share its component. Further columns are not read.
    """
    sketched = stored(sketches(documents))
    docs = sketched.where("doc_id is not null and n_shingles > 0")
    classes = docs.groupBy("digest").agg(F.min("doc_id").alias("first"))
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))

    firsts = classes.select("digest", F.col("first").alias("doc_id"), "rep")
    keyed = docs.join(firsts, ["digest", "doc_id"]).select(F.explode("bands").alias("key"), "rep")
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader <> last")
    met = stored(keyed.join(buckets, "key").select("key", "leader", "rep").distinct())
    pairs = met.where("leader <> rep").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()

    wanted = stored(firsts.join(met.select("rep").distinct(), "rep"))
    n_wanted = wanted.count()
    ids = broadcast_up_to(wanted.select("doc_id").distinct(), n_wanted, BROADCAST_IDS)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(ids, "doc_id", "left_semi")
    found = shingle_sets(texts.dropDuplicates(["doc_id", "text"]))
    found = found.join(broadcast_up_to(wanted, n_wanted, BROADCAST_IDS), ["doc_id", "digest"])
    sets = stored(found.select("rep", "shingles", "bands"))

    first = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    sizes = (F.size("of_a"), F.size("of_b"))
    compared = pairs.join(first, "a").join(second, "b").where(F.least(*sizes) * 100 >= F.greatest(*sizes) * SIMILAR_PERCENT)
    links = compared.where(_similar(F.size(F.array_intersect("of_a", "of_b")), *sizes)).select("a", "b")
    copies = docs.join(classes, "digest").where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    linked = components(_stars(links))

    labelled = met.join(linked, F.col("rep") == F.col("node"), "left")
    labelled = labelled.select("key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed_buckets = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        .where("low <> high")
        .select("key", "size")
    )
    members = labelled.join(mixed_buckets, "key").join(sets, "rep")
    # the components found so far stand for their links
    joined = linked.select(F.col("component").alias("a"), F.col("node").alias("b")).where("a <> b").union(_bucket_links(members))
    one = classes.select(F.col("rep").alias("a"), F.col("first").alias("of_a"))
    other = classes.select(F.col("rep").alias("b"), F.col("first").alias("of_b"))
    joined = joined.join(one, "a").join(other, "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    labels = components(stored(joined.union(copies)))

    component = F.coalesce("component", "doc_id")
    return sketched.join(labels, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns. Of
    rows that repeat an id one stays; rows without an id all stay."""
    found = stored(near_duplicates(documents))
    rest = without_ids(documents, found.where(~F.col("kept")), BROADCAST_IDS)
    repeated = stored(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    n_repeated = repeated.count()
    if not n_repeated:
        return rest
    again = rest.join(broadcast_up_to(repeated, n_repeated, BROADCAST_IDS), "doc_id", "left_semi").select(documents.columns)
    return without_ids(rest, repeated, BROADCAST_IDS).union(again.dropDuplicates(["doc_id"]))
