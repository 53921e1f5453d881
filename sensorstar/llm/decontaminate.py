"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Built-in functions only. A document's shingle hashes are cut into bins by their
leading bits; the smallest hash of each bin is its signature (MinHash with one
permutation). Documents are partitioned by size, in powers of four, and each
partition has its own number of bins, in proportion to its sizes: a short item inside
a long document then keeps nearly all of its hashes. Each item has a signature per
partition. Items that meet enough hashes of a document are confirmed on the shingles
themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import SHINGLE_WORDS, SIMILAR_PERCENT, stored, without_ids
from sensorstar.session import broadcast_up_to

# A partition holds sizes from 4^k below 4^(k+1) and has 2^(BIN_BITS + 2k) bins, so a
# hash of the item shares its bin with at most 1/64 of a hash of the document.
BIN_BITS = 8
PARTITIONS = 25
# Share of an item's hashes a candidate must meet: two thirds of what is asked for.
CANDIDATE_SHARE = 0.5
# Items with fewer shingles are looked up among all hashes: a signature may miss them.
FEW = 8
# Rows of signatures or ids that are sent to every task; more are shuffled.
BROADCAST_ROWS = 1_000_000


def with_shingles(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the distinct five-word shingles of a text in lower case, split at
    ASCII white space; a shorter text is one shingle, a text without words has none."""
    split = df.withColumn("_words", _words(text))
    words = F.col("_words")
    made = F.transform(_starts(words), lambda at: F.array_join(F.slice(words, at, SHINGLE_WORDS), " "))
    return split.withColumn(name, F.array_distinct(made)).drop("_words")


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _starts(words: Column) -> Column:
    """Where shingles start; nowhere without words."""
    last = F.greatest(F.size(words) - (SHINGLE_WORDS - 1), F.lit(1))
    return F.when(F.size(words) > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def with_hashes(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the sorted hashes of the shingles of ``text``. Words are hashed
    first: a shingle's hash then needs no text of its own. A word that is not there
    (shorter texts) counts as NULL."""
    hashed = df.withColumn("_words", F.transform(_words(text), lambda w: F.xxhash64(w)))

    def of(at: Column) -> Column:
        return F.xxhash64(*[F.get("_words", at + place) for place in range(SHINGLE_WORDS)])

    made = hashed.withColumn(name, F.transform(_starts(F.col("_words")), lambda at: of(at - 1)))
    return made.withColumn(name, F.sort_array(F.coalesce(name, F.array().cast("array<bigint>")))).drop("_words")


def partition_of(hashes: str) -> Column:
    return F.least(F.floor(F.log2(F.greatest(F.size(hashes), F.lit(1)).cast("double")) / 2), F.lit(PARTITIONS - 1)).cast("int")


def signature(hashes: str, partition: str) -> Column:
    """The smallest hash of each bin; equal hashes share a bin, so they stand once."""
    shift = F.lit(64 - BIN_BITS) - F.col(partition) * 2

    def new_bin(x: Column, at: Column) -> Column:
        return (at == 0) | (_right(F.get(hashes, at - 1), shift) != _right(x, shift))

    return F.filter(hashes, new_bin)


def _right(x: Column, shift: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, shift)


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared, containment)`` for each document that
    holds at least 75 % of the distinct shingles of an item.

    ``items`` has ``item_id, text``. Null ids, and texts that are null, empty or
    without words, have no pairs. Of rows that repeat an id, the one that shares most
    counts; of repeated items, each is looked for under its id. Texts are read whole.
    Other columns are not read.
    """
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
    items = with_hashes(items.dropDuplicates(), "text", "hashes").withColumn("hashes", F.array_distinct("hashes"))
    items = stored(items.withColumn("n_hashes", F.size("hashes")).where("n_hashes > 0"))
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    hashed = with_hashes(documents, "text", "hashes").withColumn("partition", partition_of("hashes"))

    many = items.where(F.col("n_hashes") >= FEW)
    numbers = F.sequence(F.lit(0), F.lit(PARTITIONS - 1))
    every = many.select("item_id", "hashes", "n_hashes", F.explode(numbers).alias("at"))
    index = stored(every.select("item_id", "n_hashes", "at", F.explode(signature("hashes", "at")).alias("hash")))
    index = broadcast_up_to(index, index.count(), BROADCAST_ROWS)
    sketched = hashed.select("doc_id", "partition", F.explode(signature("hashes", "partition")).alias("hash"))
    met = sketched.join(index, "hash").where(F.col("partition") == F.col("at"))
    met = met.groupBy("doc_id", "item_id", "n_hashes").agg(F.count("*").alias("n_met"))
    candidates = met.where(F.col("n_met") >= F.col("n_hashes") * CANDIDATE_SHARE).select("doc_id", "item_id")

    few = items.where(F.col("n_hashes") < FEW).select("item_id", F.explode("hashes").alias("hash"))
    n_few = few.count()
    if n_few:
        whole = hashed.select("doc_id", F.explode("hashes").alias("hash"))
        found = whole.join(broadcast_up_to(few, n_few, BROADCAST_ROWS), "hash").select("doc_id", "item_id")
        candidates = candidates.union(found.distinct())
    return _confirmed(documents, items.select("item_id", "text"), stored(candidates))


def _confirmed(documents: DataFrame, items: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates, on the distinct shingles of whole texts."""
    ids = candidates.select("doc_id").distinct()
    wanted = documents.join(broadcast_up_to(ids, ids.count(), BROADCAST_ROWS), "doc_id", "left_semi")
    sets = with_shingles(wanted, "text", "of_doc").drop("text")
    parts = with_shingles(items, "text", "of_item").drop("text")
    parts = broadcast_up_to(parts, parts.count(), BROADCAST_ROWS // 10)
    pairs = sets.join(candidates, "doc_id").join(parts, "item_id")
    counted = pairs.select(
        "doc_id", "item_id", F.size("of_item").cast("long").alias("n_item"), F.size(F.array_intersect("of_item", "of_doc")).cast("long").alias("n_shared")
    )
    enough = counted.where(F.col("n_shared") * 100 >= F.col("n_item") * SIMILAR_PERCENT)
    best = enough.groupBy("doc_id", "item_id").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def without_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item; rows without an id stay."""
    return without_ids(documents, contaminated(documents, items), BROADCAST_ROWS)


_SHINGLES = """
  SELECT DISTINCT {id} AS id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM (SELECT {id}, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table})
"""
ORACLE = f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
  b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
  n AS (SELECT id, count(*) AS n_item FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, n_item, count(*) AS n_shared, CAST(count(*) AS DOUBLE) / n_item AS containment
FROM d JOIN b USING (shingle) JOIN n ON n.id = b.id
GROUP BY d.id, b.id, n_item HAVING count(*) * 100 >= n_item * 75
"""
