"""The text queries by name, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorstar.llm.anchor_codes import embedding_codes
from sensorstar.llm.anchor_codes import oracle as vector_code_sql
from sensorstar.llm.bpe import count_tokens, encode_decode, read_tokenizer
from sensorstar.llm.common import table
from sensorstar.llm.decontaminate import ORACLE as CONTAMINATED
from sensorstar.llm.decontaminate import contaminated
from sensorstar.llm.hilbert_negatives import ORACLE as NEGATIVES
from sensorstar.llm.hilbert_negatives import embedding_negatives
from sensorstar.llm.html_paths import extract_pages
from sensorstar.llm.license_scan import scan_licenses
from sensorstar.llm.minhash import near_duplicates
from sensorstar.llm.mtree import embedding_top_k
from sensorstar.llm.secret_scan import scan_secrets, span_digests
from sensorstar.llm.tool_calls import conversation_calls
from sensorstar.llm.toxicity import toxicity
from sensorstar.llm.transducer import byte_round_trip, read_ranks


def op1_dictionary_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the held-out fold."""
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_containment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op5_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    return count_tokens(table(spark, sf_dir, "documents"), read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))


def op6_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best inner products of every twentieth vector with all vectors."""
    return embedding_top_k(table(spark, sf_dir, "embeddings"))


def op8_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the tokens of all documents, and of what they decode to."""
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer, public_tokenizers.PATTERN, with_ids=False)


def op9_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of all conversations as linked, ordered and checked tool calls."""
    return conversation_calls(table(spark, sf_dir, "conversations"))


def op10_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, as counts and digests."""
    return span_digests(scan_secrets(table(spark, sf_dir, "documents")))


def op11_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    return embedding_negatives(table(spark, sf_dir, "embeddings"))


def op12_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as codes of four bytes, with their errors."""
    return embedding_codes(table(spark, sf_dir, "embeddings"))


def op13_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the tokens of all documents by a file of ranks, and of their bytes."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = (
        op1_dictionary_licenses,
        op2_counterfactual_toxicity,
        op3_containment_decontamination,
        op4_tag_path_ratios,
        op5_heap_token_counts,
        op6_circulant_minhash,
        op7_mtree_top_k,
        op8_backtracking_bpe,
        op9_tool_call_links,
        op10_secret_automaton,
        op11_hilbert_negatives,
        op12_anchor_codes,
        op13_transducer_bpe,
    )
    return {query.__name__: query for query in queries}


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id,
  CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS INT) AS rank,
  c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 QUALIFY rank <= 20
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_containment_decontamination": CONTAMINATED,
        "op7_mtree_top_k": TOP_K,
        "op11_hilbert_negatives": NEGATIVES,
        "op12_anchor_codes": vector_code_sql(),
    }
