"""The registered queries of this subpackage and their DuckDB SQL.

SQL is given where it is quick on whole tables; the other queries are tested
against brute force (``tests/llm``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm.alignment import op13_cross_tokenizer
from fleetspark.llm.embed_dedup import op3_embedding_near_dedup
from fleetspark.llm.manifest import op11_merkle_manifest
from fleetspark.llm.manifest_sql import OP11_SQL, OP12_SQL
from fleetspark.llm.minhash import op10_minhash_near_dedup
from fleetspark.llm.mixing import OP1_SQL, op1_mix_sources
from fleetspark.llm.neighbours import op4_nearest_neighbours
from fleetspark.llm.packing import op2_token_packing
from fleetspark.llm.pieces import op8_sentencepiece
from fleetspark.llm.pii import op6_personal_data
from fleetspark.llm.quality import op9_quality
from fleetspark.llm.sharding import op12_rendezvous_shards
from fleetspark.llm.suffix_dedup import op7_suffix_dedup
from fleetspark.llm.token_count import op5_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_token_packing, op3_embedding_near_dedup, op4_nearest_neighbours, op5_token_counts,
        op6_personal_data, op7_suffix_dedup, op8_sentencepiece, op9_quality, op10_minhash_near_dedup,
        op11_merkle_manifest, op12_rendezvous_shards, op13_cross_tokenizer,
    )}

SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op11_merkle_manifest": OP11_SQL, "op12_rendezvous_shards": OP12_SQL}
