"""The operators' queries over the driver's tables: name -> (query, DuckDB text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import best_fit_packing, chat_format, embedding_dedup, fertility, language_id, ngram_join, quality, spelling, substring_dedup, vector_codes, vector_graph, viterbi, warc

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_substring_dedup": (substring_dedup.op1_substring_dedup, None),
    "op2_warc": (warc.op2_warc, None),
    "op3_ngram_jaccard_join": (ngram_join.op3_ngram_jaccard_join, None),
    "op4_language_id": (language_id.op4_language_id, None),
    "op5_quality_classifier": (quality.op5_quality_classifier, None),
    "op6_embedding_near_dedup": (embedding_dedup.op6_embedding_near_dedup, None),
    "op7_tokeniser_fertility": (fertility.op7_tokeniser_fertility, None),
    "op8_chat_format": (chat_format.op8_chat_format, None),
    "op9_sentencepiece": (viterbi.op9_sentencepiece, None),
    "op10_best_fit_packing": (best_fit_packing.op10_best_fit_packing, None),
    "op11_vector_codes": (vector_codes.op11_vector_codes, vector_codes.OP11_SQL),
    "op12_spelling_variants": (spelling.op12_spelling_variants, spelling.OP12_SQL),
    "op13_graph_search": (vector_graph.op13_graph_search, None),
}
