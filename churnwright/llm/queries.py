"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from churnwright.llm import bpe, chat, decontaminate, divergence, language, pii, quality, sharding, simhash, substrings, toxicity, trie, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_simhash": simhash.query,
    "op2_decontaminate": decontaminate.query,
    "op3_sharding": sharding.query,
    "op4_quality": quality.query,
    "op5_substrings": substrings.query,
    "op6_toxicity": toxicity.query,
    "op7_language": language.query,
    "op8_pii": pii.query,
    "op9_vectors": vectors.query,
    "op10_bpe": bpe.query,
    "op11_divergence": divergence.query,
    "op12_trie": trie.query,
    "op13_chat": chat.query,
}

ORACLE: dict[str, str] = {
    "op2_decontaminate": decontaminate.SQL,
    "op5_substrings": substrings.SQL,
    "op9_vectors": vectors.SQL,
    "op11_divergence": divergence.SQL,
    "op12_trie": trie.SQL,
    "op13_chat": chat.SQL,
}
