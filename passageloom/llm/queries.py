"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from passageloom.llm.contamination import OP2_SQL, op2_benchmark_decontamination
from passageloom.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from passageloom.llm.extraction import op4_html_extraction
from passageloom.llm.licenses import OP3_SQL, op3_license_scan
from passageloom.llm.packing import op9_best_fit_packing
from passageloom.llm.pii import op11_pii
from passageloom.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from passageloom.llm.quality import op7_quality_classifier
from passageloom.llm.repair import op12_conversation_repair
from passageloom.llm.sharding import op5_jump_sharding
from passageloom.llm.simhash import op6_simhash_near_dedup
from passageloom.llm.token_files import op10_token_counts
from passageloom.llm.toxicity import op1_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_html_extraction": op4_html_extraction,
    "op5_jump_sharding": op5_jump_sharding,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_counts": op10_token_counts,
    "op11_pii": op11_pii,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
SQL: dict[str, str] = {
    "op2_benchmark_decontamination": OP2_SQL,
    "op3_license_scan": OP3_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op13_prefix_trie": OP13_SQL,
}
