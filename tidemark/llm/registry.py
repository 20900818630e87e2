"""The queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import licenses, secrets, span_dedup, tool_calls
from tidemark.llm.decontaminate import op2_cgk_decontamination
from tidemark.llm.packing import op1_mixture_packing
from tidemark.llm.quality import op9_compression_quality
from tidemark.llm.simhash import op5_simhash_near_dedup
from tidemark.llm.token_counts import op10_token_counts
from tidemark.llm.vector_dedup import op8_nn_descent

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixture_packing": op1_mixture_packing,
    "op2_cgk_decontamination": op2_cgk_decontamination,
    "op3_tool_call_linking": tool_calls.op3_tool_call_linking,
    "op4_sentence_span_dedup": span_dedup.op4_sentence_span_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_license_scans": licenses.op6_license_scans,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_nn_descent": op8_nn_descent,
    "op9_compression_quality": op9_compression_quality,
    "op10_token_counts": op10_token_counts,
}

ORACLES: dict[str, str] = {
    "op3_tool_call_linking": tool_calls.ORACLE,
    "op6_license_scans": licenses.ORACLE,
    "op4_sentence_span_dedup": span_dedup.ORACLE,
    "op7_secret_scans": secrets.ORACLE,
}
