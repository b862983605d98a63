"""Queries and SQL of the pipeline operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import chat_format, decontaminate
from tidelog.llm.chat_format import op7_chat_format
from tidelog.llm.decontaminate import op5_decontaminate
from tidelog.llm.html_extract import op9_html_extract
from tidelog.llm.line_dedup import op2_line_dedup
from tidelog.llm.lm_score import op6_lm_score
from tidelog.llm.near_dup import op4_minhash_near_dedup
from tidelog.llm.quality import op1_quality_llr
from tidelog.llm.sentence_pieces import op10_sentence_pieces
from tidelog.llm.suffix_dedup import op3_suffix_dedup
from tidelog.llm.tokens import op8_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_llr": op1_quality_llr,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_lm_score": op6_lm_score,
    "op7_chat_format": op7_chat_format,
    "op8_token_counts": op8_token_counts,
    "op9_html_extract": op9_html_extract,
    "op10_sentence_pieces": op10_sentence_pieces,
}

#: The others are held against brute force or libraries in tests.
ORACLES: dict[str, str] = {
    "op5_decontaminate": decontaminate.ORACLE,
    "op7_chat_format": chat_format.ORACLE,
}
