"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardloom.llm.conversations import OP13_SQL, op13_conversation_repair
from cardloom.llm.language import op10_language_id
from cardloom.llm.lines import op5_line_dedup
from cardloom.llm.mixing import op3_mix_sources
from cardloom.llm.nearest import OP2_SQL, op2_nearest
from cardloom.llm.pieces import op9_sentencepiece
from cardloom.llm.quality import OP4_SQL, op4_quality_lines
from cardloom.llm.simhash import op7_simhash
from cardloom.llm.spelling import OP11_SQL, op11_spelling_variants
from cardloom.llm.substring import OP1_SQL, op1_substring_dedup
from cardloom.llm.suffixes import OP12_SQL, op12_suffix_dedup
from cardloom.llm.toxicity import op6_toxicity
from cardloom.llm.warc import OP8_SQL, op8_arc_to_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_nearest": op2_nearest,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_lines": op4_quality_lines,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_arc_to_warc": op8_arc_to_warc,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_nearest": OP2_SQL,
    "op4_quality_lines": OP4_SQL,
    "op8_arc_to_warc": OP8_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_suffix_dedup": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
