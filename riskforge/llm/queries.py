"""Registered queries of the package, and their SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskforge.llm import alignment, ann, collocations, decontamination, html_extraction, language_id, mixing, near_dedup, pii, quality, sharding, substring_dedup, token_output
from riskforge.llm.common import table
from riskforge.llm.sql import COLLOCATIONS, DECONTAMINATION, MIXING, PASSAGES, SHARDING

QueryFn = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, QueryFn]:
    return {
        "op1_ann": lambda s, d: ann.digest(table(s, d, "embeddings")),
        "op2_html_extraction": lambda s, d: html_extraction.digest(table(s, d, "pages")),
        "op3_quality": lambda s, d: quality.digest(table(s, d, "documents"), table(s, d, "labels")),
        "op4_decontamination": lambda s, d: decontamination.digest(table(s, d, "documents"), table(s, d, "benchmark")),
        "op5_mixing": lambda s, d: mixing.digest(table(s, d, "documents")),
        "op6_near_dedup": lambda s, d: near_dedup.digest(table(s, d, "documents")),
        "op7_language_id": lambda s, d: language_id.digest(table(s, d, "documents")),
        "op8_token_output": lambda s, d: token_output.digest(s, table(s, d, "documents")),
        "op9_pii": lambda s, d: pii.digest(table(s, d, "documents")),
        "op10_sharding": lambda s, d: sharding.digest(table(s, d, "documents")),
        "op11_collocations": lambda s, d: collocations.digest(table(s, d, "documents")),
        "op12_substring_dedup": lambda s, d: substring_dedup.digest(table(s, d, "documents")),
        "op13_alignment": lambda s, d: alignment.digest(table(s, d, "documents")),
    }


def oracle() -> dict[str, str]:
    return {"op4_decontamination": DECONTAMINATION, "op5_mixing": MIXING, "op10_sharding": SHARDING, "op11_collocations": COLLOCATIONS, "op12_substring_dedup": PASSAGES}
