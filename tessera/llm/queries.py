"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, quality_rules
from tessera.llm.decontaminate import op6_decontamination
from tessera.llm.html_text import op10_html_text
from tessera.llm.language_model import op7_language_model
from tessera.llm.license_scan import op8_license_scan
from tessera.llm.packing import op2_packing
from tessera.llm.quality_model import op3_quality_classifier
from tessera.llm.quality_rules import op5_quality_rules
from tessera.llm.simhash import op9_simhash
from tessera.llm.simple8b import op4_token_ids
from tessera.llm.token_counts import op1_token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_packing": op2_packing,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_token_ids": op4_token_ids,
        "op5_quality_rules": op5_quality_rules,
        "op6_decontamination": op6_decontamination,
        "op7_language_model": op7_language_model,
        "op8_license_scan": op8_license_scan,
        "op9_simhash": op9_simhash,
        "op10_html_text": op10_html_text,
    }


def oracle_sql() -> dict[str, str]:
    """Of the queries that SQL can express; the others are held against plain Python in tests/llm."""
    return {"op5_quality_rules": quality_rules.oracle_sql(), "op6_decontamination": decontaminate.oracle_sql()}
