"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.alignment import op12_alignment
from tidemart.llm.decontaminate import op9_decontamination
from tidemart.llm.embedding_dedup import OP11_SQL, op11_embedding_dedup
from tidemart.llm.fill_middle import OP13_SQL, op13_fill_in_middle
from tidemart.llm.jaccard_join import OP4_SQL, op4_jaccard_join
from tidemart.llm.licenses import OP10_SQL, op10_license_scan
from tidemart.llm.line_dedup import OP2_SQL, op2_line_dedup
from tidemart.llm.mixing import OP6_SQL, op6_mixing
from tidemart.llm.suffix_dedup import op7_suffix_dedup
from tidemart.llm.token_counts import op8_token_counts
from tidemart.llm.token_output import op3_token_output
from tidemart.llm.topk import OP5_SQL, op5_exact_topk
from tidemart.llm.toxicity import op1_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_line_dedup": op2_line_dedup,
        "op3_token_output": op3_token_output,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_exact_topk": op5_exact_topk,
        "op6_mixing": op6_mixing,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_token_counts": op8_token_counts,
        "op9_decontamination": op9_decontamination,
        "op10_license_scan": op10_license_scan,
        "op11_embedding_dedup": op11_embedding_dedup,
        "op12_alignment": op12_alignment,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op4_jaccard_join": OP4_SQL, "op5_exact_topk": OP5_SQL,
            "op6_mixing": OP6_SQL, "op10_license_scan": OP10_SQL, "op11_embedding_dedup": OP11_SQL,
            "op13_fill_in_middle": OP13_SQL}
