"""The queries of this subpackage and their SQL, as __spark_entry__.py takes them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import op10_decontaminate
from .language import op9_language_id, page_language_id
from .language_model import OP5_SQL, op5_lm_scoring
from .licenses import OP1_SQL, op1_license_scans
from .media import op8_media_columns
from .packing import op7_best_fit_packing
from .resample import op6_importance_resampling
from .secrets import op4_secret_scans
from .token_counts import op2_token_counts
from .trie_join import op3_jaccard_join


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scans": op1_license_scans,
        "op2_token_counts": op2_token_counts,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_secret_scans": op4_secret_scans,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_importance_resampling": op6_importance_resampling,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_media_columns": op8_media_columns,
        "op9_language_id": op9_language_id,
        "op10_decontaminate": op10_decontaminate,
        "page_language_id": page_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scans": OP1_SQL, "op5_lm_scoring": OP5_SQL}
