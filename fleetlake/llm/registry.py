"""The subpackage's queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.block_knn import OP10_SQL, op10_block_knn
from fleetlake.llm.chat import OP5_SQL, op5_chat
from fleetlake.llm.collocations import OP13_SQL, op13_collocations
from fleetlake.llm.decontaminate import op3_decontaminate
from fleetlake.llm.exact_dedup import OP12_SQL, op12_exact_dedup
from fleetlake.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from fleetlake.llm.jaccard_join import op7_jaccard_join
from fleetlake.llm.packing import op9_packing
from fleetlake.llm.quality import op8_quality
from fleetlake.llm.substring_dedup import op2_substring_dedup
from fleetlake.llm.suffix_dedup import op4_suffix_dedup
from fleetlake.llm.token_shards import op1_token_shards
from fleetlake.llm.warc import op6_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_shards": op1_token_shards,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_decontaminate": op3_decontaminate,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_chat": op5_chat,
        "op6_warc": op6_warc,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_quality": op8_quality,
        "op9_packing": op9_packing,
        "op10_block_knn": op10_block_knn,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_chat": OP5_SQL, "op10_block_knn": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op12_exact_dedup": OP12_SQL,
            "op13_collocations": OP13_SQL}
