"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmine.llm.decontaminate import OP3_SQL, op3_benchmark_decontamination
from quillmine.llm.hmm import op6_hmm_language_model
from quillmine.llm.langid import op1_language_rank_order
from quillmine.llm.quality import op8_quality_nbsvm
from quillmine.llm.secrets import op7_secret_scan
from quillmine.llm.sentencepiece import op2_sentencepiece
from quillmine.llm.sharding import op9_sampled_splitters
from quillmine.llm.simhash import op5_simhash_near_dedup
from quillmine.llm.vptree import op4_vantage_point_ann
from quillmine.llm.warc import OP10_SQL, op10_warc_zstd

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_rank_order, op2_sentencepiece, op3_benchmark_decontamination, op4_vantage_point_ann, op5_simhash_near_dedup, op6_hmm_language_model, op7_secret_scan, op8_quality_nbsvm, op9_sampled_splitters, op10_warc_zstd)
}

ORACLE_SQL: dict[str, str] = {"op3_benchmark_decontamination": OP3_SQL, "op10_warc_zstd": OP10_SQL}
