"""The bound queries of this package, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from kgspark.llm.chat import op7_chat
from kgspark.llm.decontaminate import op5_decontaminate
from kgspark.llm.divergence import op13_divergence
from kgspark.llm.licences import op11_licences
from kgspark.llm.packing import op4_packing
from kgspark.llm.paragraphs import op6_paragraphs
from kgspark.llm.pii import op2_pii
from kgspark.llm.quality import op8_quality
from kgspark.llm.secrets import op3_secrets
from kgspark.llm.sharding import op10_sharding
from kgspark.llm.simhash import op1_simhash
from kgspark.llm.warc import op9_warc
from kgspark.llm.whitening import op12_whitening


def over(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": over(op1_simhash, "documents"),
    "op2_pii": over(op2_pii, "documents"),
    "op3_secrets": over(op3_secrets, "documents"),
    "op4_packing": over(op4_packing, "documents"),
    "op5_decontaminate": over(op5_decontaminate, "documents", "benchmark"),
    "op6_paragraphs": over(op6_paragraphs, "documents"),
    "op7_chat": over(op7_chat, "conversations"),
    "op8_quality": over(op8_quality, "documents"),
    "op9_warc": over(op9_warc, "pages"),
    "op10_sharding": over(op10_sharding, "documents"),
    "op11_licences": over(op11_licences, "documents"),
    "op12_whitening": over(op12_whitening, "embeddings"),
    "op13_divergence": over(op13_divergence, "documents"),
    "pipeline": corpus_pipeline.run,
}
