"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet in the shared folder and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from purchaseflow.llm import langid, line_dedup, ngram_join, packing, pii
from purchaseflow.sources.scratch import remove, scope, staged

STAGES = [
    ("language", langid.stage),
    ("line_dedup", line_dedup.stage),
    ("near_duplicates", ngram_join.stage),
    ("pii", pii.stage),
    ("packing", packing.stage),
]

# Trained models and a tokenizer decide here, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that every stage keeps.

    What a stage writes on its way is removed when its result is written, and a result
    when the next one is; the last one stays, as it is what is returned.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with scope(spark, keep_last=True) as made:
            docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
        remove(spark, *before)
        before = list(made)
    return docs
