"""From raw documents to packed training sequences, a stage at a time.

Each stage takes what its predecessor kept, as a table that was written and read again, so a lost
executor costs single tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterlake.llm import language_id, mixing, near_duplicates, packing, personal_data
from rosterlake.session import staged

STAGES = [
    ("language_id", language_id.stage),
    ("near_duplicates", near_duplicates.stage),
    ("personal_data", personal_data.stage),
    ("source_mixing", mixing.stage),
    ("best_fit_packing", packing.stage),
]

#: SQL can express neither the model nor the signatures; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(spark, docs, name)
    return docs
