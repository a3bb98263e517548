"""A training-data pipeline over ``documents``: five stages, each one of the
operators in ``panelwright.llm`` over all rows that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``:

1. toxicity        documents scored toxic go (trained on ``labels``)
2. exact_dedup     of equal normalised texts the smallest doc_id stays
3. simhash         one document of each near-duplicate component stays
                   (4-word shingles, at most 4 bits)
4. secrets         secrets are masked; every document stays
5. packing         the texts as token pieces packed into 2048-token sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import exact, packing, secrets, simhash, toxicity
from panelwright.llm.common import written
from panelwright.sources.tables import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicate(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, words=4, radius=4)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, end_id=0, size=2048), size=2048)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("simhash", simhash_stage),
          ("secrets", secrets_stage), ("packing", packing_stage)]

# training, fingerprints, patterns and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
