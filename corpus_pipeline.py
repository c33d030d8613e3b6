"""A corpus pipeline: language identification, near-duplicates, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.

Defined results: a row whose text is null or has no letter goes in the first
stage; rows that repeat id and text, exact and near copies leave one row, that
with the least id (of rows without an id, one); very long texts pass all stages
whole; extra columns pass through every stage, whatever their names, until the
last replaces those named as its results; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import remember, shared_dir
from geoloom.llm.decontaminate import decontamination_stage
from geoloom.llm.langid import language_stage
from geoloom.llm.pieces import pieces_stage
from geoloom.llm.pii import pii_stage
from geoloom.llm.simhash import near_duplicate_stage

STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", pii_stage),
    ("pieces", pieces_stage),
]

#: The stages train models, search a lattice and walk components, which SQL can't express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        remember(spark, path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
