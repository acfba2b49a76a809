"""The corpus pipeline: language, near duplicates, contamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again before the next one, so a lost executor repeats parts of one stage only. All
stages but the last return the columns of ``documents``:

1. ``language_id`` drops the documents whose language the classifier rejects;
2. ``near_dedup`` keeps one document (the smallest id) of each near-duplicate group;
3. ``decontaminate`` drops the documents that hold too much of the benchmark;
4. ``personal_data`` replaces personal data by surrogates and updates ``n_chars``;
5. ``mix_sources`` gives, for every remaining document, the words that the mix takes of it.

``ORACLE_SQL`` is None: the classifier's and the mix's draws have no SQL form; the stages are
tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import decontam, langid, mixing, neardup, surrogates
from freshet.llm.common import stored, table

STAGES = [
    ("language_id", langid.keep_stage),
    ("near_dedup", neardup.keep_stage),
    ("decontaminate", decontam.clean_stage),
    ("personal_data", surrogates.replace_stage),
    ("mix_sources", mixing.mix_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
