"""From raw documents to training shards, one operator a stage.

Each stage takes what its predecessor kept, as a written table. All but the
last return the columns of ``documents``; the last adds ``size``, ``shard`` and
``slot``. Empty tables pass through; rows with null text fail the quality rules;
rows without id are duplicates like any others; null sources are mixed as the
last source.
"""

from imageset_spark.functions import stage
from imageset_spark.llm import decontaminate, jaccard, mixing, quality, sharding


def quality_rules(spark, docs, sf_dir):
    """Documents within the word rules and the compression bands."""
    return quality.keep_documents(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return jaccard.drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark, docs, sf_dir):
    """Documents as often as the mixture takes them."""
    return mixing.mix_documents(docs)


def shards(spark, docs, sf_dir):
    """All rows with shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: SQL has neither zstandard nor the seeded orders; a row-at-a-time model tests the pipeline.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
