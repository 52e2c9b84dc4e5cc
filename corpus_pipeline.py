"""A corpus pipeline: rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last keep the columns of documents:

1. quality rules: documents that fail go, failing lines of the others go;
2. near duplicates: of each group of texts that hang together by a Jaccard similarity of 0.8
   or more over 5-word shingles, the document with the smallest id stays; pairs come from the
   BK-trees over SimHash fingerprints, all within their radius are checked exactly unless they
   hang together already, and the segments of the join add those whose fingerprints are far apart;
3. secrets: found secrets are masked in the text;
4. mixing: each pass over a source gives a row per document that it takes words of, so a
   document can stand twice, and one taken in part has the words taken;
5. packing: one row per piece of a document with its bin.

Null texts and texts without words fail stage 1; an empty table stays empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqgate.llm import jaccard_join, mixing, packing, quality_rules, secret_scan, simhash
from dqgate.llm.common import table, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, first=simhash.near_pairs, radius=simhash.RADIUS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix),
    ("packing", pack),
]

# Trees, forests and draws can't be stated in SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
