"""Queries that weigh or arrange a whole corpus."""

from __future__ import annotations

from dqgate.llm import mixing, packing, perplexity
from dqgate.llm.common import table
from dqgate.llm.registry import query


@query("op8_source_mix")
def op8_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_bestfit_packing")
def op9_bestfit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op2_perplexity_classifier")
def op2_perplexity_classifier(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return perplexity.judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), labels)
