"""Queries over runs within documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqgate.llm import periodic_runs
from dqgate.llm.common import let, table, words
from dqgate.llm.registry import query


def planted(docs):
    """Every tenth document by the checksum of its id repeats a part of itself from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i).cast("int"))), " ")

    rebuilt = let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, repeated(w)))
    return docs.select("doc_id", F.when(h % 10 == 0, rebuilt).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")))
    order = lambda a, b: F.when(
        a["length"] * b["period"] != b["length"] * a["period"], F.signum(b["length"] * a["period"] - a["length"] * b["period"]).cast("int")
    ).otherwise(F.signum(F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])).cast("int"))
    best = F.get(F.array_sort("runs", order), F.lit(0))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    told = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
