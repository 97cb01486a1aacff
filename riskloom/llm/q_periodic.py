"""op11: periodic runs of all documents, every tenth of which repeats a passage to its end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, let, table
from riskloom.llm.periodic import periodic_runs


def _tail(words: Column, h: Column) -> Column:
    """The words, of which those from a on repeat the first p from there."""
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    passage = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    copies = F.flatten(F.array_repeat(passage, F.ceil((n - a) / p).cast("int")))
    return F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(copies, F.lit(1), (n - a).cast("int")))


def with_planted(docs: DataFrame) -> DataFrame:
    """The documents as the query judges them: the tenth whose crc32 of the id is a
    multiple of 10 repeats a passage of its own up to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    planted = let(words, lambda w: F.when(F.size(w) > 0, F.array_join(_tail(w, h), " ")).otherwise(F.col("text")))
    return docs.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


def _greater(one: Column, two: Column) -> Column:
    """Whether the first run has the greater exact exponent, or stands first of equals."""
    left, right = one["length"] * two["period"], two["length"] * one["period"]
    first = F.struct(one["start"], one["period"]) < F.struct(two["start"], two["period"])
    return (left > right) | ((left == right) & first)


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(with_planted(docs)).drop("text")
    runs = F.col("runs")
    best = F.aggregate(runs, F.get(runs, F.lit(0)), lambda b, r: F.when(_greater(r, b), r).otherwise(b))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_periodic": op11_periodic}
ORACLE: dict[str, str] = {}
