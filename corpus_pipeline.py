"""The corpus job: documents to token ids, in five stages.

Every stage takes what its predecessor wrote and keeps all that it finds clean:

    quality rules    frequent lines go from the texts, rejected documents go
    near duplicates  one document of each group stays, that with the smallest id;
                     one without an id only if no other of the group has one;
                     groups are of a similarity of 0.8 or more in shingles of five words
    decontamination  documents with words of a benchmark window go
    PII              entities are replaced by keyed surrogates
    encoding         piece ids of the whole texts are added

Stages write to the shared folder, so a lost executor costs the running stage's
tasks only.  A text that a stage changes gets its new length in ``n_chars``.
Rows that repeat a doc_id or have none are judged by their own texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import q_lattice, q_surrogates
from riskloom.llm.common import table
from riskloom.llm.decontaminate import hits
from riskloom.llm.lattice import encode, load_model
from riskloom.llm.line_quality import remove_frequent_lines
from riskloom.llm.near_duplicates import first_of_each_group
from riskloom.llm.surrogates import replace_entities
from riskloom.session import work_dir


# What the operators read; other columns pass by them under names of no meaning.
USED = ("doc_id", "text", "source")


def _judged(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], kept: str, text: str = "text") -> DataFrame:
    """The columns of documents for the rows that an operator keeps, with the text
    that it leaves and that text's length."""
    others = {c: f"__{k}" for k, c in enumerate(docs.columns) if c not in USED}
    used = [c for c in docs.columns if c in USED]
    result = operator(docs.select(*used, *[F.col(f"`{c}`").alias(n) for c, n in others.items()]))
    own = {"text": F.col(text)}
    if text != "text" and "n_chars" in others:
        size = F.length(text).cast(docs.schema["n_chars"].dataType)
        own["n_chars"] = F.coalesce(size, F.col(others["n_chars"]))
    return result.where(kept).select(
        *[own.get(c, F.col(others.get(c, c))).alias(c) for c in docs.columns]
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _judged(docs, remove_frequent_lines, "kept", "clean_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return _judged(docs, lambda d: hits(d, items), "NOT contaminated")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def replaced(rows: DataFrame) -> DataFrame:
        return replace_entities(rows, q_surrogates.KEY).withColumn("new_text", F.col("text"))

    return _judged(docs, replaced, "true", "new_text")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, load_model(q_lattice.MODEL))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

# Fingerprints, keyed surrogates and best paths have no statement in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
