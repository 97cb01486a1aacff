"""op5: piece ids of all documents and the texts that they decode to."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.lattice import encode, load_model

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = load_model(MODEL)
    return encode(docs, model, decoded=True).select("doc_id", "ids", "n_tokens", "decoded")


QUERIES = {"op5_sentencepiece": op5_sentencepiece}
ORACLE: dict[str, str] = {}
