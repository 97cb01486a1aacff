"""op8: all documents as token files, read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.token_files import document_figures, read_token_files, write_token_files
from riskloom.session import work_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), out, TOKENIZER, END_ID)
    return read_token_files(spark, out, document_figures())


QUERIES = {"op8_token_files": op8_token_files}
ORACLE: dict[str, str] = {}
