from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from rows import ODD, SCHEMA, docs
from tokenizers import Tokenizer

from riskloom.llm import token_files
from riskloom.session import work_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
ODDER = [
    (20, "<|endoftext|> and<|startoftext|>x it's we'll 'S a b \x1cc\x85 é ́ İI ΣΑΣ ﬁ 12345"),
    (21, "don't stop　here\x0b\x0c now!!!??? ﻿​ ok"),
]


def written(spark, table):
    out = work_dir(spark, "test-tokens")
    index = token_files.write_token_files(table, out, PATH, 2)
    return out, index, token_files.read_token_files(spark, out, token_files.document_figures())


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in table.collect())
    out, index, read = written(spark, table.repartition(7))
    assert sorted(tuple(r) for r in read.collect()) == expected(rows)
    assert index == token_files.read_index(out) and index["bits"] == 16
    tokenizer = Tokenizer.from_file(PATH)
    for number in (0, 57, len(rows) - 1):
        ids = tokenizer.encode(rows[number][1], add_special_tokens=False).ids + [2]
        assert token_files.document_ids(out, number).tolist() == ids


def test_odd_rows(spark):
    table = docs(spark, ODD + ODDER, ", _h int, part string", (1, "p"))
    found = [tuple(r) for r in written(spark, table)[2].collect()]
    # Rows that share an id stand side by side; here they have the same text.
    rows = sorted(ODD + ODDER, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(found, key=lambda r: r[1]) == expected(rows)


def test_empty_table(spark):
    assert written(spark, spark.createDataFrame([], SCHEMA))[2].collect() == []


def test_words_add_up_to_texts():
    """Random words of letters, marks, digits and special strings, against whole texts."""
    rng = random.Random(3)
    parts = ["a", "Z", "é", "É", "ß", "ÿ", "'s", "'", "don", "the", ".", ",", "!?", "<|", "<|endoftext|>", "7", "42", "ﬁ", "漢", "\u0301", "İ", "_", "-", "…"]
    tokenizer = Tokenizer.from_file(PATH)
    encoder = token_files.WordEncoder(PATH)
    for _ in range(400):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 30))]
        own = " ".join(words).encode().split()
        encoder.learn([own])
        ids = np.frombuffer(encoder.encode(own), dtype=encoder.kind).tolist()
        assert ids == tokenizer.encode(" ".join(words), add_special_tokens=False).ids
