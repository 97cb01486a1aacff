"""Small tables for the text operators, with the cases every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema_more: str = "", more=()):
    """Rows of (doc_id, text) or (doc_id, text, source) as a documents table."""
    rows = []
    for row in texts:
        doc_id, text, source = (*row, "src0")[:3] if len(row) == 2 else row
        rows.append((doc_id, text, "en", source, len(text or ""), *more))
    return spark.createDataFrame(rows, SCHEMA + schema_more)


ODD = [
    (None, "a text without an id " * 20),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "x" * 50_000),
    (6, "Ünïcode wörds Straße 漢字 🙂 " * 3000),
    (7, "same words here again"),
    (7, "same words here again"),
    (8, "same words here again"),
]
