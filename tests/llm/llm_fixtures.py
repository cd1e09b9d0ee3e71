"""Small fixtures with the awkward rows every operator must handle."""

TEXTS = [(1, "Plain words, and more words."), (2, None), (3, ""), (4, "   \n\t "), (5, "x" * 20_000),
         (6, "Ünïcode — “quotes” 日本語 и кириллица 🙂🙂"), (6, "Ünïcode — “quotes” 日本語 и кириллица 🙂🙂"),
         (None, "no id here"), (7, "á combining  two  spaces nbsp"), (8, "it's we're 12345 +++ <|endoftext|>"),
         (9, " ".join(f"word{i % 97}" for i in range(30_000)))]


def docs(spark, rows=None):
    """documents with a clashing extra column."""
    return spark.createDataFrame([(*r, "extra", 1) for r in (TEXTS if rows is None else rows)],
                                 "doc_id bigint, text string, ids string, n_tokens int")
