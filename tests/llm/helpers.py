"""Small tables with every odd case the operators define."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{k % 977} goes{k}" for k in range(30_000))


def odd_documents(spark, extra=False):
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta", "en", "s1", 1),
        (2, "ALPHA BETA gamma delta epsilon zeta eta theta", "en", "s1", 2),
        (3, None, "en", "s1", None),
        (4, "", None, None, 0),
        (5, LONG, "en", "s2", 5),
        (6, LONG + " tail", "en", None, 5),
        (7, "Ünï code É é  two  blanks\n\tand tabs", None, "s2", 7),
        (8, "short", "en", "s3", 1),
        (8, "short", "en", "s3", 1),
        (9, "   \n ", "en", "s3", 1),
        (10, "<|endoftext|> don't   stop", "en", "s3", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("id", "keep_id", "copies", "kept", "score", "predicted", "body", "size",
                     "winner", "times", "position", "copy", "node", "n", "word", "shard"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
