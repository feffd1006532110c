"""Awkward documents for every operator: nulls, empty and long texts, ties, repeats, clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, id string, fp long, shard string"


def odd_documents(spark):
    long = " ".join(f"word{i % 977} Été" for i in range(60_000))
    rows = [
        (1, None, None, None), (2, "", "en", "src1"), (3, "   \n\t", "en", "src1"), (None, "a text without an id", "en", "src2"),
        (4, long, "en", "src0"), (5, long, "en", "src0"), (6, "same words here again and again", "fr", "src3"),
        (6, "same words here again and again", "fr", "src3"), (7, "SAME words here again and again", None, "src3"),
        (8, "1234 !!! 5678", "en", None), (9, "ÉTÉ İstanbul ΣΑΣ 中文   \x1f end", "de", "src19"), (10, "one", "es", "src4"),
    ]
    return spark.createDataFrame([(*r, 0, 7, "x", 9, "s") for r in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
