"""Rows that every operator must survive."""

LONG = " ".join(f"word{i % 977} item{i % 31}" for i in range(30_000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions in the old tower."

MESSY = [
    (1, PROSE), (1, PROSE), (2, PROSE + " Again."), (3, None), (4, ""), (5, "   \n\t "), (6, LONG), (7, LONG + " end"),
    (None, PROSE), (None, None), (8, "x"), (9, "ÀÉÎ straße 世界 ́ İstanbul ΣΑΣ"), (10, "a\x00b\x1cc\x85d"),
    (2, "another text of the same id"), (11, "!!!" * 50), (12, "naïve café — “quotes” … |a|b|c|"),
]


def messy(spark, rows=MESSY):
    """Documents with repeated and null ids and columns named like the operators' own."""
    extra = ("raw", "range_no", "fp", "text_key", "kept_row", "hit_key", "words", "doc_key", "label", "score", "place")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    data = [
        (i, t, None if n % 3 else "en", None if n % 4 else "src0", None if n % 5 else len(t or ""), *("x" for _ in extra))
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(data, schema)


def table(spark, name, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
