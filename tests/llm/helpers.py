"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing column names."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, nid int, grp int, uid int, tkey int, item_id int, coverage int, shard int, h int, own int, f int"
TAIL = ("s", 1, "clash", 1, 1, 1, 1, 1, 1, 1, 1, 1, 1)
LONG = "lorem ipsum dolor sit amet " * 8000


def edge_rows():
    texts = [
        (1, None, "en"), (2, "", "en"), (3, "   \n\t", None), (4, "one", "en"), (5, "one two three four five six seven", "en"),
        (6, "one two three four five six seven", "de"), (6, "one two three four five six seven", "de"), (None, "no id here at all, just words", None),
        (None, None, None), (7, LONG, "en"), (8, LONG + "tail", "en"), (9, "12345 !!! ???", "en"), (10, "der die das und nicht", "de"), (11, "ß é ñ 漢字 \u0085 x", "xx"),
    ]
    return [(i, t, lang, *TAIL) for i, t, lang in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
