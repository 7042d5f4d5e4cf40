"""Small documents with every awkward case."""

LONG = "word " * 20_000 + "end"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, shard int, row_id string, n int, key string, host string"


def awkward(spark):
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away today", "en"), (2, "the QUICK brown fox jumps over the lazy dog and runs far away today", "en"), (2, "the QUICK brown fox jumps over the lazy dog and runs far away today", "en"),
        (3, None, "en"), (4, "", None), (None, "a row without an id but with a text of several words", "en"), (5, LONG, "en"), (6, "two words", "xx"), (7, "two  WORDS", None), (8, "   \n\t ", "en"), (9, "Ünïcode – 日本語 😀 text that goes on for some more words", "de"),
    ]
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", 1, "r", 7, None, "h") for i, t, lang in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
