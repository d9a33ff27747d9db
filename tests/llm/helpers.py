"""Fixtures in plain Python: the small tables and documents with every odd case."""

import pyarrow.dataset as ds

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, key int, size string"


def documents():
    t = ds.dataset(f"{SF}/documents.parquet").to_table().to_pylist()
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 1, "y") for r in t]


def odd(rows=None):
    """Null and empty columns, repeated rows and ids, a long text, ties, clashing column names."""
    extra = [(None, "a text without an id", None, None, None), (9001, None, "en", "src1", None),
             (9002, "", "en", "src1", 0), (9003, " \n\t ", None, None, 4), (9004, "1 2 3 ...", "en", "src2", 9),
             (9005, "same words here", "en", "src2", 15), (9005, "same words here", "en", "src2", 15),
             (9006, "same words here", "en", "src3", 15), (9005, "other words under an old id", "en", "src2", 27),
             (9007, "word " * 60_000, "en", "src3", 300_000), (9008, "\U0001F600 é ß 漢字", "de", "src3", 8)]
    return (documents() if rows is None else rows) + [(*r, None, None, None) for r in extra]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)
