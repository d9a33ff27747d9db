"""Quoted CSV in splits: the same records whatever the splits, and the first row read of an id."""

import csv
import io
import os
import random

import pytest
from plume.operators import clean as C
from plume.sources.files import read_labelled_csv, read_posts_csv
from plume.sources.quoted_csv import read_quoted_csv, records
from pyspark.sql import functions as F

FIELDS = ["a", "", 'say "hi"', "two\nlines", "\n\n", '"', '""', ",", " ", "é漢\n\U0001F600", "x" * 40, "end\r\nof", "l\nm\nn\no"]


def _write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    with open(path, "wb") as f:
        f.write(out.getvalue().encode())


def _rows(n, seed, width=3):
    rnd = random.Random(seed)
    return [[str(i), *[rnd.choice(FIELDS) for _ in range(width - 1)]] for i in range(n)]


@pytest.fixture()
def splits_of(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)
    spark.conf.unset("spark.sql.files.minPartitionNum")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_in_one_and_in_many_splits(spark, tmp_dir, splits_of, end):
    rows = _rows(400, 3)
    rows[200][1] = "\n".join("long field, line %d" % i for i in range(300))  # crosses many splits whole
    path = os.path.join(tmp_dir, "q.csv")
    _write(path, [["id", "first", "second"], *rows], end)
    want = sorted([r[0], *[x or None for x in r[1:]]] for r in rows)
    size = os.path.getsize(path)
    for parts in (1, 7, 50, 400):
        splits_of(size // parts + 1)
        got = read_quoted_csv(spark, path, position=True)
        assert got.columns == ["id", "first", "second", "read_at"]
        found = got.collect()
        assert sorted([r.id, r.first or None, r.second or None] for r in found) == want
        assert [r.id for r in sorted(found, key=lambda r: (r.read_at.block, r.read_at.n))] == [r[0] for r in rows]
        assert len({r.read_at.block for r in found}) > min(parts, 50) / 2


def test_records_of_odd_files(spark, tmp_dir, splits_of):
    texts = {"empty": b"", "open": b'1,"never\nclosed\n', "blank": b"\n\n1,2\n\n", "noend": b'1,"x\ny"', "header": b"id,text\n"}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(text)
    at = lambda n: os.path.join(tmp_dir, n)
    for size in (1000, 4):
        splits_of(size)
        assert records(spark, at("empty")).count() == 0
        assert [r.record for r in records(spark, at("open")).collect()] == ['1,"never\nclosed']
        assert sorted(r.record for r in records(spark, at("blank")).collect()) == ["", "", "", "1,2"]
        assert [r.record for r in records(spark, at("noend")).collect()] == ['1,"x\ny"']
        assert read_quoted_csv(spark, at("header")).columns == ["id", "text"]
        assert read_quoted_csv(spark, at("header")).count() == 0
        assert read_quoted_csv(spark, at("empty")).count() == 0


def test_several_files_and_labelled_texts(spark, tmp_dir, splits_of):
    rows = [[str(i), "t", "Positive" if i % 2 else "Negative", f"line one {i}\nline two \"{i}\""] for i in range(90)]
    paths = [os.path.join(tmp_dir, n) for n in ("training.csv", "validation.csv")]
    _write(paths[0], rows[:60])
    _write(paths[1], rows[60:])
    splits_of(300)
    got = read_labelled_csv(spark, paths).collect()
    assert sorted((r.id, r.sentiment, r.text, r.source_file) for r in got) == [
        (i, "Positive" if i % 2 else "Negative", rows[i][3], "training.csv" if i < 60 else "validation.csv") for i in range(90)]


def test_first_row_read_of_an_id_stays(spark, tmp_dir, splits_of):
    rnd = random.Random(8)
    rows = [[str(rnd.randrange(40)), f"2024-01-{rnd.randint(1, 28):02d} 10:00:00", f"text number {i}\nof many", "en"] for i in range(300)]
    rows[0][2] = "tiny"  # filtered: the next row of this id is its first
    path = os.path.join(tmp_dir, "posts.csv")
    _write(path, [["id", "date", "content", "lang"], *rows])
    want = {}
    for r in rows[1:]:
        want.setdefault(r[0], r[2])
    for parts in (1, 50):
        splits_of(os.path.getsize(path) // parts + 1)
        got = C.ingest_filter(read_posts_csv(spark, path, position=True))
        assert got.columns == ["id", "date", "content", "lang"]
        assert {r.id: r.content for r in got.collect()} == want


def test_compressed_export_of_bounded_files(spark, tmp_dir):
    import glob
    from plume.plans.catalog import _export
    df = spark.range(120_000).coalesce(2).select("id", F.format_string('say "%d",\nthen go', "id").alias("content"))
    _export(df, f"{tmp_dir}/x")
    assert len(glob.glob(f"{tmp_dir}/x/part-*.csv.gz")) == 4
    back = read_quoted_csv(spark, f"{tmp_dir}/x")
    assert back.columns == ["id", "content"] and back.count() == 120_000
    assert back.where(F.col("content") != F.format_string('say "%s",\nthen go', "id")).count() == 0
