"""Compressed files numbered in one read, with an index of line counts kept beside them."""
import gzip
import os

import pytest

from linea.sources.text import line_counts, read_lines, read_whole_files


def put(path, lines, end="\n"):
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        f.write("".join(x + end for x in lines))


def test_numbered_in_one_read(spark, tmp_path):
    files = {"b.gz": ["é one", "", "three\r"], "a.gz": [], "c.gz": [f"line {i}" for i in range(25_000)], "d.gz": ["last"]}
    paths = [str(tmp_path / name) for name in files]
    for path, lines in zip(paths, files.values(), strict=True):
        put(path, lines)
    index = str(tmp_path / "index")
    df = read_whole_files(spark, paths, index)
    want = [x for lines in files.values() for x in lines]
    assert [(r.line_no, r.text) for r in df.orderBy("line_no").collect()] == list(enumerate(want))
    # the same numbers as the reader that counts first; its plan scans twice, this one once
    assert df.orderBy("line_no").collect() == read_lines(spark, paths).orderBy("line_no").select("line_no", "text").collect()
    scans = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")
    assert scans(df) == 1 and scans(read_lines(spark, paths)) == 2


def test_index_counts_only_what_is_new(spark, tmp_path):
    index = str(tmp_path / "index")
    paths = [str(tmp_path / f"{i}.gz") for i in range(3)]
    for i, p in enumerate(paths):
        put(p, ["x"] * (i + 1))
    counted = lambda: spark.read.parquet(index).count()
    assert [n for _, n in line_counts(spark, paths[:2], index)] == [1, 2] and counted() == 2
    assert [n for _, n in line_counts(spark, paths, index)] == [1, 2, 3] and counted() == 3
    assert [n for _, n in line_counts(spark, paths[::-1], index)] == [3, 2, 1] and counted() == 3
    put(paths[0], ["y"] * 50)
    os.utime(paths[0], (2_000_000_000, 2_000_000_000))
    assert [n for _, n in line_counts(spark, paths, index)] == [50, 2, 3] and counted() == 4
    with pytest.raises(ValueError, match="may split"):
        read_whole_files(spark, [str(tmp_path / "plain.txt")], index)
