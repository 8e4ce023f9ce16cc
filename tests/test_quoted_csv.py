"""Quoted CSV with line breaks, read from byte ranges, against Spark's reader
of whole files."""

import csv
import os
import random

import pytest

from wardline.sources.tables import read_cohort_csv, read_quoted_csv


def _write(folder, name, rows, end):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "note, text", "n"])
        w.writerows(rows)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_the_reader_of_whole_files(spark, tmpdir_path, end):
    rng = random.Random(len(end))
    bits = ["plain", 'a "quoted" word', f"line{end}break", f'"{end}"', ",", "ünï 😀", "", f"{end}{end}", '""', "x" * 300]
    for k in range(3):
        rows = [(str(i), "".join(rng.choice(bits) for _ in range(rng.randint(0, 6))), rng.choice(["1", "", "2.5"])) for i in range(400)]
        _write(tmpdir_path, f"part{k}.csv", rows, end)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = _sorted(read_cohort_csv(spark, tmpdir_path, multi_line=True))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = read_quoted_csv(spark, tmpdir_path)
        assert df.columns == ["id", "note, text", "n"]
        assert spark.read.text(tmpdir_path).rdd.getNumPartitions() > 50
        assert _sorted(df) == want and len(want) == 1200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_header_only_and_a_record_over_many_ranges(spark, tmpdir_path):
    _write(tmpdir_path, "a.csv", [], "\n")
    assert read_quoted_csv(spark, os.path.join(tmpdir_path, "a.csv")).collect() == []
    long = "\n".join(f'line {k}, "said"' for k in range(2000))
    _write(tmpdir_path, "b.csv", [("1", long, ""), ("2", "short", "3")], "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        got = _sorted(read_quoted_csv(spark, os.path.join(tmpdir_path, "b.csv")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("1", long, None), ("2", "short", "3")]
