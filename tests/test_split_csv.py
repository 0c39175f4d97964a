import os
import random

import pytest

from argulith.sources.readers import read_csv
from argulith.sources.split_csv import ends_inside, read_split_csv

PIECES = ["a", "b ", ",", '""', "\n", "\r\n", "\n\n", '"",""', "ü", "\\"]


@pytest.fixture
def small_ranges(spark):
    """Byte ranges far smaller than a file."""
    names = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def plain(spark, path):
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def write(folder, name, header, seed, end="\n", last=True, longest=12):
    rng = random.Random(seed)

    def cell():
        if rng.random() < 0.4:
            return rng.choice(["", "plain", " lead", 'in"side', "é😀", "\\"])
        return '"' + "".join(rng.choice([*PIECES, "long " * rng.randint(0, longest)]) for _ in range(rng.randint(0, 12))) + '"'

    lines = [header, *(f"{i},{cell()},{cell()}{end if rng.random() < 0.05 else ''}" for i in range(60))]
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as out:
        out.write(end.join(lines) + (end if last else ""))


@pytest.mark.parametrize("header, end, last", [('id,"two\nlines",c', "\n", True), ("id,b,c", "\r\n", True), ("id,b,c", "\n", False)])
def test_rows_of_the_plain_reader(spark, tmp_path, small_ranges, header, end, last):
    for n in range(2):
        write(tmp_path, f"{n}.csv", header, n, end, last)
    path = str(tmp_path)
    assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 4
    got = read_split_csv(spark, path)
    assert got.columns == plain(spark, path).columns
    assert got.count() == 120
    assert rows(got) == rows(plain(spark, path))
    sorted_rows = read_split_csv(spark, path, in_order=True).collect()
    assert [r[0] for r in sorted_rows] == [str(i) for _ in range(2) for i in range(60)]


def test_records_longer_than_ranges(spark, tmp_path, small_ranges):
    """One cell covers several ranges, with and without lines inside them; quotes and line ends move over every border."""
    for shift in (0, 1):
        cell = ("x" * (990 + shift) + '""\n') * 5 + "y" * 2000 + "\n\n"
        (tmp_path / f"{shift}.csv").write_text(f'id,text,more\n1,"{cell}",a\n2,"{cell}","\n"\n3,,\n')
    path = str(tmp_path)
    assert rows(read_split_csv(spark, path)) == rows(plain(spark, path))
    assert read_split_csv(spark, path).count() == 6


def test_a_header_over_ranges_marks_and_files_without_rows(spark, tmp_path, small_ranges):
    name = "n" * 700 + "\n" + "m" * 700
    (tmp_path / "a.csv").write_text(f'id,"{name}"\n1,a\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text(f'id,"{name}"\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("", encoding="utf-8")
    got = read_csv(spark, str(tmp_path))
    assert got.columns == ["id", name] and [tuple(r) for r in got.collect()] == [("1", "a")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "m.csv").write_text('﻿"i\nd",b\n"1\n",\n', encoding="utf-8")
    assert [tuple(r) for r in read_split_csv(spark, str(tmp_path / "m")).collect()] == [("1\n", None)]


def test_a_file_that_ends_in_an_open_cell(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('id,b\n1,a\n2,"open\nto the end')
    assert rows(read_split_csv(spark, str(tmp_path / "a.csv"))) == rows(plain(spark, str(tmp_path / "a.csv")))


@pytest.mark.parametrize(
    "line, outside, inside",
    [(b"a,b", False, True), (b'a,"b', True, False), (b'"a""', True, False), (b'a"b,c', False, False), (b'"', True, False), (b'"",""', False, False)],
)
def test_state_after_a_line(line, outside, inside):
    assert ends_inside(line, False) is outside and ends_inside(line, True) is inside
