"""Files read by several tasks: numbered lines, CSV records with line breaks, exports, samples."""

import csv
import io
import os
import random

import pytest

from retailpulse.sources import csv as CSV
from retailpulse.sources.interest_export import read_interest_exports
from retailpulse.sources.lines import numbered_lines, quoted_records, raw_lines


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_numbered_lines(spark, tmp_dir, small_splits):
    texts = {f"f{i}": [f"line {j} of {i}" if j % 3 else "" for j in range(40 * i)] for i in range(1, 4)}
    for name, lines in texts.items():
        write(f"{tmp_dir}/{name}.csv", "\r\n".join(lines) + "\r\n")
    df = numbered_lines(spark, tmp_dir, "*.csv")
    assert raw_lines(spark, tmp_dir, "*.csv").rdd.getNumPartitions() > 3
    got = {}
    for r in df.collect():
        got.setdefault(os.path.basename(r["path"])[:2], {})[r["pos"]] = r["line"]
    assert got == {name: dict(enumerate(lines)) for name, lines in texts.items()}


@pytest.mark.parametrize("sep", [",", ";", "|", "\t"])
def test_quoted_records_in_splits(spark, tmp_dir, small_splits, sep):
    """Cells with quotes, delimiters and line breaks; one file, many splits, some inside a cell."""
    rng = random.Random(sep)
    cell = lambda: "".join(rng.choice(["a", "b c", '"', sep, "\n", "\n\n", "é", "", "x" * 30]) for _ in range(rng.randint(0, 5)))
    rows = [[str(i), cell(), cell()] for i in range(150)]
    rows[70][1] = "long\n" * 100 + '"end"'
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="\n").writerows([["id", "one", "two"], *rows])
    write(f"{tmp_dir}/shop/a.csv", out.getvalue())
    write(f"{tmp_dir}/shop/b.csv", f"id{sep}one{sep}two\n7{sep}plain 5\" pipe{sep}z\n\n8{sep}y\n")
    records = quoted_records(spark, [f"{tmp_dir}/shop/a.csv"], sep)
    texts = [r["record"] for r in records.orderBy("pos").collect()]
    assert [row for t in texts for row in csv.reader(io.StringIO(t), delimiter=sep)] == [["id", "one", "two"], *rows]
    df = CSV.read_csv_files(spark, [f"{tmp_dir}/shop/a.csv", f"{tmp_dir}/shop/b.csv"], ["id", "one", "two"], sep, multi_line=True)
    trim = lambda r: tuple(x for x in r)
    got = sorted((trim(r) for r in df.collect()), key=str)
    assert [r[0] for r in got] == [r[0] for r in sorted([*map(tuple, rows), ("7", 'plain 5" pipe', "z"), ("8", "y", "")], key=str)]
    assert {r[0]: r[1:] for r in got if r[0] not in ("7", "8")} == {r[0]: tuple(r[1:]) for r in rows if r[0] not in ("7", "8")}
    assert [r[1:] for r in got if r[0] == "8" and r[1] == "y"] == [("y", "")]


def test_exports_in_splits(spark, tmp_dir, small_splits):
    days = [f"2026-{m:02d}-{d:02d},{(m * d) % 100}" for m in range(1, 13) for d in range(1, 29)]
    write(f"{tmp_dir}/a.csv", "Notes\n\nWeek,tv: (Peru)\n" + "\n".join(days[:200]) + "\ntext,1\n2027-01-04,99\n")
    write(f"{tmp_dir}/b.csv", "Week,radio: (Peru)\n2026-02-16T10:00:00Z,50\n2026-02-17,x\n")
    weekly, status = read_interest_exports(spark, tmp_dir)
    rows = weekly.collect()
    assert max(r["week_start"].isoformat() for r in rows if r["keyword_canonica"] == "tv") < "2027"
    assert {os.path.basename(r["file"]): (r["status"], r["header_pos"], r["n_points"]) for r in status.collect()} == {
        "a.csv": ("OK", 2, 200), "b.csv": ("OK", 0, 1)}


def test_inventory_and_samples_in_file_order(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/Shop/z y+.csv", "\n﻿id;\"name\"\n" + "".join(f"{9 - i};n{i}\n" for i in range(9)) + "id;\"name\"\n")
    write(f"{tmp_dir}/shop/head.csv", "a,b\n")
    write(f"{tmp_dir}/shop/empty.csv", "")
    files = {os.path.basename(r["path"]): r for r in CSV.inventory(spark, tmp_dir).collect()}
    r = files["z y+.csv"]
    assert (r["source"], r["n_rows"], r["delimiter"], r["columns"]) == ("shop", 10, ";", "id | name")
    assert r["sample"] == ["9;n0", "8;n1", "7;n2", "6;n3", "5;n4"]
    assert (files["head.csv"]["n_rows"], files["head.csv"]["sample"], files["head.csv"]["size"]) == (0, [], 4)
    assert (files["empty.csv"]["size"], files["empty.csv"]["header"], files["empty.csv"]["n_rows"]) == (0, None, 0)
    lines = CSV.sample_lines(CSV.inventory(spark, tmp_dir)).collect()
    assert sorted(r["line_no"] for r in lines) == [1, 2, 3, 4, 5]
