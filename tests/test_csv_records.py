"""Split CSV reading against the one-task reader."""

import random

import pytest

from mercato.sources import csv_records as cr

RANGES = [64, 333, 1 << 20]


def one_task(spark, path):
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    return raw.toDF(*[c.removeprefix("﻿") for c in raw.columns])


def compare(spark, path, ranges=RANGES):
    want = one_task(spark, path)
    rows = sorted((tuple(r) for r in want.collect()), key=repr)
    for size in ranges:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = cr.read_csv(spark, path)
            assert got.columns == want.columns
            assert sorted((tuple(r) for r in got.collect()), key=repr) == rows, size
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    return rows


def quoted(v, eol):
    return '"' + v.replace('"', '""').replace("\n", eol) + '"'


@pytest.mark.parametrize("eol,bom", [("\n", ""), ("\r\n", "﻿")])
def test_equals_the_one_task_reader(spark, tmp_path, eol, bom):
    rng = random.Random(len(eol))
    parts = ["word", "a b", 'said "x"', "line\nbreak", "\n\n", ",", "", "é日本", '"', "end\n", "'", "long " * 30]
    lines = [bom + "id," + quoted("the text", eol) + ",note"]
    for i in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        plain = rng.choice(["", "n", "x y", quoted("q,\nq", eol)])
        lines.append(f"{i},{quoted(text, eol) if text or rng.random() < .5 else ''},{plain}")
    lines.insert(40, "")                                            # an empty line
    (tmp_path / "t.csv").write_bytes(eol.join([*lines, ""]).encode())
    rows = compare(spark, str(tmp_path / "t.csv"))
    assert len(rows) == 150


def test_a_record_over_many_ranges_and_several_files(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    big = "\n".join(f"row {i} \"\"" for i in range(400))
    for k, text in enumerate((f'id,text\n1,"{big}"\n2,after\n', 'id,text\n3,"a\nb"\n4,"no end of line"', "id,text\n")):
        (folder / f"{k}.csv").write_bytes(text.encode())
    rows = compare(spark, str(folder), [100, 1 << 20])
    assert [r[0] for r in rows] == ["1", "2", "3", "4"] and rows[0][1].count("\n") == 399


def test_headers_that_differ_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2\n")
    (tmp_path / "b.csv").write_text("id,y\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        cr.read_csv(spark, str(tmp_path))
