"""CSV files whose quoted values span lines, cut anywhere, against the reader that takes a file in one task."""

from __future__ import annotations

import random

import pytest

from storelens.sources import csv_tables

HOSTILE = {
    "spanning": 'a,b,c\n1,"two\nlines",x\n2,"three\n\nlines, ""quoted""\n",y\n3,plain,"z"\n',
    "carriage returns": 'a,b,c\r\n1,"two\r\nlines",x\r\n2,"q""\r\n""q",y\r\n3,"",\r\n',
    "signs": 'a,b,c\n1,in"side,"a,b"\n2,"""",""""""\n3,"x""y\nz""",","\n\n\n4,"\n\n\n",end\n',
    "one record over all": 'a,b,c\n"' + "long\n" * 12 + '",2,3\n',
    "no end": 'a,b,c\n1,"x\ny",3\n4,5,6',
    "header": '"a","b","c"\n1,2,3\n',
    "only header": "a,b,c\n",
}
CUTS = (1, 2, 3, 7, 16)


def one_task(spark, path):
    rows = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True)
    return sorted(map(tuple, rows.select(*[csv_tables.na_to_null(rows[name]).alias(name) for name in rows.columns]).collect()), key=str)


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_files_cut_anywhere(spark, tmp_path, name):
    path = tmp_path / "file.csv"
    path.write_bytes(HOSTILE[name].encode())
    wanted = one_task(spark, str(path))
    for cut in CUTS if len(wanted) else (7,):
        got = csv_tables.read_csv(spark, str(path), multiline=True, split_bytes=cut)
        assert sorted(map(tuple, got.collect()), key=str) == wanted, cut


@pytest.mark.parametrize("seed", range(2))
def test_random_files_in_a_folder(spark, tmp_path, seed):
    rng = random.Random(seed)
    pieces = ["a", "é", ",", "\n", '"', " ", "12", "日本"]
    for k in range(3):
        lines = ["a,b"]
        for _ in range(40):
            values = ["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(2)]
            lines.append(",".join('"' + v.replace('"', '""') + '"' for v in values))
        (tmp_path / f"{k}.csv").write_text("\n".join(lines) + "\n" * rng.randint(0, 2))
    wanted = one_task(spark, str(tmp_path))
    for cut in (11, 300):
        assert sorted(map(tuple, csv_tables.read_csv(spark, str(tmp_path), multiline=True, split_bytes=cut).collect()), key=str) == wanted, cut


def test_no_file_is_read_by_one_task(spark, tmp_path):
    path = tmp_path / "file.csv"
    path.write_text("a,b\n" + '1,"x\ny"\n' * 2000)
    table = csv_tables.read_csv(spark, str(path), multiline=True, split_bytes=2000)
    assert table.count() == 2000
    assert table.rdd.getNumPartitions() > 5
    assert "multiLine" not in table._jdf.queryExecution().toString()
