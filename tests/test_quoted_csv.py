"""Quoted CSV: split over many tasks it must read as one task reads it."""

import csv
import random

import pytest

from plumbline.sources import files, quoted

CELLS = ["", '""', "plain", " padded ", '"a, b"', '"line\nbreak"', '"crlf\r\ninside"', '"quote "" here"', '"""whole"""', '"\n"', '"\n\n\n"',
         "é日本", '",\n"",\n"', "back\\slash"]


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few dozen bytes, so that records, cells and runs of quotes are cut everywhere."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, rows, end="\n", lead=""):
    path.write_bytes((lead + end.join(["id,a,b", *rows]) + end).encode())
    return str(path)


def cells(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size,end", [(29, "\n"), (200, "\n"), (64, "\r\n")])
def test_tiny_splits_equal_a_plain_parser(spark, tmp_path, tiny_splits, size, end):
    r = random.Random(size)
    path = write(tmp_path / "table.csv", [f"{i},{r.choice(CELLS)},{r.choice(CELLS)}" for i in range(150)], end)
    with open(path, newline="", encoding="utf8") as f:
        want = sorted((tuple(row) for row in list(csv.reader(f))[1:]), key=str)
    tiny_splits(size)
    table = files.read_table(spark, path, missing=())
    assert table.columns == ["id", "a", "b"] and cells(table.na.fill("")) == want and len(want) == 150
    assert quoted._lines(spark, path, {}).rdd.getNumPartitions() > 4


def test_a_cell_over_many_splits_and_several_files(spark, tmp_path, tiny_splits):
    (tmp_path / "t").mkdir()
    long = "\n".join(f'row ""{i}"" of a long cell' for i in range(60))
    write(tmp_path / "t" / "one.csv", ["1,x,y", f'2,"{long}",z', "3,,"])
    write(tmp_path / "t" / "two.csv", [f'4,a,"{long}"'], lead="\n\n")
    write(tmp_path / "t" / "three.csv", [])
    whole = cells(files.read_table(spark, str(tmp_path / "t"), split=False, missing=()))
    tiny_splits(40)
    got = files.read_table(spark, str(tmp_path / "t"), missing=())
    assert cells(got) == whole
    assert sorted(r.id for r in got.collect()) == ["1", "2", "3", "4"]
    assert got.filter("id = '2'").head().a == long.replace('""', '"')


def test_a_quote_outside_of_quotes_fails(spark, tmp_path):
    path = write(tmp_path / "odd.csv", ['1,5" screen,x', '2,7" screen,y', "3,z,w"])
    with pytest.raises(Exception, match="outside of a quoted cell"):
        files.read_table(spark, path).collect()
    assert len(files.read_table(spark, path, split=False).collect()) == 3


def test_an_unclosed_quote_fails_and_an_empty_file_has_no_rows(spark, tmp_path):
    path = write(tmp_path / "open.csv", ['1,"never closed,x', "2,y,z"])
    with pytest.raises(Exception, match="outside of a quoted cell"):
        files.read_table(spark, path).collect()
    assert files.read_table(spark, write(tmp_path / "none.csv", [])).count() == 0


def test_very_many_quotes_in_a_cell_and_other_separators(spark, tmp_path):
    path = write(tmp_path / "many.csv", ['1,"' + '""' * 200_000 + '",x'])
    assert len(files.read_table(spark, path).head().a) == 200_000
    semi = tmp_path / "semi.csv"
    semi.write_text("id;a\n1;'x;\ny'\n")
    assert cells(files.read_table(spark, str(semi), sep=";", quote="'", escape="'")) == [("1", "x;\ny")]
    assert not quoted.understood({**files.CSV_FORM, "encoding": "latin1"})


def test_no_task_writes_more_than_a_bounded_file(spark, tmp_path, monkeypatch):
    from plumbline.catalog import storage

    texts = [f'{i} "x",\n' * 20 for i in range(40)]
    rows = spark.createDataFrame([(i, t, "web") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows.repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    written, write = [], storage.files.write_table
    monkeypatch.setattr(storage.files, "write_table", lambda df, *a, **k: written.append(df.rdd.getNumPartitions()) or write(df, *a, **k))
    monkeypatch.setattr(storage, "FILE_BYTES", sum(map(len, texts)))
    got = {(r["id"], r["copy"]): r["text"] for r in storage.csv_split_round_trip(spark, str(tmp_path)).collect()}
    assert written[0] > 1
    for i, t in enumerate(texts):
        assert got[i, 0] == t and got[i, 1] == f'\n{t}"' and got[i, 2] == f'"web",\n{t}'
    assert len(got) == 120
