"""Extracts as text files: rows, and lines that are none."""

import pytest

from sluice.sources import files

COLUMNS = ["id", "name", "city"]


@pytest.fixture
def extract(spark, tmp_path):
    def read(*texts, **options):
        for i, text in enumerate(texts):
            (tmp_path / f"part{i}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
        return files.read_extract(spark, str(tmp_path), COLUMNS, **options)

    return read


def found(df):
    return sorted((r.id, r.name, r.city) for r in files.rows(df).collect())


def faults(df):
    return sorted((r._line, r._fault) for r in files.rejected(df).collect())


def test_short_long_and_badly_quoted_lines_are_listed(extract):
    df = extract(
        'id,name,city\n1,Ann,Austin\n2,short\n3,"Bo, ""B"" Li",Rome\n4,too,many,fields\n5,"open,Oslo\n6,,""\n',
        '"id","name","city"\r\n7,"x"y,Bern\r\n8,a"b,Bonn\r\n\r\n9,Zoë,Łódź\r\n',
    )
    assert found(df) == [("1", "Ann", "Austin"), ("3", 'Bo, "B" Li', "Rome"), ("6", None, ""), ("9", "Zoë", "Łódź")]
    assert faults(df) == [
        ("2,short", "short"), ("4,too,many,fields", "long"), ('5,"open,Oslo', "quotes"), ('7,"x"y,Bern', "quotes"), ('8,a"b,Bonn', "quotes"),
    ]
    assert {r._source_file.rsplit("/", 1)[1] for r in files.rows(df).filter("id = '9'").collect()} == {"part1.csv"}


def test_columns_alone_do_not_hide_a_fault(extract):
    df = extract("1,Ann,Austin\n2,short\n3,a,b,c\n", header=False)
    assert [r.id for r in files.rows(df).select("id").collect()] == ["1"]
    assert files.rows(df).count() == 1 and files.rejected(df).count() == 2


def test_other_separators_and_bytes(extract):
    df = extract(b"1|a,b|c\n2|\xff|c\n3|\"x|y\"|z\n4||\n", sep="|", header=False)
    assert found(df) == [("1", "a,b", "c"), ("3", "x|y", "z"), ("4", None, None)]
    assert [f for _, f in faults(df)] == ["encoding"]


def test_long_lines(extract):
    quoted = '""x' * 50_000
    df = extract(f'1,"{quoted}",c\n2,{"y" * 3_000_000},c\n3,"{"z" * 1_000_000},c\n4{"," * 500_000}\n', header=False)
    assert {r.id: len(r.name) for r in files.rows(df).collect()} == {"1": 100_000, "2": 3_000_000}
    assert sorted(f for _, f in faults(df)) == ["long", "quotes"]
