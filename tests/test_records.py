"""Records of delimited files by the parity of quotes, over blocks of any size."""

from __future__ import annotations

import csv
import io
import random

import pytest

from depotlens.sources import readers, writers
from depotlens.sources.records import begins_quoted, records, _lines

TEXTS = ["plain", "a,b", 'say "x"', "two\nlines", "\n\n", "cr\r\nlf", "", " spaced ", '"', '""\n"', "é🙂\n" * 9, "x" * 300]


@pytest.fixture
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def use(size: int) -> None:
        for k in keys:
            spark.conf.set(k, str(size))

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(draw: random.Random, n: int) -> list[tuple]:
    return [(i, draw.choice(TEXTS), draw.choice(TEXTS[:4])) for i in range(n)]


def written(rows, end: str) -> str:
    out = io.StringIO(newline="")
    made = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_NONNUMERIC)
    made.writerow(["id", "one", "two"])
    made.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize(("size", "end"), [(37, "\n"), (64, "\r\n"), (200, "\n"), (1 << 20, "\r\n")])
def test_blocks_cut_records_anywhere(spark, tmp_path, small_blocks, size, end):
    rows = rows_of(random.Random(size), 40)
    (tmp_path / "t.csv").write_bytes(written(rows, end).encode())
    small_blocks(size)
    found = readers.scan_csv(spark, str(tmp_path / "t.csv"), "id int, one string, two string")
    assert sorted(map(tuple, found.collect())) == rows
    assert found.rdd.getNumPartitions() > (4 if size < 1000 else 0)
    inferred = readers.scan_csv(spark, str(tmp_path / "t.csv"), infer=True)
    assert inferred.dtypes == [("id", "int"), ("one", "string"), ("two", "string")]


def test_several_files_have_a_header_each(spark, tmp_path, small_blocks):
    rows = rows_of(random.Random(1), 24)
    for part in range(3):
        (tmp_path / f"p{part}.csv").write_text(written(rows[part::3], "\n"), newline="")
    small_blocks(50)
    assert sorted(map(tuple, readers.scan_csv(spark, str(tmp_path), "id int, one string, two string").collect())) == rows


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [(1, "a\n" * 400, "b"), (2, "c", "d\n" * 300), (3, "e", "f")]
    (tmp_path / "t.csv").write_text(written(rows, "\n"), newline="")
    small_blocks(90)
    assert sorted(map(tuple, readers.scan_csv(spark, str(tmp_path / "t.csv"), "id int, one string, two string").collect())) == rows
    quoted = begins_quoted(_lines(spark, str(tmp_path / "t.csv")))
    assert sum(w.sum() for _, w in quoted.values()) > 5


def test_no_final_line_break_blank_lines_and_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,one\n1,x\n\n2,"y\nz"')
    assert sorted(map(tuple, readers.scan_csv(spark, str(tmp_path / "a.csv"), "id int, one string").collect())) == [(1, "x"), (2, "y\nz")]
    (tmp_path / "b.csv").write_text("id,one\n")
    assert readers.scan_csv(spark, str(tmp_path / "b.csv"), "id int, one string").collect() == []
    (tmp_path / "c.csv").write_text("")
    assert readers.scan_csv(spark, str(tmp_path / "c.csv"), "id int, one string").collect() == []
    assert records(spark, str(tmp_path / "a.csv")).where("head").count() == 1


def test_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,other\n1,x\n")
    with pytest.raises(ValueError, match="header"):
        readers.scan_csv(spark, str(tmp_path / "a.csv"), "id int, one string")
    (tmp_path / "b.csv").write_text("id,one\n1,x\n")
    with pytest.raises(ValueError, match="common header"):
        readers.scan_csv(spark, str(tmp_path), infer=True)


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "i,l,d,day,at,b,s,none\n1,5000000000,1.5,2024-01-02,2024-01-02 03:04:05,true,1x,\n-2,1,2,2024-1-3,2024-01-02T03:04:05,FALSE,2,\n"
    )
    kinds = dict(readers.scan_csv(spark, str(tmp_path / "t.csv"), infer=True).dtypes)
    assert kinds == {"i": "int", "l": "bigint", "d": "double", "day": "date", "at": "timestamp", "b": "boolean", "s": "string", "none": "string"}


def test_stray_quotes_need_whole_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,one\n1,5" pipe\n2,y\n')
    got = readers.scan_csv(spark, str(tmp_path / "t.csv"), "id int, one string", whole_files=True)
    assert sorted(map(tuple, got.collect())) == [(1, '5" pipe'), (2, "y")]


def test_files_are_bounded_by_bytes(spark, tmp_path):
    table = spark.createDataFrame([(i, "x" * 1000) for i in range(200)], "id int, one string").coalesce(1)
    writers.write_csv_all({"t": table}, str(tmp_path), bytes_per_file=20_000)
    sizes = [f.stat().st_size for f in (tmp_path / "t.csv").glob("part-*.csv")]
    assert len(sizes) >= 10 and max(sizes) <= 21_000
