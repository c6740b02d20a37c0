"""Quoted CSV by ranges against Spark's own reader, with a range edge at every byte."""

import io
import random

import pytest

from broadsheet.sources import articles as A
from broadsheet.sources import quoted as Q

TEXTS = ["", "a", "a,b", 'say "x"', "two\nlines", "crlf\r\nline", '"', '""\n"', " pad ", "ünï\n", "\n", None, ",", "x" * 40, "'\n'"]


def csv_text(rows, end):
    def field(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"' if not v or set(v) & set(',"\n\r ') else v

    return "".join(",".join(map(field, r)) + end for r in [("id", "text", "more"), *rows])


def table(seed, n):
    rng = random.Random(seed)
    return [(str(i), rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_range_edge(end):
    rows = table(1, 14)
    data = csv_text(rows, end).encode()
    for text in (data, data[:-len(end)]):  # with and without the last line end
        for size in range(1, len(text) + 2):
            found = []
            for first in range(0, len(text), size):
                inside = text[:first].count(b'"') % 2 == 1
                found += Q._records(Q.record_bytes(io.BytesIO(text), len(text), first, min(first + size, len(text)), inside, step=7))
            assert found == [["id", "text", "more"], *[[v or "" for v in r] for r in rows]], size


@pytest.mark.parametrize("seed,end,size", [(2, "\n", 97), (3, "\r\n", 256), (4, "\n", 1 << 20)])
def test_rows_equal_those_of_the_usual_reader(spark, tmp_path, seed, end, size):
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(csv_text(table(seed + k, 300), end).encode())
    (tmp_path / "_SUCCESS").touch()
    (tmp_path / "empty.csv").touch()
    got = Q.read_quoted(spark, str(tmp_path), size)
    want = spark.read.csv(str(tmp_path), header=True, multiLine=True, quote='"', escape='"')
    assert got.columns == want.columns
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(got) == key(want) and got.count() == 600
    assert got.rdd.getNumPartitions() == len(Q.ranges_of(Q.files_of(str(tmp_path)), size))
    spark.dataSource.register(Q.QuotedCsv)
    assert key(spark.read.format(Q.NAME).load(str(tmp_path))) == key(want)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, articles):
    df = articles(*[{"title": f"t{i}\nsecond", "article": "long, \"quoted\"\n" * 50} for i in range(40)])
    path = str(tmp_path / "dev.csv")
    df.coalesce(1).write.csv(path, header=True, quote='"', escape='"')
    got = A.read_development(spark, path, range_bytes=2000)
    assert got.rdd.getNumPartitions() > 10
    assert sorted(map(repr, got.collect())) == sorted(map(repr, A.read_development(spark, path).collect()))


def test_short_long_and_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfid,b\n1\n2,x,y\n\n3,\n")
    assert [tuple(r) for r in Q.read_quoted(spark, str(tmp_path / "a.csv")).collect()] == [("1", None), ("2", "x"), ("3", None)]
    with pytest.raises(FileNotFoundError):
        Q.read_quoted(spark, str(tmp_path / "none.csv"))


def test_the_registered_table_is_not_written_by_one_task(spark, monkeypatch):
    from broadsheet import registry

    seen = []
    write = registry._csv
    monkeypatch.setattr(registry, "_csv", lambda s, df, name: seen.append(df) or write(s, df.repartition(3), name))
    rows = registry.scan_dev_ranges(spark, "/root/testdata/sf0.001").select("id", "title", "article")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "SinglePartition" not in plan
    # several files, read by ranges, give the rows of the table
    assert rows.distinct().count() == seen[0].count() == rows.count()
