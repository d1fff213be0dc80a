"""Readers and exports over real files; JDBC up to the reader's options."""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.functions.text import decoded
from tallymark.sinks.exports import export_csv
from tallymark.sinks.stores import JdbcStore
from tallymark.sources import files, jdbc
from tallymark.sources import json_documents as docs


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_delimited_files(spark, tmp_path):
    (tmp_path / "Account.csv").write_text("id;name\n1;Zoë\n2;b\n", encoding="utf-8")
    (tmp_path / "comma.csv").write_text("id,name\n1,a\n")
    got = files.read_crm_csv(spark, str(tmp_path), "Account")
    assert got.dtypes == [("id", "int"), ("name", "string")] and rows(got) == Counter([(1, "Zoë"), (2, "b")])
    assert rows(files.read_comma(spark, str(tmp_path / "comma.csv"), "id long, name string")) == Counter([(1, "a")])


def test_history_skips_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "h.csv").write_text('a,b\n1,x\n2,y,z\n3\nq,w\n5,"u,v"\n6,y,z,z\n4,v\n')
    got = files.read_history(spark, str(tmp_path / "h.csv"), "a int, b string")
    assert rows(got) == Counter([(1, "x"), (3, None), (None, "w"), (5, "u,v"), (4, "v")])
    assert got.select("a").count() == 5


def test_pipe_file_is_named_by_position(spark, tmp_path):
    path = files.dated_pipe_path(str(tmp_path), "20240502", "tickets", "RD_TR_2_")
    assert path.endswith("/20240502/RD_TR_2_20240502_tickets.txt")
    (tmp_path / "20240502").mkdir()
    with open(path, "w") as out:
        out.write("1|a\n2|b\n")
    names = [("tickets", 1, "text"), ("tickets", 0, "id"), ("tickets", 2, "unused"), ("x", 0, "no")]
    dictionary = spark.createDataFrame(names, "table string, position int, name string")
    got = files.read_pipe(spark, path, dictionary, "tickets")
    assert got.dtypes == [("id", "int"), ("text", "string")] and rows(got) == Counter([(1, "a"), (2, "b")])
    typed = files.read_pipe(spark, path, dictionary, "tickets", ["string", "string"])
    assert rows(typed) == Counter([("1", "a"), ("2", "b")])
    with pytest.raises(ValueError, match="2 columns, but 1 names"):
        files.read_pipe(spark, path, dictionary, "x")


def test_crm_parquet(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "Account.parquet"))
    assert files.read_crm_parquet(spark, str(tmp_path), "Account").count() == 3


def write_day(base, day, records, raw=None):
    folder = base / str(day.year) / str(day.month) / str(day.day)
    folder.mkdir(parents=True)
    content = raw if raw is not None else json.dumps({"totalSize": len(records), "records": records}, indent=1).encode()
    (folder / "Account.json").write_bytes(content)


def test_days_exclude_today():
    days = docs.days_back(dt.date(2024, 3, 2), 4)
    assert days == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert docs.day_path("s3://b/", "Account", days[0]) == "s3://b/2024/2/28/Account.json"


def test_plain_document(spark, tmp_path):
    write_day(tmp_path, dt.date(2024, 3, 1), [{"Id": "a", "n": 1, "attributes": {"type": "t"}}, {"Id": "b"}])
    path = docs.day_path(str(tmp_path), "Account", dt.date(2024, 3, 1))
    got = docs.read_document(spark, path)
    assert rows(got.select("Id", "n", "attributes.type")) == Counter([("a", 1, "t"), ("b", None, None)])
    assert rows(docs.read_document(spark, path, "Id string")) == Counter([("a",), ("b",)])


def test_dirty_document(spark, tmp_path):
    raw = b'{"records":[{"Id":"a\xff\x07b","t":"x\ny"},{"Id":"c","o":{"k":[1,2]}}]}'
    write_day(tmp_path, dt.date(2024, 3, 1), None, raw)
    path = docs.day_path(str(tmp_path), "Account", dt.date(2024, 3, 1))
    records = docs.read_records(spark, path)
    typed = docs.typed_records(records, "Id string, t string, o struct<k: array<int>>")
    assert [tuple(r) for r in typed.orderBy("Id").select("Id", "t", "o.k").collect()] == [
        ("ab", "x\ny", None), ("c", None, [1, 2]),
    ]
    inferred = docs.inferred_records(spark, docs.written_records(records))
    assert rows(inferred.select("Id", "t", F.size("o.k"))) == Counter([("ab", "x\ny", -1), ("c", None, 2)]) or rows(
        inferred.select("Id", "t", F.size("o.k"))
    ) == Counter([("ab", "x\ny", None), ("c", None, 2)])


def test_days_with_drift(spark, tmp_path):
    as_of = dt.datetime(2024, 3, 2, 7, 30)
    write_day(tmp_path, dt.date(2024, 2, 28), [{"Id": "a", "old": 1, "mixed": 5}])
    write_day(tmp_path, dt.date(2024, 2, 29), [{"Id": "b", "new": True, "mixed": "five"}, {"Id": "c"}])
    write_day(tmp_path, dt.date(2024, 3, 1), [{"Id": "d", "new": False, "old": 2}])
    frame, drift = docs.read_days(spark, str(tmp_path), "Account", 4, as_of)
    assert dict(frame.dtypes) == {
        "Id": "string", "mixed": "string", "new": "boolean", "old": "bigint", "Fecha": "timestamp",
    }
    got = rows(frame.select("Id", "mixed", "new", "old", F.date_format("Fecha", "yyyy-MM-dd HH:mm")))
    assert got == Counter(
        [
            ("a", "5", None, 1, "2024-02-28 07:30"),
            ("b", "five", True, None, "2024-02-29 07:30"),
            ("c", None, None, None, "2024-02-29 07:30"),
            ("d", None, False, 2, "2024-03-01 07:30"),
        ]
    )
    assert [tuple(r) for r in drift.orderBy("day").collect()] == [
        (dt.date(2024, 2, 28), [], [], 0),
        (dt.date(2024, 2, 29), ["new"], ["old"], 3),
        (dt.date(2024, 3, 1), [], ["mixed"], 2),
    ]
    known, _ = docs.read_days(spark, str(tmp_path), "Account", 4, as_of, "Id string, old long")
    assert rows(known.select("Id", "old")) == Counter([("a", 1), ("b", None), ("c", None), ("d", 2)])


def test_a_missing_day_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="at least 2"):
        docs.read_days(spark, str(tmp_path), "Account", 1, dt.datetime(2024, 3, 2))
    write_day(tmp_path, dt.date(2024, 3, 1), [{"Id": "a"}])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        docs.read_days(spark, str(tmp_path), "Account", 3, dt.datetime(2024, 3, 2))


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("", None), ("a", "b")], "x string, y string").repartition(3)
    export_csv(df, str(tmp_path / "one"), one_file=True)
    parts = list((tmp_path / "one").glob("part-*"))
    assert len(parts) == 1
    assert sorted(parts[0].read_text().splitlines()) == ["NULL;", "a;b", "x;y"]
    export_csv(df, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 2
    export_csv(df, str(tmp_path / "many"))
    lines = [line for part in (tmp_path / "many").glob("part-*") for line in part.read_text().splitlines()]
    assert Counter(line for line in lines if line != "x;y") == Counter(["NULL;", "a;b"])
    assert lines.count("x;y") >= 2


class FakeIO:
    """Stands in for a reader or writer and records its options."""

    def __init__(self):
        self.seen, self.call = {}, None

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **values):
        self.seen.update(values)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def load(self):
        return self.seen

    def save(self):
        self.call = dict(self.seen)

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


class FakeSession:
    def __init__(self):
        self.read = FakeIO()


CONNECTION = jdbc.Connection("jdbc:postgresql://h:5432/db", {"user": "u", "fetchsize": "10000"})


def test_jdbc_query_can_be_split():
    got = jdbc.read_query(FakeSession(), CONNECTION, "SELECT 1", jdbc.Split("k", 0, 99, 4))
    assert got == {
        "format": "jdbc", "url": CONNECTION.url, "dbtable": "(SELECT 1) q", "user": "u", "fetchsize": "10000",
        "partitionColumn": "k", "lowerBound": 0, "upperBound": 99, "numPartitions": 4,
    }


def test_jdbc_table_is_quoted():
    assert jdbc.read_table(FakeSession(), CONNECTION, "DB.My Table")["dbtable"] == '"DB"."My Table"'


def test_jdbc_split_covers_the_actual_range(monkeypatch):
    asked = []

    class OneRow:
        def __init__(self, row):
            self.row = row

        def first(self):
            return self.row

    def answer(row):
        return lambda spark, connection, query: asked.append(query) or OneRow(row)

    monkeypatch.setattr(jdbc, "read_query", answer((3, 90)))
    assert jdbc.split_on(None, CONNECTION, "T", "ID", 8) == jdbc.Split('"ID"', 3, 90, 8)
    assert asked == ['SELECT MIN("ID") AS lo, MAX("ID") AS hi FROM "T"']
    monkeypatch.setattr(jdbc, "read_query", answer((None, None)))
    assert jdbc.split_on(None, CONNECTION, "T", "ID", 8) is None


def test_jdbc_hash_predicates_cover_every_row(spark):
    conditions = jdbc.hash_predicates("k", 3)
    got = jdbc.read_table(FakeSession(), CONNECTION, "t", predicates=conditions)
    assert got["predicates"] == conditions
    df = spark.createDataFrame([(k,) for k in (None, -4, -1, 0, 1, 2, 3, 10)], "k int")
    assert sum(df.where(c).count() for c in conditions) == df.count()


def test_jdbc_append(spark, monkeypatch):
    df = spark.createDataFrame([([1, 2], "x")], "a array<int>, b string")
    io, types = FakeIO(), []

    def write(self):
        types.extend(self.dtypes)
        return io

    monkeypatch.setattr(type(df), "write", property(write))
    JdbcStore(spark, CONNECTION, 4).append(df, "run_log")
    assert types == [("a", "array<int>"), ("b", "string")]
    types.clear()
    JdbcStore(spark, CONNECTION, 4, arrays_as_text=True).append(df, "run_log")
    assert types == [("a", "string"), ("b", "string")]
    assert io.call["dbtable"] == '"run_log"' and io.call["mode"] == "append" and io.call["numPartitions"] == 4


@pytest.mark.parametrize("text", ['{"records": [{"a": 1}, {"a": 2}, {"a"', '{"rows": [{"a": 1}]}', '{"records": null}'])
def test_broken_documents_fail(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|document without records"):
        docs.read_records(spark, str(tmp_path / "d.json")).collect()


def test_a_misfit_record_fails(spark):
    records = spark.createDataFrame([('{"a": "abc"}',)], "record string")
    with pytest.raises(Exception, match="MALFORMED"):
        docs.typed_records(records, "a long").collect()


def test_genuine_replacement_characters_stay(spark):
    raw = "x�y\x01z\x011".encode() + b"\xff\xc3("
    got = spark.createDataFrame([(raw,)], "b binary").select(decoded(F.col("b"))).first()[0]
    assert got == "x�y\x01z\x011("
