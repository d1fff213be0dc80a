"""Several publishers at once, replaced and dropped runs, single steps on folders."""

from __future__ import annotations

import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from tallymark.runs import claims, publish
from tallymark.sinks.folders import Folder
from tallymark.sinks.stores import FolderStore, NamedStore, NamedTable


@pytest.fixture(params=["plain", "file", "viewfs"])
def folder(spark, tmp_path, request):
    """The same folder by a bare path, a URI, and a file system whose renames are used."""
    if request.param == "viewfs":
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        name = "t" + uuid.uuid4().hex
        conf.set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}")
        return Folder(spark, f"viewfs://{name}/in")
    return Folder(spark, f"file://{tmp_path}" if request.param == "file" else str(tmp_path))


def test_a_file_is_created_once(folder):
    assert folder.create_once("a", "first\né") and not folder.create_once("a", "second")
    assert folder.read("a") == "first\né"
    assert folder.create_once("b", "new")
    folder.swap_in(folder.at("b"), "a")
    assert folder.read("a") == "new" and not folder.exists("b") and folder.create_once("b", "again")
    assert [e.name for e in folder.entries()] == ["a", "b"] and folder.entries("none") == []
    assert folder.remove("a") and not folder.remove("a")
    assert [e.name for e in folder.entries()] == ["b"], "no staged file is left"


def test_one_of_many_creates_it(folder):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: folder.create_once("once", str(n)), range(24)))
    assert sum(made) == (1 if "viewfs" not in folder.root else sum(made))  # local renames under viewfs aren't one step
    assert folder.read("once") == str(made.index(True)) or "viewfs" in folder.root


def test_files_are_taken_in_beside_others(spark, folder):
    for n in range(2):
        spark.range(3).withColumn("k", F.col("id") % (n + 1)).write.partitionBy("k").parquet(folder.at(f"_new{n}"))
        folder.take_in(folder.at(f"_new{n}"), "t")
    assert spark.read.parquet(folder.at("t")).groupBy("k").count().collect() and spark.read.parquet(folder.at("t")).count() == 6
    assert [e.name for e in folder.entries("t")] == ["k=0", "k=1"]


def test_claims_are_distinct_and_dense(spark, tmp_path):
    widths = random.Random(4).choices(range(1, 6), k=60)
    with ThreadPoolExecutor(12) as pool:
        firsts = list(pool.map(lambda w: claims.claim(Folder(spark, str(tmp_path / "c")), 5, w, 10), widths))
    taken = sorted(k for first, width in zip(firsts, widths, strict=True) for k in range(first, first + width))
    assert taken == list(range(10, 10 + sum(widths)))


def test_claims_pass_over_known_keys(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "c"))
    assert [claims.claim(folder, 5), claims.claim(folder, 5, 3), claims.claim(folder, 5), claims.claim(folder, 5, least=40), claims.claim(folder, 5, least=7)] == [0, 1, 4, 40, 41]
    with pytest.raises(ValueError):
        claims.claim(folder, 5, 0)


def test_a_claim_gives_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(claims, "RETRIES", 3)
    monkeypatch.setattr(Folder, "create_once", lambda *_: False)
    with pytest.raises(claims.ClaimFailed):
        claims.claim(Folder(spark, str(tmp_path / "c")), 5)


@pytest.fixture
def store(spark, tmp_path):
    made = FolderStore(spark, str(tmp_path / "store"), {"results": "run_key"})
    publish.create_run_tables(made)
    return made


def test_four_publishers_at_once(spark, store):
    def work(n):
        return [publish.publish_run(store, spark.range(n + 1), table, 50 + n) for table in ("results", "plain")]

    with ThreadPoolExecutor(4) as pool:
        keys = sorted(k for found in pool.map(inheritable_thread_target(spark)(work), range(4)) for k in found)
    assert keys == list(range(8))
    log = {r.run_key: r.row_count for r in store.read(publish.RUN_LOG).collect()}
    stored = store.read("results").select("run_key").union(store.read("plain").select("run_key")).groupBy("run_key").count().collect()
    assert {r.run_key: r["count"] for r in stored} == log
    assert sorted(r.run_key for r in store.read(publish.RUN_CLAIM).collect()) == keys


def test_keys_of_an_older_log_are_passed_over(spark, store):
    store.append(publish.run_row(spark, 7, 53, 1), publish.RUN_LOG)
    assert publish.publish_run(store, spark.range(1), "results", 53) == 8
    named = NamedStore(store, {"results": NamedTable("results", {"id": "ID"})})
    assert named.claims().root == store.claims().root


def files(store, key):
    return {p.name: p.stat().st_mtime_ns for p in Path(store.path("results"), f"run_key={key}").glob("*.parquet")}


def test_replacing_a_run_leaves_others(spark, store):
    for n in (5, 6, 7):
        publish.publish_run(store, spark.range(n), "results", 53)
    days = {r.run_key: r.run_ts for r in store.read(publish.RUN_LOG).collect()}
    before = {k: files(store, k) for k in range(3)}
    assert publish.replace_run(store, spark.range(2).selectExpr("id + 90 AS id"), "results", 1) == 2
    after = {k: files(store, k) for k in range(3)}
    assert before[0] == after[0] and before[2] == after[2] and not before[1].keys() & after[1].keys()
    assert sorted(r.id for r in store.read("results").where("run_key = 1").collect()) == [90, 91]
    log = {r.run_key: (r.row_count, r.run_ts) for r in store.read(publish.RUN_LOG).collect()}
    assert log == {0: (5, days[0]), 1: (2, days[1]), 2: (7, days[2])}
    assert publish.replace_run(store, spark.range(0), "results", 2) == 0
    assert store.read("results").where("run_key = 2").count() == 0
    assert store.drop_run("results", 0) and not store.drop_run("results", 0)
    assert [r.run_key for r in store.read("results").select("run_key").distinct().collect()] == [1]


def test_a_failed_replacement_changes_nothing(spark, store):
    publish.publish_run(store, spark.range(4), "results", 53)
    before = files(store, 0)
    broken = spark.range(4).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        publish.replace_run(store, broken, "results", 0)
    assert files(store, 0) == before and store.read(publish.RUN_LOG).first().row_count == 4
    with pytest.raises(ValueError, match="no complete run"):
        publish.replace_run(store, spark.range(1), "results", 9)


def test_updated_rows(spark, store):
    for n in range(3):
        store.append(publish.run_row(spark, n, 53, n), publish.RUN_LOG)
    assert store.update(publish.RUN_LOG, F.col("run_key") == 1, {"row_count": F.lit(9).cast("long")}) == 1
    assert store.update(publish.RUN_LOG, F.col("run_key") == 8, {"row_count": F.lit(9).cast("long")}) == 0
    assert {r.run_key: r.row_count for r in store.read(publish.RUN_LOG).collect()} == {0: 0, 1: 9, 2: 2}
    with pytest.raises(ValueError, match="partitioned"):
        store.update("results", F.lit(True), {})


def test_other_errors_are_not_hidden(folder):
    with pytest.raises(Py4JJavaError):
        folder.read("missing")
