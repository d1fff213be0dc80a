"""Queries of reports, monitoring, sources and sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.checks import inputs as i
from tallymark.checks.registry import query
from tallymark.functions.text import printable
from tallymark.operators.drift import drift_by_day
from tallymark.operators.nested_drift import nested_drift as nested_drift_report
from tallymark.operators.shape import to_logical
from tallymark.plans.operations import Operations
from tallymark.plans.reconciliation import latest_crm
from tallymark.runs import monitoring, publish, reports
from tallymark.runs.dashboards import Dashboards
from tallymark.session import new_work_path
from tallymark.sinks.exports import export_csv, refresh_history, snapshot
from tallymark.sinks.folders import Folder
from tallymark.sinks.history import History
from tallymark.sinks.stores import CatalogStore, FolderStore
from tallymark.sources.files import read_comma, read_crm_parquet, read_delimited, read_pipe
from tallymark.sources.incremental import Landing
from tallymark.sources.json_documents import column_presence, record_texts, typed_records

RUN_TS = dt.datetime(2001, 8, 1, 12, 0)
RECENT_SQL = "r.run_ts>=DATE '2001-08-01' - INTERVAL '180' DAY"


@query(
    "latest_run",
    "SELECT f.OBJECT_ID,r.run_key,CAST(r.run_ts AS DATE) AS run_day FROM fx_order f JOIN fx_run r ON f.OBJECT_ID=r.run_key WHERE r.run_key=(SELECT max(OBJECT_ID) FROM fx_order)",
)
def latest_run(spark, sf):
    results = i.orders(spark, sf).select("OBJECT_ID", F.col("OBJECT_ID").alias("run_key"))
    return reports.latest_report(results, i.runs(spark, sf), ["OBJECT_ID"])


@query(
    "recent_180d",
    f"SELECT run_key,CAST(run_ts AS DATE) AS run_day FROM fx_run r WHERE {RECENT_SQL}",
)
def recent_180d(spark, sf):
    log = i.runs(spark, sf)
    return reports.recent_history(log.select("run_key"), log, i.AS_OF, ["run_day"])


@query(
    "holding_history",
    "SELECT h.*,CAST(r.run_ts AS DATE) AS run_day FROM fx_holding h JOIN fx_year_run r ON h.run_key=r.run_key",
)
def holding_history(spark, sf):
    return reports.full_history(i.holdings(spark, sf), i.year_runs(spark, sf), ["run_day"])


@query(
    "schema_size_history",
    f"SELECT DISTINCT CAST(r.run_key%7 AS INT) AS size_gb, CAST(r.run_ts AS DATE) AS run_day FROM fx_run r WHERE {RECENT_SQL}",
)
def schema_size_history(spark, sf):
    log = i.runs(spark, sf)
    sizes = log.select("run_key", (F.col("run_key") % 7).alias("size_gb"))
    return reports.recent_schema_sizes(sizes, log, i.AS_OF)


@query(
    "schema_sizes_sql",
    f"SELECT DISTINCT CAST(r.run_key%7 AS INT) AS size_gb, CAST(r.run_ts AS DATE) AS run_day FROM fx_run r WHERE {RECENT_SQL}",
)
def schema_sizes_sql(spark, sf):
    log = i.runs(spark, sf)
    sizes = log.select("run_key", (F.col("run_key") % 7).alias("size_gb"))
    return Dashboards(spark).schema_sizes(sizes, log, i.AS_OF)


@query(
    "run_status",
    """SELECT concat('control_',CAST(k.control_type AS VARCHAR)) AS control, CASE WHEN max(CASE WHEN CAST(r.run_ts AS DATE)=DATE '2001-08-01' THEN 1 ELSE 0 END)=1 THEN 'OK' ELSE 'NOK' END AS status
 FROM (SELECT DISTINCT control_type FROM fx_run) k LEFT JOIN fx_run r ON k.control_type=r.control_type GROUP BY 1""",
)
def run_status(spark, sf):
    log = i.runs(spark, sf)
    name = F.concat(F.lit("control_"), F.col("control_type").cast("string"))
    keys = log.select(name.alias("control"), "run_key")
    days = monitoring.run_days(keys, log)
    return monitoring.run_status(keys.select("control").distinct(), days, i.AS_OF)


def _tables_by_name(spark, sf):
    """Result tables of several controls, one of them without a run key."""
    orders = i.orders(spark, sf)
    return {
        "orders": orders.select(F.col("OBJECT_ID").alias("run_key"), "PARENT_ID"),
        "relations": i.relations(spark, sf).select(F.col("REL_CUST").alias("run_key"), "NAME"),
        "warning_orders": orders.select(F.col("OBJECT_ID").alias("run_key")),
        "Historico_orders": orders.select(F.col("OBJECT_ID").alias("run_key")),
        "accounts": i.accounts(spark, sf),
    }


TABLE_DAYS_SQL = """SELECT DISTINCT k.control, CAST(r.run_ts AS DATE) AS "day" FROM (SELECT 'orders' AS control, OBJECT_ID AS run_key FROM fx_order UNION ALL SELECT 'relations', REL_CUST FROM fx_relation
 UNION ALL SELECT 'warning_orders', OBJECT_ID FROM fx_order UNION ALL SELECT 'Historico_orders', OBJECT_ID FROM fx_order) k JOIN fx_run r ON k.run_key=r.run_key"""


@query("control_run_days", TABLE_DAYS_SQL)
def control_run_days(spark, sf):
    keys = monitoring.result_run_keys(_tables_by_name(spark, sf))
    return monitoring.run_days(keys, i.runs(spark, sf))


@query(
    "missed_days",
    f"""SELECT c.control, CAST(d."day" AS DATE) AS "day" FROM (SELECT DISTINCT control FROM ({TABLE_DAYS_SQL}) x) c,
 (SELECT unnest(generate_series((SELECT min(CAST(run_ts AS DATE)) FROM fx_run), (SELECT max(CAST(run_ts AS DATE)) FROM fx_run), INTERVAL 1 DAY)) AS "day") d
 WHERE dayofweek(d."day") BETWEEN 1 AND 5 AND NOT EXISTS (SELECT 1 FROM ({TABLE_DAYS_SQL}) t WHERE t.control=c.control AND t."day"=CAST(d."day" AS DATE))""",
)
def missed_days(spark, sf):
    """Working days without a run of each control, from bitmaps of two nights' merge."""
    log = i.runs(spark, sf)
    days = monitoring.run_days(monitoring.result_run_keys(_tables_by_name(spark, sf)), log)
    parts = [monitoring.day_bitmaps(days.where(F.dayofmonth("day") % 2 == n)) for n in (0, 1)]
    run_day = F.col("run_ts").cast("date")
    span = [log.agg(f(run_day)).scalar() for f in (F.min, F.max)]
    return monitoring.missed_days(monitoring.merged_bitmaps(*parts), *span, weekdays=True)


@query(
    "operations_status",
    f"""SELECT control, CASE WHEN max(CASE WHEN "day"=DATE '2001-08-01' THEN 1 ELSE 0 END)=1 THEN 'OK' ELSE 'NOK' END AS status FROM ({TABLE_DAYS_SQL}) d
 WHERE control NOT LIKE '%arning%' AND control NOT LIKE 'Historico!_%' ESCAPE '!' GROUP BY 1""",
)
def operations_status(spark, sf):
    control = Operations(
        _tables_by_name(spark, sf), i.runs(spark, sf), i.relation_sizes(spark, sf), "results", i.AS_OF
    )
    return control.compute()["run_status"]


@query(
    "schema_size",
    f"""SELECT CASE WHEN p LIKE '%TB' THEN n*1024 WHEN p LIKE '%GB' THEN n WHEN p LIKE '%MB' THEN n//1024 WHEN p LIKE '%kB' THEN n//1048576 ELSE n//1073741824 END AS size_gb
 FROM (SELECT p, CAST(split_part(p,' ',1) AS BIGINT) AS n FROM (SELECT {i.PRETTY_SQL} AS p FROM (SELECT CAST(sum(bytes) AS BIGINT) AS b FROM fx_relation_size WHERE "schema"='results') x) y) z""",
)
def schema_size(spark, sf):
    return monitoring.schema_size(i.relation_sizes(spark, sf), "results")


@query(
    "table_sizes",
    f"""SELECT p AS size, CASE WHEN p LIKE '%TB' THEN n*1073741824 WHEN p LIKE '%GB' THEN n*1048576 WHEN p LIKE '%MB' THEN n*1024 WHEN p LIKE '%kB' THEN n ELSE n//1024 END AS size_kb, relation AS name
 FROM (SELECT relation, p, CAST(split_part(p,' ',1) AS BIGINT) AS n FROM (SELECT relation, {i.PRETTY_SQL} AS p FROM (SELECT relation, bytes AS b FROM fx_relation_size
 WHERE "schema" NOT IN ('pg_catalog','information_schema') AND "schema" NOT LIKE 'pg_toast%' AND kind<>'i') x) y) z
 WHERE relation IN (SELECT concat(p_name,'_',CAST(p_partkey AS VARCHAR)) FROM part WHERE p_type<>'PROMO')""",
)
def table_sizes(spark, sf):
    names = i.table(spark, sf, "part").where("p_type <> 'PROMO'").select(
        F.concat("p_name", F.lit("_"), F.col("p_partkey").cast("string")).alias("name")
    )
    return monitoring.table_sizes(i.relation_sizes(spark, sf), names)


RECORDS_PER_DOCUMENT = 20_000


def _event_documents(spark, sf):
    """Daily documents made of the events, about RECORDS_PER_DOCUMENT records in each.

    A day's records are dealt to its documents by their content, so the number of documents
    follows that of the records, in whatever order the ids came.
    The value is left out on every third day and the type renamed from the
    20th day on, so the fields drift; some user ids carry a control byte.
    """
    events = i.table(spark, sf, "events")
    day = F.col("ts").cast("date")
    late = F.dayofyear(day) >= 20
    record = F.struct(
        "event_id",
        F.when(~late, F.col("event_type")).alias("event_type"),
        F.when(late, F.col("event_type")).alias("kind"),
        F.when(F.dayofyear(day) % 3 != 0, F.col("value")).alias("value"),
        F.concat(F.lit("u\x7f"), F.col("user_id").cast("string")).alias("user"),
    )
    dated = events.select(day.alias("day"), F.xxhash64("event_id", "ts", "user_id", "event_type", "value").alias("content"), record.alias("record"))
    sizes = events.groupBy(day.alias("_day")).agg(F.ceil(F.count("*") / RECORDS_PER_DOCUMENT).alias("documents"))
    dealt = dated.join(sizes, F.col("day").eqNullSafe(F.col("_day")))
    chunk = F.pmod("content", "documents").alias("chunk")
    grouped = dealt.groupBy("day", chunk).agg(F.collect_list("record").alias("records"))
    return grouped.select("day", F.to_json(F.struct("records")).alias("content"))


EVENT_SCHEMA = "event_id long, event_type string, kind string, value double, user string"
EVENT_FIELDS = "event_id: long, event_type: string, kind: string, value: double, user: string"


@query(
    "json_records",
    """SELECT CAST(ts AS DATE) AS "day", event_id, CASE WHEN dayofyear(ts)<20 THEN event_type END AS event_type, CASE WHEN dayofyear(ts)>=20 THEN event_type END AS kind,
 CASE WHEN dayofyear(ts)%3<>0 THEN value END AS value, concat('u',CAST(user_id AS VARCHAR)) AS "user" FROM events""",
)
def json_records(spark, sf):
    records = record_texts(_event_documents(spark, sf), printable(F.col("content")), "day")
    return typed_records(records, EVENT_SCHEMA, "day")


@query(
    "json_drift",
    """SELECT d."day", CAST(code_added+code_removed AS INT) AS code, added, removed FROM (
 SELECT d."day", coalesce(string_agg(CASE WHEN s.since=d."day" AND s.since>f.first_day THEN s.col END, ',' ORDER BY s.col),'') AS added,
 coalesce(string_agg(CASE WHEN s.since<d."day" AND p.col IS NULL THEN s.col END, ',' ORDER BY s.col),'') AS removed,
 max(CASE WHEN s.since=d."day" AND s.since>f.first_day THEN 1 ELSE 0 END) AS code_added, max(CASE WHEN s.since<d."day" AND p.col IS NULL THEN 2 ELSE 0 END) AS code_removed
 FROM (SELECT DISTINCT "day" FROM fx_presence) d CROSS JOIN (SELECT min("day") AS first_day FROM fx_presence) f
 CROSS JOIN (SELECT col, min("day") AS since FROM fx_presence GROUP BY 1) s LEFT JOIN fx_presence p ON p."day"=d."day" AND p.col=s.col GROUP BY 1) d""",
)
def json_drift(spark, sf):
    records = record_texts(_event_documents(spark, sf), printable(F.col("content")), "day")
    report = drift_by_day(column_presence(records, "day"), "day", "column")
    return report.withColumns({c: F.array_join(c, ",") for c in ("added", "removed")})


NESTED_RETYPED = "meta.source.id"


@query(
    "nested_drift",
    f"""WITH e AS (SELECT CAST(ts AS DATE) AS "day", dayofyear(ts) AS n, value FROM events),
 p AS (SELECT DISTINCT "day", 'meta.source.score' AS col FROM e WHERE n%3<>0 AND value IS NOT NULL UNION SELECT DISTINCT "day", 'meta.tags[].weight' FROM e WHERE n>=20),
 f AS (SELECT min("day") AS first_day FROM e), s AS (SELECT col, min("day") AS since FROM p GROUP BY 1),
 t AS (SELECT "day", CASE WHEN late<>lag(late) OVER (ORDER BY "day") THEN '{NESTED_RETYPED}' ELSE '' END AS retyped FROM (SELECT DISTINCT "day", n>=20 AS late FROM e))
 SELECT d."day", CAST(max(CASE WHEN s.since=d."day" AND s.since>f.first_day THEN 1 ELSE 0 END)+max(CASE WHEN s.since<d."day" AND p.col IS NULL THEN 2 ELSE 0 END) AS INT) AS code,
 coalesce(string_agg(CASE WHEN s.since=d."day" AND s.since>f.first_day THEN s.col END, ',' ORDER BY s.col),'') AS added,
 coalesce(string_agg(CASE WHEN s.since<d."day" AND p.col IS NULL THEN s.col END, ',' ORDER BY s.col),'') AS removed, max(t.retyped) AS retyped
 FROM (SELECT DISTINCT "day" FROM e) d CROSS JOIN f CROSS JOIN s LEFT JOIN p ON p."day"=d."day" AND p.col=s.col JOIN t ON t."day"=d."day" GROUP BY 1""",
)
def nested_drift(spark, sf):
    """Inner fields that come and go, one of an array's elements among them, and one that turns to text."""
    events = i.table(spark, sf, "events")
    late, day = F.dayofyear("ts") >= 20, F.col("ts").cast("date")
    score = F.when(F.dayofyear("ts") % 3 != 0, F.col("value")).alias("score")

    def record(user, *weight):
        source = F.struct(user.alias("id"), score).alias("source")
        tags = F.array(F.struct("event_type", *weight)).alias("tags")
        return F.to_json(F.struct("event_id", F.struct(source, tags).alias("meta")))

    early_record, late_record = record(F.col("user_id")), record(F.col("user_id").cast("string"), F.col("event_id").alias("weight"))
    records = events.select(day.alias("day"), F.when(late, late_record).otherwise(early_record).alias("record"))
    lists = ("added", "removed", "retyped")
    return nested_drift_report(records, "day").withColumns({c: F.array_join(c, ",") for c in lists})


def _written_documents(spark, sf) -> tuple[str, list[dt.date]]:
    """The events' documents as files below year=/month=/day=, and their days.

    Stray bytes: a byte that is no UTF-8 and a control character before each user id.
    """
    documents = _event_documents(spark, sf).select("day", F.from_json("content", f"records array<struct<{EVENT_FIELDS}>>").alias("c"))
    stray = documents.select("day", F.transform("c.records", lambda r: r.withField("user", F.replace(r["user"], F.lit("u"), F.lit("\xe9u")))).alias("records"))
    parts = {"year": F.year("day"), "month": F.month("day"), "dom": F.dayofmonth("day")}
    path = new_work_path(spark, "documents")
    writer = stray.withColumns(parts).drop("day").write.partitionBy(*parts).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", 1).json(path)
    return path, sorted(r.day for r in documents.select("day").distinct().collect())


@query(
    "json_incremental",
    """SELECT CAST(ts AS DATE) AS "day", event_id, CASE WHEN dayofyear(ts)<20 THEN event_type END AS event_type, CASE WHEN dayofyear(ts)>=20 THEN event_type END AS kind,
 CASE WHEN dayofyear(ts)%3<>0 THEN value END AS value, concat('u',CAST(user_id AS VARCHAR)) AS "user",
 CAST(CASE WHEN CAST(ts AS DATE)=(SELECT max(CAST(ts AS DATE)) FROM events) THEN 1 ELSE 0 END AS BIGINT) AS batch FROM events""",
)
def json_incremental(spark, sf):
    """All days but the last are taken in, then the last one arrives and is taken in by itself."""
    written, days = _written_documents(spark, sf)
    base = Folder(spark, new_work_path(spark, "arrived"))
    landing = Landing(spark, base.root, new_work_path(spark, "landed"), "*.json")
    for arriving in (days[:-1], days[-1:]):
        for d in arriving:
            base.take_in(f"{written}/year={d.year}/month={d.month}/dom={d.day}", f"{d.year}/{d.month}/{d.day}")
        landing.ingest()
    return landing.records(EVENT_SCHEMA)


@query(
    "crm_csv_export",
    "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_mktsegment='BUILDING' THEN 'NULL' ELSE c_mktsegment END AS segment, CASE WHEN c_acctbal>=0 THEN c_acctbal END AS balance FROM customer",
)
def crm_csv_export(spark, sf):
    """Export with empty and null cells, read back as text."""
    customers = i.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    path = new_work_path(spark, "export")
    export_csv(customers, path)
    return read_delimited(spark, path, ";", customers.schema)


@query(
    "pipe_file",
    "SELECT p_partkey AS part_id, p_name AS part_name, p_retailprice AS price FROM part",
)
def pipe_file(spark, sf):
    path = new_work_path(spark, "pipe")
    parts = i.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    parts.write.option("sep", "|").csv(path)
    names = [("part", 0, "part_id"), ("part", 1, "part_name"), ("part", 2, "price"), ("other", 0, "x")]
    dictionary = spark.createDataFrame(names, "table string, position int, name string")
    return read_pipe(spark, path, dictionary, "part", ["bigint", "string", "double"])


@query(
    "comma_file",
    """SELECT c_custkey AS id, concat(c_name,', "',c_mktsegment,'"; ') AS label, CASE WHEN c_acctbal>=0 THEN c_acctbal END AS balance FROM customer""",
)
def comma_file(spark, sf):
    """Comma-separated file whose texts hold commas, quotes and trailing spaces."""
    path = new_work_path(spark, "comma")
    label = F.format_string('%s, "%s"; ', "c_name", "c_mktsegment").alias("label")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    customers = i.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), label, balance)
    customers.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_comma(spark, path, customers.schema)


@query("crm_parquet", "SELECT * FROM crm_latest")
def crm_parquet(spark, sf):
    """CRM extract under its physical column names, stored as parquet and reconciled."""
    base = new_work_path(spark, "crm")
    extract = i.crm(spark, sf).withColumnsRenamed(fv.CRM_COLUMNS)
    extract.write.parquet(f"{base}/Account.parquet")
    return latest_crm(to_logical(read_crm_parquet(spark, base, "Account"), fv.CRM_COLUMNS))


@query(
    "dataset_history",
    """SELECT p_name AS Name, p_brand AS Id, p_type AS ImportMode, p_partkey AS Size, d AS Fecha FROM part, (SELECT '1/8/2001' AS d UNION ALL SELECT '31/7/2001') x""",
)
def dataset_history(spark, sf):
    datasets = i.table(spark, sf, "part").select(
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("Id"),
        F.col("p_type").alias("ImportMode"),
        F.col("p_partkey").alias("Size"),
    )
    first, second = new_work_path(spark, "sizes"), new_work_path(spark, "sizes")
    snapshot(datasets, i.AS_OF - dt.timedelta(days=1)).write.option("header", True).csv(first)
    return refresh_history(spark, snapshot(datasets, i.AS_OF), first, second)


@query(
    "history_swap",
    """SELECT p_name AS Name, p_brand AS Id, p_type AS ImportMode, p_partkey AS Size, d AS Fecha FROM part, (SELECT '1/8/2001' AS d UNION ALL SELECT '30/7/2001') x""",
)
def history_swap(spark, sf):
    """Three refreshes of a history; the second breaks off while it writes."""
    datasets = i.table(spark, sf, "part").select(
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("Id"),
        F.col("p_type").alias("ImportMode"),
        F.col("p_partkey").alias("Size"),
    )
    largest = datasets.agg(F.max("Size")).scalar()
    broken = F.when(F.col("Size") == largest, F.raise_error(F.lit("refresh broke off"))).otherwise(F.col("Size"))
    history = History(spark, new_work_path(spark, "history"))
    for back in (2, 1, 0):
        rows = snapshot(datasets.withColumn("Size", broken) if back == 1 else datasets, i.AS_OF - dt.timedelta(days=back))
        try:
            history.refresh(rows)
        except PySparkException:
            if back != 1:
                raise
    return history.read(rows.schema)


def _store(spark, **partitions):
    store = FolderStore(spark, new_work_path(spark, "store"), partitions)
    publish.create_run_tables(store)
    return store


@query(
    "published_run",
    """SELECT f.*, CAST(1 AS BIGINT) AS run_key, CAST(53 AS INT) AS control_type, (SELECT count(*) FROM fx_order) AS row_count, DATE '2001-08-01' AS run_day FROM fx_order f""",
)
def published_run(spark, sf):
    """Two runs of a control, and the report of the latest."""
    store = _store(spark, orders="run_key")
    orders = i.orders(spark, sf)
    publish.publish_run(store, orders.where("PARENT_ID IS NULL"), "orders", 53, run_ts=RUN_TS)
    publish.publish_run(store, orders, "orders", 53, attribute_keys=[11, 2], run_ts=RUN_TS)
    log = store.read(publish.RUN_LOG)
    latest = reports.with_run_day(reports.of_latest_run(store.read("orders")), log)
    facts = log.select(F.col("run_key").alias("logged"), "control_type", "row_count")
    return latest.join(facts, F.col("run_key") == F.col("logged")).drop("logged").select(
        "OBJECT_ID", "PARENT_ID", F.col("run_key").cast("long"), "control_type", "row_count", "run_day"
    )


@query(
    "published_rows",
    "SELECT OBJECT_ID, PARENT_ID, row_number() OVER (ORDER BY OBJECT_ID)-1 AS run_key, CAST(7 AS INT) AS control_type FROM fx_order",
)
def published_rows(spark, sf):
    """A run row for every result row."""
    store = _store(spark)
    publish.publish_rows(store, i.orders(spark, sf), "orders", 7, ["OBJECT_ID"], RUN_TS)
    log = store.read(publish.RUN_LOG).select(F.col("run_key").alias("logged"), "control_type")
    return store.read("orders").join(log, F.col("run_key") == F.col("logged")).drop("logged")


@query(
    "concurrent_claims",
    """SELECT OBJECT_ID, CAST(OBJECT_ID%4 AS INT) AS slice, CASE WHEN OBJECT_ID%4=3 THEN NULL ELSE count(*) OVER (PARTITION BY OBJECT_ID%4) END AS row_count,
 CAST(0 AS BIGINT) AS low_key, (SELECT 2+count(*) FROM fx_order WHERE OBJECT_ID%4=3) AS high_key, (SELECT 3+count(*) FROM fx_order WHERE OBJECT_ID%4=3) AS n_keys FROM fx_order""",
)
def concurrent_claims(spark, sf):
    """Four publishers at once, three with a key a run and one with a key a row.

    Whoever comes first, the keys of all are distinct and have no gap.
    """
    store = _store(spark, orders="run_key")
    orders = i.orders(spark, sf).withColumn("slice", (F.col("OBJECT_ID") % 4).cast("int"))

    def publisher(n):
        rows = orders.where(F.col("slice") == n)
        if n < 3:
            return publish.publish_run(store, rows, "orders", 53, run_ts=RUN_TS)
        return publish.publish_rows(store, rows, "order_rows", 7, ["OBJECT_ID"], RUN_TS)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(inheritable_thread_target(spark)(publisher), range(4)))
    log = store.read(publish.RUN_LOG)
    facts = {"low_key": F.min("run_key"), "high_key": F.max("run_key"), "n_keys": F.count_distinct("run_key")}
    columns = ["OBJECT_ID", "slice", F.col("run_key").cast("long").alias("run_key")]
    rows = store.read("orders").select(*columns).union(store.read("order_rows").select(*columns))
    rows = rows.join(log.select("run_key", "row_count"), "run_key").drop("run_key")
    return rows.withColumns({name: log.agg(fact).scalar() for name, fact in facts.items()})


@query(
    "replaced_run",
    """SELECT OBJECT_ID, coalesce(PARENT_ID,-1) AS PARENT_ID, CAST(1 AS BIGINT) AS run_key, (SELECT count(*) FROM fx_order) AS row_count FROM fx_order
 UNION ALL SELECT OBJECT_ID, PARENT_ID, CAST(2 AS BIGINT), (SELECT count(*) FROM fx_order WHERE PARENT_ID IS NULL) FROM fx_order WHERE PARENT_ID IS NULL""",
)
def replaced_run(spark, sf):
    """Three runs; the second is replaced by a corrected one, the first is dropped."""
    store = _store(spark, orders="run_key")
    orders = i.orders(spark, sf)
    publish.publish_run(store, orders, "orders", 53, run_ts=RUN_TS)
    key = publish.publish_run(store, orders.where("PARENT_ID IS NOT NULL"), "orders", 53, run_ts=RUN_TS)
    publish.publish_run(store, orders.where("PARENT_ID IS NULL"), "orders", 53, run_ts=RUN_TS)
    publish.replace_run(store, orders.withColumn("PARENT_ID", F.coalesce("PARENT_ID", F.lit(-1))), "orders", key)
    store.drop_run("orders", 0)
    log = store.read(publish.RUN_LOG).select("run_key", "row_count")
    rows = store.read("orders").withColumn("run_key", F.col("run_key").cast("long"))
    return rows.join(log, "run_key").select("OBJECT_ID", "PARENT_ID", "run_key", "row_count")


@query(
    "catalog_run",
    """SELECT OBJECT_ID, PARENT_ID, CAST(1 AS BIGINT) AS run_key, (SELECT count(*) FROM fx_order) AS row_count FROM fx_order
 UNION ALL SELECT OBJECT_ID, PARENT_ID, CAST(2 AS BIGINT), (SELECT count(*) FROM fx_order WHERE PARENT_ID IS NULL) FROM fx_order WHERE PARENT_ID IS NULL""",
)
def catalog_run(spark, sf):
    """Three runs in tables of the session catalog, the first of them dropped."""
    database = f"runs_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_work_path(spark, 'catalog')}'")
    store = CatalogStore(spark, database, {"orders": "run_key"})
    publish.create_run_tables(store)
    orders = i.orders(spark, sf).select("OBJECT_ID", "PARENT_ID")
    for rows in (orders.where("PARENT_ID IS NOT NULL"), orders, orders.where("PARENT_ID IS NULL")):
        publish.publish_run(store, rows, "orders", 53, run_ts=RUN_TS)
    store.drop_run("orders", 0)
    log = store.read(publish.RUN_LOG).select("run_key", "row_count")
    return store.read("orders").join(log, "run_key").select("OBJECT_ID", "PARENT_ID", "run_key", "row_count")


@query(
    "status_history",
    f"""SELECT s.status, s.control, s.run_key, CAST({fv.CONTROL_TYPES["run_status"]} AS INT) AS control_type, CAST(1 AS BIGINT) AS row_count, DATE '2001-08-01' AS run_day FROM (
 SELECT CASE WHEN EXISTS (SELECT 1 FROM fx_order WHERE OBJECT_ID IS NULL) THEN 'NOK' ELSE 'OK' END AS status, 'orders have ids' AS control, CAST(0 AS BIGINT) AS run_key
 UNION ALL SELECT CASE WHEN EXISTS (SELECT 1 FROM fx_order WHERE PARENT_ID IS NULL) THEN 'NOK' ELSE 'OK' END, 'orders have customers', CAST(1 AS BIGINT)) s""",
)
def status_history(spark, sf):
    """Two conditions on all orders, each recorded as OK or NOK under a run key."""
    store = _store(spark)
    orders = i.orders(spark, sf)
    for control, column in (("orders have ids", "OBJECT_ID"), ("orders have customers", "PARENT_ID")):
        publish.publish_status(store, orders.where(F.col(column).isNull()).isEmpty(), control, RUN_TS)
    log = store.read(publish.RUN_LOG)
    history = reports.with_run_day(store.read(publish.STATUS_HISTORY), log)
    facts = log.select(F.col("run_key").alias("logged"), "control_type", "row_count")
    joined = history.join(facts, F.col("run_key") == F.col("logged"))
    return joined.select("status", "control", F.col("run_key").cast("long"), "control_type", "row_count", "run_day")
