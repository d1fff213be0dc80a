"""Queries of single operators and expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallymark.checks import inputs as i
from tallymark.checks.registry import query
from tallymark.functions import calendar as cal
from tallymark.functions import predicates as p
from tallymark.functions import sizes, text
from tallymark.operators import drift, exception_rules, matching, shape, tables, versions
from tallymark.operators.keys import dense_keys, next_key
from tallymark.plans.customer_flags import named_accounts
from tallymark.plans.reconciliation import order_counts
from tallymark.session import written_once
from tallymark.sinks.version_state import VersionState


@query(
    "names_and_prefixes",
    """SELECT OBJECT_ID, NAME IS NOT NULL AND NAME NOT IN (' -','-','--') AS is_named, TAX_IDENT_NUMBER LIKE 'ACCT%' AS has_prefix,
 TAX_IDENT_NUMBER IS NULL OR TAX_IDENT_NUMBER NOT LIKE 'ACCT%' AS lacks_prefix, ltrim(NAME) AS trimmed FROM fx_account""",
)
def names_and_prefixes(spark, sf):
    tax_id = F.col("TAX_IDENT_NUMBER")
    return i.accounts(spark, sf).select(
        "OBJECT_ID",
        p.named(F.col("NAME")).alias("is_named"),
        p.has_prefix(tax_id, "ACCT").alias("has_prefix"),
        p.lacks_prefix_or_null(tax_id, "ACCT").alias("lacks_prefix"),
        F.ltrim("NAME").alias("trimmed"),
    )


@query(
    "not_in_drops_null",
    "SELECT OBJECT_ID, PRODUCT_CODE FROM fx_service WHERE PRODUCT_CODE NOT IN ('PROMO','SMALL')",
)
def not_in_drops_null(spark, sf):
    services = i.services(spark, sf)
    return services.where(p.outside(F.col("PRODUCT_CODE"), i.FLAG_CODES)).select("OBJECT_ID", "PRODUCT_CODE")


@query(
    "text_cleanup",
    """SELECT OBJECT_ID, split_part(split_part(NAME,'Instance',1),'#',1) AS label, concat(substr(NAME,1,2),'_',substr(NAME,4)) AS replaced FROM fx_service""",
)
def text_cleanup(spark, sf):
    name = F.col("NAME")
    return i.services(spark, sf).select(
        "OBJECT_ID", text.service_label(name).alias("label"), text.replace_at(name, 2, "_").alias("replaced")
    )


@query(
    "account_labels",
    """SELECT OBJECT_ID, s AS status, CASE CUST_TYPE WHEN 101 THEN 'Holding' WHEN 102 THEN 'Legal Entity' WHEN 103 THEN 'Customer Country' ELSE CAST(CUST_TYPE AS VARCHAR) END AS type_name,
 split_part('a.' || NAME,'.',-1) AS last_part FROM cleaned_account""",
)
def account_labels(spark, sf):
    return i.accounts(spark, sf).select(
        "OBJECT_ID",
        text.plain_status(F.col("STATUS")).alias("status"),
        text.type_label(F.col("CUST_TYPE"), i.TYPE_LABELS).alias("type_name"),
        text.last_segment(F.concat(F.lit("a."), "NAME")).alias("last_part"),
    )


@query(
    "synthetic_seconds",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS DOUBLE)*31536000+(month(o_orderdate)-1)*2628000.0E0+(day(o_orderdate)-1)*86400+hour(o_orderdate)*3600+minute(o_orderdate)*60+second(o_orderdate) AS secs FROM orders""",
)
def synthetic_seconds(spark, sf):
    return i.table(spark, sf, "orders").select(
        "o_orderkey", cal.synthetic_seconds(F.col("o_orderdate")).alias("secs")
    )


@query(
    "back_conversion",
    """SELECT l_orderkey, l_linenumber, make_timestamp(CAST(1970-CASE WHEN s<62167219200 THEN ceil((62167219200-s)/31536000.0) ELSE 0 END AS BIGINT),1,1,0,0,0) AS legacy,
 make_timestamp(l_orderkey*1000000) AS instant FROM (SELECT *, CAST(60000000000+l_partkey*1000000 AS BIGINT) AS s FROM lineitem) q""",
)
def back_conversion(spark, sf):
    lines = i.table(spark, sf, "lineitem")
    seconds = F.lit(60000000000) + F.col("l_partkey") * 1000000
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        cal.epoch_minus_years(seconds).alias("legacy"),
        F.convert_timezone(
            None, F.lit("UTC"), cal.instant(F.col("l_orderkey")).cast("timestamp_ntz")
        ).alias("instant"),
    )


@query(
    "prev_business_day",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_orderdate AS DATE) - CASE WHEN isodow(CAST(o_orderdate AS DATE))=1 THEN 3 ELSE 1 END AS DATE) AS p FROM orders""",
)
def prev_business_day(spark, sf):
    days = i.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.withColumn("p", cal.previous_run_day(F.col("d"), weekend_aware=True))


@query(
    "day_texts",
    """SELECT o_orderkey, strftime(o_orderdate,'%Y-%m-%d') AS iso, strftime(o_orderdate,'%-d/%-m/%Y') AS short, CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS yesterday FROM orders""",
)
def day_texts(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return i.table(spark, sf, "orders").select(
        "o_orderkey",
        cal.iso_day(day).alias("iso"),
        cal.short_day(day).alias("short"),
        cal.previous_run_day(day, weekend_aware=False).alias("yesterday"),
    )


SIZE_TEXT_SQL = """SELECT l_orderkey, l_linenumber, concat(CAST(l_orderkey AS VARCHAR),CASE l_linenumber%4 WHEN 0 THEN ' kB' WHEN 1 THEN ' MB' WHEN 2 THEN ' GB' ELSE ' bytes' END) AS x, l_orderkey AS n, l_linenumber%4 AS u FROM lineitem"""


@query(
    "size_parse",
    f"""SELECT l_orderkey, x, CASE u WHEN 0 THEN n WHEN 1 THEN n*1024 WHEN 2 THEN n*1048576 ELSE n//1024 END AS kb,
 CASE u WHEN 0 THEN n//1048576 WHEN 1 THEN n//1024 WHEN 2 THEN n ELSE n//1073741824 END AS gb FROM ({SIZE_TEXT_SQL}) q""",
)
def size_parse(spark, sf):
    unit = F.element_at(
        F.array(*map(F.lit, [" kB", " MB", " GB", " bytes"])), F.col("l_linenumber") % 4 + 1
    )
    sized = i.table(spark, sf, "lineitem").select(
        "l_orderkey", F.concat(F.col("l_orderkey").cast("string"), unit).alias("x")
    )
    size = F.col("x")
    return sized.select("l_orderkey", "x", sizes.size_in_kb(size).alias("kb"), sizes.size_in_gb(size).alias("gb"))


@query(
    "pretty_sizes",
    f"SELECT l_orderkey, b, {i.PRETTY_SQL} AS pretty FROM (SELECT l_orderkey, l_orderkey*l_partkey*l_suppkey*l_linenumber AS b FROM lineitem) q",
)
def pretty_sizes(spark, sf):
    product = F.col("l_orderkey") * F.col("l_partkey") * F.col("l_suppkey") * F.col("l_linenumber")
    sized = i.table(spark, sf, "lineitem").select("l_orderkey", product.alias("b"))
    return sized.withColumn("pretty", sizes.pretty_size(F.col("b")))


@query(
    "join_or",
    "SELECT a.OBJECT_ID,b.REL_CUST,b.PARENT_ID FROM fx_account a JOIN fx_relation b ON a.OBJECT_ID=b.PARENT_ID OR a.OBJECT_ID=b.REL_CUST",
)
def join_or(spark, sf):
    accounts = i.accounts(spark, sf).select("OBJECT_ID")
    relations = i.relations(spark, sf).select("PARENT_ID", "REL_CUST")
    return matching.match_either(accounts, relations, "OBJECT_ID", "PARENT_ID", "REL_CUST")


@query(
    "semi_neq",
    "SELECT o_orderkey, o_custkey FROM orders o WHERE EXISTS (SELECT 1 FROM (SELECT max(c_custkey) AS k FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) c WHERE c.k<>o.o_custkey)",
)
def semi_neq(spark, sf):
    """Orders of customers other than the last one that ordered."""
    orders = i.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = i.table(spark, sf, "customer").select("c_custkey")
    ordering = matching.match_semi(customers, orders, "c_custkey", "o_custkey")
    last = ordering.agg(F.max("c_custkey").alias("k"))
    return matching.match_differs(orders, last, "o_custkey", "k")


@query(
    "semi_neq_many",
    "SELECT s_suppkey, s_nationkey FROM supplier s WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey<>s.s_nationkey)",
)
def semi_neq_many(spark, sf):
    suppliers = i.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return matching.match_differs(suppliers, i.table(spark, sf, "customer"), "s_nationkey", "c_nationkey")


@query(
    "left_match",
    "SELECT a.OBJECT_ID, o.ord_customer, o.n_ord FROM fx_account a LEFT JOIN ord_count o ON CAST(a.OBJECT_ID AS VARCHAR)=o.ord_customer",
)
def left_match(spark, sf):
    accounts = i.accounts(spark, sf).select("OBJECT_ID")
    return matching.match_left(accounts, order_counts(i.orders(spark, sf)), "OBJECT_ID", "ord_customer")


@query(
    "semi_match",
    "SELECT OBJECT_ID, PARENT_ID FROM fx_order f WHERE EXISTS (SELECT 1 FROM named_account a WHERE a.OBJECT_ID=f.PARENT_ID)",
)
def semi_match(spark, sf):
    return matching.match_semi(i.orders(spark, sf), named_accounts(i.accounts(spark, sf)), "PARENT_ID", "OBJECT_ID")


@query(
    "anti_match",
    "SELECT OBJECT_ID, PARENT_ID FROM fx_order f WHERE NOT EXISTS (SELECT 1 FROM named_account a WHERE a.OBJECT_ID=f.PARENT_ID)",
)
def anti_match(spark, sf):
    return matching.match_anti(i.orders(spark, sf), named_accounts(i.accounts(spark, sf)), "PARENT_ID", "OBJECT_ID")


@query(
    "anti_match_where",
    "SELECT OBJECT_ID, PARENT_ID FROM fx_order f WHERE NOT EXISTS (SELECT 1 FROM fx_relation r WHERE r.REL_CUST=f.PARENT_ID AND r.REL_TYPE=1)",
)
def anti_match_where(spark, sf):
    return matching.match_anti_where(
        i.orders(spark, sf), i.relations(spark, sf), "PARENT_ID", "REL_CUST", "REL_TYPE", i.PARENT_OF
    )


@query(
    "hot_match",
    "SELECT s.CUSTOMER_ACCOUNT, s.PRODUCT_CODE, a.type_id, a.n_accounts FROM fx_service s LEFT JOIN (SELECT PRODUCT_CODE AS type_id, count(*) AS n_accounts FROM fx_service GROUP BY 1) a ON s.PRODUCT_CODE=a.type_id",
)
def hot_match(spark, sf):
    """Join on a column with a handful of values, every one of them hot."""
    services = written_once(i.services(spark, sf).select("CUSTOMER_ACCOUNT", "PRODUCT_CODE"), "services")
    totals = versions.rows_per(services, ["PRODUCT_CODE"], "n_accounts")
    totals = totals.withColumnRenamed("PRODUCT_CODE", "type_id")
    return matching.match_hot(services, totals, "PRODUCT_CODE", "type_id", "left")


@query(
    "latest_with_null_groups",
    "SELECT UNIQUE_GLOBAL_ID, CUST_CATEGORY, max(MODIFIED_WHEN) AS newest FROM fx_account_version GROUP BY 1,2",
)
def latest_with_null_groups(spark, sf):
    accounts = i.account_versions(spark, sf)
    return versions.latest_version(accounts, ["UNIQUE_GLOBAL_ID", "CUST_CATEGORY"], "MODIFIED_WHEN", "newest")


@query(
    "versions_merged_daily",
    "SELECT OBJECT_ID, NAME, STATUS, UNIQUE_GLOBAL_ID, max(MODIFIED_WHEN) AS MODIFIED_WHEN FROM fx_account_version GROUP BY 1,2,3,4",
)
def versions_merged_daily(spark, sf):
    """A state begun empty, into which three extracts are merged; versions come in no order."""
    versions_of = i.account_versions(spark, sf)
    describe = ["OBJECT_ID", "NAME", "STATUS", "UNIQUE_GLOBAL_ID"]
    name = f"account_state_{uuid.uuid4().hex}"
    state = VersionState(spark, name, describe, "MODIFIED_WHEN", ["OBJECT_ID"], buckets=8)
    state.create(versions_of.limit(0))
    for n in range(3):
        state.merge(versions_of.where(F.dayofyear("MODIFIED_WHEN") % 3 == n))
    return state.read()


@query(
    "products_on_both_sides",
    "SELECT CUSTOMER_ACCOUNT FROM fx_service GROUP BY 1 HAVING sum(CASE WHEN PRODUCT_CODE IN ('PROMO') THEN 1 ELSE 0 END)>0 AND sum(CASE WHEN PRODUCT_CODE NOT IN ('PROMO') THEN 1 ELSE 0 END)>0",
)
def products_on_both_sides(spark, sf):
    return versions.on_both_sides(i.services(spark, sf), "CUSTOMER_ACCOUNT", F.col("PRODUCT_CODE") == "PROMO")


@query("distinct_products", "SELECT DISTINCT PRODUCT_CODE, STATUS FROM fx_service")
def distinct_products(spark, sf):
    return versions.distinct_keys(i.services(spark, sf), "PRODUCT_CODE", "STATUS")


@query(
    "bytes_per_schema",
    'SELECT "schema", CAST(sum(bytes) AS BIGINT) AS total FROM fx_relation_size GROUP BY 1',
)
def bytes_per_schema(spark, sf):
    return versions.total_per(i.relation_sizes(spark, sf), "schema", "bytes", "total")


@query(
    "positional_union",
    "SELECT OBJECT_ID AS id, NAME AS label FROM fx_account UNION ALL SELECT OBJECT_ID, NAME FROM fx_service",
)
def positional_union(spark, sf):
    accounts = i.accounts(spark, sf).select(F.col("OBJECT_ID").alias("id"), F.col("NAME").alias("label"))
    return accounts.union(i.services(spark, sf).select("OBJECT_ID", "NAME"))


@query(
    "ordered_preview",
    "SELECT OBJECT_ID, CUST_CATEGORY, NAME FROM fx_account ORDER BY CUST_CATEGORY, OBJECT_ID LIMIT 10",
)
def ordered_preview(spark, sf):
    accounts = i.accounts(spark, sf).select("OBJECT_ID", "CUST_CATEGORY", "NAME")
    return shape.preview(accounts, "CUST_CATEGORY", 10, ["OBJECT_ID"])


@query("next_run_key", "SELECT coalesce(max(run_key)+1,0) AS next_key FROM fx_run")
def next_run_key(spark, sf):
    return next_key(i.runs(spark, sf), "run_key")


@query(
    "key_alloc",
    "SELECT f.OBJECT_ID,(SELECT coalesce(max(run_key)+1,0) FROM fx_run)+row_number() OVER (ORDER BY f.OBJECT_ID)-1 AS run_key FROM fx_order f",
)
def key_alloc(spark, sf):
    start = next_key(i.runs(spark, sf), "run_key").scalar()
    return dense_keys(i.orders(spark, sf).select("OBJECT_ID"), ["OBJECT_ID"], "run_key", start)


@query(
    "exc_filter",
    "SELECT OBJECT_ID,NAME,CUST_CATEGORY,STATUS FROM fx_account WHERE NOT (CUST_CATEGORY='BUILDING') AND NOT (CUST_CATEGORY='MACHINERY' AND STATUS='Active')",
)
def exc_filter(spark, sf):
    rules = exception_rules.rules_for(**i.rule_tables(spark), control_type=1, exception_type=1)
    accounts = i.accounts(spark, sf).select("OBJECT_ID", "NAME", "CUST_CATEGORY", "STATUS")
    return exception_rules.suppress(accounts, rules)


@query(
    "exc_mark",
    "SELECT OBJECT_ID, CASE WHEN CUST_CATEGORY='FURNITURE' THEN 1 ELSE CAST(OBJECT_ID%2 AS INT) END AS isDuplicate FROM fx_account",
)
def exc_mark(spark, sf):
    rules = exception_rules.rules_for(**i.rule_tables(spark), control_type=1, exception_type=2)
    accounts = i.accounts(spark, sf).withColumn("isDuplicate", (F.col("OBJECT_ID") % 2).cast("int"))
    return exception_rules.mark_duplicates(accounts, rules).select("OBJECT_ID", "isDuplicate")


PART_RULE_HIT = """(r.attr2 IS NULL OR (r.val2=a.CUST_CATEGORY))"""


@query(
    "exc_filter_many",
    f"""SELECT OBJECT_ID,CUST_CATEGORY FROM (SELECT PARENT_ID AS OBJECT_ID, CUST_CATEGORY FROM (SELECT o.PARENT_ID, a.CUST_CATEGORY FROM fx_order o LEFT JOIN fx_account a ON o.PARENT_ID=a.OBJECT_ID) q) a
 WHERE OBJECT_ID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_part_rule r WHERE r.val1=CAST(a.OBJECT_ID AS VARCHAR) AND {PART_RULE_HIT})""",
)
def exc_filter_many(spark, sf):
    """A rule per part, tested on orders some of which have no customer."""
    orders = i.orders(spark, sf).select("PARENT_ID")
    accounts = i.accounts(spark, sf).select("OBJECT_ID", "CUST_CATEGORY")
    tested = matching.match_hot(orders, accounts, "PARENT_ID", "OBJECT_ID", "left").drop("OBJECT_ID")
    tested = tested.withColumnRenamed("PARENT_ID", "OBJECT_ID")
    return exception_rules.suppress(tested, i.part_rules(spark, sf))


@query(
    "exc_mark_many",
    f"""SELECT OBJECT_ID, CASE WHEN EXISTS (SELECT 1 FROM fx_part_rule r WHERE r.val1=CAST(a.OBJECT_ID AS VARCHAR) AND {PART_RULE_HIT}) THEN 1 ELSE 0 END AS isDuplicate FROM fx_account a""",
)
def exc_mark_many(spark, sf):
    accounts = i.accounts(spark, sf).withColumn("isDuplicate", F.lit(0))
    marked = exception_rules.mark_duplicates(accounts, i.part_rules(spark, sf))
    return marked.select("OBJECT_ID", "isDuplicate")


@query(
    "snapshot_append",
    """SELECT event_id,event_type,CAST(NULL AS DOUBLE) AS value FROM events WHERE CAST(ts AS DATE)=(SELECT max(CAST(ts AS DATE)) FROM events)
 UNION ALL SELECT event_id,CAST(NULL AS VARCHAR),value FROM events WHERE CAST(ts AS DATE)<(SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def snapshot_append(spark, sf):
    """The last day ahead of all days before it, whose columns differ."""
    events = i.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    last = events.agg(F.max("day")).scalar()
    new = events.where(F.col("day") == last).select("event_id", "event_type")
    history = events.where(F.col("day") < last).select("event_id", "value")
    return drift.snapshot_union(new, history)


@query(
    "drift_union",
    """SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS props, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_type='click'
 UNION ALL SELECT event_id, CAST(NULL AS VARCHAR), props, concat('u',CAST(user_id AS VARCHAR)), value FROM events WHERE event_type<>'click'""",
)
def drift_union(spark, sf):
    """Two extracts with added, removed and retyped columns."""
    events = i.table(spark, sf, "events")
    first = events.where("event_type = 'click'").select("event_id", "event_type", "user_id")
    second = events.where("event_type <> 'click'").select(
        "event_id", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"), "value", "props"
    )
    return drift.drift_union(first, second).frame


@query("add_columns", "SELECT *, CAST(NULL AS VARCHAR) AS c1, CAST(NULL AS BIGINT) AS c2 FROM fx_order")
def add_columns(spark, sf):
    return tables.add_columns(i.orders(spark, sf), {"c1": "string", "c2": "long"})


@query("delete_where", "SELECT * FROM fx_run WHERE run_key<>42 OR run_key IS NULL")
def delete_where(spark, sf):
    return tables.without_run(i.runs(spark, sf), "run_key", 42)


@query(
    "insert_by_name",
    "SELECT run_ts, control_type, run_key FROM fx_run UNION ALL SELECT CAST(NULL AS TIMESTAMP), CAST(REL_TYPE AS INT), OBJECT_ID FROM fx_relation",
)
def insert_by_name(spark, sf):
    target = i.runs(spark, sf).select("run_ts", "control_type", "run_key")
    older = i.relations(spark, sf).select(
        F.col("OBJECT_ID").alias("run_key"),
        F.col("REL_TYPE").cast("int").alias("control_type"),
        F.lit(None).cast("timestamp_ntz").alias("run_ts"),
    )
    return target.union(tables.rows_for_insert(older, target.columns))


@query(
    "table_from_join",
    "SELECT f.OBJECT_ID, f.PARENT_ID, r.PARENT_ID AS HOLDING_ID, r.NAME FROM fx_order f JOIN fx_relation r ON f.PARENT_ID=r.REL_CUST",
)
def table_from_join(spark, sf):
    columns = {
        "OBJECT_ID": "left.OBJECT_ID",
        "PARENT_ID": "left.PARENT_ID",
        "HOLDING_ID": "right.PARENT_ID",
        "NAME": "right.NAME",
    }
    return tables.joined_table(i.orders(spark, sf), i.relations(spark, sf), "PARENT_ID", "REL_CUST", columns)


@query(
    "orphans",
    "SELECT * FROM fx_order f WHERE NOT EXISTS (SELECT 1 FROM fx_run r WHERE r.run_key=f.OBJECT_ID AND r.control_type<>3)",
)
def orphans(spark, sf):
    log = i.runs(spark, sf).where("control_type <> 3")
    return tables.orphans(i.orders(spark, sf), log, "OBJECT_ID", "run_key")


@query(
    "constraint_violations",
    """SELECT *, 'null key' AS reason FROM fx_order WHERE PARENT_ID IS NULL
 UNION ALL SELECT *, 'unknown run' FROM fx_order f WHERE PARENT_ID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_relation r WHERE r.REL_TYPE=1 AND r.REL_CUST=f.PARENT_ID)""",
)
def constraint_violations(spark, sf):
    log = i.relations(spark, sf).where(F.col("REL_TYPE") == i.PARENT_OF)
    return tables.violations(i.orders(spark, sf), log, "PARENT_ID", "REL_CUST")
