"""Business inputs derived from the driver's tables, in Spark and in SQL.

The driver's tables are clean, so missing, blank and decorated values are
derived by arithmetic on keys. Every row of the tables is used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.checks.registry import fragment

AS_OF = dt.date(2001, 8, 1)
PARENT_OF = 1
TYPE_IDS = (101, 102, 103)
TYPE_LABELS = {101: "Holding", 102: "Legal Entity", 103: "Customer Country"}
FLAG_CODES = ("PROMO", "SMALL")
ACCOUNT_COLUMNS = ["NAME", "OBJECT_ID", "CUST_CATEGORY", "TAX_IDENT_NUMBER", "CUSTOMER_ACCNUM"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def text(key: str) -> Column:
    return F.col(key).cast("string")


fragment(
    "fx_account",
    """SELECT c_custkey AS OBJECT_ID,
 CASE WHEN c_custkey%41=0 THEN NULL WHEN c_custkey%37=0 THEN ' -' WHEN c_custkey%31=0 THEN '--' WHEN c_custkey%5=0 THEN concat('  ',c_name) ELSE c_name END AS NAME,
 CASE WHEN c_custkey%11=0 THEN NULL WHEN c_custkey%3=0 THEN concat('ACCT',CAST(c_custkey AS VARCHAR)) ELSE concat('VAT',CAST(c_custkey AS VARCHAR)) END AS TAX_IDENT_NUMBER,
 c_mktsegment AS CUST_CATEGORY, concat('A',CAST(c_nationkey AS VARCHAR)) AS CUSTOMER_ACCNUM,
 CAST(CASE c_custkey%4 WHEN 0 THEN 101 WHEN 1 THEN 102 WHEN 2 THEN 103 ELSE 999 END AS BIGINT) AS CUST_TYPE,
 CASE c_custkey%6 WHEN 0 THEN 'Active' WHEN 1 THEN 'x6#F5DF48$Pending Activation' ELSE 'x6#9BBB59$Active' END AS STATUS,
 CASE WHEN c_custkey%13=0 THEN NULL ELSE concat('G',CAST(c_custkey AS VARCHAR)) END AS UNIQUE_GLOBAL_ID,
 c_custkey//3 AS PARENT_ID, c_acctbal > 5000 AS IS_MNC, c_acctbal < 0 AS IS_OTT, substr(c_mktsegment,1,3) AS ACRONYM
 FROM customer""",
)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "c_custkey"
    return table(spark, sf_dir, "customer").select(
        F.col(key).alias("OBJECT_ID"),
        F.when(every(key, 41), None)
        .when(every(key, 37), " -")
        .when(every(key, 31), "--")
        .when(every(key, 5), F.concat(F.lit("  "), "c_name"))
        .otherwise(F.col("c_name"))
        .alias("NAME"),
        F.when(every(key, 11), None)
        .when(every(key, 3), F.concat(F.lit("ACCT"), text(key)))
        .otherwise(F.concat(F.lit("VAT"), text(key)))
        .alias("TAX_IDENT_NUMBER"),
        F.col("c_mktsegment").alias("CUST_CATEGORY"),
        F.concat(F.lit("A"), text("c_nationkey")).alias("CUSTOMER_ACCNUM"),
        F.when(F.col(key) % 4 == 3, 999).otherwise(F.col(key) % 4 + 101).cast("long").alias("CUST_TYPE"),
        F.when(every(key, 6), "Active")
        .when(F.col(key) % 6 == 1, "x6#F5DF48$Pending Activation")
        .otherwise("x6#9BBB59$Active")
        .alias("STATUS"),
        F.when(~every(key, 13), F.concat(F.lit("G"), text(key))).alias("UNIQUE_GLOBAL_ID"),
        F.floor(F.col(key) / 3).alias("PARENT_ID"),
        (F.col("c_acctbal") > 5000).alias("IS_MNC"),
        (F.col("c_acctbal") < 0).alias("IS_OTT"),
        F.substring("c_mktsegment", 1, 3).alias("ACRONYM"),
    )


fragment(
    "fx_account_version",
    "SELECT a.*, o.o_orderdate AS MODIFIED_WHEN FROM fx_account a JOIN orders o ON a.OBJECT_ID=o.o_custkey",
)


def account_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").alias("MODIFIED_WHEN"))
    joined = accounts(spark, sf_dir).join(orders, F.col("OBJECT_ID") == F.col("o_custkey"))
    return joined.drop("o_custkey")


fragment(
    "fx_service",
    """SELECT l_orderkey*10+l_linenumber AS OBJECT_ID, o_custkey AS CUSTOMER_ACCOUNT,
 concat(p_name,' Instance #',CAST(l_linenumber AS VARCHAR)) AS NAME,
 CASE WHEN l_partkey%19=0 THEN NULL ELSE p_type END AS PRODUCT_CODE,
 CASE WHEN l_returnflag='R' THEN 'Disconnected' WHEN l_linestatus='F' THEN 'Active' ELSE 'Planned' END AS STATUS
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey""",
)


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("OBJECT_ID"),
        F.col("o_custkey").alias("CUSTOMER_ACCOUNT"),
        F.concat("p_name", F.lit(" Instance #"), text("l_linenumber")).alias("NAME"),
        F.when(~every("l_partkey", 19), F.col("p_type")).alias("PRODUCT_CODE"),
        F.when(F.col("l_returnflag") == "R", "Disconnected")
        .when(F.col("l_linestatus") == "F", "Active")
        .otherwise("Planned")
        .alias("STATUS"),
    )


fragment(
    "fx_order",
    "SELECT o_orderkey AS OBJECT_ID, CASE WHEN o_custkey%7=0 THEN NULL ELSE o_custkey END AS PARENT_ID FROM orders",
)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; those of every seventh customer have lost their customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OBJECT_ID"),
        F.when(~every("o_custkey", 7), F.col("o_custkey")).alias("PARENT_ID"),
    )


fragment(
    "fx_relation",
    """SELECT concat('rel ',CAST(c_custkey AS VARCHAR)) AS NAME, c_custkey AS OBJECT_ID,
 CAST(CASE WHEN c_custkey%10=0 THEN 2 ELSE 1 END AS BIGINT) AS REL_TYPE, CASE WHEN c_custkey>0 THEN c_custkey//3 END AS PARENT_ID, c_custkey AS REL_CUST
 FROM customer""",
)


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree with three children per account; the top account has no parent."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("rel "), text("c_custkey")).alias("NAME"),
        key.alias("OBJECT_ID"),
        F.when(every("c_custkey", 10), 2).otherwise(PARENT_OF).cast("long").alias("REL_TYPE"),
        F.when(key > 0, F.floor(key / 3)).alias("PARENT_ID"),
        key.alias("REL_CUST"),
    )


fragment(
    "fx_type",
    """SELECT CAST(101 AS BIGINT) AS OBJECT_ID,'Holding' AS NAME UNION ALL SELECT 102,'Legal Entity'
 UNION ALL SELECT 103,'Customer Country' UNION ALL SELECT 500,'Noise'""",
)


def types(spark: SparkSession) -> DataFrame:
    rows = [(101, "Holding"), (102, "Legal Entity"), (103, "Customer Country"), (500, "Noise")]
    return spark.createDataFrame(rows, "OBJECT_ID long, NAME string")


fragment(
    "fx_crm",
    """SELECT CASE WHEN c_custkey%9=0 THEN concat('Other ',c_name) ELSE c_name END AS NameSF,
 concat('T',CAST(c_nationkey AS VARCHAR)) AS crm_tax_id, CAST(c_custkey//3 AS VARCHAR) AS crm_parent_id,
 CASE WHEN c_custkey%17=0 THEN NULL ELSE concat('G',CAST(c_custkey%1400 AS VARCHAR)) END AS crm_global_id,
 CASE WHEN c_custkey%8=0 THEN NULL WHEN c_custkey%5=0 THEN CAST(c_custkey+1 AS VARCHAR) WHEN c_custkey%29=0 THEN 'not-a-number' ELSE CAST(c_custkey AS VARCHAR) END AS crm_ext_id,
 CASE c_custkey%5 WHEN 0 THEN 'a.b.Holding' WHEN 1 THEN 'Legal Entity' WHEN 2 THEN 'x.Customer Country' WHEN 3 THEN 'x.Business Unit' ELSE 'x.Cost Center' END AS record_type,
 CASE WHEN c_custkey%12=0 THEN 'No' ELSE 'Sí' END AS active,
 o_orderdate AS last_activity FROM customer JOIN orders ON c_custkey=o_custkey""",
)


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "c_custkey"
    record_types = ["a.b.Holding", "Legal Entity", "x.Customer Country", "x.Business Unit", "x.Cost Center"]
    customers = table(spark, sf_dir, "customer").select(
        F.col(key),
        F.when(every(key, 9), F.concat(F.lit("Other "), "c_name")).otherwise(F.col("c_name")).alias("NameSF"),
        F.concat(F.lit("T"), text("c_nationkey")).alias("crm_tax_id"),
        F.floor(F.col(key) / 3).cast("string").alias("crm_parent_id"),
        F.when(~every(key, 17), F.concat(F.lit("G"), (F.col(key) % 1400).cast("string"))).alias("crm_global_id"),
        F.when(every(key, 8), None)
        .when(every(key, 5), (F.col(key) + 1).cast("string"))
        .when(every(key, 29), "not-a-number")
        .otherwise(text(key))
        .alias("crm_ext_id"),
        F.element_at(F.array(*map(F.lit, record_types)), (F.col(key) % 5 + 1).cast("int")).alias("record_type"),
        F.when(every(key, 12), "No").otherwise("Sí").alias("active"),
    )
    activity = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").alias("last_activity"))
    return customers.join(activity, F.col(key) == F.col("o_custkey")).drop(key, "o_custkey")


fragment(
    "fx_run",
    "SELECT o_orderkey AS run_key, CAST(o_orderkey%5 AS INT) AS control_type, o_orderdate AS run_ts FROM orders",
)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_key"),
        (F.col("o_orderkey") % 5).cast("int").alias("control_type"),
        F.col("o_orderdate").alias("run_ts"),
    )


fragment(
    "fx_holding",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS run_key, CAST(o_custkey AS VARCHAR) AS OBJECT_ID_BUS,
 'Holding' AS NAME_NC, concat('Holding ',o_orderstatus) AS NAME_HOLDING, o_custkey//3 AS OBJECT_ID_HOLDING FROM orders""",
)


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published holding results: one run per year."""
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("long").alias("run_key"),
        text("o_custkey").alias("OBJECT_ID_BUS"),
        F.lit("Holding").alias("NAME_NC"),
        F.concat(F.lit("Holding "), "o_orderstatus").alias("NAME_HOLDING"),
        F.floor(F.col("o_custkey") / 3).alias("OBJECT_ID_HOLDING"),
    )


fragment(
    "fx_year_run",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS run_key, max(o_orderdate) AS run_ts FROM orders GROUP BY 1""",
)


def year_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log of the published holding results."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").cast("long").alias("run_key"))
        .agg(F.max("o_orderdate").alias("run_ts"))
    )


RULE_SCHEMA = "exception_key int, attr1 string, val1 string, attr2 string, val2 string"
RULES = [
    (1, "CUST_CATEGORY", "BUILDING", None, None),
    (2, "CUST_CATEGORY", "MACHINERY", "STATUS", "Active"),
    (3, "CUST_CATEGORY", "FURNITURE", None, None),
]


def rule_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The five rule tables: keys 1 and 2 suppress, key 3 forces a duplicate."""
    return {
        "filters": spark.createDataFrame(RULES, RULE_SCHEMA),
        "exceptions": spark.createDataFrame(
            [(1, 1), (2, 1), (3, 2)], "exception_key int, exception_type int"
        ),
        "exception_controls": spark.createDataFrame(
            [(1, 1), (2, 1), (3, 1)], "exception_key int, control_type int"
        ),
        "control_types": spark.createDataFrame([(1,), (2,)], "control_type int"),
        "exception_types": spark.createDataFrame([(1,), (2,)], "exception_type int"),
    }


fragment(
    "fx_part_rule",
    """SELECT 'OBJECT_ID' AS attr1, CAST(p_partkey AS VARCHAR) AS val1,
 CASE WHEN p_size>25 THEN 'CUST_CATEGORY' END AS attr2, CASE WHEN p_size>25 THEN CASE WHEN p_size>40 THEN 'BUILDING' ELSE 'MACHINERY' END END AS val2 FROM part""",
)


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per part: too many for one expression."""
    double = F.col("p_size") > 25
    return table(spark, sf_dir, "part").select(
        F.lit("OBJECT_ID").alias("attr1"),
        text("p_partkey").alias("val1"),
        F.when(double, "CUST_CATEGORY").alias("attr2"),
        F.when(double, F.when(F.col("p_size") > 40, "BUILDING").otherwise("MACHINERY")).alias("val2"),
    )


fragment(
    "fx_relation_size",
    """SELECT CASE WHEN p_size<4 THEN 'pg_catalog' WHEN p_size<7 THEN 'pg_toast_1' WHEN p_type='PROMO' THEN 'staging' ELSE 'results' END AS "schema",
 concat(p_name,'_',CAST(p_partkey AS VARCHAR)) AS relation, CASE WHEN p_brand='Brand#1' THEN 'i' ELSE 'r' END AS kind,
 (p_partkey+1)*p_size*CASE p_size%3 WHEN 0 THEN 1 WHEN 1 THEN 1024 ELSE 1048576 END AS bytes FROM part""",
)


def relation_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.when(every("p_size", 3), 1).when(F.col("p_size") % 3 == 1, 1024).otherwise(1024 * 1024)
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") < 4, "pg_catalog")
        .when(F.col("p_size") < 7, "pg_toast_1")
        .when(F.col("p_type") == "PROMO", "staging")
        .otherwise("results")
        .alias("schema"),
        F.concat("p_name", F.lit("_"), text("p_partkey")).alias("relation"),
        F.when(F.col("p_brand") == "Brand#1", "i").otherwise("r").alias("kind"),
        ((F.col("p_partkey") + 1) * F.col("p_size") * unit).alias("bytes"),
    )


# Size text of a number of bytes `b`, as SQL.
PRETTY_SQL = """CASE WHEN b<10240 THEN concat(CAST(b AS VARCHAR),' bytes') WHEN b//512<20479 THEN concat(CAST((b//512+1)//2 AS VARCHAR),' kB')
 WHEN b//524288<20479 THEN concat(CAST((b//524288+1)//2 AS VARCHAR),' MB') WHEN b//536870912<20479 THEN concat(CAST((b//536870912+1)//2 AS VARCHAR),' GB')
 ELSE concat(CAST((b//549755813888+1)//2 AS VARCHAR),' TB') END"""

# Blocks shared by several SQL twins.
fragment(
    "cleaned_account",
    r"""SELECT *, CASE WHEN STATUS LIKE '%6#9BBB59$Active' THEN regexp_replace(STATUS,'[a-zA-z0-9«#$%&/()=*]*Active','Active')
 WHEN STATUS LIKE '%6#F5DF48$Pending Activation' THEN regexp_replace(STATUS,'[a-zA-z0-9«#$%&/()=*]*Pending Activation','Pending Activation') END AS s FROM fx_account""",
)
fragment(
    "svc",
    """SELECT split_part(split_part(NAME,'Instance',1),'#',1) AS NAME_TOP, CUSTOMER_ACCOUNT AS CUSTOMER_ACCOUNT_TOP,
 PRODUCT_CODE AS PRODUCT_CODE_TOP, count(*) AS n_services FROM fx_service WHERE STATUS='Active' GROUP BY 1,2,3""",
)
fragment(
    "named_account",
    """SELECT ltrim(NAME) AS NAME,OBJECT_ID,CUST_CATEGORY,TAX_IDENT_NUMBER,CUSTOMER_ACCNUM FROM fx_account
 WHERE NAME IS NOT NULL AND NAME NOT IN (' -','-','--')""",
)
fragment(
    "edge",
    """SELECT r1.NAME, r1.PARENT_ID, r2.REL_CUST FROM fx_relation r1 JOIN fx_relation r2 ON r1.REL_CUST=r2.PARENT_ID WHERE r1.REL_TYPE=1 AND r2.REL_TYPE=1
 UNION ALL SELECT NAME, PARENT_ID, REL_CUST FROM fx_relation r WHERE REL_TYPE=1 AND NOT EXISTS (SELECT 1 FROM fx_relation q WHERE q.REL_CUST=r.PARENT_ID AND q.REL_TYPE=1)""",
)
fragment(
    "live_account",
    """SELECT ltrim(NAME) AS NAME_BUS,OBJECT_ID AS OBJECT_ID_BUS,CUST_TYPE AS CUST_TYPE_BUS,s AS STATUS_BUS FROM cleaned_account
 WHERE s IN ('Active','Pending Activation') AND NAME NOT IN (' -','-','--')""",
)
fragment(
    "crm_latest",
    """SELECT NameSF,crm_tax_id,crm_parent_id,crm_global_id,crm_ext_id,split_part(record_type,'.',-1) AS record_type,active,max(last_activity) AS last_activity
 FROM fx_crm WHERE active='Sí' AND split_part(record_type,'.',-1) NOT IN ('Business Unit','Cost Center') GROUP BY 1,2,3,4,5,6,7""",
)
fragment(
    "acc_latest",
    """SELECT a.NAME,a.TAX_IDENT_NUMBER,a.PARENT_ID,a.UNIQUE_GLOBAL_ID,a.s AS STATUS,CAST(a.OBJECT_ID AS VARCHAR) AS OBJECT_ID,
 CASE a.CUST_TYPE WHEN 101 THEN 'Holding' WHEN 102 THEN 'Legal Entity' WHEN 103 THEN 'Customer Country' ELSE CAST(a.CUST_TYPE AS VARCHAR) END AS CUST_TYPE,
 max(o.o_orderdate) AS MODIFIED_WHEN FROM cleaned_account a JOIN orders o ON a.OBJECT_ID=o.o_custkey
 WHERE a.s IN ('Active','Pending Activation') GROUP BY 1,2,3,4,5,6,7""",
)
fragment(
    "acc_holding",
    """SELECT a.*,h.OBJECT_ID_BUS,h.NAME_NC,h.NAME_HOLDING,h.OBJECT_ID_HOLDING FROM acc_latest a
 LEFT JOIN (SELECT DISTINCT OBJECT_ID_BUS,NAME_NC,NAME_HOLDING,OBJECT_ID_HOLDING FROM fx_holding WHERE run_key=(SELECT max(run_key) FROM fx_holding)) h ON a.OBJECT_ID=h.OBJECT_ID_BUS""",
)
fragment(
    "svc_count",
    "SELECT CAST(CUSTOMER_ACCOUNT AS VARCHAR) AS svc_customer,count(*) AS n_svc FROM fx_service WHERE STATUS NOT IN ('Disconnected') GROUP BY 1",
)
fragment(
    "ord_count",
    "SELECT CAST(PARENT_ID AS VARCHAR) AS ord_customer,count(*) AS n_ord FROM fx_order GROUP BY 1",
)

fragment(
    "fx_presence",
    """SELECT DISTINCT CAST(ts AS DATE) AS "day", unnest(list_filter(['event_id','user',CASE WHEN dayofyear(ts)<20 THEN 'event_type' ELSE 'kind' END,CASE WHEN dayofyear(ts)%3<>0 THEN 'value' END], lambda x: x IS NOT NULL)) AS col FROM events""",
)
