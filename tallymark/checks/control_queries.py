"""Queries of the controls."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.checks import inputs as i
from tallymark.checks.registry import query
from tallymark.operators.shape import pick, to_layout
from tallymark.plans import customer_flags as flags
from tallymark.plans import hierarchy as tree
from tallymark.plans import reconciliation as recon
from tallymark.runs.dashboards import Dashboards
from tallymark.runs.reports import full_history, latest_report, of_latest_run
from tallymark.session import written_once

CODES_SQL = "('PROMO','SMALL')"
ACTIVITY_SQL = "LEFT JOIN svc_count p ON a.OBJECT_ID=p.svc_customer LEFT JOIN ord_count o ON a.OBJECT_ID=o.ord_customer"
LAYOUT_SQL = """NameSF, crm_tax_id AS BI_No_Identificador_fiscal__c, crm_parent_id AS ParentId, crm_global_id AS BI_Id_del_cliente_BIEN__c,
 crm_ext_id AS BI_Identificador_Externo__c, record_type AS "RecordType.Name", active AS BI_Activo__c, last_activity AS "max(Last_Account_Activity__c)",
 NAME, TAX_IDENT_NUMBER, PARENT_ID, UNIQUE_GLOBAL_ID, STATUS, OBJECT_ID, CUST_TYPE, OBJECT_ID_BUS, NAME_NC, NAME_HOLDING, OBJECT_ID_HOLDING,
 MODIFIED_WHEN AS "max(MODIFIED_WHEN)", svc_customer AS CUSTOMER_ACCOUNT_TOP, n_svc AS Cant_Prod_Instances_active_planned,
 ord_customer AS PARENT_ID_ORD, n_ord AS Cant_Prod_Orders"""


@query("active_services", "SELECT * FROM svc")
def active_services(spark, sf):
    return flags.active_services(i.services(spark, sf))


@query(
    "flag_svc_mismatch",
    f"""SELECT a.NAME,a.OBJECT_ID,a.CUST_CATEGORY,a.TAX_IDENT_NUMBER,a.CUSTOMER_ACCNUM,s.* FROM fx_account a JOIN svc s ON a.OBJECT_ID=s.CUSTOMER_ACCOUNT_TOP
 WHERE a.TAX_IDENT_NUMBER LIKE 'ACCT%' AND s.PRODUCT_CODE_TOP NOT IN {CODES_SQL}""",
)
def flag_svc_mismatch(spark, sf):
    return flags.flagged_without_flag_services(
        flags.flagged_accounts(i.accounts(spark, sf)),
        flags.active_services(i.services(spark, sf)),
        i.FLAG_CODES,
    )


@query(
    "unflag_svc_mismatch",
    f"""SELECT a.*,s.* FROM named_account a JOIN svc s ON a.OBJECT_ID=s.CUSTOMER_ACCOUNT_TOP
 WHERE (a.TAX_IDENT_NUMBER IS NULL OR a.TAX_IDENT_NUMBER NOT LIKE 'ACCT%') AND s.PRODUCT_CODE_TOP IN {CODES_SQL}""",
)
def unflag_svc_mismatch(spark, sf):
    return flags.unflagged_with_flag_services(
        flags.unflagged_accounts(i.accounts(spark, sf)),
        flags.active_services(i.services(spark, sf)),
        i.FLAG_CODES,
    )


@query(
    "shared_customers",
    f"""SELECT a.*,s.* FROM named_account a JOIN svc s ON a.OBJECT_ID=s.CUSTOMER_ACCOUNT_TOP WHERE a.OBJECT_ID IN (SELECT CUSTOMER_ACCOUNT_TOP FROM svc t GROUP BY 1
 HAVING sum(CASE WHEN PRODUCT_CODE_TOP IN {CODES_SQL} THEN 1 ELSE 0 END)>0 AND sum(CASE WHEN PRODUCT_CODE_TOP NOT IN {CODES_SQL} THEN 1 ELSE 0 END)>0)""",
)
def shared_customers(spark, sf):
    control = flags.CustomerFlags(i.accounts(spark, sf), i.services(spark, sf), i.FLAG_CODES)
    return control.compute()["shared_customers"]


@query("hier_edges", "SELECT NAME, PARENT_ID, REL_CUST FROM edge")
def hier_edges(spark, sf):
    return tree.holding_edges(i.relations(spark, sf), i.PARENT_OF)


@query("distinct_pairs_rel", "SELECT DISTINCT PARENT_ID, REL_CUST FROM edge")
def distinct_pairs_rel(spark, sf):
    return tree.holding_pairs(i.relations(spark, sf), i.PARENT_OF)


@query("live_accounts", "SELECT * FROM live_account")
def live_accounts(spark, sf):
    return tree.live_accounts(i.accounts(spark, sf))


HOLDING_SQL = """SELECT u.NAME_BUS,u.OBJECT_ID_BUS,u.CUST_TYPE_BUS,u.STATUS_BUS,u.NAME_NC,u.role,u.PARENT_ID,u.REL_CUST,
 h.NAME_BUS AS NAME_HOLDING,h.OBJECT_ID_BUS AS OBJECT_ID_HOLDING,h.CUST_TYPE_BUS AS ID_CUST_TYPE FROM (
 SELECT b.*,t.NAME AS NAME_NC,'P' AS role,e.PARENT_ID,e.REL_CUST FROM live_account b JOIN fx_type t ON b.CUST_TYPE_BUS=t.OBJECT_ID AND t.OBJECT_ID IN (101,102,103) JOIN edge e ON b.OBJECT_ID_BUS=e.PARENT_ID
 UNION ALL SELECT b.*,t.NAME,'C',e.PARENT_ID,e.REL_CUST FROM live_account b JOIN fx_type t ON b.CUST_TYPE_BUS=t.OBJECT_ID AND t.OBJECT_ID IN (101,102,103) JOIN edge e ON b.OBJECT_ID_BUS=e.REL_CUST) u
 LEFT JOIN live_account h ON u.PARENT_ID=h.OBJECT_ID_BUS"""


@query("hier_holding", HOLDING_SQL)
def hier_holding(spark, sf):
    return tree.holding_of_accounts(
        i.accounts(spark, sf), i.relations(spark, sf), i.types(spark), i.PARENT_OF, i.TYPE_IDS
    )


@query(
    "holding_control",
    f"""SELECT NAME_BUS,CAST(OBJECT_ID_BUS AS VARCHAR) AS OBJECT_ID_BUS,CUST_TYPE_BUS,STATUS_BUS,NAME_NC,PARENT_ID,CAST(REL_CUST AS VARCHAR) AS REL_CUST,
 NAME_HOLDING,OBJECT_ID_HOLDING,ID_CUST_TYPE FROM ({HOLDING_SQL}) x""",
)
def holding_control(spark, sf):
    control = tree.Holding(
        i.accounts(spark, sf), i.relations(spark, sf), i.types(spark), i.PARENT_OF, i.TYPE_IDS
    )
    return control.compute()["holding"]


def _wide_sql() -> str:
    picked = []
    for alias, role in (("p", "HOLDING"), ("h", "LE")):
        picked += [f"{alias}.{c} AS {c}_{role}" for c in tree.WIDE_ACCOUNT_COLUMNS]
        picked.append(f"t{alias}.NAME AS CUST_TYPE_NAME_{role}")
    return f"""SELECT {', '.join(picked)} FROM (SELECT DISTINCT PARENT_ID,REL_CUST FROM edge e) t JOIN fx_account p ON p.OBJECT_ID=t.PARENT_ID
 JOIN fx_account h ON h.OBJECT_ID=t.REL_CUST LEFT JOIN fx_type tp ON p.CUST_TYPE=tp.OBJECT_ID LEFT JOIN fx_type th ON h.CUST_TYPE=th.OBJECT_ID"""


@query("holding_pairs_wide", _wide_sql())
def holding_pairs_wide(spark, sf):
    return tree.holding_pairs_wide(
        i.accounts(spark, sf), i.relations(spark, sf), i.types(spark), i.PARENT_OF
    )


@query(
    "holding_pairs_table",
    "SELECT " + ", ".join(f"{a} AS {b}" for a, b in fv.HOLDING_PAIRS_LAYOUT.items()) + f" FROM ({_wide_sql()}) w",
)
def holding_pairs_table(spark, sf):
    """The pairs under the column names in use."""
    return to_layout(holding_pairs_wide(spark, sf), fv.HOLDING_PAIRS_LAYOUT)


def _reconciliation(spark, sf, holdings=False):
    return recon.Reconciliation(
        i.account_versions(spark, sf),
        i.crm(spark, sf),
        i.services(spark, sf),
        i.orders(spark, sf),
        i.holdings(spark, sf) if holdings else None,
        i.TYPE_LABELS,
        run_log=i.year_runs(spark, sf) if holdings else None,
    )


@query("service_counts", "SELECT svc_customer, n_svc FROM svc_count")
def service_counts(spark, sf):
    return recon.service_counts(i.services(spark, sf))


@query("order_counts", "SELECT ord_customer, n_ord FROM ord_count")
def order_counts(spark, sf):
    return recon.order_counts(i.orders(spark, sf))


@query("crm_latest_versions", "SELECT * FROM crm_latest")
def crm_latest_versions(spark, sf):
    return recon.latest_crm(i.crm(spark, sf))


@query("account_latest_versions", "SELECT * FROM acc_holding")
def account_latest_versions(spark, sf):
    live = recon.live_account_versions(i.account_versions(spark, sf), i.TYPE_LABELS)
    return recon.with_latest_holding(recon.latest_accounts(live), i.holdings(spark, sf), i.year_runs(spark, sf))


@query(
    "holdings_of_complete_run",
    """SELECT * FROM fx_holding WHERE run_key = (SELECT max(run_key) FROM fx_year_run
 WHERE run_key < (SELECT max(run_key) FROM fx_year_run))""",
)
def holdings_of_complete_run(spark, sf):
    """The last run is not in the log yet, so the one before it counts."""
    runs = i.year_runs(spark, sf)
    logged = runs.where(F.col("run_key") < runs.agg(F.max("run_key")).scalar())
    return of_latest_run(i.holdings(spark, sf), run_log=logged)


R1_SQL = f"""SELECT a.*,c.*,p.*,o.* FROM acc_latest a JOIN crm_latest c ON a.UNIQUE_GLOBAL_ID=c.crm_global_id {ACTIVITY_SQL}"""


@query("recon_r1", R1_SQL)
def recon_r1(spark, sf):
    return _reconciliation(spark, sf).compute()["matched_by_global_id"]


R2_SQL = f"""SELECT a.*,c.*,p.*,o.* FROM acc_latest a JOIN crm_latest c ON c.crm_ext_id=a.OBJECT_ID {ACTIVITY_SQL}"""


@query("recon_r2", R2_SQL)
def recon_r2(spark, sf):
    return _reconciliation(spark, sf).compute()["matched_by_external_id"]


CRM_ONLY_SQL = "SELECT * FROM crm_latest c WHERE NOT EXISTS (SELECT 1 FROM acc_latest a WHERE a.UNIQUE_GLOBAL_ID=c.crm_global_id)"


@query("recon_crm_only", CRM_ONLY_SQL)
def recon_crm_only(spark, sf):
    live = recon.live_account_versions(i.account_versions(spark, sf), i.TYPE_LABELS)
    return recon.crm_only(recon.latest_crm(i.crm(spark, sf)), recon.latest_accounts(live))


def _acc_only_sql(accounts: str) -> str:
    return f"""SELECT a.*,p.*,o.* FROM {accounts} a {ACTIVITY_SQL} WHERE STATUS='Active'
 AND NOT EXISTS (SELECT 1 FROM crm_latest c WHERE a.UNIQUE_GLOBAL_ID=c.crm_global_id)"""


@query("recon_acc_only", _acc_only_sql("acc_latest"))
def recon_acc_only(spark, sf):
    return _reconciliation(spark, sf).compute()["account_only"]


@query("recon_acc_only_holding", _acc_only_sql("acc_holding"))
def recon_acc_only_holding(spark, sf):
    return _reconciliation(spark, sf, holdings=True).compute()["account_only"]


FULL_R1_SQL = f"""SELECT {LAYOUT_SQL} FROM acc_holding a JOIN crm_latest c ON a.UNIQUE_GLOBAL_ID=c.crm_global_id {ACTIVITY_SQL}"""


@query("recon_global_id_table", FULL_R1_SQL)
def recon_global_id_table(spark, sf):
    result = _reconciliation(spark, sf, holdings=True).compute()["matched_by_global_id"]
    return to_layout(result, fv.RECONCILIATION_LAYOUT)


@query(
    "recon_external_id_table",
    f"""SELECT {LAYOUT_SQL} FROM acc_holding a JOIN crm_latest c ON c.crm_ext_id=a.OBJECT_ID {ACTIVITY_SQL}""",
)
def recon_external_id_table(spark, sf):
    result = _reconciliation(spark, sf, holdings=True).compute()["matched_by_external_id"]
    return to_layout(result, fv.RECONCILIATION_LAYOUT)


FLAG_LABELS = {"R1_1": (1, 0), "R1_2": (1, 0), "R1_3": (1, 0), "R1_4": (1, 0)}


@query(
    "recon_flags",
    """SELECT a.OBJECT_ID,c.crm_ext_id,CASE WHEN c.crm_ext_id<>a.OBJECT_ID OR c.crm_ext_id IS NULL OR a.OBJECT_ID IS NULL THEN 1 ELSE 0 END AS R1_1,
 CASE WHEN c.crm_ext_id=a.OBJECT_ID THEN 1 ELSE 0 END AS R1_2, CASE WHEN c.NameSF<>a.NAME THEN 1 ELSE 0 END AS R1_3,
 CASE WHEN c.record_type<>a.CUST_TYPE THEN 1 ELSE 0 END AS R1_4, CASE WHEN a.TAX_IDENT_NUMBER LIKE 'ACCT%' THEN 'Yes' ELSE 'No' END AS has_flag
 FROM acc_latest a JOIN crm_latest c ON a.UNIQUE_GLOBAL_ID=c.crm_global_id""",
)
def recon_flags(spark, sf):
    joined = _reconciliation(spark, sf).compute()["matched_by_global_id"]
    flagged = recon.report_flags(joined, FLAG_LABELS)
    return pick(flagged, ["OBJECT_ID", "crm_ext_id", *FLAG_LABELS, "has_flag"])


def _report_sql(latest: bool) -> str:
    only = " AND b.run_key=(SELECT max(run_key) FROM fx_year_run)" if latest else ""
    return f"""SELECT b.*, CAST(r.run_ts AS DATE) AS run_day,
 CASE WHEN crm_ext_id<>OBJECT_ID OR crm_ext_id IS NULL OR OBJECT_ID IS NULL THEN 'SiR1_1' ELSE 'NoR1_1' END AS R1_1,
 CASE WHEN crm_ext_id=OBJECT_ID THEN 'SiR1_2' ELSE 'NoR1_2' END AS R1_2, CASE WHEN NameSF<>NAME THEN 'SiR1_3' ELSE 'NoR1_3' END AS R1_3,
 CASE WHEN record_type<>CUST_TYPE THEN 'SiR1_4' ELSE 'NoR1_4' END AS R1_4, CASE WHEN TAX_IDENT_NUMBER LIKE 'ACCT%' THEN 'Yes' ELSE 'No' END AS has_flag
 FROM (SELECT a.*,c.*,p.*,o.*,CAST(year(c.last_activity) AS BIGINT) AS run_key FROM acc_latest a JOIN crm_latest c ON a.UNIQUE_GLOBAL_ID=c.crm_global_id {ACTIVITY_SQL}) b
 JOIN fx_year_run r ON b.run_key=r.run_key{only}"""


def _reported(spark, sf):
    """Stored results; the year of the last activity stands for the run."""
    joined = _reconciliation(spark, sf).compute()["matched_by_global_id"]
    return written_once(joined.withColumn("run_key", F.year("last_activity").cast("long")), "results")


@query("recon_report_latest", _report_sql(latest=True))
def recon_report_latest(spark, sf):
    report = latest_report(_reported(spark, sf), i.year_runs(spark, sf), ["NAME"])
    return recon.report_flags(report)


@query("recon_report_sql", _report_sql(latest=True))
def recon_report_sql(spark, sf):
    """The report of the latest run through `spark.sql`."""
    return Dashboards(spark).latest(_reported(spark, sf), i.year_runs(spark, sf))


@query("recon_history_sql", _report_sql(latest=False))
def recon_history_sql(spark, sf):
    return Dashboards(spark).history(_reported(spark, sf), i.year_runs(spark, sf))


@query("recon_report_history", _report_sql(latest=False))
def recon_report_history(spark, sf):
    report = full_history(_reported(spark, sf), i.year_runs(spark, sf), ["NAME"])
    return recon.report_flags(report)


def _stored(spark, sf):
    """Both sides in buckets, the CRM refreshed a second time on its own."""
    stored = recon.StoredReconciliation.tables(spark, f"recon_{uuid.uuid4().hex}", buckets=8)
    prepared = _reconciliation(spark, sf)
    stored.refresh(prepared)
    stored.refresh(prepared, accounts=False)
    return stored.compute()


@query("recon_r1_stored", R1_SQL)
def recon_r1_stored(spark, sf):
    return _stored(spark, sf)["matched_by_global_id"]


@query("recon_r2_stored", R2_SQL)
def recon_r2_stored(spark, sf):
    return _stored(spark, sf)["matched_by_external_id"]


@query("recon_acc_only_stored", _acc_only_sql("acc_latest"))
def recon_acc_only_stored(spark, sf):
    return _stored(spark, sf)["account_only"]


@query("recon_crm_only_stored", CRM_ONLY_SQL)
def recon_crm_only_stored(spark, sf):
    return _stored(spark, sf)["crm_only"]
