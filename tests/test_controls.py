"""Controls on hand-made business rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.operators.shape import to_layout, to_logical
from tallymark.operators.tables import conform
from tallymark.plans import customer_flags as flags
from tallymark.plans import hierarchy as tree
from tallymark.plans import reconciliation as recon

ACTIVE = "x6#9BBB59$Active"
PENDING = "x6#F5DF48$Pending Activation"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def accounts(spark, data):
    """(id, name, tax id)"""
    full = [(name, id_, "cat", tax, "num") for id_, name, tax in data]
    return spark.createDataFrame(
        full, "NAME string, OBJECT_ID long, CUST_CATEGORY string, TAX_IDENT_NUMBER string, CUSTOMER_ACCNUM string"
    )


def services(spark, data):
    """(customer, name, product, status)"""
    return spark.createDataFrame(
        data, "CUSTOMER_ACCOUNT long, NAME string, PRODUCT_CODE string, STATUS string"
    )


def flag_results(spark, account_rows, service_rows):
    control = flags.CustomerFlags(accounts(spark, account_rows), services(spark, service_rows))
    picked = ["OBJECT_ID", "NAME", "NAME_TOP", "PRODUCT_CODE_TOP", "n_services"]
    return {name: rows(df.select(*picked)) for name, df in control.compute().items()}


def test_customer_flags(spark):
    got = flag_results(
        spark,
        [(1, " Flagged", "ACCT9"), (2, "  Plain", None), (3, "-", "VAT"), (4, "Both", "VAT")],
        [
            (1, "Net Instance #1", "OTHER", "Active"),
            (1, "Net Instance #2", "OTHER", "Active"),
            (1, "Net Instance #3", "ITS", "Active"),
            (1, "Net Instance #4", None, "Active"),
            (2, "Sky Instance #1", "CLOUD_DDOS", "Active"),
            (2, "Sky Instance #2", "CLOUD_DDOS", "Planned"),
            (3, "Sky Instance #1", "CLOUD_DDOS", "Active"),
            (4, "A", "ITS", "Active"),
            (4, "B", "OTHER", "Active"),
            (4, "C", None, "Active"),
        ],
    )
    # Unknown products go, names stay as they are.
    assert got["flagged_without_flag_services"] == Counter([(1, " Flagged", "Net ", "OTHER", 2)])
    assert got["unflagged_with_flag_services"] == Counter(
        [(2, "Plain", "Sky ", "CLOUD_DDOS", 1), (4, "Both", "A", "ITS", 1)]
    )
    # Shared customers show every service, unknown products included.
    assert got["shared_customers"] == Counter(
        [
            (1, "Flagged", "Net ", "OTHER", 2),
            (1, "Flagged", "Net ", "ITS", 1),
            (1, "Flagged", "Net ", None, 1),
            (4, "Both", "A", "ITS", 1),
            (4, "Both", "B", "OTHER", 1),
            (4, "Both", "C", None, 1),
        ]
    )


def test_flag_product_and_unknown_is_not_shared(spark):
    got = flag_results(spark, [(1, "A", None)], [(1, "s", "ITS", "Active"), (1, "t", None, "Active")])
    assert got["shared_customers"] == Counter()


def relations(spark, edges):
    data = [(f"r{n}", n, kind, parent, child) for n, (parent, child, kind) in enumerate(edges)]
    return spark.createDataFrame(
        data, "NAME string, OBJECT_ID long, REL_TYPE long, PARENT_ID long, REL_CUST long"
    )


def pairs(df):
    return Counter((r.PARENT_ID, r.REL_CUST) for r in df.collect())


def test_edges_follow_two_hops(spark):
    chain = relations(spark, [(1, 2, fv.PARENT_OF), (2, 3, fv.PARENT_OF), (3, 4, fv.PARENT_OF)])
    assert pairs(tree.holding_edges(chain)) == Counter([(1, 3), (2, 4), (1, 2)])


def test_other_relation_types_do_not_make_a_parent(spark):
    edges = relations(spark, [(9, 1, 5), (1, 2, fv.PARENT_OF)])
    assert pairs(tree.holding_edges(edges)) == Counter([(1, 2)])


def test_duplicate_edges_stay_until_made_distinct(spark):
    edges = relations(spark, [(1, 2, fv.PARENT_OF), (1, 2, fv.PARENT_OF)])
    assert pairs(tree.holding_edges(edges)) == Counter({(1, 2): 2})
    assert pairs(tree.holding_pairs(edges)) == Counter([(1, 2)])


def tree_accounts(spark, data):
    return spark.createDataFrame(
        [(*row, True, False, "acr") for row in data],
        "OBJECT_ID long, NAME string, CUST_TYPE long, STATUS string, IS_MNC boolean, IS_OTT boolean, ACRONYM string",
    )


def objects(spark):
    data = [(1, "Holding"), (2, "Legal Entity"), (7, "Noise")]
    return spark.createDataFrame(data, "OBJECT_ID long, NAME string")


def test_holding_of_accounts(spark):
    df = tree.holding_of_accounts(
        tree_accounts(
            spark,
            [
                (10, "  Top", 1, ACTIVE),
                (11, "Left", 2, PENDING),
                (12, "Right", 2, ACTIVE),
                (13, "Plain", 2, "Active"),
                (14, "Typeless", 7, ACTIVE),
                (15, "--", 2, ACTIVE),
                (16, "Lost", 2, ACTIVE),
            ],
        ),
        relations(
            spark,
            [(10, c, fv.PARENT_OF) for c in (11, 12, 13, 14, 15)] + [(99, 16, fv.PARENT_OF)],
        ),
        objects(spark),
        type_ids=[1, 2],
    )
    got = rows(df.select("OBJECT_ID_BUS", "NAME_BUS", "STATUS_BUS", "NAME_NC", "role", "PARENT_ID", "REL_CUST", "NAME_HOLDING"))
    top = [(10, "Top", "Active", "Holding", "P", 10, child, "Top") for child in (11, 12, 13, 14, 15)]
    assert got == Counter(
        top
        + [
            (11, "Left", "Pending Activation", "Legal Entity", "C", 10, 11, "Top"),
            (12, "Right", "Active", "Legal Entity", "C", 10, 12, "Top"),
            (16, "Lost", "Active", "Legal Entity", "C", 99, 16, None),
        ]
    )


def test_wide_pairs_keep_unknown_types(spark):
    df = tree.holding_pairs_wide(
        tree_accounts(spark, [(10, "Top", 1, "Active"), (11, "Child", 5, "Closed")]),
        relations(spark, [(10, 11, fv.PARENT_OF), (10, 11, fv.PARENT_OF), (10, 12, fv.PARENT_OF)]),
        objects(spark),
    )
    assert len(df.columns) == 14
    got = rows(df.select("OBJECT_ID_HOLDING", "NAME_HOLDING", "CUST_TYPE_NAME_HOLDING", "OBJECT_ID_LE", "CUST_TYPE_NAME_LE"))
    assert got == Counter([(10, "Top", "Holding", 11, None)])


def day(n):
    return dt.datetime(2024, 1, n)


def reconciliation(spark, account_rows, crm_rows, service_rows=(), order_rows=(), holding_rows=None):
    """accounts (id, name, type, status, global id, day); crm (name, global id, ext id, type, active, day)"""
    account_frame = spark.createDataFrame(
        [(id_, name, "VAT", 5, kind, status, gid, when) for id_, name, kind, status, gid, when in account_rows],
        "OBJECT_ID long, NAME string, TAX_IDENT_NUMBER string, PARENT_ID long, CUST_TYPE long, STATUS string,"
        " UNIQUE_GLOBAL_ID string, MODIFIED_WHEN timestamp_ntz",
    )
    crm_frame = to_logical(
        spark.createDataFrame(
            [(name, "T", "P", gid, ext, kind, active, when) for name, gid, ext, kind, active, when in crm_rows],
            "Name string, BI_No_Identificador_fiscal__c string, ParentId string, BI_Id_del_cliente_BIEN__c string,"
            " BI_Identificador_Externo__c string, `RecordType.Name` string, BI_Activo__c string,"
            " Last_Account_Activity__c timestamp_ntz",
        ),
        fv.CRM_COLUMNS,
    )
    holdings = None
    if holding_rows is not None:
        holdings = spark.createDataFrame(
            holding_rows,
            "run_key long, OBJECT_ID_BUS string, NAME_NC string, NAME_HOLDING string, OBJECT_ID_HOLDING long",
        )
    return recon.Reconciliation(
        account_frame,
        crm_frame,
        services(spark, list(service_rows)),
        spark.createDataFrame(list(order_rows), "OBJECT_ID long, PARENT_ID long"),
        holdings,
        run_log=None if holdings is None else holdings.select("run_key").distinct(),
    )


HOLDING_ID = 9145485386913639390


def test_reconciliation(spark):
    results = reconciliation(
        spark,
        [
            (1, "One", HOLDING_ID, ACTIVE, "G1", day(1)),
            (1, "One", HOLDING_ID, ACTIVE, "G1", day(3)),
            (2, "Two", 77, PENDING, "G2", day(1)),
            (3, "Three", None, ACTIVE, None, day(1)),
            (4, "Four", HOLDING_ID, "Active", "G1", day(1)),
        ],
        [
            ("uno", "G1", "3", "x.Holding", "Sí", day(1)),
            ("uno", "G1", "3", "x.Holding", "Sí", day(2)),
            ("old", "G1", "1", "Holding", "No", day(9)),
            ("unit", "G2", "2", "a.Business Unit", "Sí", day(1)),
            ("lost", None, "not-a-number", "Holding", "Sí", day(1)),
            ("far", "G9", "1", "Holding", "Sí", day(1)),
        ],
        service_rows=[(1, "s", "p", "Active"), (1, "s", "p", "Planned"), (1, "s", "p", "Disconnected")],
        order_rows=[(1, 1), (2, 3), (3, None)],
        holding_rows=[(1, "1", "Holding", "stale", 9), (2, "1", "Holding", "Top", 8), (2, "1", "Holding", "Top", 8)],
    ).compute()
    picked = ["OBJECT_ID", "CUST_TYPE", "MODIFIED_WHEN", "NameSF", "record_type", "last_activity", "NAME_HOLDING", "n_svc", "n_ord"]
    assert rows(results["matched_by_global_id"].select(*picked)) == Counter(
        [("1", "Holding", day(3), "uno", "Holding", day(2), "Top", 2, 1)]
    )
    assert rows(results["matched_by_external_id"].select("OBJECT_ID", "NameSF", "crm_global_id")) == Counter(
        [("3", "uno", "G1"), ("1", "far", "G9")]
    )
    assert rows(results["crm_only"].select("NameSF")) == Counter([("lost",), ("far",)])
    # Pending accounts are left out, null global ids are kept.
    assert rows(results["account_only"].select("OBJECT_ID", "n_svc", "n_ord")) == Counter([("3", None, 1)])
    layout = to_layout(results["matched_by_global_id"], fv.RECONCILIATION_LAYOUT)
    assert len(layout.columns) == 24
    schema = recon.result_schema()
    stored = conform(layout.withColumn("ClEjecControl", F.lit(7)), schema)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
    assert stored.dtypes[0] == ("ClEjecControl", "bigint") and len(stored.columns) == 25
    row = stored.first()
    assert row["max(Last_Account_Activity__c)"] == "2024-01-02 00:00:00" and row["Cant_Prod_Orders"] == 1


def test_matched_and_unmatched_rows_partition_each_side(spark, sf_dir):
    from tallymark.checks import inputs as i

    control = recon.Reconciliation(
        i.account_versions(spark, sf_dir), i.crm(spark, sf_dir), i.services(spark, sf_dir),
        i.orders(spark, sf_dir), None, i.TYPE_LABELS,
    )
    results = control.compute()
    matched = results["matched_by_global_id"]
    crm_keys = [*recon.CRM_KEYS, "last_activity"]
    both = rows(matched.select(*crm_keys).distinct())
    alone = rows(results["crm_only"].select(*crm_keys))
    assert not both & alone and both + alone == rows(control.crm.select(*crm_keys))
    account_keys = [*recon.ACCOUNT_KEYS, "MODIFIED_WHEN"]
    both = rows(matched.select(*account_keys).distinct().where("STATUS = 'Active'"))
    alone = rows(results["account_only"].select(*account_keys))
    assert not both & alone
    assert both + alone == rows(control.accounts.where("STATUS = 'Active'").select(*account_keys))


def test_report_flags(spark):
    data = [("1", "1", "A", "A", "H", "H", "ACCT1"), (None, "1", "A", None, "H", "L", None)]
    df = spark.createDataFrame(
        data, "crm_ext_id string, OBJECT_ID string, NameSF string, NAME string, record_type string, CUST_TYPE string, TAX_IDENT_NUMBER string"
    )
    got = recon.report_flags(df).select("R1_1", "R1_2", "R1_3", "R1_4", "has_flag")
    assert rows(got) == Counter(
        [("NoR1_1", "SiR1_2", "NoR1_3", "NoR1_4", "Yes"), ("SiR1_1", "NoR1_2", "NoR1_3", "SiR1_4", "No")]
    )


def test_hot_global_id_is_joined_whole(spark):
    """A third of the CRM claims one id."""
    crm_rows = [(f"n{n}", "G1" if n % 3 == 0 else f"X{n}", None, "Holding", "Sí", day(1)) for n in range(300)]
    results = reconciliation(spark, [(1, "One", HOLDING_ID, ACTIVE, "G1", day(1))], crm_rows).compute()
    assert results["matched_by_global_id"].count() == 100
    assert results["crm_only"].count() == 200
    assert results["matched_by_global_id"].select(F.countDistinct("NameSF")).first()[0] == 100
