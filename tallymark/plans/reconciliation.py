"""The same accounts in two systems: matched, or in one of them only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark import fixed_values as fv
from tallymark.functions import predicates as p
from tallymark.functions.flags import differs_or_missing, labelled
from tallymark.functions.text import decorated, last_segment, plain_status, type_label
from tallymark.operators.matching import hot_keys, match_anti, match_hot, match_left
from tallymark.operators.shape import as_text, pick
from tallymark.operators.versions import latest_version, rows_per
from tallymark.plans.control import Control, target
from tallymark.runs.reports import of_latest_run
from tallymark.session import written_together
from tallymark.sinks.match_tables import MatchTables, match_anti_stored, match_stored

ACCOUNT_KEYS = [
    "NAME",
    "TAX_IDENT_NUMBER",
    "PARENT_ID",
    "UNIQUE_GLOBAL_ID",
    "STATUS",
    "OBJECT_ID",
    "CUST_TYPE",
]
CRM_KEYS = [
    "NameSF",
    "crm_tax_id",
    "crm_parent_id",
    "crm_global_id",
    "crm_ext_id",
    "record_type",
    "active",
]
HOLDING_ATTACHED = ["OBJECT_ID_BUS", "NAME_NC", "NAME_HOLDING", "OBJECT_ID_HOLDING"]
# Columns of the stored result that are not text.
RESULT_TYPES = {
    "PARENT_ID": T.LongType(),
    "OBJECT_ID_HOLDING": T.LongType(),
    "MODIFIED_WHEN": T.TimestampType(),
    "n_svc": T.LongType(),
    "n_ord": T.LongType(),
}
ACCOUNT_VERSION = "MODIFIED_WHEN"
CRM_VERSION = "last_activity"


def live_account_versions(accounts: DataFrame, labels: Mapping[int, str] = fv.TYPE_LABELS) -> DataFrame:
    """Account versions in a decorated live status; id as text, type as label."""
    changes = {
        "OBJECT_ID": F.col("OBJECT_ID").cast("string"),
        "STATUS": plain_status(F.col("STATUS")),
    }
    if "CUST_TYPE" in accounts.columns:
        changes["CUST_TYPE"] = type_label(F.col("CUST_TYPE"), labels)
    cleaned = accounts.where(decorated(F.col("STATUS"))).withColumns(changes)
    return cleaned.where(p.equals_any(F.col("STATUS"), fv.LIVE_STATUSES))


def with_latest_holding(
    latest: DataFrame, holdings: DataFrame, run_log: DataFrame, key: str = "run_key"
) -> DataFrame:
    """Attach each distinct holding that the latest holding run found for an account.

    The latest run is one that the log holds: one that broke off before its log
    row is passed over.

    Grouping the account versions first and joining the distinct holdings gives
    the same rows as joining first, with far fewer rows in the join.
    """
    run = of_latest_run(holdings, key, run_log)
    found = as_text(pick(run, HOLDING_ATTACHED), "OBJECT_ID_BUS").distinct()
    return match_left(latest, found, "OBJECT_ID", "OBJECT_ID_BUS")


def latest_accounts(live: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS) -> DataFrame:
    """Latest version of each account.

    The account id and the global id are among the keys, so a match on either
    keeps or drops whole groups and can be done after the grouping.
    """
    return latest_version(live, keys, ACCOUNT_VERSION)


def latest_crm(crm: DataFrame, keys: Sequence[str] = CRM_KEYS) -> DataFrame:
    """Latest activity of each active CRM account of a reconciled type."""
    typed = crm.where(F.col("active") == F.lit(fv.CRM_ACTIVE)).withColumn(
        "record_type", last_segment(F.col("record_type"))
    )
    kept = typed.where(p.outside(F.col("record_type"), fv.CRM_EXCLUDED_TYPES))
    return latest_version(kept, keys, CRM_VERSION)


def service_counts(services: DataFrame) -> DataFrame:
    """Open services per customer."""
    opened = services.where(p.outside(F.col("STATUS"), fv.CLOSED_SERVICE_STATUSES))
    keyed = opened.select(F.col("CUSTOMER_ACCOUNT").cast("string").alias("svc_customer"))
    return rows_per(keyed, ["svc_customer"], "n_svc")


def order_counts(orders: DataFrame) -> DataFrame:
    """Orders per customer."""
    keyed = orders.select(F.col("PARENT_ID").cast("string").alias("ord_customer"))
    return rows_per(keyed, ["ord_customer"], "n_ord")


def with_activity(accounts: DataFrame, services: DataFrame, orders: DataFrame) -> DataFrame:
    """Attach the number of open services and of orders; null where there are none."""
    served = match_left(accounts, services, "OBJECT_ID", "svc_customer")
    return match_left(served, orders, "OBJECT_ID", "ord_customer")


def matched(
    crm: DataFrame, accounts: DataFrame, crm_key: str, account_key: str, hot: Sequence | None = None
) -> DataFrame:
    """Accounts found in both systems. A null key never matches.

    Many CRM accounts may claim one id. Unless its hot keys are given they are
    counted, so `crm` should be a stored table.
    """
    return match_hot(crm, accounts, crm_key, account_key, hot=hot)


def crm_only(crm: DataFrame, accounts: DataFrame, hot: Sequence = ()) -> DataFrame:
    """CRM accounts whose global id no account has, null ids included."""
    return match_anti(crm, accounts, "crm_global_id", "UNIQUE_GLOBAL_ID", hot)


def account_only(accounts: DataFrame, crm: DataFrame) -> DataFrame:
    """Active accounts whose global id the CRM does not have."""
    active = accounts.where(F.col("STATUS") == fv.ACTIVE_STATUS)
    return match_anti(active, crm, "UNIQUE_GLOBAL_ID", "crm_global_id")


def result_schema() -> T.StructType:
    """Layout of the stored result: run key, then the columns under the names in use."""
    key = T.StructField(fv.RUN_LOG_COLUMNS["run_key"], T.LongType(), False)
    columns = [
        T.StructField(physical, RESULT_TYPES.get(logical, T.StringType()))
        for logical, physical in fv.RECONCILIATION_LAYOUT.items()
    ]
    return T.StructType([key, *columns])


def report_flags(
    results: DataFrame,
    labels: Mapping[str, tuple] = fv.REPORT_LABELS,
    prefix_flag: str = "has_flag",
    prefix_labels: tuple = ("Yes", "No"),
) -> DataFrame:
    """Result rows with the consistency flags of the dashboards.

    R1_1 ids differ or are missing, R1_2 ids agree, R1_3 names differ,
    R1_4 types differ, and whether the tax id carries the flag. An unknown
    comparison gets the second label.
    """
    ext_id, account_id = F.col("crm_ext_id"), F.col("OBJECT_ID")
    conditions = {
        "R1_1": lambda: differs_or_missing(ext_id, account_id),
        "R1_2": lambda: ext_id == account_id,
        "R1_3": lambda: F.col("NameSF") != F.col("NAME"),
        "R1_4": lambda: F.col("record_type") != F.col("CUST_TYPE"),
    }
    flags = {name: labelled(conditions[name](), labels[name]) for name in labels}
    if "TAX_IDENT_NUMBER" in results.columns:
        flagged = p.has_prefix(F.col("TAX_IDENT_NUMBER"), fv.FLAG_PREFIX)
        flags[prefix_flag] = labelled(flagged, prefix_labels)
    return results.withColumns(flags)


class Reconciliation(Control):
    """Accounts against the CRM: two matching rules and both remainders.

    `accounts` holds account versions, `crm` CRM rows under their logical
    names, `holdings` the published holding results and `run_log` the log of
    their runs.
    """

    targets = {
        name: target(name, attribute_keys=tuple(fv.RECONCILIATION_ATTRIBUTES))
        for name in ("matched_by_global_id", "crm_only", "account_only", "matched_by_external_id")
    }

    def __init__(
        self,
        accounts: DataFrame,
        crm: DataFrame,
        services: DataFrame,
        orders: DataFrame,
        holdings: DataFrame | None = None,
        labels: Mapping[int, str] = fv.TYPE_LABELS,
        account_keys: Sequence[str] = ACCOUNT_KEYS,
        crm_keys: Sequence[str] = CRM_KEYS,
        run_log: DataFrame | None = None,
    ):
        latest = latest_accounts(live_account_versions(accounts, labels), account_keys)
        if holdings is not None:
            if run_log is None:
                raise ValueError("holdings need the log of their runs, to pass over one that broke off")
            latest = with_latest_holding(latest, holdings, run_log)
        self.accounts = with_activity(latest, service_counts(services), order_counts(orders))
        self.crm = latest_crm(crm, crm_keys)

    def compute(self) -> dict[str, DataFrame]:
        """Results by name; both prepared sides are written once for all of them.

        Activity is attached to the accounts before they are matched: accounts
        are unique there, while a matched account may repeat very often.
        """
        accounts, crm = written_together(accounts=self.accounts, crm=self.crm)
        hot = hot_keys(crm, "crm_global_id")
        return {
            "matched_by_global_id": matched(crm, accounts, "crm_global_id", "UNIQUE_GLOBAL_ID", hot),
            "crm_only": crm_only(crm, accounts, hot),
            "account_only": account_only(accounts, crm),
            "matched_by_external_id": matched(crm, accounts, "crm_ext_id", "OBJECT_ID"),
        }


class StoredReconciliation(Control):
    """The same four results from two stored sides, which no join shuffles.

    `Reconciliation` prepares the sides; each is refreshed by the job that changes it,
    so a night on which only the CRM moved deals only the CRM to buckets again.
    """

    targets = Reconciliation.targets

    def __init__(self, accounts: MatchTables, crm: MatchTables):
        self.accounts, self.crm = accounts, crm

    @classmethod
    def tables(cls, spark: SparkSession, name: str, **settings) -> StoredReconciliation:
        """Both sides under names that begin with `name`; `settings` go to `MatchTables`."""
        accounts = MatchTables(spark, f"{name}_accounts", ("UNIQUE_GLOBAL_ID", "OBJECT_ID"), **settings)
        return cls(accounts, MatchTables(spark, f"{name}_crm", ("crm_global_id", "crm_ext_id"), **settings))

    def refresh(self, prepared: Reconciliation, accounts: bool = True, crm: bool = True) -> None:
        """Store the prepared sides that changed."""
        if accounts:
            self.accounts.refresh(prepared.accounts)
        if crm:
            self.crm.refresh(prepared.crm)

    def compute(self) -> dict[str, DataFrame]:
        accounts, crm = self.accounts.read(), self.crm.read()
        alone = match_anti_stored(accounts, crm, "UNIQUE_GLOBAL_ID", "crm_global_id")
        return {
            "matched_by_global_id": match_stored(crm, accounts, "crm_global_id", "UNIQUE_GLOBAL_ID"),
            "crm_only": match_anti_stored(crm, accounts, "crm_global_id", "UNIQUE_GLOBAL_ID"),
            "account_only": alone.where(F.col("STATUS") == fv.ACTIVE_STATUS),
            "matched_by_external_id": match_stored(crm, accounts, "crm_ext_id", "OBJECT_ID"),
        }
