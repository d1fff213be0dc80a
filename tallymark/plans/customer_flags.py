"""Customers marked by their tax id against the products of their services."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.functions import predicates as p
from tallymark.functions.text import service_label
from tallymark.operators.matching import hot_keys, match_hot, match_semi
from tallymark.operators.shape import pick
from tallymark.operators.versions import on_both_sides, rows_per
from tallymark.plans.control import Control, target
from tallymark.session import written_once

ACCOUNT_COLUMNS = ["NAME", "OBJECT_ID", "CUST_CATEGORY", "TAX_IDENT_NUMBER", "CUSTOMER_ACCNUM"]
SERVICE_KEYS = ["NAME_TOP", "CUSTOMER_ACCOUNT_TOP", "PRODUCT_CODE_TOP"]
SERVICE_COUNT = "n_services"


def active_services(services: DataFrame, count: str = SERVICE_COUNT) -> DataFrame:
    """Active services per clean name, customer and product, with their number."""
    active = services.where(p.equals_any(F.col("STATUS"), [fv.ACTIVE_STATUS])).select(
        service_label(F.col("NAME")).alias("NAME_TOP"),
        F.col("CUSTOMER_ACCOUNT").alias("CUSTOMER_ACCOUNT_TOP"),
        F.col("PRODUCT_CODE").alias("PRODUCT_CODE_TOP"),
    )
    return rows_per(active, SERVICE_KEYS, count)


def named_accounts(accounts: DataFrame, columns: Sequence[str] = ACCOUNT_COLUMNS) -> DataFrame:
    """Accounts with a usable name, left-trimmed."""
    named = pick(accounts, columns).where(p.named(F.col("NAME")))
    return named.withColumn("NAME", F.ltrim("NAME"))


def flagged_accounts(accounts: DataFrame, columns: Sequence[str] = ACCOUNT_COLUMNS) -> DataFrame:
    """Accounts whose tax id carries the flag; names stay as they are."""
    return pick(accounts, columns).where(p.has_prefix(F.col("TAX_IDENT_NUMBER"), fv.FLAG_PREFIX))


def unflagged_accounts(accounts: DataFrame, columns: Sequence[str] = ACCOUNT_COLUMNS) -> DataFrame:
    """Named accounts whose tax id is missing or carries no flag."""
    named = named_accounts(accounts, columns)
    return named.where(p.lacks_prefix_or_null(F.col("TAX_IDENT_NUMBER"), fv.FLAG_PREFIX))


def _is_flag_product(codes: Sequence[str]) -> Column:
    return p.equals_any(F.col("PRODUCT_CODE_TOP"), codes)


def _with_services(customers: DataFrame, services: DataFrame, hot: Sequence) -> DataFrame:
    """Customers with their services; `hot` are customers holding much of them."""
    joined = match_hot(services, customers, "CUSTOMER_ACCOUNT_TOP", "OBJECT_ID", hot=hot)
    return pick(joined, customers.columns + services.columns)


def flagged_without_flag_services(
    flagged: DataFrame,
    services: DataFrame,
    codes: Sequence[str] = fv.FLAG_PRODUCT_CODES,
    hot: Sequence = (),
) -> DataFrame:
    """Flagged customers with services of other products; unknown products go."""
    others = services.where(p.outside(F.col("PRODUCT_CODE_TOP"), codes))
    return _with_services(flagged, others, hot)


def unflagged_with_flag_services(
    unflagged: DataFrame,
    services: DataFrame,
    codes: Sequence[str] = fv.FLAG_PRODUCT_CODES,
    hot: Sequence = (),
) -> DataFrame:
    """Unflagged customers with services of flag products."""
    return _with_services(unflagged, services.where(_is_flag_product(codes)), hot)


def shared_customers(
    named: DataFrame,
    services: DataFrame,
    codes: Sequence[str] = fv.FLAG_PRODUCT_CODES,
    hot: Sequence = (),
) -> DataFrame:
    """All services of customers that hold both kinds of products.

    The customers are narrowed down first, then joined to the services once.
    The services are read twice, so they should be a stored table.
    """
    both = on_both_sides(services, "CUSTOMER_ACCOUNT_TOP", _is_flag_product(codes))
    customers = match_semi(named, both, "OBJECT_ID", "CUSTOMER_ACCOUNT_TOP")
    return _with_services(customers, services, hot)


class CustomerFlags(Control):
    """Flag of a customer against the services it holds."""

    targets = {
        name: target(name)
        for name in (
            "flagged_without_flag_services",
            "unflagged_with_flag_services",
            "shared_customers",
        )
    }

    def __init__(
        self,
        accounts: DataFrame,
        services: DataFrame,
        codes: Sequence[str] = fv.FLAG_PRODUCT_CODES,
        columns: Sequence[str] = ACCOUNT_COLUMNS,
        count: str = SERVICE_COUNT,
    ):
        self.accounts, self.codes, self.columns = accounts, codes, columns
        self.services = active_services(services, count)

    def compute(self) -> dict[str, DataFrame]:
        """Results by name; the grouped services are written once for all of them."""
        services = written_once(self.services, "services")
        hot = hot_keys(services, "CUSTOMER_ACCOUNT_TOP")
        accounts, columns = self.accounts, self.columns
        return {
            "flagged_without_flag_services": flagged_without_flag_services(
                flagged_accounts(accounts, columns), services, self.codes, hot
            ),
            "unflagged_with_flag_services": unflagged_with_flag_services(
                unflagged_accounts(accounts, columns), services, self.codes, hot
            ),
            "shared_customers": shared_customers(
                named_accounts(accounts, columns), services, self.codes, hot
            ),
        }
