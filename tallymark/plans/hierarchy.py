"""Customer hierarchy: the holding account above each account.

The relation table is an edge list. Two hops are followed on purpose: parent
to grandchild, and root parent to child. The grandchild branch does not ask
its parent to be a root, so in A-B-C-D account D is placed under B.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.functions import predicates as p
from tallymark.functions.text import decorated, plain_status
from tallymark.operators.matching import hot_keys, hot_share, match_anti, match_hot, match_inner
from tallymark.operators.shape import as_text, pick, with_role
from tallymark.plans.control import Control, target
from tallymark.session import written_once

EDGE_COLUMNS = ["NAME", "PARENT_ID", "REL_CUST"]
HOLDING_COLUMNS = [
    "NAME_BUS",
    "OBJECT_ID_BUS",
    "CUST_TYPE_BUS",
    "STATUS_BUS",
    "NAME_NC",
    "PARENT_ID",
    "REL_CUST",
    "NAME_HOLDING",
    "OBJECT_ID_HOLDING",
    "ID_CUST_TYPE",
]
WIDE_ACCOUNT_COLUMNS = ["OBJECT_ID", "NAME", "STATUS", "IS_MNC", "IS_OTT", "ACRONYM"]


def parent_edges(relations: DataFrame, parent_of: int = fv.PARENT_OF) -> DataFrame:
    """Edges of the parent relation."""
    return relations.where(F.col("REL_TYPE") == F.lit(parent_of)).select(*EDGE_COLUMNS)


def holding_edges(relations: DataFrame, parent_of: int = fv.PARENT_OF) -> DataFrame:
    """Parent to grandchild, and root parent to child; duplicates are kept."""
    edges = parent_edges(relations, parent_of)
    upper, lower = with_role(edges, "R1"), with_role(edges, "R2")
    # A parent with very many children is hot on both sides.
    hot = hot_keys(edges, "PARENT_ID")
    hops = match_hot(lower, upper, "PARENT_ID_R2", "REL_CUST_R1", hot=hot)
    grandchildren = hops.select(
        F.col("NAME_R1").alias("NAME"),
        F.col("PARENT_ID_R1").alias("PARENT_ID"),
        F.col("REL_CUST_R2").alias("REL_CUST"),
    )
    children = match_anti(upper, lower, "PARENT_ID_R1", "REL_CUST_R2", hot)
    return grandchildren.union(children.select("NAME_R1", "PARENT_ID_R1", "REL_CUST_R1"))


def holding_pairs(relations: DataFrame, parent_of: int = fv.PARENT_OF) -> DataFrame:
    """Distinct (parent, account) pairs."""
    return holding_edges(relations, parent_of).select("PARENT_ID", "REL_CUST").distinct()


def live_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts in a decorated live status with a usable name."""
    cleaned = accounts.where(decorated(F.col("STATUS"))).select(
        F.ltrim("NAME").alias("NAME_BUS"),
        F.col("OBJECT_ID").alias("OBJECT_ID_BUS"),
        F.col("CUST_TYPE").alias("CUST_TYPE_BUS"),
        plain_status(F.col("STATUS")).alias("STATUS_BUS"),
        F.col("NAME").alias("_raw_name"),
    )
    kept = cleaned.where(
        p.equals_any(F.col("STATUS_BUS"), fv.LIVE_STATUSES)
        & p.outside(F.col("_raw_name"), fv.BLANK_NAMES)
    )
    return kept.drop("_raw_name")


def account_types(objects: DataFrame, type_ids: Iterable[int] = tuple(fv.TYPE_LABELS)) -> DataFrame:
    """The account types among all objects.

    One row per type id, so safe to broadcast; a shuffle by type would leave
    all accounts to as many tasks as there are types.
    """
    kept = objects.where(p.equals_any(F.col("OBJECT_ID"), type_ids))
    return F.broadcast(
        kept.select(F.col("OBJECT_ID").alias("OBJECT_ID_NC"), F.col("NAME").alias("NAME_NC"))
    )


def _both_ends() -> Column:
    """The two ends of an edge, with the role of each."""
    return F.array(
        F.struct(F.lit("P").alias("role"), F.col("PARENT_ID").alias("id")),
        F.struct(F.lit("C").alias("role"), F.col("REL_CUST").alias("id")),
    )


def holding_of_accounts(
    accounts: DataFrame,
    relations: DataFrame,
    objects: DataFrame,
    parent_of: int = fv.PARENT_OF,
    type_ids: Iterable[int] = tuple(fv.TYPE_LABELS),
) -> DataFrame:
    """Each typed account as parent and as child, with its holding.

    `role` tells the two apart (P, C). Accounts that are unknown as holding
    leave the holding columns null.
    """
    live = live_accounts(accounts)
    typed = match_inner(live, account_types(objects, type_ids), "CUST_TYPE_BUS", "OBJECT_ID_NC")
    edges = written_once(holding_edges(relations, parent_of).select("PARENT_ID", "REL_CUST"), "edges")
    ends = edges.select("PARENT_ID", "REL_CUST", F.explode(_both_ends()).alias("end"))
    ends = ends.select("PARENT_ID", "REL_CUST", "end.role", F.col("end.id").alias("_end_id"))
    # A parent's share of the ends is half its share of the edges: one count serves both joins.
    hot = hot_keys(ends, "_end_id", share=2 * hot_share(ends.sparkSession))
    both = match_hot(ends, typed, "_end_id", "OBJECT_ID_BUS", hot=hot)
    holders = live.select(
        F.col("NAME_BUS").alias("NAME_HOLDING"),
        F.col("OBJECT_ID_BUS").alias("OBJECT_ID_HOLDING"),
        F.col("CUST_TYPE_BUS").alias("ID_CUST_TYPE"),
    )
    named = match_hot(both, holders, "PARENT_ID", "OBJECT_ID_HOLDING", "left", hot=hot)
    return pick(named, HOLDING_COLUMNS + ["role"])


def holding_pairs_wide(
    accounts: DataFrame,
    relations: DataFrame,
    objects: DataFrame,
    parent_of: int = fv.PARENT_OF,
    columns: Iterable[str] = tuple(WIDE_ACCOUNT_COLUMNS),
) -> DataFrame:
    """Distinct pairs with the columns of both accounts and their type names.

    Unlike `holding_of_accounts`, accounts come as they are and an unknown
    type leaves the type name null.
    """
    columns = list(columns)
    types = objects.select(F.col("OBJECT_ID").alias("_type_id"), F.col("NAME").alias("CUST_TYPE_NAME"))
    kept = accounts.select(*map(p.quoted, columns), F.col("CUST_TYPE").alias("_cust_type"))
    # Few types for all accounts: every one of them is a hot key.
    labelled = match_hot(kept, types, "_cust_type", "_type_id", "left")
    side = pick(labelled, columns + ["CUST_TYPE_NAME"])
    parents, children = with_role(side, "HOLDING"), with_role(side, "LE")
    pairs = written_once(holding_pairs(relations, parent_of), "pairs")
    with_parent = match_hot(pairs, parents, "PARENT_ID", "OBJECT_ID_HOLDING")
    with_both = match_hot(with_parent, children, "REL_CUST", "OBJECT_ID_LE", hot=hot_keys(pairs, "REL_CUST"))
    return pick(with_both, parents.columns + children.columns)


class Holding(Control):
    """Holding account of every account."""

    targets = {"holding": target("holding")}

    def __init__(self, accounts, relations, objects, parent_of=fv.PARENT_OF, type_ids=tuple(fv.TYPE_LABELS)):
        self.inputs = (accounts, relations, objects, parent_of, type_ids)

    def compute(self) -> dict[str, DataFrame]:
        result = pick(holding_of_accounts(*self.inputs), HOLDING_COLUMNS)
        return {"holding": as_text(result, "OBJECT_ID_BUS", "REL_CUST")}
