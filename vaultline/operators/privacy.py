"""Secured views of tables, and the right to be forgotten."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions import masks
from vaultline.sinks.tables import create_view

PolicyFunction = Callable[[Column, frozenset[str]], Column]

# What an anonymised customer looks like.
FORGOTTEN_NAME = "ANONYMIZED"
FORGOTTEN_MAIL = ("deleted_", "@anonymized.com")
FORGOTTEN_PHONE = "0000000000"


@dataclass(frozen=True)
class TablePolicy:
    """Column masks, and a row filter given as its column and function."""

    masks: Mapping[str, PolicyFunction] = field(default_factory=dict)
    row_filter: tuple[str, PolicyFunction] | None = None

    def columns(self) -> set[str]:
        return set(self.masks) | ({self.row_filter[0]} if self.row_filter else set())


POLICIES: dict[str, TablePolicy] = {
    "customers": TablePolicy(
        masks={"email": masks.mask_email, "phone": masks.mask_phone},
        row_filter=("nationality", masks.rls_by_nationality),
    ),
    "accounts": TablePolicy(masks={"iban": masks.mask_iban}),
    "transactions": TablePolicy(masks={"counterpart_iban": masks.mask_iban}),
}


# Row filters as SQL text.
ROW_FILTER_SQL = {masks.rls_by_nationality: masks.rls_by_nationality_sql}


def secure_view(df: DataFrame, policy: TablePolicy, groups: Iterable[str] = ()) -> DataFrame:
    """What a reader in ``groups`` may see. The row filter works on unmasked values."""
    missing = policy.columns() - set(df.columns)
    if missing:
        raise ValueError(f"policy on unknown columns: {sorted(missing)}")
    reader = masks.reader_groups(groups)
    if policy.row_filter:
        column, visible = policy.row_filter
        df = df.filter(visible(F.col(column), reader))
    return df.withColumns({c: mask(F.col(c), reader) for c, mask in policy.masks.items()})


def secure_views(
    tables: Mapping[str, DataFrame],
    groups: Iterable[str] = (),
    policies: Mapping[str, TablePolicy] = POLICIES,
) -> dict[str, DataFrame]:
    """All tables as seen by a reader in ``groups``; a policy without its table is an error."""
    unknown = set(policies) - set(tables)
    if unknown:
        raise ValueError(f"policies on unknown tables: {sorted(unknown)}")
    nothing = TablePolicy()
    groups = masks.reader_groups(groups)
    return {name: secure_view(df, policies.get(name, nothing), groups) for name, df in tables.items()}


def publish(views: Mapping[str, DataFrame]) -> None:
    """Register the secured tables for SQL under their names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def apply_policies(
    spark: SparkSession, tables: Mapping[str, DataFrame], groups: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """All of it for one reader: SQL functions, forgotten customers, masks and filters, named views."""
    groups = masks.reader_groups(groups)  # once: an iterator would be empty for the views
    masks.register_sql(spark, groups)
    forgotten = {**tables, "customers": anonymize(tables["customers"])}
    views = secure_views(forgotten, groups)
    publish(views)
    return views


def secured_query(table: str, columns: Sequence[str], policy: TablePolicy, membership: str) -> str:
    """SQL text of what whoever runs it may see of ``table``, by the groups that ``membership`` has for them."""
    missing = policy.columns() - set(columns)
    if missing:
        raise ValueError(f"policy on unknown columns: {sorted(missing)}")
    shown = [
        f"{masks.masked_sql(policy.masks[c].__name__, f'`{c}`', membership)} AS `{c}`" if c in policy.masks else f"`{c}`"
        for c in columns
    ]
    query = f"SELECT {', '.join(shown)} FROM {table}"
    if policy.row_filter:
        column, visible = policy.row_filter
        query += f" WHERE {ROW_FILTER_SQL[visible](f'`{column}`', membership)}"
    return query


def secure_in_catalog(
    spark: SparkSession,
    tables: Mapping[str, str],
    membership: str,
    policies: Mapping[str, TablePolicy] = POLICIES,
    suffix: str = "_secured",
) -> dict[str, str]:
    """A lasting view of each catalog table that a policy covers, by the names of ``policies``; returns their names.

    The views ask for the groups of the reader with every query: ``membership`` is a table with user_name and
    group_name, and a change of it holds from the next query on. Give readers the views, not the tables.
    """
    unknown = set(policies) - set(tables)
    if unknown:
        raise ValueError(f"policies on unknown tables: {sorted(unknown)}")
    views = {}
    for name, policy in policies.items():
        table = tables[name]
        views[name] = f"{table}{suffix}"
        query = secured_query(table, spark.table(table).columns, policy, membership)
        create_view(spark, views[name], query, f"{name} as their reader may see them", {"secured": "true"})
    return views


def _blank() -> dict[str, Column]:
    """What takes the place of an identity."""
    before, after = FORGOTTEN_MAIL
    return {
        "full_name": F.lit(FORGOTTEN_NAME),
        "email": F.concat(F.lit(before), F.col("customer_id"), F.lit(after)),
        "phone": F.lit(FORGOTTEN_PHONE),
    }


def anonymize(customers: DataFrame) -> DataFrame:
    """Blank the identity of customers flagged as deleted; an unknown flag leaves the row alone."""
    forgotten = F.col("is_deleted")
    return customers.withColumns({c: F.when(forgotten, value).otherwise(F.col(c)) for c, value in _blank().items()})


def forget_rows(customers: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Blank the identity of all rows of the customers whose key is in ``gone`` (distinct keys).

    ``_forgotten`` tells whether a row still had one: a table without such rows need not be written.
    """
    marked = gone.select(F.col(key).alias("_gone"))
    rows = customers.join(marked, F.col(key) == F.col("_gone"), "left")
    listed = F.col("_gone").isNotNull()
    left = [~F.col(c).eqNullSafe(value) for c, value in _blank().items()]
    return rows.withColumn("_forgotten", listed & reduce(or_, left)).withColumns(
        {c: F.when(listed, value).otherwise(F.col(c)) for c, value in _blank().items()}
    ).drop("_gone")
