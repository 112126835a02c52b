"""Masking and row-visibility functions.

The reader's groups are known on the driver, so a privileged reader's mask is the plain column and
nothing about groups is left for the executors to evaluate.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Group names and the literals the masks put in.
ENGINEERS = "data-engineers"
ANALYST_NATIONALITY = (("data-analysts-fr", "FR"), ("data-analysts-be", "BE"))
EMAIL_FILL = "***@"
PHONE_FILL = "*****"
IBAN_FILL = "***"


# The masks as SQL text over a column.
MASK_SQL = {
    "mask_email": f"concat(left({{0}}, 1), '{EMAIL_FILL}', get(split({{0}}, '@'), 1))",
    "mask_phone": f"concat(left({{0}}, 4), '{PHONE_FILL}', right({{0}}, 3))",
    "mask_iban": f"concat(left({{0}}, 4), '{IBAN_FILL}', right({{0}}, 3))",
}


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ends(c: Column, head: int, fill: str, tail: int) -> Column:
    return F.concat(F.left(c, F.lit(head)), F.lit(fill), F.right(c, F.lit(tail)))


def reader_groups(groups: Iterable[str]) -> frozenset[str]:
    """The groups of a reader; a single text is refused, as it would match groups by their parts."""
    if isinstance(groups, str):
        raise TypeError("groups must be a collection of names, not one text")
    return frozenset(groups)


def mask_email(c: Column | str, groups: Iterable[str] = ()) -> Column:
    """First character and the domain; text without a domain masks to NULL."""
    c = _column(c)
    if ENGINEERS in reader_groups(groups):
        return c
    return F.concat(F.left(c, F.lit(1)), F.lit(EMAIL_FILL), F.get(F.split(c, "@"), 1))


def mask_phone(c: Column | str, groups: Iterable[str] = ()) -> Column:
    c = _column(c)
    return c if ENGINEERS in reader_groups(groups) else _ends(c, 4, PHONE_FILL, 3)


def mask_iban(c: Column | str, groups: Iterable[str] = ()) -> Column:
    c = _column(c)
    return c if ENGINEERS in reader_groups(groups) else _ends(c, 4, IBAN_FILL, 3)


def visible_nationality(groups: Iterable[str] = ()) -> str | bool:
    """True for everything, False for nothing, or the one nationality the reader may see."""
    groups = reader_groups(groups)
    if ENGINEERS in groups:
        return True
    return next((nation for group, nation in ANALYST_NATIONALITY if group in groups), False)


def rls_by_nationality(c: Column | str, groups: Iterable[str] = ()) -> Column:
    seen = visible_nationality(groups)
    return F.lit(seen) if isinstance(seen, bool) else _column(c) == seen


def register_sql(spark: SparkSession, groups: Iterable[str] = ()) -> None:
    """Offer the four functions to SQL text as temporary functions for a reader in ``groups``."""
    groups = reader_groups(groups)
    clear = ENGINEERS in groups
    seen = visible_nationality(groups)
    bodies = {
        f"{name}({column} STRING) RETURNS STRING": column if clear else mask.format(column)
        for (name, mask), column in zip(MASK_SQL.items(), ("email", "phone", "iban"))
    }
    seen_sql = str(seen).lower() if isinstance(seen, bool) else f"nationality = '{seen}'"
    bodies["rls_by_nationality(nationality STRING) RETURNS BOOLEAN"] = seen_sql
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def member_sql(membership: str, group: str) -> str:
    """Whether the user who runs a query is in a group by the table ``membership`` (user_name, group_name), as SQL text."""
    return f"(SELECT count(*) > 0 FROM {membership} WHERE user_name = session_user() AND group_name = '{group}')"


def masked_sql(mask: str, column: str, membership: str) -> str:
    """The named mask over a column, for whoever runs the query."""
    return f"CASE WHEN {member_sql(membership, ENGINEERS)} THEN {column} ELSE {MASK_SQL[mask].format(column)} END"


def rls_by_nationality_sql(column: str, membership: str) -> str:
    """The rows that whoever runs the query may see; the first group that fits decides."""
    cases = [f"WHEN {member_sql(membership, ENGINEERS)} THEN true"]
    cases += [f"WHEN {member_sql(membership, group)} THEN {column} = '{nation}'" for group, nation in ANALYST_NATIONALITY]
    return f"CASE {' '.join(cases)} ELSE false END"
