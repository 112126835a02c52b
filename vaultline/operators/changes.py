"""Change capture: keep the newest row of each key, and remove the keys whose newest row is a delete."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.derive import is_true
from vaultline.operators.dedup import leading_row


@dataclass(frozen=True)
class ChangeFeed:
    """How to read a feed of changes.

    ``sequence`` lists SQL expressions, most significant first; a row without a sequence is the
    oldest. ``delete_when`` marks a row as a delete only where it is true. With ``deleted_keep``, a delete
    keeps only these columns and the keys; list at least those that the sequence and the delete read.
    """

    keys: Sequence[str]
    sequence: Sequence[str]
    delete_when: str | None = None
    except_columns: Sequence[str] = ()
    deleted_keep: Sequence[str] | None = None

    def newest(self, changes: DataFrame) -> DataFrame:
        """Newest row per key, deletes included: a late older row can then not revive a key."""
        order = [F.expr(s).desc_nulls_last() for s in self.sequence]
        return self._stripped(leading_row(changes.drop(*self.except_columns), self.keys, order))

    def _stripped(self, newest: DataFrame) -> DataFrame:
        if self.deleted_keep is None:
            return newest
        blank = [c for c in newest.columns if c not in (*self.keys, *self.deleted_keep)]
        return newest.withColumns({c: F.when(~self.is_delete(), F.col(c)) for c in blank})

    def is_delete(self) -> Column:
        return is_true(F.expr(self.delete_when)) if self.delete_when else F.lit(False)

    def live(self, newest: DataFrame) -> DataFrame:
        return newest.filter(~self.is_delete())


def apply_changes(changes: DataFrame, feed: ChangeFeed) -> DataFrame:
    """The table a whole feed leads to. The row order of the feed does not matter."""
    return feed.live(feed.newest(changes))
