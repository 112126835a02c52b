"""Bronze: landed rows as they are, minus those the drop rules reject."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from vaultline.operators.rules import enforce
from vaultline.plans import rulebook
from vaultline.schemas import MALFORMED


def raw(entity: str, landed: DataFrame, metrics: str | Observation | None = None) -> DataFrame:
    """``landed`` may be a batch or a stream of one entity's files."""
    rules = rulebook.BRONZE[entity]
    if MALFORMED in landed.columns:
        rules += rulebook.LANDED[entity]
    return enforce(landed, rules, metrics)
