"""Rules that stop a computation, written as filters so that no projection can prune them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, condition: Column, message: Column | str) -> DataFrame:
    """``df`` unchanged; a row on which ``condition`` is not true raises ``message``."""
    text = F.lit(message) if isinstance(message, str) else message
    holds = F.coalesce(condition, F.lit(False))
    return df.where(F.when(holds, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def at_key(what: str, keys: list[str]) -> Column:
    """A message that names the key it is about."""
    return F.concat(F.lit(f"{what} "), F.to_json(F.struct(*keys)))
