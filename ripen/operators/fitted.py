"""Fit once, transform anywhere.

``fit_*`` reads a table (the train part, say) and gives a ``Fitted``: literals in
expressions over one row, or a counted lookup table.  ``transform`` applies
it to any table with the column, streaming tables included when there is no
lookup.  The plain operators are ``fit_x(df, ...).transform(df)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lookup import lookup_join
from ..functions.stats import c


@dataclass(frozen=True)
class Fitted:
    """``replace``: new expression of a column; ``expand``: columns that take the
    place of one, at the end; ``lookup``: (column, key expression, table with
    __v, its value column).  A level that the fit has not seen becomes null (codes,
    means), 'Other' (reduced categories) or false (one-hot)."""

    replace: dict[str, Column] = field(default_factory=dict)
    expand: dict[str, list[tuple[str, Column]]] = field(default_factory=dict)
    lookup: tuple[str, Column, DataFrame, str] | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        if self.lookup:
            col, key, table, value = self.lookup
            df = lookup_join(df.withColumn("__v", key), table.select("__v", value), on="__v", how="left")
            return df.select(*[F.col(value).alias(n) if n == col else c(n) for n in columns])
        kept = [self.replace[n].alias(n) if n in self.replace else c(n) for n in columns if n not in self.expand]
        return df.select(*kept, *[x.alias(n) for n, x in (y for col in self.expand for y in self.expand[col])])


def operator(fit: Callable[..., Fitted]) -> Callable[..., DataFrame]:
    """The operator of a fit: fitted on the table that it transforms."""
    @wraps(fit)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        return fit(df, *args, **kwargs).transform(df)
    return run
