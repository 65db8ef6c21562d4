"""Share of a total within groups.

``window`` (default): one window sum over the group keys. The inputs the
models pass are already aggregated (months x devices x states x segments), so
a window partition is a handful of rows and the source is scanned once.

``join``: aggregate the totals and join them back, the models' own form.
Its totals are partially aggregated before the shuffle, so it is the form to
use on an input that is not yet aggregated, where one hot group would
otherwise land in a single window task.

Both give NULL wherever a group key is NULL, since a join never matches one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audival.functions.columns import all_not_null, safe_div


def share(value: str, within: list[str]) -> Column:
    total = F.sum(value).over(Window.partitionBy(*within))
    return F.when(all_not_null(within), safe_div(F.col(value), total))


def share_of_total(df: DataFrame, values: dict[str, str], within: list[str],
                   method: str = "window") -> DataFrame:
    """Add ``out = value / sum(value) over within`` for each ``out: value``."""
    if method == "window":
        return df.select("*", *[share(v, within).alias(out) for out, v in values.items()])
    if method != "join":
        raise ValueError(f"unknown method {method}")
    totals = df.groupBy(*within).agg(*[F.sum(v).alias(f"_total_{out}") for out, v in values.items()])
    joined = df.join(totals, within, "left")
    return joined.select(*df.columns, *[safe_div(F.col(v), F.col(f"_total_{out}")).alias(out)
                                        for out, v in values.items()])
