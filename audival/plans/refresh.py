"""Which months have changed, and inputs of these months alone.

Every table of the models depends month by month on the inputs: all joins and
groups have the month among their keys. So a month needs to be computed again
only if an input has other rows of it. A month's fingerprint says so: the
files that hold rows of the month (path, size, time of change), read off the
scan's metadata and the month column alone, or, for an input that is no scan of
files, a checksum of its rows; and the parameters of the run.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.functions.columns import month_from_dash, month_from_yearmonth
from audival.plans.inputs import INPUT_NAMES, Inputs
from audival.plans.stage import run_concurrently
from audival.sources import schemas

#: Part of every fingerprint: raise it when the models' results change.
VERSION = 1
#: What stands for rows without a month in names of folders and manifests.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"

#: Inputs whose month is text: column, reader, format of a day's month.
TEXT_MONTHS = {"ga4_export": ("yearMonth", month_from_yearmonth, "%Y%m"),
               "ga4_device_aggregate": ("month", month_from_dash, "%Y-%m")}


def _month(df: DataFrame, name: str) -> Column:
    if name in TEXT_MONTHS:
        column, read, _ = TEXT_MONTHS[name]
        return read(column)
    return schemas.month(F.col("month"), dict(df.dtypes)["month"])


def fingerprint_of(df: DataFrame, name: str) -> dict[str, str]:
    """Month to what its rows of one input are known by."""
    rows = df.select(_month(df, name).alias("m"), F.struct("*").alias("row"))
    try:
        files = df.select(_month(df, name).alias("m"), F.struct(
            "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("row")).distinct()
        rows = files
    except AnalysisException:
        pass  # not a scan of files
    one, two = F.xxhash64(F.to_json("row")), F.xxhash64(F.lit(1), F.to_json("row"))
    sums = rows.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(one).alias("x"),
                                 F.sum(two.cast("decimal(38,0)")).alias("s"))
    # one row per month of an input
    return {NO_MONTH if r["m"] is None else str(r["m"]): f"{r['n']}/{r['x']}/{r['s']}" for r in sums.collect()}


def fingerprints(inp: Inputs) -> dict[str, str]:
    """Month to fingerprint, for every month that any input has."""
    parts: dict[str, list[str]] = {}
    found = run_concurrently({n: (lambda n=n: fingerprint_of(inp.source(n), n)) for n in INPUT_NAMES}, workers=8)
    for name, months in found.items():
        for month, what in months.items():
            parts.setdefault(month, []).append(f"{name}:{what}")
    first, last = inp.window
    out = {}
    for month, what in parts.items():
        run = f"{VERSION}|{inp.publication}|{inp.device_prefix}|{str(first) <= month <= str(last)}"
        out[month] = hashlib.sha256("|".join([run, *sorted(what)]).encode()).hexdigest()
    return out


def months_only(inp: Inputs, months: list[str]) -> Inputs:
    """The inputs' rows of some months. The filter is on the stored column in
    its own form, so it reaches the scan."""
    days = [dt.date.fromisoformat(m) for m in months if m != NO_MONTH]

    def cut(name: str) -> DataFrame:
        df = getattr(inp, name)
        if name in TEXT_MONTHS:
            column, _, form = TEXT_MONTHS[name]
            is_in = F.col(column).isin([d.strftime(form) for d in days])
        else:
            column, is_in = "month", F.col("month").isin(days)
        return df.filter(is_in | F.col(column).isNull() if NO_MONTH in months else is_in)
    return inp.with_tables(**{name: cut(name) for name in INPUT_NAMES})
