"""Report files: CSV with a header even when empty, optionally
gzip-compressed, as a folder of parts or as one file. The models' tables are
written by ``plans.run``."""

from __future__ import annotations

import gzip as gz
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.plans.files import Files

LINE_END = "\r\n"


def _as_text(df: DataFrame) -> DataFrame:
    """Report values as text, a missing value as an empty string."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def write_report_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Header = the report's columns (dimensions then metrics). Each task
    writes its own part file with the header, so the write stays parallel."""
    writer = _as_text(df).write.mode("overwrite").option("header", True)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def _quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(ch in text for ch in ',"\r\n') else text


def csv_line(names: list[str]) -> Column:
    """A row as a CSV line: values with a comma, quote or line end in quotes,
    quotes doubled; a row of one empty value is a pair of quotes."""
    cells = []
    for name in names:
        c = F.col(f"`{name}`")
        cells.append(F.when(c.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
                     .otherwise(c))
    if len(names) == 1:
        return F.when(F.col(f"`{names[0]}`") == "", F.lit('""')).otherwise(cells[0])
    return F.concat_ws(",", *cells)


def write_report_file(df: DataFrame, path: str, gzip: bool = False) -> None:
    """One CSV file with one header, rows ordered by the report's columns from
    left to right, lines ending in CR LF.

    Tasks write sorted parts without a header. The store then joins header and
    parts: by its own concatenation where it has one, else by copying bytes
    through a buffer; members of a gzip file may follow each other, so nothing
    is packed again. Rows never go through the driver or one task. The file
    replaces one of that name by a rename when it is whole; a write that fails
    leaves the old one."""
    spark, files = df.sparkSession, Files(df.sparkSession)
    work = f"{path}.writing-{uuid.uuid4().hex}"
    rows, names = _as_text(df), df.columns
    if names:
        # ordered by value, not by the text of it
        rows = _as_text(df.orderBy(*[F.col(f"`{c}`") for c in names]))
    writer = rows.select(csv_line(names).alias("value")).write.option("lineSep", LINE_END)
    if gzip:
        writer = writer.option("compression", "gzip")
    try:
        writer.text(f"{work}/parts")
        header = (",".join(map(_quoted, names)) + LINE_END).encode()
        files.write_bytes(f"{work}/whole", gz.compress(header, mtime=0) if gzip else header)
        parts = [f"{work}/parts/{n}" for n in files.names(f"{work}/parts") if n.startswith("part-")]
        files.append(f"{work}/whole", parts)
        files.move(f"{work}/whole", path, replace=True)
    finally:
        files.delete(work)
