"""Typed report values (``kind: value`` text) to plain values."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.functions.columns import col

# The characters Python's str.strip() removes (every str.isspace() character).
WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())


def strip(c: Column) -> Column:
    """str.strip(). It references ``c`` once: filters pushed below the parse
    inline these expressions, and any repeated reference multiplies there."""
    return F.btrim(c, F.lit(WHITESPACE))


def _parts(text: Column, lenient: bool = False) -> tuple[Column, Column, Column]:
    """kind (before the first ':'), the text after the first ':' and the text
    between the first and second ':', each stripped. A text without ':' is an
    error, or has no kind if ``lenient``; null stays null."""
    at = F.instr(text, ":")
    kind = F.when(at > 0, F.lower(F.substring_index(text, ":", 1)))
    if not lenient:
        kind = kind.when(text.isNotNull(), F.raise_error(
            F.concat(F.lit("a typed value has no ':': "), text)).cast("string"))
    after_first = strip(F.substr(text, at + 1))
    second = strip(F.substring_index(F.substring_index(text, ":", 2), ":", -1))
    return kind, after_first, second


#: Type of a parsed column by what the definition says of it.
TYPES = {"date": "date", "int_value": "bigint", "double_value": "double", "string_value": "string"}


def _value(kind: Column, after_first: Column, second: Column, to: str, lenient: bool = False) -> Column:
    if to == "date":
        # the kind is looked at first, so that a text without ':' is an error
        day = F.try_to_timestamp(second, F.lit("yyyyMMdd")).cast("date") if lenient else F.to_date(second, "yyyyMMdd")
        return F.when(kind.isNotNull(), day)
    quoted = after_first.startswith('"') & after_first.endswith('"')
    unquoted = F.when(quoted, F.substring(after_first, F.lit(2), F.length(after_first) - 2))
    text = F.when(kind == "string_value", unquoted.otherwise(after_first)).when(kind.isNotNull(), second)
    if to == "string":
        return text
    return text.try_cast(to) if lenient else text.cast(to)


def parse_typed_value(c: str | Column, is_date: bool = False) -> Column:
    """A date column takes the text between the first and second ``:`` as
    ``yyyyMMdd``; ``string_value`` takes everything after the first ``:``
    with one pair of surrounding quotes removed; any other kind takes the
    text between the first and second ``:``. Results are stripped."""
    return _value(*_parts(strip(col(c))), "date" if is_date else "string")


def parse_typed_columns(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """``out: (source column, type)`` parsed in three projections, so each
    text is stripped and split once per row rather than once per use."""
    stripped = df.select(*[strip(F.col(src)).alias(f"_t{i}") for i, (src, _) in enumerate(columns.values())])
    parts = []
    for i in range(len(columns)):
        kind, after_first, second = _parts(F.col(f"_t{i}"))
        parts += [kind.alias(f"_k{i}"), after_first.alias(f"_a{i}"), second.alias(f"_s{i}")]
    split = stripped.select(*parts)
    return split.select(*[_value(F.col(f"_k{i}"), F.col(f"_a{i}"), F.col(f"_s{i}"), to).alias(out)
                          for i, (out, (_, to)) in enumerate(columns.items())])


def split_typed_columns(df: DataFrame, columns: dict[str, tuple[str, str]], keep: list[str], reason: str) -> DataFrame:
    """As ``parse_typed_columns``, but no value ends the job: a value that
    cannot be read is null and ``reason`` says what is wrong with it, for each
    such column of the row; it is null for a row that is good. ``keep`` names
    columns of ``df`` that stay. Null values are values, not faults."""
    names = list(columns)
    rows = df.select(*keep, *[strip(F.col(src)).alias(f"_t{i}") for i, (src, _) in enumerate(columns.values())])
    parts = []
    for i in range(len(names)):
        kind, after_first, second = _parts(F.col(f"_t{i}"), lenient=True)
        parts += [F.col(f"_t{i}").isNotNull().alias(f"_g{i}"), kind.alias(f"_k{i}"), after_first.alias(f"_a{i}"),
                  second.alias(f"_s{i}")]
    rows = rows.select(*keep, *parts)
    rows = rows.select(*keep, *[c for i, (_, to) in enumerate(columns.values()) for c in (
        (F.col(f"_g{i}") & F.col(f"_k{i}").isNull()).alias(f"_n{i}"), F.col(f"_g{i}"),
        _value(F.col(f"_k{i}"), F.col(f"_a{i}"), F.col(f"_s{i}"), to, lenient=True).alias(f"_v{i}"))])
    faults = [F.when(F.col(f"_n{i}"), F.lit(f"{name}: no kind")).when(
        F.col(f"_g{i}") & F.col(f"_v{i}").isNull(), F.lit(f"{name}: not a {columns[name][1]}"))
        for i, name in enumerate(names)]
    # the one row of a generator: a filter on the reason stays above it, where pushed below the parse it would
    # parse each text again for every use
    judged = F.struct(*[F.col(f"_v{i}").alias(name) for i, name in enumerate(names)],
                      F.nullif(F.concat_ws("; ", *faults), F.lit("")).alias(reason))
    return rows.select(*keep, F.inline(F.array(judged)))
