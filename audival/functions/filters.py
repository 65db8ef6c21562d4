"""Report dimension filter: ``"field operator value"`` text to a predicate."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted match operators.
OPERATORS = ("contains", "exact", "begins_with", "ends_with")

#: Longer lists of values are not given to a scan.
MOST_VALUES = 1000


_SHAPE = re.compile(r"(?P<field>[^ ]*) (?P<operator>[^ ]*) (?P<value>.*)", re.DOTALL)


def parse_filter(text: str) -> tuple[str, str, str]:
    """Field, operator (any case) and value of a filter text, the value
    without the double quotes around it."""
    shape = _SHAPE.fullmatch(text)
    if shape is None:
        raise ValueError(f"a filter is written as: field operator value; got {text!r}")
    name = shape["operator"].lower()
    if name not in OPERATORS:
        raise ValueError(f"{shape['operator']!r} is none of {', '.join(OPERATORS)}")
    return shape["field"], name, shape["value"].strip('"')


def match(c: Column, operator: str, value: str, case_sensitive: bool = False) -> Column:
    if not case_sensitive:
        c, value = F.lower(c), value.lower()
    tests = {"contains": c.contains, "exact": c.__eq__, "begins_with": c.startswith, "ends_with": c.endswith}
    return tests[operator](value)


def dimension_filter(text: str, resolve: Callable[[str], Column],
                     case_sensitive: bool = False) -> Column:
    """Predicate for a filter text; ``resolve`` maps the field name to the
    dimension's column expression."""
    field, operator, value = parse_filter(text)
    return match(resolve(field), operator, value, case_sensitive)


def matching_values(rows: DataFrame, column: str, test: Column, most: int = MOST_VALUES) -> list | None:
    """The distinct values of ``column`` whose rows pass ``test`` (a function of
    that column alone), or None if they are more than ``most``. A list of values
    can be pushed to a scan where the test, being on a lower-cased text, cannot."""
    found = rows.filter(test).select(column).distinct().limit(most + 1).collect()
    return [r[0] for r in found] if len(found) <= most else None
