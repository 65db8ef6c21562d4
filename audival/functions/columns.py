"""Column builders: safe division, canonical months, device names and the
login-state vocabulary. All are JVM expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from audival.functions import vocab as V


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI mode would
    raise on zero)."""
    return F.try_divide(col(num), col(den))


def month_from_yearmonth(c: str | Column) -> Column:
    """``YYYYMM`` text to the first day of the month as DATE. Characters 5..10
    are taken as the month, which for six-character input is just ``MM``."""
    c = col(c)
    return F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 6), F.lit("-01")).cast("date")


def month_from_dash(c: str | Column) -> Column:
    """``YYYY-MM`` text to the first day of the month as DATE."""
    return F.concat(col(c), F.lit("-01")).cast("date")


def normalise_device(c: str | Column, prefix: str) -> Column:
    """Remove every occurrence of ``prefix`` from a request source."""
    return F.replace(col(c), F.lit(prefix))


def _contains_any(c: Column, fragments: tuple[str, ...]) -> Column:
    cond = c.contains(fragments[0])
    for frag in fragments[1:]:
        cond = cond | c.contains(frag)
    return cond


def classify_login_state(status: str | Column, product: str | Column) -> Column:
    """Ordered rule from raw user status and product name to a login state;
    anything unmatched (NULL status or product included) is ``Other``."""
    s = F.lower(col(status))
    p = F.lower(col(product))
    subscribed = s == V.SUBSCRIBED.lower()
    return (F.when(s.isin(*V.CONSENT_ONLY_STATUSES), V.CONSENT_ONLY)
            .when(s == V.NOT_SUBSCRIBED.lower(), V.LOGGED_IN)
            .when(subscribed & _contains_any(p, V.MONTHLY_MARKERS), V.MONTHLY)
            .when(subscribed & _contains_any(p, V.YEARLY_MARKERS), V.YEARLY)
            .otherwise(V.OTHER))


def user_status_of(login_state: str | Column) -> Column:
    """Login state back to the raw user status used by the ratio tables."""
    ls = col(login_state)
    return (F.when(ls.isin(V.CONSENT_ONLY, V.NO_CONSENT), V.NOT_LOGGED_IN)
            .when(ls == V.LOGGED_IN, V.NOT_SUBSCRIBED)
            .when(ls.isin(V.MONTHLY, V.YEARLY), V.SUBSCRIBED))


def consent_status(login_state: str | Column) -> Column:
    ls = col(login_state)
    return F.when(ls == V.NO_CONSENT, V.NO_CONSENT).otherwise(V.CONSENT)


def all_not_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
