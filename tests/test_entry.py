"""The driver contract of __spark_entry__.py."""

import re

import __spark_entry__ as E


def test_keys_and_oracle_agree():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    own = {k for k in q if not re.match(r"op\d+_|pipeline$", k)}  # the text operators have tests of their own
    assert own <= set(sql) and len(own) >= 70


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["quarter", "year", "month", "publication", "login_state", "tclv_value"]
    assert dict(df.dtypes) == {"quarter": "string", "year": "int", "month": "date", "publication": "string",
                               "login_state": "string", "tclv_value": "double"}
    assert df.count() > 0
