import re

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date_td", "cnt", "enb", "gridid", "pct", "rank", "is_other"]
    assert df.count() > 0


def test_every_library_query_has_an_oracle():
    """The optional subpackage's queries (opN_..., pipeline) may go without one."""
    qs, os_ = set(E.queries()), set(E.oracle_sql())
    assert os_ <= qs
    assert all(re.fullmatch(r"op\d+_\w+|pipeline", name) for name in qs - os_)
