import __spark_entry__ as E

from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["qms_unit__c", "ignore__qms_unit__c__name__v", "ignore__keyword_helper",
                          "keyword__c"]


def test_every_query_runs_on_sf0001(spark):
    qs, oracles = E.queries(), E.oracle_sql()
    assert set(oracles) <= set(qs)
    for name, fn in qs.items():
        df = fn(spark, SF_SMALL)
        assert df.count() >= 0, name
