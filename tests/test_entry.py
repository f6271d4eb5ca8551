import __spark_entry__ as contract
from conftest import SMALL


def test_every_check_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.oracle_sql()) > 50


def test_entry_gives_the_flagship_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["country", "host", "rnk", "n"]
    assert df.count() > 0


def test_queries_leave_the_session_settings_alone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    contract.queries()["log_heatmap"](spark, SMALL)
    assert spark.conf.get("spark.sql.session.timeZone") == before
