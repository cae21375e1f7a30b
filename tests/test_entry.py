import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Vehicle_ID", "events", "lost"] and df.count() > 0


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
