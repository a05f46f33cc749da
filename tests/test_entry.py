import __spark_entry__ as entry


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 100
    assert all(callable(q) for q in queries.values())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "total", "delayed", "delay_rate"] and df.count() == 8
