import duckdb
import pytest


@pytest.fixture(scope="session")
def tables(spark):
    """``tables(documents=[...], ...)``: writes the rows as the named tables and returns
    their folder and a DuckDB connection that sees them."""
    import tempfile

    def make(**given):
        folder = tempfile.mkdtemp(prefix="llm-tables-")
        con = duckdb.connect()
        for name, (schema, rows) in given.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
        return folder, con

    return make


@pytest.fixture(scope="session")
def agree(spark):
    """Run a query and its SQL on tables and compare the rows."""
    from ledgerflow.llm import queries as Q

    def norm(v):
        if hasattr(v, "as_integer_ratio") and not isinstance(v, (bool, int)):
            return round(float(v), 6)
        return int(v) if isinstance(v, bool) else v

    def rows(cols, got):
        at = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(repr([norm(r[i]) for i in at]) for r in got)

    def check(name, folder, con):
        df = Q.QUERIES[name](spark, folder)
        rel = con.sql(Q.ORACLE[name])
        assert sorted(df.columns) == sorted(rel.columns)
        got = rows(df.columns, [tuple(r) for r in df.collect()])
        assert got == rows(rel.columns, rel.fetchall())
        return len(got)

    return check
