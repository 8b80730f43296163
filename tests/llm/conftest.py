import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import CLASHING, DOCUMENTS, LABELS, VECTORS


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables below a new folder and gives its path."""
    made = iter(range(1000))

    def write(documents=(), labels=(), vectors=(), extra=False) -> str:
        path = str(tmp_path / f"tables-{next(made)}")
        for name, rows, schema in (
            ("documents", documents, DOCUMENTS),
            ("labels", labels, LABELS),
            ("embeddings", vectors, VECTORS),
        ):
            df = spark.createDataFrame(list(rows), schema)
            if extra:
                from pyspark.sql import functions as F

                df = df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})
            df.coalesce(2).write.parquet(f"{path}/{name}.parquet")
        return path

    return write


@pytest.fixture
def same_as_sql(spark):
    """Compares a query with its SQL, run by another engine on the same files."""
    import glob

    import duckdb

    def compare(query, sql, path):
        found = query(spark, path).toPandas()
        con = duckdb.connect()
        for file in glob.glob(f"{path}/*.parquet"):
            name = file.rsplit("/", 1)[1].removesuffix(".parquet")
            pattern = file if not glob.glob(f"{file}/*.parquet") else f"{file}/*.parquet"
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{pattern}'")
        wanted = con.sql(sql).df()[list(found.columns)]

        def rows(frame):
            plain = frame.astype(object).where(frame.notna(), None)
            return sorted(
                (
                    tuple(round(x, 9) if isinstance(x, float) else x for x in row)
                    for row in plain.itertuples(index=False)
                ),
                key=repr,
            )

        def whole(row):
            return tuple(float(x) if isinstance(x, (int, float)) else x for x in row)

        assert [whole(r) for r in rows(found)] == [whole(r) for r in rows(wanted)]
        return found

    return compare
