from conftest_llm import awkward_rows

from ledgerloop.llm import line_dedup


def site_rows(sites: int, line: str = "All rights reserved.") -> list[tuple]:
    rows = []
    for k in range(sites):
        rows.append((100 + k, f"own {k}\n  {line}\t\nrest {k}", "en", f"s{k}", 0))
    return rows


def test_awkward_documents(folder, same_as_sql):
    path = folder(awkward_rows() + site_rows(12) + site_rows(12, ""), extra=True)
    same_as_sql(line_dedup.op2_line_dedup, line_dedup.ORACLE, path)


def test_threshold_is_exact(spark, folder, same_as_sql):
    for sites in (line_dedup.MIN_SITES - 1, line_dedup.MIN_SITES):
        path = folder(site_rows(sites) + [(1, "All rights reserved.", "en", "s0", 0)])
        found = same_as_sql(line_dedup.op2_line_dedup, line_dedup.ORACLE, path)
        assert found["n_removed"].sum() == (sites if sites >= line_dedup.MIN_SITES else 0)


def test_far_above_the_threshold_the_sketch_decides(spark, folder, same_as_sql):
    path = folder(site_rows(300))
    found = same_as_sql(line_dedup.op2_line_dedup, line_dedup.ORACLE, path)
    assert found["n_removed"].sum() == 299


def test_many_copies_on_one_site_are_no_boilerplate(spark, folder):
    rows = [(k, "same line\nother", "en", "hot", 0) for k in range(500)]
    found = line_dedup.op2_line_dedup(spark, folder(rows)).toPandas()
    assert found["n_removed"].sum() == 0


def test_given_tables(same_as_sql):
    found = same_as_sql(
        line_dedup.op2_line_dedup, line_dedup.ORACLE, "/root/testdata/sf0.01"
    )
    assert found["n_removed"].sum() > 0


def test_stage_keeps_columns_and_rows(spark, folder):
    path = folder(awkward_rows() + site_rows(12), extra=True)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = line_dedup.stage(spark, docs, path)
    assert out.columns == docs.columns and out.count() == docs.count()
    lost = {r.doc_id: r for r in out.collect()}[105]
    assert lost.text == "own 5\nrest 5" and lost.n_chars == len(lost.text)


def test_empty_table(spark, folder):
    assert line_dedup.op2_line_dedup(spark, folder()).collect() == []
