"""How the titles are joined."""

from listlens.bindings import tables


def test_part_texts_are_joined_last(spark):
    plan = tables.title_rows(spark, "/root/testdata/sf0.001").select("title")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("p_partkey") < plan.index("o_orderkey")
