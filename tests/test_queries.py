import pytest
from compare import both
from conftest import SMALL

from obsflow.plans import defects, landed, queries  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    got, want = both(queries.QUERIES[name](spark, SMALL), queries.ORACLE[name], SMALL)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert queries.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans_have_no_python(spark):
    for name in ("validate_reasons", "merge_fact", "daily_summary", "station_coverage", "window_match"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan, name


def test_winner_limits_groups_before_the_shuffle(spark):
    assert "WindowGroupLimit" in queries.QUERIES["dedup_winner"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_lines_of_one_small_file_go_to_all_cores(spark):
    from obsflow.plans import mapping

    assert mapping.table(spark, SMALL, "events").rdd.getNumPartitions() == 1
    lines = mapping.raw_lines(spark, SMALL)
    sizes = lines.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)
