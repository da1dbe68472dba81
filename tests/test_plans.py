import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import SMALL, agree  # noqa: E402

from caresieve.plans import registry  # noqa: E402

QUERIES, ORACLES = registry.all_queries(), registry.all_oracles()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_oracle(spark, name):
    agree(spark, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SMALL).columns


def test_site_stage_releases_one_row_a_site(spark):
    assert QUERIES["fed_local_moments"](spark, SMALL).count() <= 5
    assert QUERIES["fed_overlap_similarity"](spark, SMALL).count() <= 25


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1


def _plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "cohort_label_filter")
    assert "PushedFilters: [In(o_orderpriority" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
    assert "l_comment" not in _plan(spark, "fed_local_moments") and "l_tax" not in _plan(spark, "fed_local_moments")


def test_row_checks_are_one_aggregation(spark):
    plan = _plan(spark, "dq_missing_tokens")
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_row_wise_operators_do_not_shuffle(spark):
    for name in ("etl_measurement_eav", "etl_concept_map", "prep_one_hot", "tensor_minmax_scale", "dq_date_format"):
        assert "Exchange" not in _plan(spark, name), name


def _beside(folder, name, rows):
    """A data folder with a table of its own; the others are the small ones."""
    for file in os.listdir(SMALL):
        if file != f"{name}.parquet":
            os.symlink(f"{SMALL}/{file}", folder / file)
    rows.coalesce(1).write.parquet(f"{folder}/of")
    os.rename(next((folder / "of").glob("*.parquet")), folder / f"{name}.parquet")
    return str(folder)


def test_genomic_folders_of_over_999_files(spark, tmp_path):
    rows = spark.range(1015).selectExpr("id * 2 AS s_suppkey", "concat('name ', id) AS s_name", "1 AS s_nationkey", "0D AS s_acctbal")
    agree(spark, QUERIES["sink_genomic_folders"], ORACLES["sink_genomic_folders"], _beside(tmp_path, "supplier", rows))


@pytest.mark.parametrize("name", ["tensor_replicate_groups", "tensor_replicate_pairs"])
def test_replicates_of_ids_that_copies_have_too(spark, tmp_path, name):
    rows = spark.sql("SELECT id AS vec_id, transform(sequence(1, 64), j -> CAST(sin(id * 7 + j) AS FLOAT)) AS embedding, 0 AS label FROM VALUES (0L), (1L), (50L), (100000L), (100001L), (100050L) t(id)")
    agree(spark, QUERIES[name], ORACLES[name], _beside(tmp_path, "embeddings", rows))
