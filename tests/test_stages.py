"""Stages are kept per source and written again when the source changes; totals scan the table once."""

import shutil

import pytest
from pyspark.sql import functions as F

from flowops.operators import groups
from flowops.plans import catalog, flow_view
from flowops.spec import FLOW, family_dimension


def test_a_changed_source_is_read_again(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(500).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = flow_view.read_clean(spark, str(tmp_path)).count()
    assert flow_view.read_clean(spark, str(tmp_path)).count() == rows
    shutil.copy(f"{sf_dir}/lineitem.parquet", tmp_path / "lineitem.parquet" / "part-more.parquet")
    assert flow_view.read_clean(spark, str(tmp_path)).count() > rows


@pytest.mark.parametrize("report", ["label_protocol", "top_volumes", "family_distribution", "top_attacks"])
def test_totals_need_one_scan(spark, sf_dir, report):
    df = catalog.QUERIES[report](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1


def test_mean_indicators_leave_missing_cells_out(spark, sf_dir):
    rate = F.when(F.col("Number") % 2 == 0, F.col(FLOW.rate))
    flows = flow_view.read_clean(spark, sf_dir).withColumn(FLOW.rate, rate)
    got = {r["metrica"]: r["valor_num"] for r in groups.indicators(flows, FLOW).collect()}
    want = flows.agg(F.avg(FLOW.rate)).first()[0]
    assert abs(got["tasa_media"] - want) < 1e-5
    assert family_dimension(spark).count() > 0


def test_cleaning_is_observed_while_it_is_written(spark, sf_dir):
    """The report of the stage equals a scan of the raw rows, and costs none."""
    from flowops.operators import cleaning
    from flowops.plans.flow_view import read_clean_counts, read_flows
    from flowops.spec import FLOW

    counts = read_clean_counts(spark, sf_dir)
    assert "FileScan" not in counts._jdf.queryExecution().executedPlan().toString()
    scanned = cleaning.with_kept(read_flows(spark, sf_dir), FLOW).agg(*cleaning.clean_counts(FLOW)).first().asDict()
    assert counts.first().asDict() == scanned
    assert sorted(cleaning.clean_summary(counts, FLOW).collect()) == sorted(cleaning.clean_report(read_flows(spark, sf_dir), FLOW).collect())


def test_clean_rows_do_not_pay_for_the_counts_of_the_report(spark, sf_dir, tmp_path):
    shutil.copy(f"{sf_dir}/lineitem.parquet", tmp_path / "lineitem.parquet")
    flow_view.read_clean(spark, str(tmp_path)).count()
    key = flow_view._source_key(spark, str(tmp_path), "clean")
    assert key not in flow_view._counted
    flow_view.read_clean_counts(spark, str(tmp_path))
    assert key in flow_view._counted
