from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.dates import month_start, prior_month, prior_month_value, yyyymm
from revmap.operators import coverage as cov
from revmap.operators import mapping as mp

JAN, FEB = "1998-01-01", "1998-02-01"
AS_OF = {"as_of": "1998-02-15"}


def test_prior_month(spark):
    one = spark.range(1)
    for as_of, back in (("2026-01-31", 1), ("2026-03-31", 1), ("2025-12-01", 4), ("2024-02-29", 12), ("2026-01-15", 0)):
        got = one.select(prior_month(as_of, back)).first()[0]
        assert got == prior_month_value(as_of, back) and got.day == 1
    assert prior_month_value("2026-01-31") == dt.date(2025, 12, 1)
    assert one.select(month_start("2026-01-31"), yyyymm("2024-12-30")).first() == (dt.date(2026, 1, 1), "202412")


def test_left_view_fans_out_and_keeps_unmapped(revenue, mapping, rows):
    r = revenue(("a", JAN, 1.0), ("b", JAN, 2.0), (None, JAN, 3.0), ("a", FEB, 9.0))
    m = mapping(("a", "A", "1"), ("a", "A2", "2"), (None, "N", "3"))
    v = mp.map_revenue(r, m, **AS_OF)
    assert rows(v.select("id", "amount", "Oracle_Customer_Name")) == [
        ("a", 1.0, "A"),
        ("a", 1.0, "A2"),
        ("b", 2.0, None),
        (None, 3.0, None),
    ]
    first = mp.map_revenue(r, m, on_duplicate="first", **AS_OF)
    assert rows(first.select("id", "Oracle_Customer_Name")) == [("a", "A"), ("b", None), (None, None)]
    with pytest.raises(ValueError, match="duplicate"):
        mp.map_revenue(r, m, on_duplicate="raise", **AS_OF)
    assert mp.map_revenue(r, m, month=FEB).count() == 2


def test_flags(revenue, mapping, rows):
    r = revenue(("a", JAN, 1.0), ("b", JAN, 2.0), ("c", JAN, 3.0))
    m = mapping(("a", "A", "1"), ("b", "B", None))
    v = mp.map_revenue(r, m, flags=True, **AS_OF)
    assert v.columns[:8][-1] == "id"
    assert rows(v.select("id", "Oracle_mapped_record_flag", "ID_mapped_record_flag")) == [
        ("a", "Y", "Y"),
        ("b", "N", "Y"),
        ("c", "N", "N"),
    ]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_mapping_master(spark, revenue, mapping, rows, threshold):
    r = revenue(("a", JAN, 1.0), ("a", JAN, 2.0), ("b", FEB, 3.0), (None, JAN, 4.0))
    m = mapping(("a", "A", "1"), ("b", "B", "1"), (None, "N", "1"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = mp.map_revenue(r, m, master="mapping", **AS_OF).select("mapping_ID", "id", "amount")
        inner = mp.map_revenue(r, m, master="mapping", how="inner", **AS_OF).select("mapping_ID", "id", "amount")
        assert rows(left) == [("a", "a", 1.0), ("a", "a", 2.0), ("b", None, None), (None, None, None)]
        assert rows(inner) == [("a", "a", 1.0), ("a", "a", 2.0)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unmapped_and_unused(revenue, mapping, rows):
    r = revenue(("a", JAN, 1.0), ("z", JAN, 2.0), (None, JAN, None), ("b", FEB, 9.0))
    m = mapping(("a", "A", "1"), ("b", "B", "1"), (None, "N", "1"))
    assert [x.id for x in mp.unmapped_revenue(r, m, **AS_OF).collect()] == ["z", None]
    assert rows(mp.unmapped_totals(r, m, measure="amount", **AS_OF)) == [(2, 1, 2.0)]
    assert [x.ID for x in mp.unused_mappings(r, m, **AS_OF).collect()] == ["b", None]
    assert mp.unused_count(r, m, **AS_OF).first()[0] == 2


def test_months(revenue):
    r = revenue(("a", JAN, 1.0), ("b", JAN, 1.0), ("a", FEB, 1.0), ("a", None, 1.0))
    assert [tuple(x) for x in mp.months_available(r, 2).collect()] == [(None, 1), (dt.date(1998, 2, 1), 1)]
    bounds = mp.month_bounds(r, "1998-02-15").first()
    assert (bounds.prior_month_start, bounds.prior_month_records) == (dt.date(1998, 1, 1), 2)


def test_month_is_required(revenue):
    with pytest.raises(ValueError):
        mp.month_slice(revenue(("a", JAN, 1.0)))


def _percent(revenue, mapping, mapped, total):
    r = revenue(*[(f"c{i}", JAN, 1.0) for i in range(total)])
    m = mapping(*[(f"c{i}", "A", "1") for i in range(mapped)])
    return r, m


@pytest.mark.parametrize(
    ("mapped", "total", "pct", "status"),
    [(19, 20, 95.0, "PASS"), (16, 20, 80.0, "WARNING"), (10, 20, 50.0, "FAIL"), (20, 20, 100.0, "PASS")],
)
def test_band_edges(revenue, mapping, mapped, total, pct, status):
    row = cov.coverage(*_percent(revenue, mapping, mapped, total), **AS_OF).first()
    assert (row.revenue_coverage_rate_pct, row.revenue_coverage_status) == (pct, status)


@pytest.mark.parametrize(
    ("mapped", "status"), [(16, texts.PASS_QUALITY), (10, texts.WARN_COVERAGE), (9, texts.FAIL_QUALITY)]
)
def test_report_bands(revenue, mapping, mapped, status):
    r, m = _percent(revenue, mapping, mapped, 20)
    v = mp.map_revenue(r, m, **AS_OF)
    row = cov.merged_report(r, m, v, **AS_OF).first()
    assert row.overall_status == status
    assert (row.total_mapping_records, row.unmapped_revenue_count) == (mapped, 20 - mapped)


def test_no_revenue_in_month(revenue, mapping):
    r, m = revenue(("a", FEB, 1.0)), mapping(("a", "A", "1"))
    row = cov.coverage(r, m, **AS_OF).first()
    assert (row.total_revenue_records, row.revenue_coverage_rate_pct, row.revenue_coverage_status) == (0, None, "FAIL")
    assert cov.coverage_failures(r, m, **AS_OF).count() == 0
    assert cov.coverage_failures(r, m, fail_on_empty=True, **AS_OF).count() == 1


def test_nothing_at_all(revenue, mapping):
    row = cov.coverage(revenue(), mapping(), variant="model", run_ts="2026-01-01 00:00:00", **AS_OF).first()
    assert (row.total_mapping_records, row.mapping_usage_rate_pct) == (0, None)


def test_failures_threshold(revenue, mapping):
    r, m = _percent(revenue, mapping, 19, 20)
    assert cov.coverage_failures(r, m, **AS_OF).count() == 0
    assert cov.coverage_failures(r, m, threshold=96, **AS_OF).count() == 1


def test_model_counts_rows_after_the_join(revenue, mapping):
    r = revenue(("a", JAN, 1.0), ("a", JAN, 2.0), (None, JAN, 1.0))
    m = mapping(("a", "A", "1"), ("a", "A", "1"), ("b", "B", "1"), (None, "N", "1"), (None, "N", "1"))
    row = cov.coverage(r, m, variant="model", run_ts="2026-01-01 00:00:00", **AS_OF).first()
    assert (row.total_unique_mapping_records, row.total_mapping_records, row.used_mapping_records) == (2, 7, 1)


def test_a_value_called_unmapped_stays_apart(revenue, mapping, rows):
    r = revenue(("a", JAN, 1.0), ("z", JAN, 2.0))
    v = mp.map_revenue(r, mapping(("a", "UNMAPPED", "UNMAPPED")), **AS_OF)
    v = v.withColumn("Oracle_Invoice_Group", F.lit(None).cast("string"))
    got = cov.revenue_by_mapping(v, "amount").select("Oracle_Customer_Name", "total_records", "total_revenue")
    assert rows(got) == [("UNMAPPED", 1, 1.0), ("UNMAPPED", 1, 2.0)]


IDS = st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(r_ids=IDS, m_ids=IDS)
def test_coverage_adds_up_and_matches_the_join(revenue, mapping, r_ids, m_ids):
    r, m = revenue(*[(i, JAN, 1.0) for i in r_ids]), mapping(*[(i, "A", "1") for i in m_ids])
    row = cov.coverage(r, m, variant="model", run_ts="2026-01-01 00:00:00", **AS_OF).first()
    assert row.mapped_revenue_records + row.unmapped_revenue_records == row.total_revenue_records
    assert row.used_mapping_records + row.unused_mapping_records == row.total_unique_mapping_records
    joined = m.select(F.col("ID").alias("k")).join(r, F.col("k") == F.col("id"), "left")
    assert row.total_mapping_records == joined.count()
    assert row.mapped_revenue_records == len({i for i in r_ids if i in m_ids} - {None})
