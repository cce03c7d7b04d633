from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revmap.operators import recon
from revmap.operators import rebuild as rb
from revmap.operators import sketches as sk

KEYS, MEASURES = ["id", "data_month", "feed"], ["x", "y"]
DAY = dt.date(2025, 2, 1)


@pytest.fixture
def side(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(i, m, f, None if x is None else Decimal(x), None if y is None else Decimal(y)) for i, m, f, x, y in rows],
            "id string, data_month date, feed string, x decimal(18,4), y decimal(18,4)",
        )

    return make


@pytest.mark.parametrize("method", ["aggregate", "join"])
def test_diff_edges(side, rows, method):
    dev = side(
        ("same", DAY, "f", "1", "1"),
        ("edge", DAY, "f", "1.01", "1"),
        ("over", DAY, "f", "1.02", "1"),
        ("dev", DAY, "f", "1", "1"),
        (None, None, None, "5", None),
        ("split", DAY, "f", "1", "1"),
        ("split", DAY, "f", "2", "1"),
        ("empty", DAY, "f", None, None),
    )
    prod = side(
        ("same", DAY, "f", "1", "1"),
        ("edge", DAY, "f", "1", "1"),
        ("over", DAY, "f", "1", "1"),
        ("prod", DAY, "f", "1", "1"),
        ("N/A", None, "N/A", "5", "0"),
        ("split", DAY, "f", "3", "2"),
        ("empty", DAY, "f", "0.5", None),
    )
    got = recon.diff(dev, prod, KEYS, MEASURES, method=method)
    assert got.columns == ["dev_records_present", "prod_records_present", *KEYS, "dev_x", "prod_x", "dev_y", "prod_y"]
    found = {r.id: (r.dev_records_present, r.prod_records_present, float(r.dev_x), float(r.prod_x)) for r in got.collect()}
    assert found == {
        "over": (True, True, 1.02, 1.0),
        "dev": (True, False, 1.0, 0.0),
        "prod": (False, True, 0.0, 1.0),
        "empty": (True, True, 0.0, 0.5),
    }
    counts = recon.diff_counts(dev, prod, KEYS, MEASURES, method=method).first()
    assert tuple(counts) == (8, 1, 1, 2, 4)


def _months(spark, n, per_month=400):
    return spark.range(0, n * per_month, 1, 6).selectExpr(
        "concat('i', id) AS id", f"add_months(DATE '2024-01-01', CAST(id DIV {per_month} AS INT)) AS data_month",
        "IF(id % 9 = 0, NULL, 'f') AS feed", "CAST(id % 17 AS DECIMAL(18,4)) AS x", "IF(id % 5 = 0, NULL, CAST(id AS DECIMAL(18,4))) AS y",
    )


def test_only_changed_blocks_are_summed(spark, rows):
    dev = _months(spark, 12)
    # One value, one row missing, one row more, a split row, and a change within the tolerance.
    prod = dev.where("id <> 'i900'").withColumn("x", F.expr("IF(id = 'i17', x + 1, IF(id = 'i4000', x + 0.005, x))"))
    prod = prod.unionByName(spark.sql("SELECT 'new' AS id, DATE '2024-08-01' AS data_month, CAST(NULL AS STRING) AS feed, 1.0 AS x, 2.0 AS y"))
    half = prod.where("id = 'i1250'").withColumns({"x": F.col("x") / 2, "y": F.col("y") / 2})
    prod = prod.where("id <> 'i1250'").unionByName(half).unionByName(half)
    whole = recon.diff(dev, prod, KEYS, MEASURES)
    assert whole.count() == 3
    for buckets in (1, 64):
        assert rows(recon.diff_blocks(dev, prod, KEYS, MEASURES, buckets=buckets)) == rows(whole)
    blocks = recon.changed_blocks(dev, prod, KEYS, MEASURES, buckets=64)
    assert blocks.count() == 5 and blocks.agg(F.sum("dev_rows")).first()[0] <= 5 * 30
    # Rows that reach the wide aggregate: those of five blocks of 12 x 64, not all 9,600.
    reached = []
    real = recon.diff
    recon.diff = lambda a, b, *args, **kw: reached.append(a.count() + b.count()) or real(a, b, *args, **kw)
    try:
        recon.diff_blocks(dev, prod, KEYS, MEASURES, buckets=64)
    finally:
        recon.diff = real
    assert 5 <= reached[0] <= 150
    assert recon.changed_blocks(dev, dev.repartition(3), KEYS, MEASURES).count() == 0
    assert recon.diff_blocks(dev, dev.limit(0), KEYS, MEASURES).count() == 4800


def test_blocks_of_rows_without_keys(side, rows):
    dev = side((None, None, None, "5", None), ("a", None, "f", "1", "1"), ("a", DAY, "f", "1", "1"), ("a", DAY, "f", "1", "1"))
    prod = side(("N/A", None, "N/A", "5", None), ("a", None, "f", "2", "1"), ("a", DAY, "f", "1", "1"))
    assert rows(recon.diff_blocks(dev, prod, KEYS, MEASURES, buckets=8)) == rows(recon.diff(dev, prod, KEYS, MEASURES))


def test_blocks_of_many_keys_are_planned_in_little_memory(spark):
    # Every key doubled what Spark notes on the rows: with 19 the driver ran out of memory.
    keys = ["data_month", *[f"k{i}" for i in range(11)]]
    named = [f"IF(id % 7 = {i}, NULL, concat('{i}.', id % 97)) AS k{i}" for i in range(11)]
    dev = spark.range(500).selectExpr("DATE '2025-02-01' AS data_month", *named, "double(id) AS x")
    prod = dev.withColumn("x", F.expr("IF(k0 = '0.5', x + 1, x)"))
    found = recon.diff_blocks(dev, prod, keys, ["x"], buckets=16, order_by=None)
    assert found.count() == recon.diff(dev, prod, keys, ["x"]).count() > 0
    plans = [found._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        assert plan.validConstraints().size() < 1000
        plans += [plan.children().apply(i) for i in range(plan.children().size())]


def test_nothing_compared_is_visible(side):
    empty = side()
    assert recon.diff(empty, empty, KEYS, MEASURES).count() == 0
    assert recon.diff_counts(empty, empty, KEYS, MEASURES).first().keys_compared == 0


ROW = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.sampled_from([DAY, None]),
    st.sampled_from(["f", None]),
    st.sampled_from(["1", "1.01", "1.02", None]),
    st.sampled_from(["0", "7", None]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(dev=st.lists(ROW, max_size=6), prod=st.lists(ROW, max_size=6))
def test_both_methods_agree(side, rows, dev, prod):
    a, b = side(*dev), side(*prod)
    one = recon.diff(a, b, KEYS, MEASURES, method="aggregate")
    other = recon.diff(a, b, KEYS, MEASURES, method="join")
    assert [tuple(map(str, r)) for r in rows(one)] == [tuple(map(str, r)) for r in rows(other)]
    assert recon.diff(a, a, KEYS, MEASURES).count() == 0


def test_sketches_merge_and_keep_their_bound(spark):
    df = spark.range(0, 400_000, 1, 8).selectExpr(
        "IF(id % 10 = 0, NULL, concat('u', id % 90000)) AS user", "add_months(DATE '2024-01-01', CAST(id DIV 50000 AS INT)) AS data_month"
    )
    stored = sk.monthly_sketches(df, ["user"])
    assert stored.count() == 8
    for lo, hi in ((None, None), ("2024-02-01", "2024-04-01"), ("2024-05-01", "2024-06-01")):
        some = df if lo is None else recon.date_range(df, lo, hi)
        exact = some.agg(F.count("*"), F.count_distinct("user")).first()
        got = sk.distinct_in_range(stored, ["user"], lo, hi).first()
        assert got.n == exact[0] and abs(got.user_distinct - exact[1]) <= 4 * sk.standard_error() * exact[1]
    none = sk.distinct_in_range(stored, ["user"], "2030-01-01", "2031-01-01").first()
    assert (none.n, none.user_distinct) == (0, 0)


def test_ranges(spark, rows):
    r = spark.sql("SELECT '210' AS contract_id, explode(sequence(DATE'2025-04-01', DATE'2025-07-01', INTERVAL 1 MONTH)) AS data_month")
    assert recon.contract_rows(r, 210, "2025-04-01", "2025-06-01").count() == 2
    assert recon.contract_rows(r, 210, "2025-04-01", "2025-06-01", lo_inclusive=False).count() == 1
    assert recon.contract_rows(r, "210", month="2025-06-01").count() == 1
    assert recon.contract_rows(r, 211, month="2025-06-01").count() == 0


SITES = {"One": "acct-one", "Two": "acct-two"}


@pytest.fixture
def partner(spark):
    def make(*rows):
        return spark.createDataFrame(
            list(rows), "partner_website string, order_date string, total_revenue double, order_count bigint"
        )

    return make


def test_labels(partner, rows):
    got = rb.label_accounts(partner(("One", "2025-01-01", 1.0, 1), ("x", "2025-01-01", 1.0, 1), (None, "2025-01-01", 1.0, 1)), SITES, "acct-other")
    assert rows(got.select("account_id", "data_date")) == [
        ("acct-one", dt.date(2025, 1, 1)),
        ("acct-other", dt.date(2025, 1, 1)),
        ("acct-other", dt.date(2025, 1, 1)),
    ]


def test_additional_revenue_needs_both_sides(spark, partner, rows):
    labelled = rb.label_accounts(
        partner(("One", "2025-01-02", 1.0, 1), ("Two", "2025-01-02", 2.0, 1), ("One", "2025-01-03", 5.0, 1), ("One", "2024-01-01", 5.0, 1)),
        SITES,
        "acct-other",
    )
    total = spark.sql("SELECT DATE'2025-01-02' AS data_date, 10D AS revenue UNION ALL SELECT DATE'2025-01-04', 3D UNION ALL SELECT DATE'2024-01-01', 9D")
    got = rb.additional_revenue(total, labelled, "2024-12-01", "acct-two")
    assert rows(got) == [(dt.date(2025, 1, 2), "acct-two", 7.0)]


def test_union_drops_equal_rows_and_says_so(spark, partner, rows):
    old = rb.label_accounts(
        partner(("One", "2025-01-01", 1.0, 0), ("One", "2025-01-01", 1.0, 0), ("One", "2023-08-16", 4.0, 1), ("Two", "2025-01-01", 8.0, 1)),
        SITES,
        "acct-other",
    )
    new = spark.sql("SELECT DATE'2025-01-01' AS data_date, 'acct-one' AS account_id, 1D AS revenue UNION ALL SELECT DATE'2025-02-01', 'acct-one', 2D")
    how = {"website": "One", "account_id": "acct-one", "exclude_date": "2023-08-16"}
    both = rb.combine_sources(old, new, **how)
    assert rows(both) == [("acct-one", dt.date(2025, 1, 1), 1.0, 0), ("acct-one", dt.date(2025, 2, 1), 2.0, 0)]
    assert rb.combine_sources(old, new, dedup=False, **how).count() == 4
    assert tuple(rb.dropped_rows(old, new, **how).first()) == (2, 2.0)
    # Without duplicates the combined total is old plus new.
    old_total = old.where("partner_website = 'One' AND data_date <> DATE'2023-08-16'").distinct().groupBy().sum("revenue").first()[0]
    assert sum(r.revenue for r in rb.monthly_totals(rb.combine_sources(old, new.where("data_date > DATE'2025-01-31'"), **how)).collect()) == old_total + 2.0
    assert rb.month_total(both, "2025-02-01", counted_only=True).first()[0] == 2.0


def test_effective_dating(spark, rows):
    facts = spark.sql(
        "SELECT 'a' AS account_id, explode(sequence(DATE'2025-01-01', DATE'2025-01-31')) AS data_date, 1D AS revenue, 1L AS conversions"
    )
    accounts = rb.account_metadata(
        spark.sql(
            """SELECT * FROM VALUES ('a', 'p', '1', '10', 'USD-far-too-long', DATE'2025-01-11', DATE'2025-01-20'),
                                    ('a', 'q', '1', '10', 'USD', DATE'2025-01-21', NULL)
               AS t(account_id, product_line_id, bi_account_id, network_name_id, currency_code, effective_from, effective_to)"""
        )
    )
    contracts = spark.sql("SELECT 1 AS bi_account_id, 210 AS contract_id")
    how = {"as_of": "2025-01-31", "aggregation_source": "manual", "run_ts": "2025-02-01 00:00:00"}
    got = rb.effective_join(facts, accounts, contracts, **how)
    # From the 11th to the 30th, and from the 21st on both periods.
    assert got.groupBy("product_line_id").count().orderBy("product_line_id").collect() == [("p", 20), ("q", 10)]
    assert rows(got.select("currency_code").distinct()) == [("USD",), ("USD-far-to",)]
    closed = rb.effective_join(facts, accounts, contracts, use_effective_to=True, **how)
    assert closed.groupBy("product_line_id").count().orderBy("product_line_id").collect() == [("p", 10), ("q", 10)]
    assert len(got.columns) == 15


def test_periods_by_month_meet_each_fact_once(spark, rows):
    """An account with a period of 20 days after another for 40 years, overlapping by five."""
    facts = spark.sql(
        "SELECT 'a' AS account_id, explode(sequence(DATE'2000-01-01', DATE'2004-12-31')) AS data_date, 1D AS revenue, 1L AS conversions"
    )
    spans = spark.range(730).selectExpr(
        "'a' AS account_id", "concat('p', id) AS product_line_id", "1 AS bi_account_id", "1 AS network_name_id", "'USD' AS currency_code",
        "date_add(DATE'1990-01-01', CAST(20 * id AS INT)) AS effective_from", "date_add(DATE'1990-01-01', CAST(20 * id + 24 AS INT)) AS effective_to",
    )
    odd = spark.sql(
        """SELECT * FROM VALUES ('a', 'open', 1, 1, 'USD', DATE'2004-12-30', NULL), ('a', 'turned', 1, 1, 'USD', DATE'2010-05-09', DATE'2010-05-01'),
           ('a', 'none', 1, 1, 'USD', NULL, DATE'2010-05-01'), ('a', 'old', 1, 1, 'USD', DATE'0001-01-01', DATE'2000-01-02'),
           ('a', 'later', 1, 1, 'USD', DATE'2031-01-01', NULL), ('b', 'other', 1, 1, 'USD', DATE'2000-01-01', NULL)"""
    ).toDF(*spans.columns)
    accounts = spans.unionByName(odd)
    contracts = spark.sql("SELECT 1 AS bi_account_id, 210 AS contract_id")
    joined = rb.effective_join(facts, accounts, contracts, as_of="2004-12-31", aggregation_source="m", run_ts="2025-02-01 00:00:00", use_effective_to=True)
    got = rows(joined.select("data_ts", "product_line_id"))
    wanted = [
        (f.data_date, p.product_line_id)
        for f in facts.collect()
        for p in accounts.collect()
        if p.account_id == "a" and f.data_date < dt.date(2004, 12, 31) and p.effective_from and p.effective_from <= f.data_date
        and (p.effective_to is None or f.data_date <= p.effective_to)
    ]
    assert got == sorted(wanted, key=repr)
    # Pairs before the range test: periods of the fact's month, not all 730 and more.
    first, last = F.lit(dt.date(2000, 1, 1)), F.lit(dt.date(2004, 12, 30))
    laid = rb.periods_by_month(accounts.where("account_id = 'a'"), first, last)
    pairs = facts.where("data_date < DATE'2004-12-31'").join(laid.drop("account_id"), F.trunc("data_date", "MM") == F.col("period_month")).count()
    assert len(wanted) <= pairs <= 3 * len(wanted)
    assert "trunc(data_date" in joined._jdf.queryExecution().executedPlan().toString()
    none = rb.effective_join(facts.limit(0), accounts, contracts, as_of="2004-12-31", aggregation_source="m", use_effective_to=True)
    assert none.count() == 0
