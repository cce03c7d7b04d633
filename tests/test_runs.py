"""The stream, the monthly run, scratch space and the shape of plans."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from test_files import write  # noqa: F401

from revmap import session, texts
from revmap.plans import monthly, views
from revmap.plans.queries import QUERIES
from revmap.streaming import ingest
from revmap.streaming.ingest import NO_NEW_FILES, arrivals, ingest_new_files, read_ingested

SF = "/root/testdata/sf0.001"


def _ingest(spark, tmp_path, **kw):
    return ingest_new_files(spark, str(tmp_path / "in"), str(tmp_path / "checkpoint"), str(tmp_path / "out"), **kw)


def test_only_new_files_are_loaded(spark, write, tmp_path, rows):  # noqa: F811
    write("in/one.csv", "a,A,1,g,i,NULL")
    assert _ingest(spark, tmp_path).ok
    assert rows(read_ingested(spark, str(tmp_path / "out")).select("ID", "Oracle_GL_Account")) == [("a", None)]
    assert _ingest(spark, tmp_path).message == NO_NEW_FILES
    write("in/two.csv", "b,B,1,g,i,9")
    _ingest(spark, tmp_path)
    assert rows(read_ingested(spark, str(tmp_path / "out")).select("ID")) == [("a",), ("b",)]
    assert rows(read_ingested(spark, str(tmp_path / "out"), latest_only=True).select("ID")) == [("b",)]


def test_an_arrival_is_whole_whatever_a_batch_holds(spark, write, tmp_path, rows):  # noqa: F811
    write("in/zero.csv", "z,Z,1,g,i,9")
    _ingest(spark, tmp_path)
    for name in "abc":
        write(f"in/{name}.csv", f"{name},A,1,g,i,9")
    _ingest(spark, tmp_path, max_files=1)
    latest = read_ingested(spark, str(tmp_path / "out"), latest_only=True)
    assert rows(latest.select("ID")) == [("a",), ("b",), ("c",)]
    for name in "de":
        write(f"in/{name}.csv", "same,A,1,g,i,9")
    assert not _ingest(spark, tmp_path, max_files=1, strict=True).ok
    assert read_ingested(spark, str(tmp_path / "out")).count() == 4


def test_an_arrival_that_fails_its_gate_is_set_aside(spark, write, tmp_path, rows):  # noqa: F811
    write("in/one.csv", "a,A,1,g,i,9", "a,A,1,g,i,9")
    failed = _ingest(spark, tmp_path, strict=True)
    assert not failed.ok and "Duplicate IDs" in failed.message
    assert read_ingested(spark, str(tmp_path / "out")).count() == 0
    assert (tmp_path / f"out-rejected/arrival={failed.number}").exists()
    # The next arrival is not held up, nor by a file without rows.
    write("in/empty.csv")
    assert _ingest(spark, tmp_path).message == texts.NO_ROWS
    write("in/two.csv", "b,B,1,g,i,9")
    assert _ingest(spark, tmp_path, strict=True).ok
    assert rows(read_ingested(spark, str(tmp_path / "out")).select("ID")) == [("b",)]
    assert rows(arrivals(spark, str(tmp_path / "out")).select("ok")) == [(False,), (False,), (True,)]


def _staged_files(tmp_path):
    return [p for p in (tmp_path / "out-staged").rglob("*.parquet") if "batch=" in str(p)]


def test_what_is_recorded_is_no_longer_staged(spark, write, tmp_path, rows, monkeypatch):  # noqa: F811
    """The files a call looks at are those of its own batches, whatever came before."""
    for n in range(3):
        for k in range(2):
            write(f"in/{n}-{k}.csv", f"i{n}{k},A,1,g,i,9")
        assert _ingest(spark, tmp_path, max_files=1).ok
        assert not _staged_files(tmp_path)
    listed = []
    real = ingest.list_files
    monkeypatch.setattr(ingest, "list_files", lambda *a, **kw: listed.append(real(*a, **kw).count()) or real(*a, **kw))
    write("in/last.csv", "z,A,1,g,i,9")
    assert _ingest(spark, tmp_path).ok
    assert listed and max(listed) <= 2
    assert read_ingested(spark, str(tmp_path / "out")).count() == 7
    assert rows(arrivals(spark, str(tmp_path / "out")).select("ok")) == [(True,)] * 7


@pytest.mark.parametrize("broken", ["rows", "record", "give up"])
def test_a_call_that_breaks_off_is_taken_up(spark, write, tmp_path, rows, monkeypatch, broken):  # noqa: F811
    write("in/a.csv", "a,A,1,g,i,9")
    write("in/b.csv", "b,A,1,g,i,9")

    def fail(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if broken == "rows":
            patch.setattr(ingest, "gate_import", fail)
        elif broken == "record":
            patch.setattr(ingest, "_LEDGER", "no schema at all")
        else:
            patch.setattr(ingest, "clear", fail)
        with pytest.raises((KeyboardInterrupt, PySparkException)):
            _ingest(spark, tmp_path, max_files=1)
    assert _staged_files(tmp_path)
    write("in/c.csv", "c,A,1,g,i,9")
    taken = _ingest(spark, tmp_path)
    assert taken.ok and not _staged_files(tmp_path)
    assert rows(read_ingested(spark, str(tmp_path / "out")).select("ID")) == [("a",), ("b",), ("c",)]
    ledger = rows(arrivals(spark, str(tmp_path / "out")).select("arrival", "batch"))
    assert len(ledger) == len(set(ledger)) == 3
    assert len({a for a, _ in ledger}) == (2 if broken == "give up" else 1)
    assert _ingest(spark, tmp_path).message == NO_NEW_FILES


@pytest.fixture
def config(spark, write, tmp_path):  # noqa: F811
    def make(*lines, **kw):
        return monthly.RunConfig(
            mapping_path=write("mapping.csv", *lines),
            revenue=views.revenue(spark, SF, *views.MONTH),
            work_dir=str(tmp_path / "work"),
            export_dir=str(tmp_path / "out"),
            as_of=views.AS_OF,
            **kw,
        )

    return make


def test_a_run_in_full_and_by_step(spark, config):
    cfg = config("C.1,A,1,g,i,9", "C.2,B,2,g,i,9")
    results = monthly.run(spark, cfg)
    assert [r.step for r in results] == monthly.STEPS and all(r.ok for r in results)
    assert results[-1].message == texts.PASS_EXPORT
    assert results[1].frames["summary"].first().overall_status == texts.PASS_QUALITY
    assert results[3].frames["coverage"].first().total_mapping_records >= 2
    assert [r.ok for r in monthly.run(spark, cfg, step="quality_merged")] == [True]
    with pytest.raises(ValueError):
        monthly.run(spark, cfg, step="everything")


def test_a_run_stops_at_the_first_failure(spark, config):
    results = monthly.run(spark, config())
    assert [(r.step, r.ok) for r in results] == [("import", False)]
    assert results[0].message == texts.NO_ROWS
    strict = monthly.run(spark, config("C.1,A,1,g,i,9", "C.1,A,1,g,i,9", strict=True))
    assert strict[-1].message == texts.STRICT_DUPLICATE_IDS


def test_a_dry_run_writes_nothing(spark, config, tmp_path):
    results = monthly.run(spark, config("C.1,A,1,g,i,9"), dry_run=True)
    assert [r.step for r in results] == monthly.STEPS
    assert len(results[2].frames["view"].columns) == 43
    assert not (tmp_path / "work").exists() and not (tmp_path / "out").exists()


def test_scratch_is_shared_or_refused(spark, monkeypatch):
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")

    class Cluster:
        master = "spark://cluster"

    class Session:
        sparkContext = Cluster()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")
    Session.conf.get = staticmethod(lambda name, default=None: "hdfs://shared/")
    assert session.scratch_dir(Session(), "x").startswith("hdfs://shared/revmap-x-")


# Queries that only build a plan; the others write files to make one.
LAZY = [
    "raw_summary",
    "mapped_view",
    "mapped_view_flags",
    "mapping_master_view",
    "coverage",
    "unmapped_revenue",
    "unused_mappings",
    "merged_report",
    "recon_diff",
    "recon_counts",
    "additional_revenue",
    "combined_revenue",
    "manual_revenue",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_product_in_a_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        assert bad not in plan


def test_month_reaches_the_scan_and_columns_are_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = QUERIES["coverage"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1998-02-01T00:00)" in plan
    assert "l_extendedprice" not in plan and "Join" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_comparison_shuffles_its_rows_once(spark):
    plan = QUERIES["recon_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan


def test_export_order_compares_hundreds_of_files_not_files(spark):
    # Every file met every earlier one, and the files were read for each of the two sides.
    plan = QUERIES["export_order"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    loop = plan.index("BroadcastNestedLoopJoin") if "BroadcastNestedLoopJoin" in plan else plan.index("CartesianProduct")
    assert "hundred#" in plan[loop:].split("\n", 1)[0] and "file_name#" not in plan[loop:].split("\n", 1)[0]
