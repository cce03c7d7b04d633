"""The monthly run: import, raw checks, mapped view, merged checks, export.

Each step reads what the one before it wrote, so any step can be run alone, and
an executor lost in one step does not reach into another. The mapped view is
written once and read by the checks, the export and its verification."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from revmap import texts
from revmap.operators import coverage, export_qa, mapping, quality
from revmap.operators.gates import GateError, gate_import, gate_non_empty
from revmap.operators.mapping import map_revenue
from revmap.sources.export import export_csv
from revmap.sources.mapping_csv import read_mapping
from revmap.sources.tables import read_table, reload_table, write_version

STEPS = ["import", "quality_raw", "create_view", "quality_merged", "export"]


@dataclass
class RunConfig:
    mapping_path: str
    revenue: DataFrame
    work_dir: str  # shared by all executors
    export_dir: str
    as_of: str | dt.date
    prefix: str = "revenue_mapped"
    months_back: int = 1
    flags: bool = True
    strict: bool = False
    pattern: str | None = None
    latest: bool = False
    on_empty: str = "warn"  # "raise" stops the run at an empty view
    run_ts: dt.datetime | str | None = None

    @property
    def mapping_table(self) -> str:
        return f"{self.work_dir.rstrip('/')}/mapping"

    @property
    def view_table(self) -> str:
        return f"{self.work_dir.rstrip('/')}/mapped_view"


@dataclass
class StepResult:
    step: str
    ok: bool
    message: str
    frames: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)  # of each report


def _read_mapping(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return quality.typed(read_mapping(spark, cfg.mapping_path, pattern=cfg.pattern, latest=cfg.latest))


def _mapped(cfg: RunConfig, m: DataFrame) -> DataFrame:
    return map_revenue(cfg.revenue, m, as_of=cfg.as_of, months_back=cfg.months_back, flags=cfg.flags)


def _raw_reports(m: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary": quality.dq_summary(m),
        "duplicates": quality.duplicates(m),
        "null_ids": quality.null_ids(m),
        "null_critical": quality.null_critical(m),
    }


def _merged_reports(cfg: RunConfig, m: DataFrame, v: DataFrame) -> dict[str, DataFrame]:
    month = {"as_of": cfg.as_of, "months_back": cfg.months_back}
    return {
        "coverage": coverage.coverage(cfg.revenue, m, variant="model", run_ts=cfg.run_ts, **month),
        "report": coverage.merged_report(cfg.revenue, m, v, **month),
        "completeness": coverage.merged_completeness(v),
        "duplicates": quality.duplicates(v, "id", texts.MERGED_DUPLICATES),
        "by_mapping": coverage.revenue_by_mapping(v),
        "unmapped": mapping.unmapped_revenue(cfg.revenue, m, **month),
        "unused": mapping.unused_mappings(cfg.revenue, m, **month),
    }


def _written(step: str, cfg: RunConfig, reports: dict[str, DataFrame]) -> StepResult:
    """Work every report out, into a table of its own, and count its rows."""
    root = f"{cfg.work_dir.rstrip('/')}/reports/{step}"
    frames = {name: reload_table(report, f"{root}/{name}") for name, report in reports.items()}
    return StepResult(step, True, "reports made", frames, {name: frame.count() for name, frame in frames.items()})


def _import(spark: SparkSession, cfg: RunConfig) -> StepResult:
    # The gate stands before the switch: a mapping that fails leaves the last good one.
    version = write_version(_read_mapping(spark, cfg), cfg.mapping_table)
    gate = gate_import(version.rows, strict=cfg.strict)
    version.publish()
    return StepResult("import", True, gate.message)


def _quality_raw(spark: SparkSession, cfg: RunConfig) -> StepResult:
    return _written("quality_raw", cfg, _raw_reports(read_table(spark, cfg.mapping_table)))


def _create_view(spark: SparkSession, cfg: RunConfig) -> StepResult:
    view = _mapped(cfg, read_table(spark, cfg.mapping_table))
    version = write_version(view, cfg.view_table)
    gate = gate_non_empty(version.rows, on_empty=cfg.on_empty)
    version.publish()
    return StepResult("create_view", True, gate.message)


def _quality_merged(spark: SparkSession, cfg: RunConfig) -> StepResult:
    m, v = read_table(spark, cfg.mapping_table), read_table(spark, cfg.view_table)
    return _written("quality_merged", cfg, _merged_reports(cfg, m, v))


def _export(spark: SparkSession, cfg: RunConfig) -> StepResult:
    v = read_table(spark, cfg.view_table)
    receipt = export_csv(
        v,
        cfg.export_dir,
        cfg.prefix,
        as_of=cfg.as_of,
        months_back=cfg.months_back,
        source=cfg.view_table,
        run_ts=cfg.run_ts,
        store=False,
    )
    # That export and no other: by the name on the receipt.
    checked = export_qa.export_qa(spark, v, cfg.export_dir, receipt.first().exported_file, cfg.run_ts)
    done = _written("export", cfg, {"receipt": receipt, "qa": checked})
    done.message = done.frames["qa"].first().export_status
    done.ok = done.message == texts.PASS_EXPORT
    return done


_RUN: dict[str, Callable[[SparkSession, RunConfig], StepResult]] = {
    "import": _import,
    "quality_raw": _quality_raw,
    "create_view": _create_view,
    "quality_merged": _quality_merged,
    "export": _export,
}


def _plan(spark: SparkSession, cfg: RunConfig) -> dict[str, dict[str, DataFrame]]:
    """The frames each step would compute, for ``explain``."""
    m = _read_mapping(spark, cfg)
    v = _mapped(cfg, m)
    return {
        "import": {"mapping": m},
        "quality_raw": _raw_reports(m),
        "create_view": {"view": v},
        "quality_merged": _merged_reports(cfg, m, v),
        "export": {"view": v},
    }


def run(spark: SparkSession, cfg: RunConfig, *, step: str = "all", dry_run: bool = False) -> list[StepResult]:
    """Run one step or all in order, up to the first that fails, be it at a gate or
    by an error in Spark. A dry run writes nothing and gives back the frames the
    steps would compute."""
    if step != "all" and step not in _RUN:
        raise ValueError(f"unknown step {step}; there are {', '.join(STEPS)}")
    names = STEPS if step == "all" else [step]
    if dry_run:
        planned = _plan(spark, cfg)
        return [StepResult(name, True, f"would run {name}", planned[name]) for name in names]
    results = []
    for name in names:
        try:
            results.append(_RUN[name](spark, cfg))
        except (GateError, FileNotFoundError, PySparkException) as error:
            results.append(StepResult(name, False, str(error)))
        if not results[-1].ok:
            break
    return results
