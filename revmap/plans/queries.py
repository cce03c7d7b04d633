"""The registered queries: each operator on the derived views. A query about
one month reads only that month's orders; every other reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.columns import has_special_chars, split_fields
from revmap.functions.dates import run_stamp
from revmap.operators import coverage as cov
from revmap.operators import export_qa as qa
from revmap.operators import mapping as mp
from revmap.operators import quality as dq
from revmap.operators import rebuild as rb
from revmap.operators import recon
from revmap.operators import sketches as sk
from revmap.operators.gates import gate_import, gate_non_empty
from revmap.plans import monthly
from revmap.plans import views as v
from revmap.plans.views import AS_OF, MONTH, doubles
from revmap.schemas import EXPORT_COLS, EXPORT_HEADER, MAPPING_COLS
from revmap.session import scratch_dir
from revmap.sources import export as ex
from revmap.sources import files as fl
from revmap.sources import mapping_csv as mc
from revmap.sources import tables as tb
from revmap.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUN_TS = "1998-02-15 02:00:00"
PREFIX = "revenue_mapped"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _raw(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: operator(v.mapping_faulty(spark, sf))


# Raw mapping checks
_raw("raw_quick_check", dq.quick_check)
_raw("raw_uniqueness", dq.uniqueness)
_raw("raw_duplicates", dq.duplicates)
_raw("raw_completeness", dq.completeness)
_raw("raw_null_ids", dq.null_ids)
_raw("raw_null_critical", dq.null_critical)
_raw("raw_format", dq.format_check)
_raw("raw_format_dots", lambda m: dq.format_check(m, r"^[A-Za-z0-9.]+$"))
_raw("raw_empty", dq.empty_check)
_raw("raw_length", dq.length_profile)
_raw("raw_summary", dq.dq_summary)
_raw("raw_check_rows", dq.check_rows)
_raw("raw_preview", dq.preview)
_raw("not_null_failures", lambda m: dq.not_null(m, "Oracle_GL_Account"))
_raw("unique_failures", lambda m: dq.unique(m, "ID"))
_raw("staged_mapping", dq.staged)
_raw("typed_mapping", lambda m: dq.typed(m, require_id=True))


@query
def import_gates(spark, sf):
    """What the import gate says of three mappings, and of the view."""
    rows = []
    for name, m in (
        ("dirty", v.mapping_dirty(spark, sf)),
        ("clean", v.mapping(spark, sf)),
        ("full", v.mapping_full(spark, sf)),
    ):
        gate = gate_import(m)
        rows.append((name, gate.status, gate.message, gate.row_count, gate.unique_ids, gate.null_ids))
    view = gate_non_empty(_mapped(spark, sf, v.mapping(spark, sf)), on_empty="warn")
    rows.append(("view", view.status, view.message, None, None, None))
    return spark.createDataFrame(
        rows,
        "mapping string, status string, message string, row_count bigint, unique_ids bigint, null_ids bigint",
    )


# Mapped views
def _month_revenue(spark, sf):
    return v.revenue(spark, sf, *MONTH)


def _mapped(spark, sf, m, **kw):
    return mp.map_revenue(_month_revenue(spark, sf), m, as_of=AS_OF, **kw)


@query
def mapped_view(spark, sf):
    return _mapped(spark, sf, v.mapping_dirty(spark, sf))


@query
def mapped_view_month(spark, sf):
    """The same by a given month, one row per ID whatever the mapping repeats."""
    m = v.mapping_dirty(spark, sf)
    return mp.map_revenue(_month_revenue(spark, sf), m, month=MONTH[0], on_duplicate="first")


@query
def mapped_view_flags(spark, sf):
    """Four months back, seen from four months later."""
    r = _month_revenue(spark, sf)
    return mp.map_revenue(r, v.mapping_dirty(spark, sf), as_of="1998-05-31", months_back=4, flags=True)


@query
def mapping_master_view(spark, sf):
    return _mapped(spark, sf, v.mapping_dirty(spark, sf), master="mapping")


@query
def mapped_inner(spark, sf):
    return _mapped(spark, sf, v.mapping_dirty(spark, sf), how="inner", master="mapping")


# Coverage
@query
def coverage(spark, sf):
    return cov.coverage(_month_revenue(spark, sf), v.mapping_dirty(spark, sf), as_of=AS_OF)


@query
def coverage_model(spark, sf):
    m = v.mapping_dirty(spark, sf)
    return cov.coverage(_month_revenue(spark, sf), m, as_of=AS_OF, variant="model", run_ts=RUN_TS).drop(
        "test_run_timestamp"
    )


@query
def coverage_full(spark, sf):
    return cov.coverage(_month_revenue(spark, sf), v.mapping_full(spark, sf), as_of=AS_OF)


@query
def coverage_failures(spark, sf):
    m = v.mapping(spark, sf, 4500)
    return cov.coverage_failures(_month_revenue(spark, sf), m, as_of=AS_OF, run_ts=RUN_TS).drop("test_run_timestamp")


@query
def coverage_no_failures(spark, sf):
    m = v.mapping_full(spark, sf)
    return cov.coverage_failures(_month_revenue(spark, sf), m, as_of=AS_OF, run_ts=RUN_TS).drop("test_run_timestamp")


@query
def mapping_success(spark, sf):
    return cov.coverage(_month_revenue(spark, sf), v.mapping_dirty(spark, sf), as_of=AS_OF, variant="document")


@query
def unmapped_revenue(spark, sf):
    return mp.unmapped_revenue(_month_revenue(spark, sf), v.mapping_dirty(spark, sf), as_of=AS_OF)


@query
def unmapped_totals(spark, sf):
    r = v.exact(_month_revenue(spark, sf), ["network_gross_revenue"])
    m = v.mapping_dirty(spark, sf)
    return doubles(mp.unmapped_totals(r, m, as_of=AS_OF, measure="network_gross_revenue"))


@query
def unused_mappings(spark, sf):
    return mp.unused_mappings(_month_revenue(spark, sf), v.mapping_dirty(spark, sf), as_of=AS_OF)


@query
def unused_count(spark, sf):
    return mp.unused_count(_month_revenue(spark, sf), v.mapping_dirty(spark, sf), as_of=AS_OF)


# Mapped view checks
@query
def merged_completeness(spark, sf):
    return cov.merged_completeness(_mapped(spark, sf, v.mapping_dirty(spark, sf)))


@query
def merged_duplicates(spark, sf):
    return dq.duplicates(_mapped(spark, sf, v.mapping_dirty(spark, sf)), "id", texts.MERGED_DUPLICATES)


@query
def revenue_by_mapping(spark, sf):
    r = v.exact(_month_revenue(spark, sf), ["network_gross_revenue"])
    view = mp.map_revenue(r, v.mapping_dirty(spark, sf), as_of=AS_OF)
    return doubles(cov.revenue_by_mapping(view, "network_gross_revenue"))


@query
def unmapped_summary(spark, sf):
    return cov.unmapped_summary(_mapped(spark, sf, v.mapping_dirty(spark, sf)))


@query
def merged_report(spark, sf):
    r, m = _month_revenue(spark, sf), v.mapping_dirty(spark, sf)
    return cov.merged_report(r, m, mp.map_revenue(r, m, as_of=AS_OF), as_of=AS_OF)


@query
def merged_preview(spark, sf):
    m = v.mapping_dirty(spark, sf)
    return dq.preview(_mapped(spark, sf, m, on_duplicate="first"), texts.MERGED_PREVIEW, order_by="id")


@query
def months_available(spark, sf):
    return mp.months_available(v.revenue(spark, sf))


@query
def month_bounds(spark, sf):
    return mp.month_bounds(v.revenue(spark, sf), AS_OF)


# Reconciliation
@query
def recon_diff(spark, sf):
    return recon.diff(v.dev(spark, sf), v.prod(spark, sf))


@query
def recon_diff_join(spark, sf):
    """The same through a full outer join."""
    return recon.diff(v.dev(spark, sf), v.prod(spark, sf), method="join")


@query
def recon_diff_range(spark, sf):
    """The same between two months, both left out."""
    return recon.diff(
        recon.date_range(v.dev(spark, sf), "1997-01-01", "1997-06-01", lo_inclusive=False),
        recon.date_range(v.prod(spark, sf), "1997-01-01", "1997-06-01", lo_inclusive=False),
    )


@query
def recon_diff_identity(spark, sf):
    return recon.diff(v.revenue(spark, sf), v.revenue(spark, sf))


@query
def recon_counts(spark, sf):
    return recon.diff_counts(v.dev(spark, sf), v.prod(spark, sf))


@query
def recon_diff_blocks(spark, sf):
    """The same as recon_diff, with sums over the blocks only that differ."""
    return recon.diff_blocks(v.dev(spark, sf), v.prod(spark, sf))


@query
def recon_changed_months(spark, sf):
    """The months in which the rows differ, in blocks of a whole month."""
    return recon.changed_blocks(v.dev(spark, sf), v.prod(spark, sf), buckets=1).drop("block_bucket")


@query
def contract_rows(spark, sf):
    return recon.contract_rows(v.revenue(spark, sf), 210, "1997-04-01", "1997-06-01")


@query
def contract_month_rows(spark, sf):
    return recon.contract_rows(v.revenue(spark, sf), 211, month="1997-06-01")


@query
def approximate_distinct(spark, sf):
    """Distinct IDs and contracts of ten months from stored sketches of each, against exact counts:
    whether both are within four standard deviations."""
    columns = ["id", "contract_id"]
    r = v.revenue(spark, sf)
    stored = tb.reload_table(sk.monthly_sketches(r, columns), scratch_dir(spark, "sketches"))
    got = sk.distinct_in_range(stored, columns, "1997-01-01", "1997-11-01")
    exact = recon.date_range(r, "1997-01-01", "1997-11-01").agg(*[F.count_distinct(c).alias(f"{c}_exact") for c in columns])
    near = [(F.abs(F.col(f"{c}_distinct") - F.col(f"{c}_exact")) <= 1 + 4 * sk.standard_error() * F.col(f"{c}_exact")).alias(f"{c}_near") for c in columns]
    return got.crossJoin(exact).select("n", "id_exact", "contract_id_exact", *near)


# Rebuilding a revenue source
def _additional(spark, sf):
    return rb.additional_revenue(v.total_revenue(spark, sf), v.partners_only(spark, sf), v.SINCE, v.MANUAL)


_COMBINE = {"website": v.MANUAL_SITE, "account_id": v.MANUAL, "exclude_date": v.EXCLUDED}


def _combined(spark, sf, **kw):
    return rb.combine_sources(v.old_source(spark, sf), _additional(spark, sf), **_COMBINE, **kw)


def _manual(spark, sf, **kw):
    return rb.effective_join(
        _combined(spark, sf),
        v.accounts(spark, sf),
        v.contracts(spark, sf),
        as_of=v.EVENTS_AS_OF,
        aggregation_source=v.SOURCE,
        run_ts=RUN_TS,
        **kw,
    ).drop("aggregation_date")


@query
def label_revenue(spark, sf):
    return doubles(v.labelled(spark, sf))


@query
def additional_revenue(spark, sf):
    return doubles(_additional(spark, sf))


@query
def combined_revenue(spark, sf):
    return doubles(_combined(spark, sf))


@query
def combined_dropped(spark, sf):
    return doubles(rb.dropped_rows(v.old_source(spark, sf), _additional(spark, sf), **_COMBINE))


@query
def manual_revenue(spark, sf):
    return _manual(spark, sf)


@query
def manual_revenue_in_force(spark, sf):
    return _manual(spark, sf, use_effective_to=True)


@query
def monthly_revenue(spark, sf):
    return doubles(rb.monthly_totals(_combined(spark, sf)))


@query
def month_revenue_total(spark, sf):
    return doubles(rb.month_total(_combined(spark, sf), "2024-01-01", counted_only=True))


# Files. The views are written below the shared scratch folder and read back.
def _flagged(spark, sf):
    r = v.exact(_month_revenue(spark, sf))
    return mp.map_revenue(r, v.mapping_dirty(spark, sf), as_of=AS_OF, flags=True)


def _stored_flagged(spark, sf, root):
    """The flagged view as a table, so that it is worked out once."""
    return tb.store_rows(_flagged(spark, sf), f"{root}/view")


def _mapping_files(spark, sf, root):
    """The faulty mapping as delimited files, and their folder."""
    path = f"{root}/mapping"
    m = v.mapping_faulty(spark, sf)
    m.write.options(**mc.CSV_OPTS).option("header", True).option("emptyValue", "").csv(path)
    return path


@query
def csv_mapping(spark, sf):
    """The mapping after a round trip through files."""
    path = _mapping_files(spark, sf, scratch_dir(spark, "csv"))
    return mc.read_mapping(spark, path, pattern=r"part-.*\.csv")


@query
def csv_mapping_latest(spark, sf):
    """The newer of two deliveries, each a folder of files."""
    root = scratch_dir(spark, "latest")
    for name, m in (("old", v.mapping_full(spark, sf)), ("new", v.mapping(spark, sf))):
        m.write.options(**mc.CSV_OPTS).option("header", True).csv(f"{root}/{name}")
    newest = fl.latest_file(fl.list_files(spark, root, pattern=r".*\.csv"))
    return mc.read_mapping(spark, newest.rsplit("/", 1)[0])


@query
def load_report(spark, sf):
    """The load report, summed over the files."""
    path = _mapping_files(spark, sf, scratch_dir(spark, "load"))
    report = mc.load_report(spark, path, run_ts=RUN_TS)
    recent = mc.recent_loads(tb.append_rows(report, f"{path}-history"), "1998-02-15 02:30:00")
    return recent.agg(
        F.sum("row_count").alias("row_count"),
        F.sum("row_parsed").alias("row_parsed"),
        F.sum("error_count").alias("error_count"),
        F.sum("null_ids").alias("null_ids"),
        F.min("status").alias("status"),
    )


@query
def csv_mapping_nested(spark, sf):
    """The mapping from files in folders below folders, by pattern."""
    root = scratch_dir(spark, "nested")
    low = F.col("Oracle_Invoice_Group") < "F"
    m = v.mapping_faulty(spark, sf)
    for folder, some in (("in", m.where(low)), ("in/deep/er", m.where(~low))):
        some.write.options(**mc.CSV_OPTS).option("header", True).option("emptyValue", "").mode("append").csv(f"{root}/{folder}")
    return mc.read_mapping(spark, f"{root}/in", pattern=r"part-.*\.csv")


def _ragged_files(spark, sf, root):
    """Mapping files in which the rows of customers in debt lack their last field."""
    fields = [F.coalesce(F.col(c), F.lit("")) for c in MAPPING_COLS]
    short = F.col("debt") & F.lit(True)
    customers = v.table(spark, sf, "customer").select(F.concat(F.lit("C."), "c_custkey").alias("who"), (F.col("c_acctbal") < 0).alias("debt"))
    m = v.mapping_full(spark, sf).join(customers, F.col("ID") == F.col("who"))
    line = F.when(short, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *fields))
    # One column whose name is the header; nothing in it is quoted.
    lines = m.select(line.alias(",".join(MAPPING_COLS)))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(f"{root}/ragged")
    return f"{root}/ragged"


@query
def csv_ragged_continue(spark, sf):
    """The rows that are whole, though only some columns are read."""
    path = _ragged_files(spark, sf, scratch_dir(spark, "ragged"))
    m = mc.read_mapping(spark, path, on_error="continue", multi_line=False)
    return m.select("ID", "Oracle_GL_Account")


@query
def load_report_errors(spark, sf):
    """The load report of files with short rows, in both ways of reading."""
    path = _ragged_files(spark, sf, scratch_dir(spark, "ragged"))
    reports = [mc.load_report(spark, path, run_ts=RUN_TS, multi_line=m).withColumn("multi_line", F.lit(m)) for m in (True, False)]
    return (
        reports[0].unionByName(reports[1]).groupBy("multi_line")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("error_count").alias("error_count"),
            F.max("first_error_column").alias("first_error_column"),
            F.max("status").alias("status"),
        )
    )


@contextmanager
def _split_files(spark, path):
    """Within it, the largest file below ``path`` is read by some eight tasks."""
    largest = fl.list_files(spark, path).agg(F.max("length")).first()[0]
    setting, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(setting, str(max(1, largest // 8)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@query
def positional_split(spark, sf):
    """Order lines by position and number, from files that many tasks read; a file a line number."""
    root = scratch_dir(spark, "split")
    lines = v.table(spark, sf, "lineitem").select("l_linenumber", "l_orderkey", F.col("l_linenumber").alias("line"), "l_quantity")
    lines = lines.repartition("l_linenumber").sortWithinPartitions("l_linenumber", "l_orderkey")
    lines.write.partitionBy("l_linenumber").options(**mc.CSV_OPTS).csv(f"{root}/in")
    with _split_files(spark, f"{root}/in"):
        raw = mc.read_positional(spark, f"{root}/in", 3, multi_line=False)
        return tb.store_rows(raw.select("c1", "c2", F.col("row_number").cast("bigint").alias("row_number")), f"{root}/read")


@query
def load_report_split(spark, sf):
    """The first short row of every file, each read by many tasks; a file a nation, customers in debt are short."""
    root = scratch_dir(spark, "split")
    customers = v.table(spark, sf, "customer")
    fields = [F.concat(F.lit("C."), "c_custkey"), *[F.col("c_name")] * 3]
    line = F.concat_ws(",", *fields, F.when(F.col("c_acctbal") < 0, F.lit("short")).otherwise(F.lit("i,9")))
    lines = customers.select("c_nationkey", "c_custkey", line.alias("line"))
    lines = lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", F.col("line").alias(",".join(MAPPING_COLS)))
    out = lines.write.partitionBy("c_nationkey").option("header", True).option("sep", "\u0001").option("quote", "\u0000")
    out.csv(f"{root}/in")
    with _split_files(spark, f"{root}/in"):
        report = mc.load_report(spark, f"{root}/in", run_ts=RUN_TS, multi_line=False)
        return tb.store_rows(report.select("row_count", "error_count", "first_error_record", "first_error_column"), f"{root}/report")


@query
def content_keys_order(spark, sf):
    """Keys of three files of the same lines: as they are, once more, and in the other order."""
    root = scratch_dir(spark, "keys")
    lines = v.mapping_full(spark, sf).select(F.concat_ws(",", *MAPPING_COLS).alias("line"))
    for name, order in (("up", F.asc("line")), ("again", F.asc("line")), ("down", F.desc("line"))):
        lines.repartition(1).sortWithinPartitions(order).write.text(f"{root}/in/{name}")
    with _split_files(spark, f"{root}/in"):
        keys = tb.store_rows(fl.content_keys(spark, f"{root}/in", glob="*.txt"), f"{root}/keys")
    return keys.groupBy("content_key").agg(F.count("*").alias("files"), F.max("lines").alias("lines")).select("files", "lines")


@query
def csv_roundtrip(spark, sf):
    """The flagged view after an export."""
    receipt = ex.export_csv(_flagged(spark, sf), scratch_dir(spark, "export"), PREFIX, compression="gzip", run_ts=RUN_TS)
    return ex.read_export(spark, receipt.first().path).select(*[F.col(c.upper()).alias(c) for c in EXPORT_COLS])


@query
def export_receipt(spark, sf):
    root = scratch_dir(spark, "receipt")
    receipt = ex.export_csv(_flagged(spark, sf), root, PREFIX, source="mapped view", run_ts=RUN_TS)
    return receipt.drop("path", "export_timestamp")


@query
def export_record(spark, sf):
    """The least ID of the month, exported alone."""
    root = scratch_dir(spark, "record")
    view = _stored_flagged(spark, sf, root)
    least = view.agg(F.min("ID")).first()[0]
    receipt = ex.export_record(view, root, least, run_ts=RUN_TS)
    return ex.read_export(spark, receipt.first().path).select(
        F.lit(texts.SINGLE_RECORD_CHECK).alias("check_type"), F.col("ID").alias("ID"), F.col("DATA_MONTH").alias("data_month")
    )


@query
def add_header(spark, sf):
    """Export without a header, add one, read by name."""
    root = scratch_dir(spark, "header")
    bare = ex.export_csv(_flagged(spark, sf), root, PREFIX, header=False, run_ts=RUN_TS).first().path
    ex.add_header(spark, bare, f"{bare}_with_headers")
    return ex.read_export(spark, f"{bare}_with_headers").select(*[F.col(c.upper()).alias(c) for c in EXPORT_COLS])


def _partial_export(spark, sf, root):
    """The flagged view, and an export of its mapped rows only."""
    view = _stored_flagged(spark, sf, root)
    mapped = view.where(F.col("ID_mapped_record_flag") == "Y")
    ex.export_csv(mapped, f"{root}/out", PREFIX, as_of=AS_OF, run_ts=RUN_TS, store=False)
    return view


def _counts(df):
    """Without what depends on the clock or on how many tasks wrote."""
    return df.drop("last_modified", "qa_run_timestamp", "total_files", "first_file_exported", "last_file_exported")


@query
def export_verify(spark, sf):
    root = scratch_dir(spark, "verify")
    view = _stored_flagged(spark, sf, root)
    ex.export_csv(view, f"{root}/out", PREFIX, run_ts=RUN_TS)
    return _counts(qa.export_verify(spark, view, f"{root}/out", PREFIX))


@query
def export_summary(spark, sf):
    root = scratch_dir(spark, "qa")
    view = _stored_flagged(spark, sf, root)
    ex.export_csv(view, f"{root}/out", PREFIX, run_ts=RUN_TS)
    return _counts(qa.export_qa(spark, view, f"{root}/out", PREFIX, RUN_TS))


@query
def export_summary_partial(spark, sf):
    root = scratch_dir(spark, "partial")
    view = _partial_export(spark, sf, root)
    return _counts(qa.export_qa(spark, view, f"{root}/out", PREFIX, RUN_TS))


@query
def export_summary_missing(spark, sf):
    """An export that never happened."""
    root = scratch_dir(spark, "nothing")
    return _counts(qa.export_qa(spark, _flagged(spark, sf), f"{root}/out", PREFIX, RUN_TS))


@query
def export_failures(spark, sf):
    root = scratch_dir(spark, "failures")
    view = _partial_export(spark, sf, root)
    return _counts(qa.export_failures(spark, view, f"{root}/out", PREFIX))


@query
def missing_ids(spark, sf):
    root = scratch_dir(spark, "missing")
    view = _partial_export(spark, sf, root)
    return qa.missing_ids(view, ex.read_export(spark, f"{root}/out/{PREFIX}_199801"))


@query
def field_status(spark, sf):
    return qa.field_status(_flagged(spark, sf))


@query
def investigate_record(spark, sf):
    """Counts of the least unmapped ID in the view and in a partial export."""
    root = scratch_dir(spark, "investigate")
    view = _partial_export(spark, sf, root)
    least = view.agg(F.min(F.when(F.col("ID_mapped_record_flag") == "N", F.col("ID")))).first()[0]
    found = qa.investigate(view, ex.read_export(spark, f"{root}/out/{PREFIX}_199801"), least)
    exists = found["exists"].select("check_type", F.col("record_count").alias("n"))
    return exists.unionByName(found["in_export"].select("check_type", F.col("exported_count").alias("n")))


def _header_counts(df, column):
    return df.groupBy(column).agg(F.lit(True).alias("seen")).select(column, "seen")


def _exported_files(spark, sf, label, **kw):
    root = scratch_dir(spark, label)
    return ex.export_csv(_flagged(spark, sf), root, PREFIX, run_ts=RUN_TS, **kw).first().path


@query
def header_check(spark, sf):
    """The verdict on every file of an export with headers."""
    raw = mc.read_positional(spark, _exported_files(spark, sf, "check"), len(EXPORT_COLS), max_rows=1)
    return _header_counts(qa.header_check(raw), "header_check_status")


@query
def header_validation(spark, sf):
    raw = mc.read_positional(spark, _exported_files(spark, sf, "validate"), len(EXPORT_COLS), max_rows=1)
    return _header_counts(qa.header_validation(raw), "validation_result")


def _nation_files(spark, sf, root):
    """A file of two lines for each nation. The first line is, by the nation's number: the
    export's header, a text with a dot, a number, or a short word; the second is data."""
    kind = F.col("n_nationkey") % 4
    first = F.when(kind == 0, EXPORT_HEADER[0]).when(kind == 1, F.concat(F.lit("a."), "n_name"))
    first = first.when(kind == 2, F.col("n_nationkey").cast("string")).otherwise("word")
    rest = [F.when(kind == 0, EXPORT_HEADER[i]).otherwise(F.lit(f"x{i}")) for i in (1, 2)]
    nation = v.table(spark, sf, "nation")
    lines = [nation.select("n_nationkey", F.lit(1).alias("line"), F.concat_ws(",", first, *rest).alias("value"))]
    lines.append(nation.select("n_nationkey", F.lit(2).alias("line"), F.concat_ws(",", "n_name", "n_nationkey", F.repeat(F.lit("long "), 30)).alias("value")))
    out = lines[0].unionByName(lines[1]).repartition("n_nationkey").sortWithinPartitions("n_nationkey", "line").drop("line")
    out.write.partitionBy("n_nationkey").text(f"{root}/in")
    return f"{root}/in"


@query
def header_verdicts(spark, sf):
    """All four verdicts on a first line, and both of the validation."""
    raw = mc.read_positional(spark, _nation_files(spark, sf, scratch_dir(spark, "verdicts")), 5, max_rows=1)
    checked = qa.header_check(raw, escape_underscore=True).select("header_check_status", F.col("first_column_sample").alias("first"))
    validated = qa.header_validation(raw).select("validation_result", F.col("first_column").alias("first"))
    return checked.distinct().join(validated.distinct(), "first")


@query
def preview_texts(spark, sf):
    """The text that a preview shows of the first two lines of every file."""
    raw = mc.read_positional(spark, _nation_files(spark, sf, scratch_dir(spark, "previews")), 5, max_rows=2)
    return qa.preview_rows(raw).select("row_num", "row_type", "col1", "first_three_cols_preview")


@query
def header_counts(spark, sf):
    """All three outcomes of the count: of files with a header, without, and with rows that are missing."""
    raw = mc.read_positional(spark, _nation_files(spark, sf, scratch_dir(spark, "counts")), 5)
    nation = v.table(spark, sf, "nation")
    files = nation.count()
    both = nation.unionByName(nation)
    some = [qa.header_by_count(raw, src, files=files) for src in (nation, both, nation.where("n_nationkey < 3"))]
    return some[0].unionByName(some[1]).unionByName(some[2])


@query
def header_by_count(spark, sf):
    """Rows of a header-less export against the view."""
    root = scratch_dir(spark, "count")
    view = _stored_flagged(spark, sf, root)
    path = ex.export_csv(view, root, PREFIX, header=False, run_ts=RUN_TS).first().path
    return qa.header_by_count(mc.read_positional(spark, path, len(EXPORT_COLS)), view)


@query
def export_preview(spark, sf):
    """Where header and data stand in the first five rows of every file."""
    raw = mc.read_positional(spark, _exported_files(spark, sf, "preview"), len(EXPORT_COLS), max_rows=5)
    return (
        qa.preview_rows(raw)
        .groupBy("row_type")
        .agg(F.min("row_num").alias("first_row"), (F.max("row_num") <= 5).alias("within_five"))
    )


@query
def export_order(spark, sf):
    """The IDs of an export in several files, by their place in all of them: sorted, without an ID last."""
    root = scratch_dir(spark, "order")
    docs = v.table(spark, sf, "orders").select(F.expr("IF(o_orderkey % 50 = 0, NULL, concat('O', o_custkey))").alias("ID"), "o_orderkey")
    path = ex.export_csv(docs, root, PREFIX, as_of=AS_OF, header=False, max_bytes=16 << 10, run_ts=RUN_TS).first().path
    rows = mc.read_positional(spark, path, 2, names=["ID", "o_orderkey"], multi_line=False)
    sizes = rows.groupBy("file_name", F.substring("file_name", 1, 8).alias("hundred")).agg(F.count("*").alias("size"))
    sizes = tb.store_rows(sizes, scratch_dir(spark, "sizes"))
    # Rows before a file: those of earlier hundreds of files, and of earlier files of its own.
    hundreds = sizes.groupBy("hundred").agg(F.sum("size").alias("size"))
    pairs = hundreds.alias("a").join(hundreds.alias("b"), F.col("b.hundred") < F.col("a.hundred"), "left")
    earlier = pairs.groupBy("a.hundred").agg(F.coalesce(F.sum("b.size"), F.lit(0)).alias("earlier"))
    own = F.sum("size").over(Window.partitionBy("hundred").orderBy("file_name")) - F.col("size")
    before = sizes.withColumn("own", own).join(earlier, "hundred").select("file_name", (F.col("earlier") + F.col("own")).alias("before"))
    return rows.join(before, "file_name").select("ID", (F.col("before") + F.col("row_number")).cast("bigint").alias("place"))


@query
def header_mismatches_found(spark, sf):
    """Files whose header is another: the columns of a mapping in the other order, a file a nation."""
    root = scratch_dir(spark, "mismatch")
    names = MAPPING_COLS[::-1]
    customers = v.table(spark, sf, "customer").select("c_nationkey", *[F.col("c_name").alias(c) for c in names])
    out = customers.repartition("c_nationkey").write.partitionBy("c_nationkey").options(**mc.CSV_OPTS)
    out.option("header", True).csv(f"{root}/in")
    return mc.header_mismatches(spark, f"{root}/in").select("found")


@query
def header_mismatches(spark, sf):
    """Files whose header is not the export's: there are none."""
    path = _exported_files(spark, sf, "mismatch")
    return mc.header_mismatches(spark, path, EXPORT_HEADER).select("found")


@query
def export_files(spark, sf):
    """Lines in the files of a header-less export, by content key and name."""
    path = _exported_files(spark, sf, "files", header=False)
    details = fl.file_details(fl.list_files(spark, path, glob="*.csv")).select("path", "export_name")
    return (
        fl.content_keys(spark, path, glob="*.csv")
        .select(fl.file_name(F.col("path")).alias("name"), "lines")
        .join(details.select(fl.file_name(F.col("path")).alias("name"), "export_name"), "name")
        .groupBy("export_name")
        .agg(F.sum("lines").alias("lines"))
    )


@query
def expired_exports(spark, sf):
    """Exports that are over 90 days old a year from now, and today."""
    path = _exported_files(spark, sf, "expired")
    files = fl.list_files(spark, path, glob="*.csv")
    today, later = spark.sql("SELECT current_date(), date_add(current_date(), 365)").first()
    return files.agg(F.count("*").alias("n")).select(
        (F.col("n") == fl.expired(files, later).count()).alias("all_expire"),
        F.lit(fl.expired(files, today).isEmpty()).alias("none_today"),
    )


@query
def special_characters(spark, sf):
    """Documents that upset a CSV parser, by language."""
    docs = v.table(spark, sf, "documents")
    return docs.groupBy("lang").agg(
        F.count("*").alias("documents"), F.count_if(has_special_chars("text")).alias("with_special_chars")
    )


@query
def documents_roundtrip(spark, sf):
    """Whole texts, with their line breaks and quotes, through an export."""
    docs = v.table(spark, sf, "documents").select(F.col("doc_id").alias("ID"), "lang", "text")
    receipt = ex.export_csv(docs, scratch_dir(spark, "texts"), "documents", as_of=AS_OF, run_ts=RUN_TS)
    back = ex.read_export(spark, receipt.first().path, ["ID", "LANG", "TEXT"])
    return back.select(
        F.col("ID").cast("bigint").alias("doc_id"),
        F.col("LANG").alias("lang"),
        F.length("TEXT").cast("bigint").alias("n_chars"),
        F.md5("TEXT").alias("text_md5"),
    )


@query
def export_capped(spark, sf):
    """Documents of very uneven length in files of 256 KB at most: whether all rows
    are there, whether a file is larger, and whether there are over twice as many as
    the bytes need (and one)."""
    cap = 256 << 10
    docs = v.table(spark, sf, "documents").select(F.col("doc_id").alias("ID"), "text")
    path = ex.export_csv(docs, scratch_dir(spark, "capped"), "documents", as_of=AS_OF, max_bytes=cap, run_ts=RUN_TS).first().path
    files = fl.list_files(spark, path, glob="*.csv").agg(
        F.max("length").alias("largest"), F.count("*").alias("files"), F.ceil(F.sum("length") / cap).alias("least")
    )
    rows = ex.read_export(spark, path, ["ID", "TEXT"]).agg(F.count("*").alias("n"), F.sum(F.length("TEXT")).alias("n_chars"))
    return rows.crossJoin(files).select(
        "n", "n_chars", (F.col("largest") > cap).alias("too_large"), (F.col("files") > 2 * F.col("least") + 1).alias("too_many")
    )


def _broken_names(spark, sf):
    """Customers; the names of those in debt hold bytes that are no UTF-8."""
    name = F.encode("c_name", "UTF-8")
    broken = F.concat(name, F.unhex(F.lit("FF")), name, F.unhex(F.lit("E282"))).cast("string")
    customers = v.table(spark, sf, "customer")
    return customers.select(F.col("c_custkey").alias("ID"), F.when(F.col("c_acctbal") < 0, broken).otherwise(F.col("c_name")).alias("name"))


@query
def export_invalid_bytes(spark, sf):
    """Names with bytes that are no UTF-8, after an export, and how many characters it put in."""
    receipt = ex.export_csv(
        _broken_names(spark, sf), scratch_dir(spark, "invalid"), "names", as_of=AS_OF, run_ts=RUN_TS, invalid="replace"
    ).first()
    back = ex.read_export(spark, receipt.path, ["ID", "NAME"])
    return back.select(F.col("ID").cast("bigint").alias("ID"), F.col("NAME").alias("name"), F.lit(receipt.replaced_characters).alias("replaced"))


@query
def load_report_invalid(spark, sf):
    """Lines with bytes that are no UTF-8 in files of mappings, and the characters a reader puts in."""
    root = scratch_dir(spark, "invalid")
    fields = [F.concat(F.lit("C."), "ID"), F.col("name"), *[F.lit("x")] * 4]
    names = _broken_names(spark, sf).select(F.concat_ws(",", *fields).alias("line"))
    names.write.text(f"{root}/in")
    report = mc.load_report(spark, f"{root}/in", run_ts=RUN_TS, check_header=False, multi_line=False, count_invalid=True)
    return report.agg(F.sum("invalid_lines").alias("invalid_lines"), F.sum("replaced_characters").alias("replaced_characters"))


@query
def split_line(spark, sf):
    """Mapping lines cut back into fields."""
    m = v.mapping_full(spark, sf)
    line = m.select(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in MAPPING_COLS]).alias("line"))
    return line.select(*split_fields(F.col("line"), MAPPING_COLS))


@query
def table_rebuild(spark, sf):
    """A table created empty, loaded, and rebuilt from itself without NULL IDs."""
    path = scratch_dir(spark, "table")
    tb.create_if_absent(spark, path)
    tb.reload_table(v.mapping_faulty(spark, sf), path)
    return tb.rebuild_table(spark, path, lambda m: dq.typed(m, require_id=True))


@query
def catalog_table(spark, sf):
    """A mapping saved as a table of the catalog, its column list, and a report with the time
    of its run appended to another twice."""
    name, root = f"revmap_mapping_{scratch_dir(spark, 'catalog')[-32:]}", scratch_dir(spark, "catalog")
    tb.save_as_table(v.mapping_full(spark, sf), name)
    counted = spark.table(name).agg(F.count("*").alias("n"))
    stamped = counted.withColumn("run", run_stamp(RUN_TS))
    tb.append_rows(stamped, f"{root}/log")
    log = tb.append_rows(stamped, f"{root}/log").agg(F.sum("n").alias("n"), F.date_format(F.max("run"), "yyyy-MM-dd HH:mm:ss").alias("run"))
    found = tb.store_rows(log.withColumn("columns", F.lit(tb.column_list(spark.table(name), upper=True))), f"{root}/found")
    spark.sql(f"DROP TABLE {name}")
    return found


@query
def table_versions(spark, sf):
    """What readers of a table get while it is loaded: the rows before the switch and
    after it, the versions out of use, and their sizes against the current one."""
    path = scratch_dir(spark, "versions")
    full = v.mapping_full(spark, sf)
    tb.reload_table(full, path)
    early = tb.read_table(spark, path)
    loading = tb.write_version(v.mapping_faulty(spark, sf), path)
    before = tb.read_table(spark, path)
    loading.publish()
    parts = {"before": before, "after": tb.read_table(spark, path), "held": early}
    counts = [f.groupBy(F.lit(name).alias("reader")).agg(F.count("*").alias("n"), F.count("ID").alias("ids")) for name, f in parts.items()]
    out = tb.superseded(spark, path).groupBy(F.lit("superseded").alias("reader")).agg(F.count("*").alias("n"), F.max("version").alias("ids"))
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(out)


@query
def partitioned_revenue(spark, sf):
    """Mapped revenue from a table partitioned by month: the month filter reads
    one folder."""
    path = scratch_dir(spark, "revenue")
    stored = tb.reload_table(v.revenue(spark, sf), path, partition_by="data_month")
    return mp.map_revenue(stored, v.mapping(spark, sf), as_of=AS_OF).drop("aggregation_source")


def _arrivals(spark, sf, root):
    """The faulty mapping in two arrivals of several files, a file to a batch."""
    low = F.col("Oracle_Invoice_Group") < "F"
    m = v.mapping_faulty(spark, sf)
    for arrived in (m.where(low), m.where(~low)):
        files = arrived.repartition(3, "Oracle_Customer_Name_ID").write.mode("append").options(**mc.CSV_OPTS)
        files.option("header", True).csv(f"{root}/in")
        ingest.ingest_new_files(spark, f"{root}/in", f"{root}/checkpoint", f"{root}/mapping", max_files=1)
    return f"{root}/mapping"


@query
def ingest_stream(spark, sf):
    """The mapping loaded by a stream in two arrivals."""
    return ingest.read_ingested(spark, _arrivals(spark, sf, scratch_dir(spark, "stream")))


@query
def ingest_latest(spark, sf):
    """The latest of two arrivals, whole though it came in several batches."""
    return ingest.read_ingested(spark, _arrivals(spark, sf, scratch_dir(spark, "stream")), latest_only=True)


@query
def ingest_strict(spark, sf):
    """An arrival with every ID in two files, which is set aside, and a clean one after it."""
    root = scratch_dir(spark, "stream")
    m = v.mapping_full(spark, sf)
    outcome = []
    for n, (name, arrived) in enumerate((("twice", m), ("twice", m), ("once", m)), 1):
        arrived.write.mode("append").options(**mc.CSV_OPTS).option("header", True).csv(f"{root}/{name}/{n}")
        if n > 1:
            got = ingest.ingest_new_files(
                spark, f"{root}/{name}", f"{root}/{name}-checkpoint", f"{root}/{name}-mapping", strict=True, max_files=1
            )
            outcome.append((name, got.ok, got.message, ingest.read_ingested(spark, f"{root}/{name}-mapping").count()))
    return spark.createDataFrame(outcome, "arrival string, ok boolean, message string, n bigint")


@query
def monthly_run(spark, sf):
    """All steps of a run, with their outcome and the size of each report."""
    root = scratch_dir(spark, "run")
    cfg = monthly.RunConfig(
        mapping_path=_mapping_files(spark, sf, root),
        revenue=_month_revenue(spark, sf),
        work_dir=f"{root}/work",
        export_dir=f"{root}/out",
        as_of=AS_OF,
        run_ts=RUN_TS,
    )
    results = monthly.run(spark, cfg)
    rows = [
        (i, r.step, r.ok, r.message, name, n)
        for i, r in enumerate(results, 1)
        for name, n in (r.rows or {None: None}).items()
    ]
    return spark.createDataFrame(rows, "n bigint, step string, ok boolean, message string, report string, report_rows bigint")


@query
def export_verify_bare(spark, sf):
    """As export_verify, of an export without headers in a folder below, beside one whose name holds the prefix."""
    root = scratch_dir(spark, "bare")
    view = _stored_flagged(spark, sf, root)
    ex.export_csv(view, f"{root}/out/deep", PREFIX, header=False, run_ts=RUN_TS, store=False)
    ex.export_csv(view.limit(3), f"{root}/out", f"old_{PREFIX}", header=False, run_ts=RUN_TS)
    return qa.export_verify(spark, view, f"{root}/out", PREFIX, header=False).drop(
        "total_files", "first_file_exported", "last_file_exported"
    )


@query
def export_summary_bare(spark, sf):
    """The check of the newest export, without headers, in one file."""
    root = scratch_dir(spark, "bare")
    view = _stored_flagged(spark, sf, root)
    ex.export_csv(view, f"{root}/out", PREFIX, header=False, single=True, run_ts=RUN_TS, store=False)
    found = qa.export_qa(spark, view, f"{root}/out", PREFIX, RUN_TS, header=False)
    return found.select("source_row_count", "exported_data_row_count", "source_unique_ids", "exported_unique_ids", "file_name", "export_status")


@query
def export_sample(spark, sf):
    """A sample of an export without headers: its size, and that its rows are the view's."""
    root = scratch_dir(spark, "sample")
    view = _stored_flagged(spark, sf, root)
    ex.export_csv(view, f"{root}/out", PREFIX, header=False, run_ts=RUN_TS, store=False)
    some = ex.sample_export(spark, f"{root}/out", 7, header=False, export_name=f"{PREFIX}.*")
    known = some.join(view.select("ID").distinct(), "ID", "left_semi")
    return known.agg(F.count("*").alias("n"))
