"""Reading mapping files, writing exports, and checking what was written."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revmap import texts
from revmap.operators import export_qa as qa
from revmap.schemas import EXPORT_COLS, EXPORT_HEADER, MAPPING_COLS, REVENUE
from revmap.sources import export as ex
from revmap.sources import files as fl
from revmap.sources import mapping_csv as mc
from revmap.sources import numbering as nb
from revmap.sources import tables as tb

HEADER = ",".join(MAPPING_COLS)


@pytest.fixture
def write(tmp_path):
    def make(name, *lines, header=HEADER):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *lines] if header else lines) + "\n")
        return str(path)

    return make


def test_quotes_line_breaks_and_null_tokens(spark, write):
    path = write(
        "m.csv",
        '00.248.000.90002.000.000000,"x, y",1,"he said ""hi""","two\nlines",9',
        "b,NULL,null,,\"\",' '",
        " c ,x,1,g,i,9",
    )
    a, b, c = mc.read_mapping(spark, path).orderBy("Oracle_GL_Account").collect()[::-1][::-1]
    found = {r.ID: r for r in (a, b, c)}
    first = found["00.248.000.90002.000.000000"]
    assert (first.Oracle_Customer_Name, first.Oracle_Invoice_Group, first.Oracle_Invoice_Name) == (
        "x, y",
        'he said "hi"',
        "two\nlines",
    )
    assert tuple(found["b"])[1:5] == (None, None, None, None)
    assert " c " in found


def test_ragged_rows(spark, write):
    path = write("m.csv", "a,A,1,g,i,9", "b,B,1,g,i", "c,C,1,g,i,9,extra")
    rows = {r.ID: r for r in mc.read_mapping(spark, path).collect()}
    assert rows["b"].Oracle_GL_Account is None and rows["c"].Oracle_GL_Account == "9"
    assert [r.ID for r in mc.read_mapping(spark, path, on_error="continue").collect()] == ["a"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        mc.read_mapping(spark, path, on_error="strict").collect()
    with pytest.raises(ValueError):
        mc.read_mapping(spark, path, on_error="ignore")


def test_load_report(spark, write, tmp_path):
    write("in/one.csv", "a,A,1,g,i,9", "b,B,1,g,i", "c,C,1,g,i,9,extra", ",C,1,g,i,9")
    write("in/two.csv", "a,A,1,g,i,9")
    report = mc.load_report(spark, str(tmp_path / "in"), run_ts="2026-01-01 10:00:00")
    one, two = report.orderBy("file_name").collect()
    assert (one.file_name, one.row_count, one.error_count, one.null_ids) == ("one.csv", 4, 2, 1)
    assert (one.first_error, one.first_error_record, one.status) == ("b,B,1,g,i", 2, "LOADED_WITH_ERRORS")
    assert (two.row_count, two.error_count, two.first_error, two.status) == (1, 0, None, "LOADED")
    history = tb.append_rows(report, str(tmp_path / "history"))
    assert mc.recent_loads(history, "2026-01-01 10:59:00").count() == 2
    assert mc.recent_loads(history, "2026-01-01 11:01:00").count() == 0


def test_reordered_header_is_refused(spark, write):
    path = write("m.csv", "A,a,1,g,i,9", header="Oracle_Customer_Name,ID,Oracle_Customer_Name_ID,Oracle_Invoice_Group,Oracle_Invoice_Name,Oracle_GL_Account")
    with pytest.raises((PySparkException, Py4JJavaError)):
        mc.read_mapping(spark, path).collect()
    assert mc.read_mapping(spark, path, check_header=False).first().ID == "A"
    assert mc.header_mismatches(spark, path).count() == 1
    assert mc.header_mismatches(spark, write("ok.csv", "a,A,1,g,i,9")).count() == 0


def test_pattern_and_latest(spark, write, tmp_path):
    old = write("in/mapping_1.csv", "old,A,1,g,i,9")
    new = write("in/mapping_2.csv", "new,A,1,g,i,9")
    # Not a mapping: were it opened, its header would stop the read.
    other = write("in/other.csv", "x,y", header="p,q")
    for path, day in ((old, 1), (new, 2), (other, 3)):
        stamp = dt.datetime(2026, 1, day).timestamp()
        os.utime(path, (stamp, stamp))
    root = str(tmp_path / "in")
    assert {r.ID for r in mc.read_mapping(spark, root, pattern=r".*mapping.*\.csv").collect()} == {"old", "new"}
    assert [r.ID for r in mc.read_mapping(spark, root, pattern=r"mapping_.*\.csv", latest=True).collect()] == ["new"]
    assert fl.list_files(spark, root, glob="other*").count() == 1
    assert fl.latest_file(fl.list_files(spark, root)).endswith("other.csv")
    assert [r.file_name for r in fl.file_details(fl.list_files(spark, root)).collect()] == [
        "other.csv",
        "mapping_2.csv",
        "mapping_1.csv",
    ]
    gone = fl.expired(fl.list_files(spark, root), dt.date(2026, 4, 2))
    assert [fl_.path.rsplit("/", 1)[1] for fl_ in gone.collect()] == ["mapping_1.csv"]
    with pytest.raises(FileNotFoundError):
        mc.read_mapping(spark, root, pattern="nothing", latest=True)


def test_missing_folder_has_no_files(spark, tmp_path):
    assert fl.list_files(spark, str(tmp_path / "none")).count() == 0
    assert fl.latest_file(fl.list_files(spark, str(tmp_path / "none"))) is None


def test_content_keys(spark, write, tmp_path):
    write("in/a.csv", "1,2", header=None)
    write("in/b.csv", "1,2", header=None)
    write("in/c.csv", "1,3", header=None)
    keys = {r.path.rsplit("/", 1)[1]: r.content_key for r in fl.content_keys(spark, str(tmp_path / "in")).collect()}
    assert keys["a.csv"] == keys["b.csv"] != keys["c.csv"]


def test_content_keys_see_the_order_of_lines_and_blocks(spark, tmp_path, small_blocks):
    lines = [f"line {i} {'x' * (i % 60)}" for i in range(2000)]
    swapped = [*lines[:700], lines[701], lines[700], *lines[702:]]
    turned = lines[1000:] + lines[:1000]
    for name, content in {"a": lines, "b": swapped, "c": turned, "d": lines, "e": lines[:-1], "f": [], "g": [""]}.items():
        (tmp_path / f"{name}.txt").write_text("".join(x + "\n" for x in content))
    keys = lambda: {r.path[-5]: r.content_key for r in fl.content_keys(spark, str(tmp_path)).collect()}
    found = keys()
    assert found["a"] == found["d"] and len({found[k] for k in "abceg"}) == 5
    # A key does not depend on how the file is split.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    assert keys() == found


def test_positional_rows_are_numbered_per_file(spark, write, tmp_path):
    for name in ("a.csv", "b.csv"):
        write(f"in/{name}", "x,1", "y,2", "z,\"3\n4\"", header="h,k")
    raw = mc.read_positional(spark, str(tmp_path / "in"), 2)
    got = sorted((r.file_name, r.row_number, r.c1, r.c2) for r in raw.collect())
    assert got[:4] == [("a.csv", 1, "h", "k"), ("a.csv", 2, "x", "1"), ("a.csv", 3, "y", "2"), ("a.csv", 4, "z", "3\n4")]
    assert mc.read_positional(spark, str(tmp_path / "in"), 2, max_rows=2).count() == 4


@pytest.fixture
def small_blocks(spark):
    """Files are read in blocks of 4 KB."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_of_split_files_are_numbered_by_offsets(spark, tmp_path, small_blocks):
    """Files of one line, none, blank lines, and of many blocks, with lines longer than a block."""
    wanted = {}
    for name, lines in {
        "one.csv": ["only,1"],
        "none.csv": [],
        "many.csv": [f"r{i},{'x' * (i % 97)}" for i in range(3000)],
        "long.csv": [f"r{i},{'y' * (9000 if i % 7 == 0 else 3)}" for i in range(60)],
        "blank.csv": [f"r{i},z" if i % 5 else "" for i in range(2000)],
    }.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("".join(line + "\n" for line in lines))
        wanted |= {(name, n): line.split(",")[0] for n, line in enumerate((x for x in lines if x), 1)}
    raw = mc.read_positional(spark, str(tmp_path / "in"), 2, multi_line=False)
    assert {(r.file_name, r.row_number): r.c1 for r in raw.collect()} == wanted
    assert raw.count() == len(wanted) and raw.rdd.getNumPartitions() > 20
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = mc.read_positional(spark, str(tmp_path / "in"), 2, multi_line=False)
        assert {(r.file_name, r.row_number): r.c1 for r in shuffled.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first = mc.read_positional(spark, str(tmp_path / "in"), 2, multi_line=False, max_rows=3)
    assert {(r.file_name, r.row_number): r.c1 for r in first.collect()} == {k: c for k, c in wanted.items() if k[1] <= 3}


def test_first_error_of_a_split_file(spark, tmp_path, small_blocks):
    good, bad = "id{},A,1,g,i,9", "id{},A,1,g,i"
    for name, errors in (("late.csv", {1900, 1950}), ("early.csv", {3, 1999}), ("clean.csv", set())):
        lines = [HEADER] + [(bad if i in errors else good).format(i) for i in range(2000)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    for multi_line in (True, False):
        report = {r.file_name: r for r in mc.load_report(spark, str(tmp_path), multi_line=multi_line).collect()}
        assert {n: (r.row_count, r.error_count, r.first_error_record) for n, r in report.items()} == {
            "late.csv": (2000, 2, 1901),
            "early.csv": (2000, 2, 4),
            "clean.csv": (2000, 0, None),
        }
        assert report["late.csv"].first_error == "id1900,A,1,g,i"


def test_blocks_that_change_are_an_error(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("".join(f"r{i},{i}\n" for i in range(3000)))
    raw = mc.read_positional(spark, str(tmp_path), 2, multi_line=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    with pytest.raises((PySparkException, Py4JJavaError), match="changed while it was read"):
        raw.collect()


# Exports


@pytest.fixture
def view(spark):
    """Seven rows of the flagged view with awkward text and a NULL ID."""
    names = ['a "quoted" name', "comma, name", "two\nlines", "  spaces  ", "back\\slash", None, "plain"]
    rows = []
    for i, name in enumerate(names):
        record = [name, str(i), "g", "i", "9", "Y", "Y"]
        for f in REVENUE.fields:
            value = {"date": dt.date(2025, 9, 1), "double": i + 0.5, "string": f"s{i}"}[f.dataType.simpleString()]
            record.append((f"00.{i}" if i < 6 else None) if f.name == "id" else value)
        rows.append(tuple(record))
    schema = ", ".join(f"{c} string" for c in EXPORT_COLS[:7]) + ", " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in REVENUE.fields
    )
    return spark.createDataFrame(rows, schema)


def _texts(df):
    return sorted((tuple(r) for r in df.select([F.col(c).cast("string") for c in EXPORT_COLS]).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"compression": "gzip"}, {"single": True}, {"max_records": 2}])
def test_export_comes_back_whole(spark, view, tmp_path, how):
    receipt = ex.export_csv(view, str(tmp_path), "mapped", run_ts="2025-10-01 00:00:00", source="v", **how).first()
    assert receipt.exported_file == "mapped_202509" and receipt.data_month == "202509"
    back = ex.read_export(spark, receipt.path)
    assert _texts(back) == _texts(view)
    names = [n for n in os.listdir(receipt.path) if n.startswith("part-")]
    assert all(n.endswith(".csv.gz" if "compression" in how else ".csv") for n in names)
    if "single" in how:
        assert len(names) == 1
        assert [r.ID for r in back.collect()] == [f"00.{i}" for i in range(6)] + [None]
    if "max_records" in how:
        assert len(names) >= 4


def test_export_order_header_and_overwrite(spark, view, tmp_path):
    path = ex.export_csv(view, str(tmp_path), "mapped", as_of="2026-01-15").first().path
    assert path.endswith("mapped_202512")
    files = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    first = (tmp_path / "mapped_202512" / files[0]).read_text()
    assert first.startswith(",".join(EXPORT_HEADER) + "\n")
    ids = [r.ID for r in spark.read.options(**ex.CSV_OPTS).option("header", True).option("multiLine", True).csv([f"{path}/{n}" for n in files]).collect()]
    assert sorted(ids, key=lambda i: (i is None, i)) == ids
    with pytest.raises((PySparkException, Py4JJavaError)):
        ex.export_csv(view, str(tmp_path), "mapped", as_of="2026-01-15", overwrite=False)


def test_empty_export_still_has_a_header(spark, view, tmp_path):
    path = ex.export_csv(view.limit(0), str(tmp_path), "mapped", as_of="2025-10-15").first().path
    assert ex.read_export(spark, path).count() == 0
    assert mc.read_positional(spark, path, 43, max_rows=1).first().c1 == "ORACLE_CUSTOMER_NAME"
    with pytest.raises(ValueError, match="data_month"):
        ex.export_csv(view.limit(0), str(tmp_path), "other")


def test_one_file_has_a_limit(view, tmp_path):
    with pytest.raises(ValueError, match="single=False"):
        ex.export_csv(view, str(tmp_path), "mapped", single=True, max_records=6)


def test_no_file_exceeds_its_cap(spark, tmp_path):
    uneven = spark.range(0, 400, 1, 1).selectExpr("id AS ID", "repeat('\"x', IF(id < 200, 400, 4)) AS text")
    path = ex.export_csv(uneven, str(tmp_path), "uneven", as_of="2025-10-15", max_bytes=50_000).first().path
    sizes = [os.path.getsize(f"{path}/{n}") for n in os.listdir(path) if n.startswith("part-")]
    assert max(sizes) <= 50_000 < sum(sizes)
    assert ex.read_export(spark, path, ["ID", "TEXT"]).count() == 400
    with pytest.raises(ValueError, match="single=False"):
        ex.export_csv(uneven, str(tmp_path), "uneven", as_of="2025-10-15", max_bytes=50_000, single=True)


def _file_sizes(path):
    return [os.path.getsize(f"{path}/{n}") for n in sorted(os.listdir(path)) if n.startswith("part-")]


@pytest.mark.parametrize(
    "key", ["CAST(id AS BIGINT)", "CAST(id % 7 AS STRING)", "IF(id % 3 = 0, NULL, id DIV 900)", "date_add(DATE '2020-01-01', CAST(id % 11 AS INT))",
            "IF(id % 5 = 0, double('nan'), -id / 3)", "CAST(id % 13 AS DECIMAL(20, 2)) / 3", "CAST(NULL AS STRING)", "concat('é', id)"],
)
def test_files_are_cut_at_bytes(spark, tmp_path, key):
    """Rows of 10 to 40,000 bytes: no file above the cap, few files, all rows in order."""
    rows = spark.range(0, 3000, 1, 7).selectExpr(
        f"{key} AS ID", "id AS n", "repeat(IF(id % 2 = 0, '\"', 'x'), CAST(IF(id % 250 = 7, 19000, 5 + id % 90) AS INT)) AS text"
    )
    path = ex.export_csv(rows, str(tmp_path), "cut", as_of="2025-10-15", max_bytes=60_000).first().path
    sizes = _file_sizes(path)
    assert max(sizes) <= 60_000
    assert len(sizes) <= 2 * -(-sum(sizes) // 60_000) + 1
    back = ex.read_export(spark, path, ["ID", "N", "TEXT"])
    assert back.agg(F.count("*"), F.countDistinct("N"), F.sum(F.length("TEXT"))).first() == rows.agg(
        F.count("*"), F.countDistinct("n"), F.sum(F.length("text"))
    ).first()
    found = back.select("file_name", F.col("N").cast("bigint").alias("n")).collect()
    place = {r.n: r.file_name for r in found}
    wanted = [r.n for r in rows.orderBy(F.asc_nulls_last("ID")).collect()]
    keys = {r.n: r.ID for r in rows.collect()}
    for a, b in zip(wanted, wanted[1:], strict=False):
        assert place[a] <= place[b] or repr(keys[a]) == repr(keys[b])


def test_a_dominant_key_fills_several_files(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 5).selectExpr("IF(id < 3000, 'same', concat('k', id)) AS ID", "repeat('y', 100) AS text")
    path = ex.export_csv(rows, str(tmp_path), "hot", as_of="2025-10-15", max_bytes=30_000).first().path
    sizes = _file_sizes(path)
    assert max(sizes) <= 30_000 and len(sizes) <= 2 * -(-sum(sizes) // 30_000) + 1
    assert ex.read_export(spark, path, ["ID", "TEXT"]).where("ID = 'same'").count() == 3000


def test_a_row_beyond_the_cap_has_its_own_file(spark, tmp_path):
    rows = spark.range(0, 50, 1, 3).selectExpr("id AS ID", "repeat('z', IF(id % 10 = 3, 9000, 10)) AS text")
    path = ex.export_csv(rows, str(tmp_path), "large", as_of="2025-10-15", max_bytes=5_000).first().path
    sizes = _file_sizes(path)
    assert sum(s > 5_000 for s in sizes) == 5 and max(sizes) < 9_100 and len(sizes) <= 11
    assert ex.read_export(spark, path, ["ID", "TEXT"]).count() == 50


def test_the_copy_of_an_export_is_cleared(spark, view, tmp_path, monkeypatch):
    monkeypatch.setattr(ex, "scratch_dir", lambda *_: str(tmp_path / "copy"))
    path = ex.export_csv(view, str(tmp_path / "out"), "mapped").first().path
    assert spark.read.parquet(str(tmp_path / "copy")).columns == ["cleared"]
    assert _texts(ex.read_export(spark, path)) == _texts(view)


def test_bytes_that_are_no_utf8(spark, tmp_path):
    broken = "CAST(concat(encode('a', 'UTF-8'), X'FF', encode('é', 'UTF-8'), X'E282', encode('z', 'UTF-8')) AS STRING)"
    rows = spark.range(0, 60, 1, 4).selectExpr("CAST(id AS STRING) AS ID", f"IF(id % 20 = 3, {broken}, IF(id % 2 = 0, 'ok \ufffd', NULL)) AS text")
    receipt = ex.export_csv(rows, str(tmp_path), "bad", as_of="2025-10-15", invalid="replace").first()
    assert receipt.replaced_characters == 6
    back = {int(r.ID): r.TEXT for r in ex.read_export(spark, receipt.path, ["ID", "TEXT"]).collect()}
    assert {back[i] for i in (3, 23, 43)} == {"a\ufffdé\ufffdz"} and back[4] == "ok \ufffd" and back[5] is None
    assert "replaced_characters" not in ex.export_csv(rows, str(tmp_path), "same", as_of="2025-10-15", max_bytes=300).columns
    assert max(_file_sizes(f"{tmp_path}/same_202509")) <= 300
    with pytest.raises(ValueError, match="6 characters"):
        ex.export_csv(rows, str(tmp_path), "no", as_of="2025-10-15", invalid="error")
    assert not (tmp_path / "no_202509").exists()
    clean = ex.export_csv(rows.where("ID = '4'"), str(tmp_path), "clean", as_of="2025-10-15", invalid="error").first()
    assert clean.replaced_characters == 0


def test_invalid_lines_of_split_files(spark, tmp_path, small_blocks):
    good, bad = b"id,A,1,g,i,9", b"i\xffd,A\xe2\x82,1,g,i,9"
    for name, at in (("late.csv", {1800, 1850}), ("early.csv", {2}), ("clean.csv", set())):
        lines = [HEADER.encode()] + [bad if i in at else good for i in range(2, 2000)]
        (tmp_path / name).write_bytes(b"\n".join(lines) + b"\n")
    report = mc.load_report(spark, str(tmp_path), multi_line=False, count_invalid=True).collect()
    assert {r.file_name: (r.row_count, r.invalid_lines, r.replaced_characters, r.first_invalid_line) for r in report} == {
        "late.csv": (1998, 2, 4, 1800),
        "early.csv": (1998, 1, 2, 2),
        "clean.csv": (1998, 0, 0, None),
    }


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_short_row_is_one_to_every_reader(spark, tmp_path, multi_line):
    lines = [",".join(MAPPING_COLS)] + [f"id{i},A,1,g,i,9" if i != 1500 else "bad,A,1,g,i" for i in range(2000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        read = lambda how: mc.read_mapping(spark, str(tmp_path / "in"), on_error=how, multi_line=multi_line)
        assert read("continue").count() == read("continue").select("ID").count() == 1999
        assert read("abort").count() == 2000
        for use in (lambda d: d.count(), lambda d: d.select("ID").collect()):
            with pytest.raises((PySparkException, Py4JJavaError)):
                use(read("strict"))
        report = mc.load_report(spark, str(tmp_path / "in"), multi_line=multi_line).first()
        assert (report.row_count, report.error_count, report.first_error_column) == (2000, 1, 6)
        assert report.first_error_record == 1501
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_folders_below_are_read_and_checked(spark, write, view, tmp_path):
    write("in/a.csv", "a,A,1,g,i,9")
    write("in/deep/b.csv", "b,A,1,g,i,9")
    assert mc.read_mapping(spark, str(tmp_path / "in"), pattern=r".\.csv").count() == 2
    root = str(tmp_path / "out")
    ex.export_csv(view, f"{root}/deep", "mapped", header=False)
    ex.export_csv(view.limit(1), root, "old_mapped", header=False)
    assert qa.export_verify(spark, view, root, "mapped", header=False).first().export_status == texts.PASS_ALL_ROWS
    assert qa.export_qa(spark, view, root, "mapped", header=False).first().export_status == texts.PASS_EXPORT
    assert qa.export_failures(spark, view, root, "mapped", header=False).count() == 0
    assert ex.sample_export(spark, root, 3, header=False, export_name="mapped.*").count() == 3


def test_null_text_can_be_chosen(spark, view, tmp_path):
    path = ex.export_csv(view, str(tmp_path), "mapped", null_value="NULL", single=True).first().path
    text = "".join((p.read_text()) for p in (tmp_path / "mapped_202509").glob("part-*"))
    assert "NULL" in text
    assert _texts(ex.read_export(spark, path)) == _texts(view)


def test_add_header(spark, view, tmp_path):
    bare = ex.export_csv(view, str(tmp_path), "mapped", header=False, single=True).first().path
    raw = mc.read_positional(spark, bare, 43)
    assert qa.header_by_count(raw, view).first().header_analysis == texts.COUNT_NONE
    assert qa.header_validation(raw).first().validation_result == texts.HEADERS_NOT_FOUND
    ex.add_header(spark, bare, f"{bare}_with_headers")
    raw = mc.read_positional(spark, f"{bare}_with_headers", 43)
    assert qa.header_by_count(raw, view).first().header_analysis == texts.COUNT_PRESENT
    assert qa.header_validation(raw).first().validation_result == texts.HEADERS_CONFIRMED
    assert _texts(ex.read_export(spark, f"{bare}_with_headers")) == _texts(view)
    assert qa.header_by_count(raw, view.limit(3)).first().header_analysis == texts.COUNT_MISMATCH
    with pytest.raises((PySparkException, Py4JJavaError)):
        ex.add_header(spark, bare, f"{bare}_short", "A,B,C")


@pytest.mark.parametrize(
    ("first", "literal", "escaped"),
    [
        ("ORACLE_CUSTOMER_NAME,ORACLE_CUSTOMER_NAME_ID,ORACLE_INVOICE_GROUP", texts.HEADERS_FOUND, texts.HEADERS_FOUND),
        ("some_name,b,c", texts.HEADERS_LIKELY, texts.HEADERS_LIKELY),
        ("a.b,b,c", texts.HEADERS_LIKELY, texts.HEADERS_LIKELY),
        ("x" * 21 + ",b,c", texts.HEADERS_LIKELY, texts.HEADERS_LIKELY),
        ("123,b,c", texts.HEADERS_LIKELY, texts.HEADERS_NONE),
        ("word,b,c", texts.HEADERS_LIKELY, texts.HEADERS_UNCERTAIN),
        (",b,c", texts.HEADERS_UNCERTAIN, texts.HEADERS_UNCERTAIN),
    ],
)
def test_header_detector(spark, write, first, literal, escaped):
    raw = mc.read_positional(spark, write("f.csv", "1,2,3", header=first), 3)
    assert qa.header_check(raw).first().header_check_status == literal
    assert qa.header_check(raw, escape_underscore=True).first().header_check_status == escaped


def test_preview_rows(spark, write):
    raw = mc.read_positional(spark, write("f.csv", *["1,2,3"] * 9, header="a,b,c"), 3)
    rows = qa.preview_rows(raw).collect()
    assert [r.row_num for r in rows] == [1, 2, 3, 4, 5]
    assert (rows[0].row_type, rows[1].row_type) == (texts.HEADER_ROW, texts.DATA_ROW)
    assert rows[0].first_three_cols_preview == "a,b,c..."


def test_qa_of_a_good_and_a_short_export(spark, view, tmp_path):
    root = str(tmp_path / "out")
    ex.export_csv(view, root, "mapped")
    good = qa.export_qa(spark, view, root, "mapped", "2025-10-01 00:00:00").first()
    assert (good.export_status, good.file_name, good.export_completeness_pct) == (texts.PASS_EXPORT, "mapped_202509", 100.0)
    assert qa.export_failures(spark, view, root, "mapped").count() == 0
    assert qa.export_verify(spark, view, root, "mapped").first().export_status == texts.PASS_ALL_ROWS

    ex.export_csv(view.where("ID IS NULL OR ID <> '00.3'"), root, "mapped")
    short = qa.export_qa(spark, view, root, "mapped").first()
    assert (short.export_status, short.row_count_difference) == (texts.WARN_ROWS, 1)
    assert short.validation_details == "Source has 7 rows, exported has 6 rows"
    assert qa.export_failures(spark, view, root, "mapped").first().failure_reason == texts.REASON_ROWS
    back = ex.read_export(spark, f"{root}/mapped_202509")
    assert [r.missing_id for r in qa.missing_ids(view, back).collect()] == ["00.3"]
    found = qa.investigate(view, back, "00.3")
    assert found["exists"].first().record_count == 1 and found["in_export"].first().exported_count == 0
    assert found["record"].count() == 1
    status = found["field_status"].first()
    assert (status.id_format, status.id_length, status.Oracle_Customer_Name_status) == ("HAS_DOTS", 4, "HAS_VALUE")


def test_special_characters(view):
    chars = {r.ID: r.Oracle_Customer_Name_chars for r in qa.field_status(view).collect()}
    assert [chars[f"00.{i}"] for i in range(6)] == ["HAS_SPECIAL_CHARS", "OK", "HAS_SPECIAL_CHARS", "OK", "OK", "OK"]


def test_qa_of_a_missing_an_empty_and_a_changed_export(spark, view, tmp_path):
    root = str(tmp_path / "out")
    missing = qa.export_qa(spark, view, root, "mapped").first()
    assert (missing.export_status, missing.file_name, missing.source_row_count) == (texts.FAIL_NO_FILE, None, 7)
    assert qa.export_failures(spark, view, root, "mapped").first().failure_reason == texts.REASON_NO_FILE
    verified = qa.export_verify(spark, view, root, "mapped").first()
    assert (verified.total_files, verified.total_rows_exported, verified.export_status) == (0, None, texts.WARN_ROWS)

    ex.export_csv(view.limit(0), root, "mapped", as_of="2025-10-01")
    assert qa.export_qa(spark, view, root, "mapped").first().export_status == texts.FAIL_EMPTY_FILE
    assert qa.export_failures(spark, view, root, "mapped").first().failure_reason == texts.REASON_ROWS
    assert qa.export_failures(spark, view.limit(0), root, "mapped").first().failure_reason == texts.REASON_EMPTY

    ex.export_csv(view.withColumn("ID", F.lit("x")), root, "mapped")
    assert qa.export_qa(spark, view, root, "mapped").first().export_status == texts.WARN_IDS


def test_newest_export_counts(spark, view, tmp_path):
    root = str(tmp_path / "out")
    for as_of, rows, day in (("2025-10-01", 7, 1), ("2025-11-01", 5, 2)):
        path = ex.export_csv(view.limit(rows), root, "mapped", as_of=as_of).first().path
        for name in os.listdir(path):
            stamp = dt.datetime(2026, 1, day).timestamp()
            os.utime(f"{path}/{name}", (stamp, stamp))
    row = qa.export_qa(spark, view, root, "mapped").first()
    assert (row.file_name, row.exported_data_row_count) == ("mapped_202510", 5)
    assert [r.export_name for r in qa.exports(spark, root, "mapped").collect()] == ["mapped_202510", "mapped_202509"]
    assert qa.export_verify(spark, view, root, "mapped").first().total_rows_exported == 12


def test_record_export(spark, view, tmp_path):
    path = ex.export_record(view, str(tmp_path), "00.2").first().path
    assert [r.ORACLE_CUSTOMER_NAME for r in ex.read_export(spark, path).collect()] == ["two\nlines"]


# Tables


def test_tables(spark, tmp_path, mapping, rows):
    path = str(tmp_path / "t")
    assert tb.create_if_absent(spark, path).count() == 0
    tb.reload_table(mapping(("a", "A", "1"), (None, "B", "2")), path)
    assert tb.create_if_absent(spark, path).count() == 2
    assert rows(tb.rebuild_table(spark, path, lambda m: m.where("ID IS NOT NULL")).select("ID")) == [("a",)]
    tb.register_view(tb.read_table(spark, path), "mapping_view")
    assert spark.sql("SELECT count(*) FROM mapping_view").first()[0] == 1
    assert tb.column_list(tb.read_table(spark, path)) == HEADER
    assert tb.column_list(tb.read_table(spark, path), upper=True) == HEADER.upper()


def test_month_partitions_are_pruned(spark, revenue, tmp_path):
    r = revenue(*[(f"c{i}", f"2025-{m:02d}-01", 1.0) for m in range(1, 13) for i in range(5)])
    stored = tb.reload_table(r, str(tmp_path / "r"), partition_by="data_month")
    plan = stored.where(F.col("data_month") == F.lit("2025-02-01").cast("date"))
    assert "PartitionFilters: [isnotnull(data_month" in plan._jdf.queryExecution().toString()
    assert plan.count() == 5
    assert len(list((tmp_path / "r/data").glob("*/data_month=*"))) == 12


def test_readers_never_see_half_a_load(spark, mapping, rows, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        tb.read_table(spark, path)
    tb.reload_table(mapping(("a", "A", "1"), ("b", "B", "2")), path)
    held = tb.read_table(spark, path)
    many = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("broken"))).otherwise("x").alias("ID"))
    for load in (lambda: tb.reload_table(many, path), lambda: tb.rebuild_table(spark, path, lambda m: m.crossJoin(many.withColumnRenamed("ID", "i")))):
        with pytest.raises((PySparkException, Py4JJavaError), match="broken"):
            load()
        assert rows(tb.read_table(spark, path).select("ID")) == [("a",), ("b",)]
    waiting = tb.write_version(mapping(("c", "C", "3")), path)
    assert rows(tb.read_table(spark, path).select("ID")) == [("a",), ("b",)] and waiting.rows.count() == 1
    waiting.publish()
    assert rows(tb.read_table(spark, path).select("ID")) == [("c",)]
    # A frame that was made before the switch still reads what it was made for.
    assert rows(held.select("ID")) == [("a",), ("b",)]
    assert rows(tb.versions(spark, path).select("version", "current")) == [(1, False), (2, True)]
    old = [r.version for r in tb.superseded(spark, path).collect()]
    assert 1 in old and 2 not in old
    tb.rebuild_table(spark, path, lambda m: m.where("ID = 'none'"))
    assert tb.read_table(spark, path).schema == mapping(("a", "A", "1")).schema and tb.read_table(spark, path).count() == 0


def test_two_loads_at_once_agree_on_one(spark, mapping, rows, tmp_path):
    path = str(tmp_path / "table")
    one, two = (tb.write_version(mapping((i, "A", "1")), path) for i in "ab")
    entry = spark.createDataFrame([(7, v.folder, __import__("json").dumps(v.rows.schema.jsonValue())) for v in (one, two)], "version bigint, folder string, columns string")
    entry.withColumn("published", F.current_timestamp()).write.parquet(f"{path}/versions")
    wanted = max(((v.folder, v) for v in (one, two)), key=lambda x: x[0])[1]
    assert rows(tb.read_table(spark, path)) == rows(wanted.rows)
    assert [r.version for r in tb.superseded(spark, path).collect()] == [7]
