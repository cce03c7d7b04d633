from __future__ import annotations

import pytest

from revmap import texts
from revmap.operators import quality as dq
from revmap.operators.gates import GateError, gate_import, gate_non_empty


def test_empty_mapping(mapping):
    m = mapping()
    summary = dq.dq_summary(m).first()
    assert (summary.total_records, summary.unique_ids, summary.overall_status) == (0, 0, texts.PASS_QUALITY)
    assert dq.uniqueness(m).first().status == texts.PASS
    with pytest.raises(GateError, match="No rows loaded"):
        gate_import(m)


def test_null_id_is_a_duplicate_and_warns_first(mapping):
    m = mapping(("a", "A", "1"), (None, "B", "2"))
    row = dq.uniqueness(m).first()
    assert (row.total_records, row.unique_ids, row.duplicate_count, row.status) == (2, 1, 1, texts.FAIL_DUPLICATE_IDS)
    gate = gate_import(m)
    assert (gate.status, gate.message, gate.null_ids) == (texts.WARNING, texts.DUPLICATE_IDS, 1)
    with pytest.raises(GateError, match="Duplicate IDs"):
        gate_import(m, strict=True)


def test_gate_passes_clean_mapping(mapping):
    assert gate_import(mapping(("a", "A", "1"))).message == "Import validation passed: 1 rows loaded"


def test_duplicates_with_null_group_in_order(mapping, rows):
    m = mapping(("a", "A", "1"), ("a", "A", "1"), (None, "x", "1"), (None, "x", "1"), (None, "y", "1"), ("b", "B", "1"))
    assert [tuple(r) for r in dq.duplicates(m).collect()] == [(None, 3), ("a", 2)]
    # The column test does not look at NULL.
    assert rows(dq.unique(m, "ID")) == [("a", 2)]
    assert dq.not_null(m, "ID").count() == 3


def test_blank_is_not_null(mapping):
    m = mapping(("  ", "A", "1"), ("\t", "B", "2"), (None, None, None))
    assert dq.empty_check(m).first().empty_ids == 1
    summary = dq.dq_summary(m).first()
    assert (summary.total_invalid_ids, summary.id_completeness_status) == (2, texts.FAIL)
    assert dq.completeness(m).first().null_ids == 1


def test_null_critical_labels(mapping, rows):
    m = mapping(("a", None, "1"), ("b", "B", None), ("c", "C", "3"))
    assert rows(dq.null_critical(m)) == [("a", "NULL", "OK"), ("b", "OK", "NULL")]


def test_format_depends_on_the_pattern(mapping):
    m = mapping(("00.248.000.90002.000.000000", "A", "1"), ("abc1", "B", "1"), (None, "C", "1"))
    assert dq.format_check(m).first().invalid_format_ids == 2
    assert dq.format_check(m, r"^[A-Za-z0-9.]+$").first().invalid_format_ids == 1


def test_check_rows(mapping, rows):
    m = mapping(("a", "A", "1"), (None, "B", "2"))
    assert rows(dq.check_rows(m)) == [
        ("NULL IDs", 1, texts.FAIL_NULL_IDS),
        ("Total Records", 2, None),
        ("Unique IDs", 1, texts.FAIL_DUPLICATES),
    ]


def test_quick_check(mapping):
    assert dq.quick_check(mapping(("a", "A", "1"), ("b", "B", "1"))).first().status == texts.PASS
    assert dq.quick_check(mapping(("a", "A", "1"), ("a", "B", "1"))).first().status == texts.FAIL_QUICK


def test_lengths(mapping):
    row = dq.length_profile(mapping(("a", "AB", "1"), ("abc", None, "12"))).first()
    assert (row.min_id_length, row.max_id_length, row.avg_id_length) == (1, 3, 2.0)
    assert (row.min_customer_name_length, row.max_gl_account_length) == (2, 2)


def test_staged_and_preview(mapping, rows):
    m = mapping(("b", " B ", "1"), (None, "C", "1"), ("a", "A", "1"))
    assert rows(dq.staged(m)) == [("a", "A", "1"), ("b", "B", "1")]
    assert [r.ID for r in dq.preview(m, n=2).collect()] == ["a", "b"]
    assert [r.ID for r in dq.typed(m, ordered=True).collect()] == ["a", "b", None]


def test_non_empty_gate(mapping):
    assert gate_non_empty(mapping(("a", "A", "1"))).status == texts.PASS
    assert gate_non_empty(mapping(), on_empty="warn").status == texts.WARNING
    with pytest.raises(GateError):
        gate_non_empty(mapping())
    with pytest.raises(ValueError):
        gate_non_empty(mapping(), on_empty="ignore")
