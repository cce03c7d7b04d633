"""Gates: actions that stop a run or warn. They bring one row of counts, or no
row at all, to the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.columns import count_null


class GateError(RuntimeError):
    """A gate did not let the run continue."""


@dataclass(frozen=True)
class GateResult:
    status: str  # PASS or WARNING
    message: str
    row_count: int | None = None
    unique_ids: int | None = None
    null_ids: int | None = None


def gate_import(m: DataFrame, *, strict: bool = False) -> GateResult:
    """No rows is an error. Duplicates are looked for before NULL IDs, and both
    only warn; ``strict`` makes duplicates (and with them NULL IDs) an error."""
    rows, distinct, nulls = m.agg(F.count("*"), F.count_distinct("ID"), count_null("ID")).first()
    if rows == 0:
        raise GateError(texts.STRICT_NO_ROWS if strict else texts.NO_ROWS)
    if rows != distinct:
        if strict:
            raise GateError(texts.STRICT_DUPLICATE_IDS)
        return GateResult(texts.WARNING, texts.DUPLICATE_IDS, rows, distinct, nulls)
    if nulls > 0:
        return GateResult(texts.WARNING, texts.NULL_IDS_FOUND, rows, distinct, nulls)
    return GateResult(texts.PASS, f"Import validation passed: {rows} rows loaded", rows, distinct, nulls)


def gate_non_empty(df: DataFrame, on_empty: str = "raise") -> GateResult:
    """Whether there is any row; reads no more than it takes to find one."""
    if on_empty not in ("raise", "warn"):
        raise ValueError(f"on_empty must be raise or warn, not {on_empty}")
    if not df.isEmpty():
        return GateResult(texts.PASS, "rows present")
    if on_empty == "raise":
        raise GateError("no rows")
    return GateResult(texts.WARNING, "no rows (may be expected if no revenue data)", 0)
