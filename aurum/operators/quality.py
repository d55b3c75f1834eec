"""Promotion gate: declarative checks, fused execution, one report.

Each check counts failing rows (or failing groups).  Row-level checks on the
same table run as ONE aggregate over one scan; group-level checks (unique,
accepted values, references) are partial-aggregated before their shuffle.
The report is a DataFrame with one row per check; ``assert_open`` raises
when any error-severity check failed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from aurum.operators.joins import missing_references
from aurum.operators.reshape import duplicate_groups

#: Name of the row count among the metrics of ``observe_checks``.
ROWS = "rows"
REPORT_COLUMNS = ["check_no", "check_name", "failing", "severity", "status"]


@dataclass
class Check:
    name: str
    table: str
    kind: str                       # row | floor | unique | values | refs
    predicate: str | None = None    # failing-row predicate (row kind), SQL text
    cols: list[str] = field(default_factory=list)
    values: list = field(default_factory=list)
    parent: tuple[str, str] | None = None
    min_rows: int = 0
    severity: str = "error"
    skip_null: bool = False         # unique: ignore NULL keys (single-column form)

    def failing_pred(self) -> Column:
        return F.expr(self.predicate)


# ------------------------------------------------------------ constructors
def not_null(table: str, col: str, severity: str = "error") -> Check:
    return Check(f"{table}.{col} not_null", table, "row", f"{col} IS NULL", severity=severity)


def accepted_range(table: str, col: str, min_value=None, max_value=None, inclusive: bool = True,
                   severity: str = "error") -> Check:
    """Fails where the value is outside the bounds; NULL passes; a bound may be absent."""
    if min_value is None and max_value is None:
        raise ValueError("accepted_range needs min_value and/or max_value")
    lo, hi = (">=", "<=") if inclusive else (">", "<")
    parts = []
    if min_value is not None:
        parts.append(f"{col} {lo} {min_value}")
    if max_value is not None:
        parts.append(f"{col} {hi} {max_value}")
    pred = f"NOT ({' AND '.join(parts)})"
    return Check(f"{table}.{col} accepted_range", table, "row", pred, severity=severity)


def expression(table: str, name: str, failing: str, severity: str = "error") -> Check:
    """Free check: ``failing`` is the SQL predicate of a failing row."""
    return Check(name, table, "row", failing, severity=severity)


def unique(table: str, cols: list[str] | str, severity: str = "error", name: str | None = None,
           skip_null: bool | None = None) -> Check:
    cols = [cols] if isinstance(cols, str) else list(cols)
    nm = name or (f"{table}.{cols[0]} unique" if len(cols) == 1
                  else f"{table}.({','.join(cols)}) unique_combination")
    return Check(nm, table, "unique", cols=cols, severity=severity,
                 skip_null=(len(cols) == 1) if skip_null is None else skip_null)


def accepted_values(table: str, col: str, values: list, severity: str = "error") -> Check:
    return Check(f"{table}.{col} accepted_values", table, "values", cols=[col], values=list(values),
                 severity=severity)


def relationships(table: str, col: str, parent_table: str, parent_col: str,
                  severity: str = "error") -> Check:
    return Check(f"{table}.{col} relationships", table, "refs", cols=[col],
                 parent=(parent_table, parent_col), severity=severity)


def row_floor(table: str, min_rows: int, severity: str = "error", name: str | None = None) -> Check:
    """Fails (one failing row) when the table has fewer than ``min_rows`` rows."""
    return Check(name or f"{table} row_floor", table, "floor", min_rows=min_rows, severity=severity)


# ------------------------------------------------------------ execution
def _group_failures(check: Check, frames: dict[str, DataFrame]) -> DataFrame:
    df = frames[check.table]
    if check.kind == "unique":
        src = df.filter(F.col(check.cols[0]).isNotNull()) if check.skip_null else df
        return duplicate_groups(src, check.cols).agg(F.count(F.lit(1)).alias("failing"))
    if check.kind == "values":
        c = check.cols[0]
        bad = df.filter(~F.col(c).isin(check.values)).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        return bad.agg(F.count(F.lit(1)).alias("failing"))
    if check.kind == "refs":
        pt, pc = check.parent
        miss = missing_references(df, check.cols[0], frames[pt], pc, "_n")
        return miss.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failing"))
    raise ValueError(check.kind)


def _failing(check: Check) -> Column:
    """Failing rows of a row or floor check, as an aggregate."""
    if check.kind == "row":
        return F.sum(F.when(check.failing_pred(), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    return F.when(F.count(F.lit(1)) < F.lit(check.min_rows), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def metric(check: Check) -> str:
    """Its name among the metrics of a write; checks of one name differ in what they ask."""
    return f"{check.name}: {check.predicate or check.min_rows}"


def observe_checks(df: DataFrame, table: str, checks: list[Check]) -> tuple[DataFrame, Observation]:
    """``df`` with all row and floor checks of ``table`` as metrics of the job that writes it.

    After the write, ``run_checks(observed={table: observation.get})`` reads the counts from
    there instead of scanning the table again."""
    mine = [F.coalesce(_failing(c), F.lit(0)).alias(metric(c)) for c in checks if c.table == table and c.kind in ("row", "floor")]
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS), *mine), seen


def run_checks(checks: list[Check], frames: dict[str, DataFrame], observed: dict[str, dict] | None = None) -> DataFrame:
    """Evaluate all checks; returns the report DataFrame (lazy).  ``observed`` has the metrics of
    tables that were written with ``observe_checks``: only their group checks read them."""
    if not checks:
        raise ValueError("no checks")
    parts: list[DataFrame] = []
    known = [(i, c, observed[c.table][metric(c)]) for i, c in enumerate(checks, start=1)
             if c.kind in ("row", "floor") and c.table in (observed or {})]
    if known:
        spark = next(iter(frames.values())).sparkSession
        parts.append(spark.createDataFrame([(i, int(n)) for i, _, n in known], "check_no int, failing bigint"))
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for i, ch in enumerate(checks, start=1):
        if ch.kind in ("row", "floor") and ch.table not in (observed or {}):
            by_table.setdefault(ch.table, []).append((i, ch))
    for table, items in by_table.items():
        one = frames[table].agg(*[_failing(ch).alias(f"_c{i}") for i, ch in items])
        stack = ", ".join(f"{i}, _c{i}" for i, _ in items)
        parts.append(one.selectExpr(f"stack({len(items)}, {stack}) as (check_no, failing)")
                        .select(F.col("check_no").cast("int"), F.coalesce("failing", F.lit(0)).cast("bigint").alias("failing")))
    for i, ch in enumerate(checks, start=1):
        if ch.kind not in ("row", "floor"):
            parts.append(_group_failures(ch, frames)
                         .select(F.lit(i).cast("int").alias("check_no"), F.col("failing").cast("bigint")))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    # Names and severities are plan-time constants: a CASE on check_no, not a join.
    name = F.lit(None).cast("string")
    sev = F.lit(None).cast("string")
    for i, ch in enumerate(checks, start=1):
        name = F.when(F.col("check_no") == i, F.lit(ch.name)).otherwise(name)
        sev = F.when(F.col("check_no") == i, F.lit(ch.severity)).otherwise(sev)
    status = (F.when(F.col("failing") == 0, F.lit("PASS"))
               .when(F.col("severity") == "warn", F.lit("WARN"))
               .otherwise(F.lit("FAIL")))
    return (counts.select("check_no", name.alias("check_name"), "failing", sev.alias("severity"))
                  .select("check_no", "check_name", "failing", "severity", status.alias("status")))


class GateClosed(RuntimeError):
    pass


def assert_open(report: DataFrame) -> list:
    """Collect the (one row per check) report; raise if an error check failed."""
    rows = report.orderBy("check_no").collect()
    failed = [r.check_name for r in rows if r.status == "FAIL"]
    if failed:
        raise GateClosed(f"gate closed: {len(failed)} error-severity check(s) failed: {failed}")
    return rows
