"""Oracle: load results (target after merge), load counts, guard, reclassification."""

from __future__ import annotations

from slicewright.config import SPLIT_DIVISION
from slicewright.oracle.common import entity_ctes, sql_str, with_fixtures
from slicewright.oracle.purchasing import purchase_order_sql, receipt_sql
from slicewright.oracle.sales_order import sales_order_sql
from slicewright.oracle.slices import RUN_TS, inventory_sql, invoice_sql, quote_sql, shipment_sql
from slicewright.plans.loads import FLAG, SPECS, STAMP

SLICE_PARTS = {
    "sales_order_slice_split": lambda: sales_order_sql("split", parts=True),
    "invoice_slice_split": lambda: invoice_sql("split", parts=True),
    "inventory_slice_split": lambda: inventory_sql(parts=True),
    "purchase_order_slice_split": lambda: purchase_order_sql(parts=True),
    "shipment_slice_split": lambda: shipment_sql(parts=True),
    "receipt_slice_split": lambda: receipt_sql(parts=True),
    "quote_slice_split": lambda: quote_sql(parts=True),
}

SEED_COLS = {
    "f_sales_order": "NativeId, NativeLineId, SONumber, IsLTA, DPT_AUTO_KEY, DivisionId",
    "f_invoice": "NativeId, NativeLineId, InvoiceNumber, InvoiceDate, LinePrice, DPT_AUTO_KEY, DivisionId",
    "f_inventory": "NativeId, PartId, QtyOnHand, DPT_AUTO_KEY, DivisionId",
    "f_purchase_order": "NativeId, NativeLineId, PartId, UnitCost, PODate, DPT_AUTO_KEY, DivisionId",
}


def _q(c: str) -> str:
    return f'"{c}"'


def slice_ctes(slice_job: str) -> list[tuple[str, str]]:
    ctes, final = SLICE_PARTS[slice_job]()
    return ctes + [("slice_out", final)]


def source_cte(spec) -> tuple[str, str]:
    if spec.kind in ("sales_order", "purchase_order"):
        return ("src", f"SELECT * FROM slice_out WHERE DivisionId = {SPLIT_DIVISION}")
    if spec.kind == "shipment":
        rest = [c for c in spec.insert_cols if c not in ("NativeId", "DivisionId", "NativeModifiedDate")]
        order = ", ".join(f"{_q(c)} ASC NULLS FIRST" for c in rest)
        return ("src", "SELECT * EXCLUDE (__r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY NativeId, DivisionId "
                       f"ORDER BY NativeModifiedDate DESC NULLS LAST, {order}) AS __r FROM slice_out) WHERE __r = 1")
    return ("src", "SELECT * FROM slice_out")


def target_ctes(spec, blocked: bool = False) -> list[tuple[str, str]]:
    key = "PartId" if spec.kind == "receipts" else "NativeId"
    cols = ", ".join(
        (f"{_q(c)} + 1 AS {_q(c)}" if c == spec.amount_col else _q(c)) for c in spec.insert_cols
    )
    even = (f"SELECT {cols}, CAST(NULL AS TIMESTAMP) AS {STAMP}, CAST(NULL AS INTEGER) AS {FLAG} "
            f"FROM slice_out WHERE {key} % 2 = 0")
    if spec.seed_fact:
        others = (f"SELECT {SEED_COLS[spec.seed_fact]}, CAST(NULL AS TIMESTAMP) AS {STAMP}, "
                  f"CAST(NULL AS INTEGER) AS {FLAG} FROM {spec.seed_fact} WHERE DivisionId <> {SPLIT_DIVISION}")
    else:
        others = f"SELECT * REPLACE (CAST(1 AS INTEGER) AS DivisionId) FROM tgt_even"
    out = [("tgt_even", even), ("tgt_seed", f"SELECT * FROM tgt_even UNION ALL BY NAME {others}")]
    if blocked:
        all_rows = (f"SELECT {', '.join(_q(c) for c in spec.insert_cols)}, CAST(NULL AS TIMESTAMP) AS {STAMP}, "
                    f"CAST(NULL AS INTEGER) AS {FLAG} FROM slice_out")
        out.append(("tgt_full", f"SELECT * FROM tgt_seed UNION ALL BY NAME {all_rows} UNION ALL BY NAME {all_rows}"))
    typed = ", ".join(_q(c) for c in (*spec.insert_cols, STAMP, FLAG))
    out.append(("tgt", f"SELECT {typed} FROM {'tgt_full' if blocked else 'tgt_seed'}"))
    return out


ONE_DEPARTMENT = (106,)
ALL_DEPARTMENTS = (106, 107, 108, 109, 110, 111, 112, 113, 114)
DELETED_BY = ("invoice", "receipts")


def same_key(kind: str, keys) -> str:
    """Equality of a target row ``t`` and a source row ``s``; null only equals its stand-in."""
    as_null = {"LineNumber": "0", "ReceivedDate": "TIMESTAMP '1990-01-01 00:00:00'"} if kind == "receipts" else {}
    one = lambda a, k: f"COALESCE({a}.{_q(k)}, {as_null[k]})" if k in as_null else f"{a}.{_q(k)}"
    return " AND ".join(f"{one('t', k)} = {one('s', k)}" for k in keys)


def loaded_ctes(spec, departments=ONE_DEPARTMENT, as_written: bool = False) -> list[tuple[str, str]]:
    """What a load leaves, as four sets: deleted, updated, inserted and untouched rows."""
    among = f"DPT_AUTO_KEY IN ({', '.join(map(str, departments))})"
    gone = f"COALESCE({among} AND DivisionId IN (1, 12), FALSE)" if spec.kind in DELETED_BY else "FALSE"
    eligible = "t.DivisionId = 12"
    if spec.kind == "receipts":
        eligible = "TRUE"
    elif as_written:
        eligible = {"inventory": f"t.{among}", "purchase_order": "FALSE"}[spec.kind]
    same = f"{eligible} AND {same_key(spec.kind, spec.keys)}"
    columns = (*spec.insert_cols, STAMP, FLAG)
    own = spec.insert_cols if spec.kind == "receipts" else spec.update_cols
    stamped = {STAMP: RUN_TS} if spec.kind != "receipts" else {}
    pick = lambda c: stamped.get(c) or (f"s.{_q(c)}" if c in own else f"t.{_q(c)}")
    updated = ", ".join(f"{pick(c)} AS {_q(c)}" for c in columns)
    new = ", ".join(f"s.{_q(c)}" if c in spec.insert_cols else f"NULL AS {_q(c)}" for c in columns)
    old = ", ".join(f"t.{_q(c)}" for c in columns)
    source = "SELECT * FROM src"
    if spec.kind == "receipts":
        source = f"SELECT * REPLACE ({RUN_TS} AS ETLImportDate) FROM src"
    return [
        ("incoming", source),
        ("gone", f"SELECT * FROM tgt WHERE {gone}"),
        ("staying", f"SELECT * FROM tgt WHERE NOT {gone}"),
        ("was_updated", f"SELECT {updated}, 'UPDATE' AS MergeAction FROM staying t, incoming s WHERE {same}"),
        ("was_inserted", f"SELECT {new}, 'INSERT' AS MergeAction FROM incoming s WHERE NOT EXISTS "
                         f"(SELECT 1 FROM staying t WHERE {same})"),
        ("was_kept", f"SELECT {old}, 'KEEP' AS MergeAction FROM staying t WHERE NOT EXISTS "
                     f"(SELECT 1 FROM incoming s WHERE {same})"),
    ]


def _before(spec, blocked: bool = False) -> list[tuple[str, str]]:
    return slice_ctes(spec.slice_job) + [source_cte(spec)] + target_ctes(spec, blocked)


def load_sql(kind: str, departments=ONE_DEPARTMENT, as_written: bool = False) -> str:
    spec = SPECS[kind]
    after = "SELECT * FROM was_updated UNION ALL BY NAME SELECT * FROM was_inserted UNION ALL BY NAME SELECT * FROM was_kept"
    return with_fixtures(_before(spec) + loaded_ctes(spec, departments, as_written), after)


def load_changes_sql(kind: str) -> str:
    """Deleted, updated and inserted rows as they were and as they are."""
    spec = SPECS[kind]
    columns = (*spec.insert_cols, STAMP, FLAG)
    sets = loaded_ctes(spec)
    was = ", ".join(f"t.{_q(c)} AS {_q('Before_' + c)}" for c in columns)
    now = lambda a: ", ".join(f"{a}.{_q(c)} AS {_q('After_' + c)}" for c in columns)
    # the updated rows' new values, with the old ones beside them
    update = dict(sets)["was_updated"].replace("SELECT ", f"SELECT {was}, ", 1)
    feed = (
        f"SELECT {was}, 'DELETE' AS MergeAction FROM gone t UNION ALL BY NAME "
        f"SELECT {', '.join(_q('Before_' + c) for c in columns)}, {now('u')}, MergeAction FROM both_sides u "
        f"UNION ALL BY NAME SELECT {now('i')}, 'INSERT' AS MergeAction FROM was_inserted i"
    )
    return with_fixtures(_before(spec) + [*sets, ("both_sides", update)], feed)


_COUNTED = (
    "SELECT r AS RowsRead, i AS RowsWritten, r - i AS RowsUpdated, d AS RowsDeleted, CAST(0 AS BIGINT) AS RowsByPassed "
    "FROM (SELECT (SELECT COUNT(*) FROM src) AS r, (SELECT COUNT(*) FROM was_inserted) AS i, "
    "(SELECT COUNT(*) FROM gone) AS d)"
)


def load_counts_sql(kind: str) -> str:
    spec = SPECS[kind]
    return with_fixtures(_before(spec) + loaded_ctes(spec), _COUNTED)


def _log_head(kind: str) -> str:
    spec = SPECS[kind]
    return (f"SELECT 'Split Refresh' AS SystemName, 100 AS SystemNameRank, 'load_{kind}' AS ProcessName, "
            f"{sql_str(spec.slice_job)} AS SourceName, {sql_str(spec.target_name)} AS TargetName, "
            "'UNDEFINED' AS UniqueRunID, 'UNDEFINED' AS ParentPipelineID, 'UNDEFINED' AS PipelineID, ")


_COUNT_NAMES = ("RowsRead", "RowsWritten", "RowsUpdated", "RowsDeleted", "RowsByPassed")


def _log_row(kind: str, status: str, counts: str | None, message: str = "NULL", error: str = "NULL", relation: str = "") -> str:
    numbers = ", ".join(f"CAST({counts if counts is not None else c} AS BIGINT) AS {c}" for c in _COUNT_NAMES)
    return (f"{_log_head(kind)}'{status}' AS Status, {numbers}, CAST({message} AS VARCHAR) AS Message, "
            f"CAST({error} AS VARCHAR) AS ErrorDescription{relation}")


def run_log_sql() -> str:
    inner = load_counts_sql("sales_order")
    start = _log_row("sales_order", "RUNNING", "NULL")
    end = _log_row("sales_order", "PASS", None, "'Success'", relation=f" FROM ({inner})")
    return f"({start}) UNION ALL ({end})"


def run_log_failed_sql() -> str:
    """Every source row of the spoiled run comes twice, so the load must fail; it fails exactly
    if the source has a row at all."""
    spec = SPECS["inventory"]
    some = with_fixtures(slice_ctes(spec.slice_job), "SELECT 1 FROM slice_out LIMIT 1")
    error = "'merge source: a target row would be matched by more than one source row'"
    return (f"({_log_row('inventory', 'RUNNING', 'NULL')}) UNION ALL "
            f"({_log_row('inventory', 'FAIL', '0', error=error, relation=f' FROM ({some})')})")


def guard_blocked_sql() -> str:
    spec = SPECS["receipts"]
    final = ("SELECT s AS SourceRows, t AS TargetRows, n AS TargetRowsAfter, s AS RowsRead, CAST(0 AS BIGINT) AS RowsWritten, "
             "CAST(0 AS BIGINT) AS RowsUpdated, CAST(0 AS BIGINT) AS RowsDeleted, s AS RowsByPassed, 'PASS' AS Status, "
             "'Not enough staged records' AS Message FROM (SELECT (SELECT COUNT(*) FROM src) AS s, "
             "(SELECT COUNT(*) FROM tgt WHERE DivisionId = 12) AS t, (SELECT COUNT(*) FROM tgt) AS n) WHERE s <= 0.8 * t")
    return with_fixtures(_before(spec, blocked=True), final)


RECLASS_SEEDS = {"sales_order": "f_sales_order", "invoice": "f_invoice", "inventory": "f_inventory",
                 "purchase_order": "f_purchase_order"}
RECLASS_SLICES = {"receipts": "receipt_slice_split", "quote": "quote_slice_split",
                  "shipment": "shipment_slice_split"}


def _reclassified(kind: str) -> list[tuple[str, str]]:
    """``fact``: the rows before; ``after``: with the new division and flag, and whether they moved."""
    if kind in RECLASS_SEEDS:
        ctes = entity_ctes()
        base = f"SELECT *, CAST(NULL AS INTEGER) AS {FLAG} FROM {RECLASS_SEEDS[kind]}"
    else:
        ctes = slice_ctes(RECLASS_SLICES[kind])
        base = f"SELECT * REPLACE (CAST(1 AS INTEGER) AS DivisionId), CAST(NULL AS INTEGER) AS {FLAG} FROM slice_out"
    unit = "SELECT DPT_AUTO_KEY FROM ent1 WHERE DEPT_Definition = 'Split Unit'"
    moves = f"COALESCE(DivisionId = 1 AND DPT_AUTO_KEY IN ({unit}), FALSE)"
    after = (f"SELECT * REPLACE (CASE WHEN moves THEN 12 ELSE DivisionId END AS DivisionId, "
             f"CASE WHEN moves THEN 1 ELSE {FLAG} END AS {FLAG}) FROM (SELECT *, {moves} AS moves FROM fact)")
    return [*ctes, ("fact", base), ("after", after)]


def reclassify_sql(kind: str) -> str:
    return with_fixtures(_reclassified(kind), "SELECT * EXCLUDE (moves) FROM after")


def reclassify_counts_sql(kind: str) -> str:
    final = ("SELECT DivisionId, COUNT(*) AS RowsAfter, CAST(SUM(COALESCE(IsSplit, 0)) AS BIGINT) AS SplitRows, "
             "(SELECT COUNT(*) FROM fact WHERE DivisionId IN (1, 12)) AS RowsRead, CAST(0 AS BIGINT) AS RowsWritten, "
             "(SELECT COUNT(*) FROM after WHERE moves) AS RowsUpdated, CAST(0 AS BIGINT) AS RowsDeleted, "
             "(SELECT COUNT(*) FROM fact WHERE DivisionId IN (1, 12)) - (SELECT COUNT(*) FROM after WHERE moves) AS RowsByPassed "
             "FROM after GROUP BY DivisionId")
    return with_fixtures(_reclassified(kind), final)
