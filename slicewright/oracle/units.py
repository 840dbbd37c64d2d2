"""Oracle: operator-level jobs (one operator each, whole input tables)."""

from __future__ import annotations

from slicewright.config import EntityConfig
from slicewright.oracle.common import (
    address,
    date_floor,
    date_key,
    dim1,
    entity_ctes,
    first_by,
    fixture_columns,
    letter_flag,
    long_term_flag,
    money,
    money_div,
    money_mul,
    part1,
    part_by_id,
    with_fixtures,
)
from slicewright.oracle.purchasing import region_sql
from slicewright.oracle.slices import RUN_TS

SO = "so.SOH_AUTO_KEY, so.SOD_AUTO_KEY"


def _q(c: str) -> str:
    return f'"{c}"'


def _tb(table: str, exclude: set[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(f"{p}{_q(c)} ASC NULLS FIRST" for c in fixture_columns(table) if c not in exclude)


POS = ("pos", "SELECT PartAutoKey, UnitCost AS PoUnitCost FROM (SELECT prt.NativeId AS PartAutoKey, po.UnitCost, "
              "ROW_NUMBER() OVER (PARTITION BY prt.NativeId ORDER BY po.PODate DESC NULLS LAST, po.UnitCost DESC NULLS LAST) AS RN "
              "FROM f_purchase_order po LEFT JOIN pt_by_id prt ON prt.PartId = po.PartId WHERE po.DivisionId = 1) "
              "WHERE RN = 1 AND PartAutoKey IS NOT NULL")


def receipt_totals_ctes() -> list[tuple[str, str]]:
    by_factor = "pod.UOM_AUTO_KEY = 4 AND pod.FACTOR <> 0"
    unit_cost = f"CASE WHEN {by_factor} THEN {money_div('pod.UNIT_COST', 'pod.FACTOR')} ELSE {money('pod.UNIT_COST')} END"
    qty = (f"CASE WHEN st.QTY_REC >= 290000 AND pod.FACTOR <> 1 THEN {money_div('st.QTY_REC', 'pod.FACTOR', 6)} "
           "ELSE st.QTY_REC END")
    value = (f"CASE WHEN {by_factor} THEN {money_div('st.QTY_REC * pod.UNIT_COST', 'pod.FACTOR', 6, a_scale=8)} "
             "ELSE st.QTY_REC * pod.UNIT_COST END")
    return [
        dim1("ven", "d_vendor", "VendorId"),
        dim1("ptd", "d_part", "PartId"),
        ("totals", f"""SELECT COALESCE(ven.v, -1) AS VendorId, COALESCE(ptd.v, -1) AS PartId,
 substring(CAST(pod.PO_NUMBER AS VARCHAR), 1, 30) AS PONumber, rc.ITEM_NUMBER AS LineNumber,
 CAST(CAST(SUM(CAST({qty} AS DECIMAL(38,8))) AS VARCHAR) AS DOUBLE) AS QuantityReceived, 'U' AS Complete,
 st.REC_DATE AS ReceivedDate, {unit_cost} AS UnitCost,
 CAST(CAST(SUM(CAST({value} AS DECIMAL(38,8))) AS VARCHAR) AS DOUBLE) AS CalculatedValue,
 {RUN_TS} AS ETLImportDate, pod.DPT_AUTO_KEY
FROM stg_rc_detail rc JOIN stg_rc_header rh ON rc.RCH_AUTO_KEY = rh.RCH_AUTO_KEY
JOIN stg_stock st ON rc.RCD_AUTO_KEY = st.RCD_AUTO_KEY JOIN stg_po_detail pod ON rc.POD_AUTO_KEY = pod.POD_AUTO_KEY
JOIN stg_parts_master pm ON st.PNM_AUTO_KEY = pm.PNM_AUTO_KEY JOIN stg_sys_companies sc ON rh.SYSCM_AUTO_KEY = sc.SYSCM_AUTO_KEY
LEFT JOIN stg_companies co ON rh.CMP_AUTO_KEY = co.CMP_AUTO_KEY LEFT JOIN ven ON co.CMP_AUTO_KEY = ven.k
LEFT JOIN ptd ON st.PNM_AUTO_KEY = ptd.k
WHERE pod.PO_NUMBER IS NOT NULL AND pod.UNIT_COST <> 0
GROUP BY ven.v, ptd.v, pod.PO_NUMBER, rc.ITEM_NUMBER, st.REC_DATE, {unit_cost}, pod.DPT_AUTO_KEY, rh.SYSCM_AUTO_KEY"""),
    ]


def _simple(final: str, ctes: list[tuple[str, str]] | None = None) -> str:
    return with_fixtures(ctes or [], final)


def _respelled(table: str) -> tuple[str, str]:
    text, key = {
        "stg_sys_companies": ("company_name", "SYSCM_AUTO_KEY"), "stg_division": ("division_name", "DIV_AUTO_KEY"),
        "stg_warehouse": ("warehouse_code", "WHS_AUTO_KEY"), "stg_stock": ("IC_UDF_005", "STM_AUTO_KEY"),
        "d_manufacturer": ("ManufacturerName", "ManufacturerId"),
    }[table]
    return (f"r_{table}", f"SELECT * REPLACE (CASE WHEN {key} % 2 = 0 THEN upper({text}) || '  ' ELSE lower({text}) END "
                          f"AS {text}) FROM {table}")


def caseless_entity_sql() -> str:
    """The classification with names folded to lower case without trailing blanks."""
    cfg = EntityConfig()
    rules = []
    for i, r in enumerate(cfg.rules):
        conditions = [f"d.DPT_AUTO_KEY IN ({', '.join(map(str, r.dept_keys))})"] if r.dept_keys else []
        conditions += [f"lower(rtrim(c.company_name)) = lower('{r.company}')"] if r.company else []
        conditions += [f"lower(rtrim(v.division_name)) = lower('{r.division}')"] if r.division else []
        rules.append(f"WHEN {' AND '.join(conditions)} THEN {i}")
    labels = " ".join(f"WHEN {i} THEN '{r.label}'" for i, r in enumerate(cfg.rules))
    numbers = " ".join(f"WHEN lower(rtrim(DEPT_Definition)) = lower('{r.label}') THEN {r.division_id}" for r in cfg.rules)
    fallback = f"WHEN lower(rtrim(company_name)) = lower('{cfg.fallback_company}') THEN 1"
    return _simple(
        f"SELECT *, CAST(CASE {numbers} {fallback} END AS INTEGER) AS DivisionId FROM (SELECT dept_name, division_name, "
        f"company_name, DPT_AUTO_KEY, CASE rule {labels} ELSE company_name END AS DEPT_Definition FROM (SELECT d.dept_name, "
        f"v.division_name, c.company_name, d.DPT_AUTO_KEY, CASE {' '.join(rules)} END AS rule FROM stg_department d "
        "JOIN r_stg_division v ON v.DIV_AUTO_KEY = d.DIV_AUTO_KEY JOIN r_stg_sys_companies c "
        "ON c.SYSCM_AUTO_KEY = d.SYSCM_AUTO_KEY))", [_respelled("stg_division"), _respelled("stg_sys_companies")])


def caseless_region_sql() -> str:
    code = "lower(rtrim(w.warehouse_code))"
    return _simple(
        f"SELECT po.POH_AUTO_KEY, po.POD_AUTO_KEY, w.warehouse_code, CASE WHEN {code} LIKE '%us%' OR {code} LIKE '%coe%' THEN 'US' "
        f"WHEN {code} LIKE '%uk%' THEN 'UK' WHEN {code} LIKE '%cn%' OR {code} IN ('shanghai', 'xaic c919', 'xian lta') THEN 'China' "
        f"WHEN {code} LIKE '%de%' OR {code} = 'germany' THEN 'Bremen' WHEN {code} LIKE '%vmi%' THEN 'VMI' "
        f"WHEN {code} LIKE '%pdq%' THEN 'PDQ' ELSE w.warehouse_code END AS warehouse FROM stg_po_detail po "
        "LEFT JOIN r_stg_warehouse w ON w.WHS_AUTO_KEY = po.WHS_AUTO_KEY", [_respelled("stg_warehouse")])


def caseless_maker_sql() -> str:
    return _simple(
        "SELECT st.STM_AUTO_KEY, st.IC_UDF_005, COALESCE((SELECT MIN(m.ManufacturerId) FROM r_d_manufacturer m "
        "WHERE m.DivisionId = 1 AND lower(rtrim(m.ManufacturerName)) = lower(rtrim(st.IC_UDF_005))), -1) AS ManufacturerId "
        "FROM r_stg_stock st", [_respelled("stg_stock"), _respelled("d_manufacturer")])


def age_days_sql() -> str:
    held = ("FROM d_age a WHERE date_diff('day', CAST(st.REC_DATE AS DATE), CAST(" + RUN_TS + " AS DATE)) "
            "BETWEEN CAST(a.MinMonth AS BIGINT) * 30 AND CAST(a.MaxMonth AS BIGINT) * 30 + 45")
    return _simple(f"SELECT st.STM_AUTO_KEY, st.REC_DATE, COALESCE((SELECT MIN(a.AgeId) {held}), -1) AS AgeId, "
                   f"(SELECT COUNT(*) {held}) AS Bands FROM stg_stock st")


def quote_stock_sql() -> str:
    return _simple(
        "SELECT q.CQH_AUTO_KEY, q.CQD_AUTO_KEY, q.PNM_AUTO_KEY, CASE WHEN q.PNM_AUTO_KEY IN (SELECT NativeId FROM d_part "
        "WHERE DivisionId = 1) AND q.PNM_AUTO_KEY IN (SELECT pt.NativeId FROM f_inventory i JOIN pt_by_id pt ON pt.PartId = i.PartId "
        "WHERE i.DivisionId = 1 AND pt.NativeId IS NOT NULL GROUP BY pt.NativeId HAVING SUM(i.QtyOnHand) > 0) THEN 1 ELSE 0 END AS HasQOH "
        "FROM stg_cq_detail q", [part_by_id()])


def address_tables_sql() -> str:
    """Country by kind of test address, then the country's pattern over lines 4, 5, 3 and 2."""
    spelled = "upper(trim(so.BILL_ADDRESS5))"
    text = "concat_ws('|', so.line4, so.BILL_ADDRESS5, so.BILL_ADDRESS3, so.BILL_ADDRESS2)"
    code = lambda p: f"NULLIF(regexp_extract(upper({text}), '(^|[ ,|])({p})($|[ ,|])', 2), '')"
    return _simple(
        f"SELECT SOH_AUTO_KEY, SOD_AUTO_KEY, country AS BillingCountry, CASE country "
        f"WHEN 'UNITED KINGDOM' THEN {code('[A-Z]{1,2}[0-9][A-Z0-9]? [0-9][A-Z]{2}')} "
        f"WHEN 'CANADA' THEN {code('[A-Z][0-9][A-Z] [0-9][A-Z][0-9]')} WHEN 'CHINA' THEN {code('[0-9]{6}')} "
        f"ELSE {code('[0-9]{5}(?:-[0-9]{4})?')} END AS BillingZipCode FROM (SELECT *, CASE SOH_AUTO_KEY % 5 "
        "WHEN 1 THEN 'UNITED KINGDOM' WHEN 2 THEN 'CANADA' WHEN 3 THEN 'CHINA' WHEN 4 THEN 'UNITED STATES' "
        f"ELSE CASE WHEN {spelled} <> '' AND NOT regexp_matches({spelled}, '[0-9]') THEN {spelled} END END AS country, CASE SOH_AUTO_KEY % 5 WHEN 1 THEN 'London, sw1a ' || d || 'aa' "
        "WHEN 2 THEN 'TORONTO M' || d || 'V ' || d || 'T' || d WHEN 3 THEN 'Beijing 1000' || d || d "
        "WHEN 4 THEN 'Troy NY 12180-123' || d ELSE BILL_ADDRESS4 END AS line4 "
        "FROM (SELECT *, CAST(SOD_AUTO_KEY % 10 AS VARCHAR) AS d FROM stg_so_detail) so) so")


FURTHER = {
    "billing_address_by_tables": address_tables_sql,
    "entity_dim_caseless": caseless_entity_sql,
    "warehouse_region_label_caseless": caseless_region_sql,
    "manufacturer_by_name_caseless": caseless_maker_sql,
    "age_band_by_days": age_days_sql,
    "has_stock_by_quote": quote_stock_sql,
}


def unit_sql(key: str) -> str:  # noqa: C901 - one branch per operator
    if key in FURTHER:
        return FURTHER[key]()
    cfg = EntityConfig()
    if key == "date_floor":
        return _simple(f"SELECT {SO}, so.ENTRY_DATE, {date_floor('so.ENTRY_DATE')} AS OrderDate FROM stg_so_detail so")
    if key == "date_key":
        return _simple(f"SELECT {SO}, {date_key(date_floor('so.ENTRY_DATE'))} AS OrderDateId, "
                       f"{date_key(date_floor('so.SHIP_DATE'))} AS ShipDateId, {date_key('so.ENTRY_DATE')} AS RawDateId "
                       "FROM stg_so_detail so")
    if key == "letter_flag":
        return _simple(f"SELECT POH_AUTO_KEY, POD_AUTO_KEY, {letter_flag('OPEN_FLAG')} AS IsOpen, "
                       f"{letter_flag('RESALE_FLAG')} AS IsResale, {letter_flag('DROP_SHIP')} AS IsDropShip FROM stg_po_detail")
    if key == "open_flag":
        return _simple(f"SELECT {SO}, COALESCE(so.OPEN_FLAG = 'T' AND so.QTY_ORDERED - so.QTY_DELIVERED > 0, FALSE) "
                       "AS IsOpen FROM stg_so_detail so")
    if key == "long_term_flag":
        return _simple(f"SELECT {SO}, so.SO_NUMBER, {long_term_flag('so.SO_NUMBER')} AS IsLTA FROM stg_so_detail so")
    if key == "null_default":
        return _simple("SELECT STM_AUTO_KEY, COALESCE(PART_CERT_NUMBER, 'N/A') AS CertNumber, "
                       "COALESCE(REVISION, 'N/A') AS Revision FROM stg_stock")
    if key == "money_cast":
        return _simple(f"SELECT INH_AUTO_KEY, IND_AUTO_KEY, {money('UNIT_COST')} AS UnitCost, {money('UNIT_PRICE')} AS UnitPrice, "
                       "CAST(QTY_SHIP AS DOUBLE) AS QtyShipped FROM stg_invc_detail")
    if key == "fixed_width_cast":
        return _simple("SELECT CAST(SMH_AUTO_KEY AS INTEGER) AS NativeId, substring(SM_NUMBER, 1, 75) AS ShipmentNumber, "
                       "substring(TRACKING_NUMBER, 1, 100) AS TrackingNumber, substring(PACKER_NAME, 1, 50) AS PackerName, "
                       "substring(SM_UDF_002, 1, 10) AS WarehouseLocation, CAST(SHIP_PRIORITY AS INTEGER) AS ShipmentPriority "
                       "FROM stg_sm_header")
    if key == "safe_date":
        return _simple("SELECT POH_AUTO_KEY, POD_AUTO_KEY, COMMIT_SHIP_DATE2, TRY_CAST(COMMIT_SHIP_DATE2 AS DATE) AS ETADate "
                       "FROM stg_po_detail")
    if key == "extended_amounts":
        return _simple(f"SELECT STM_AUTO_KEY, {money_mul('UNIT_COST', 'QTY_OH')} AS CurrentCost, "
                       f"{money_mul('UNIT_PRICE', 'QTY_OH')} AS CurrentValue, {money_mul('UNIT_COST', 'QTY_REC')} AS OriginalCost, "
                       f"{money_mul('UNIT_PRICE', 'QTY_REC')} AS OriginalValue FROM stg_stock")
    if key == "open_quantity":
        return _simple("SELECT POH_AUTO_KEY, POD_AUTO_KEY, CAST(QTY_ORDERED * FACTOR - QTY_REC AS DOUBLE) AS QtyOpen FROM stg_po_detail")
    if key == "uom_unit_cost":
        q = money_div("UNIT_COST", "FACTOR")
        return _simple(f"SELECT POH_AUTO_KEY, POD_AUTO_KEY, {q} AS POUnitCost, CASE WHEN UOM_AUTO_KEY = 4 AND FACTOR <> 0 "
                       f"THEN {q} ELSE {money('UNIT_COST')} END AS ReceiptUnitCost FROM stg_po_detail")
    if key == "warehouse_region_label":
        return _simple(f"SELECT po.POH_AUTO_KEY, po.POD_AUTO_KEY, wh.warehouse_code, {region_sql('wh.warehouse_code')} AS warehouse "
                       "FROM stg_po_detail po LEFT JOIN (SELECT WHS_AUTO_KEY, MIN(warehouse_code) AS warehouse_code "
                       "FROM stg_warehouse GROUP BY WHS_AUTO_KEY) wh ON po.WHS_AUTO_KEY = wh.WHS_AUTO_KEY")
    if key == "billing_address":
        c, z = address("so.BILL_ADDRESS2", "so.BILL_ADDRESS3", "so.BILL_ADDRESS4", "so.BILL_ADDRESS5")
        return _simple(f"SELECT {SO}, {c} AS BillingCountry, {z} AS BillingZipCode FROM stg_so_detail so")
    if key == "qty_outlier_fix":
        return _simple(f"SELECT rc.RCD_AUTO_KEY, rc.POD_AUTO_KEY, st.QTY_REC, po.FACTOR, CAST(CASE WHEN st.QTY_REC >= 290000 "
                       f"AND po.FACTOR <> 1 THEN {money_div('st.QTY_REC', 'po.FACTOR', 6)} ELSE st.QTY_REC END AS DECIMAL(38,6)) "
                       "AS QtyRepaired FROM stg_rc_detail rc JOIN stg_stock st ON rc.RCD_AUTO_KEY = st.RCD_AUTO_KEY "
                       "JOIN stg_po_detail po ON rc.POD_AUTO_KEY = po.POD_AUTO_KEY")
    if key == "surrogate_key_lookup":
        return _simple(f"SELECT {SO}, so.CMP_AUTO_KEY, so.SYSUR_AUTO_KEY, so.WHS_AUTO_KEY, COALESCE(cus.v, -1) AS CustomerId, "
                       "COALESCE(emp.v, -1) AS EmployeeId, COALESCE(whs.v, -1) AS WarehouseId FROM stg_so_detail so "
                       "LEFT JOIN cus ON so.CMP_AUTO_KEY = cus.k LEFT JOIN emp ON so.SYSUR_AUTO_KEY = emp.k "
                       "LEFT JOIN whs ON so.WHS_AUTO_KEY = whs.k",
                       [dim1("cus", "d_customer", "CustomerId"), dim1("emp", "d_employee", "EmployeeId"),
                        dim1("whs", "d_warehouse", "WarehouseId")])
    if key == "route_lookup":
        return _simple(f"SELECT {SO}, so.ROUTE_CODE, COALESCE(rte.v, -1) AS RouteId FROM stg_so_detail so "
                       "LEFT JOIN rte ON so.ROUTE_CODE = rte.k",
                       [dim1("rte", "d_route", "RouteId", key="RouteCode", where="Source = 'Sales'")])
    if key == "rep_line_over_header":
        return _simple(f"SELECT {SO}, so.SPN_AUTO_KEY_LINE, so.SPN_AUTO_KEY, COALESCE(srp.v, -1) AS SalesRepId "
                       "FROM stg_so_detail so LEFT JOIN srp ON COALESCE(so.SPN_AUTO_KEY_LINE, so.SPN_AUTO_KEY) = srp.k",
                       [dim1("srp", "d_sales_rep", "SalesRepId")])
    if key == "alternate_part_lookup":
        return _simple(f"SELECT {SO}, so.PNM_AUTO_KEY, so.ALT_PNM_AUTO_KEY, COALESCE(pt.v, -1) AS PartId, "
                       "COALESCE(pta.v, -1) AS AltPartId FROM stg_so_detail so LEFT JOIN pt ON so.PNM_AUTO_KEY = pt.k "
                       "LEFT JOIN pt pta ON so.ALT_PNM_AUTO_KEY = pta.k", [dim1("pt", "d_part", "PartId")])
    if key == "staging_lookup":
        return _simple(f"SELECT {SO}, so.CTH_AUTO_KEY, ch.CONTRACT_NUMBER FROM stg_so_detail so LEFT JOIN "
                       "(SELECT CTH_AUTO_KEY, MIN(CONTRACT_NUMBER) AS CONTRACT_NUMBER FROM stg_contract_header "
                       "GROUP BY CTH_AUTO_KEY) ch ON so.CTH_AUTO_KEY = ch.CTH_AUTO_KEY")
    if key == "entity_lookup":
        return _simple("SELECT i.INH_AUTO_KEY, i.IND_AUTO_KEY, i.DPT_AUTO_KEY, ae.DivisionId, ae.DEPT_Definition "
                       "FROM stg_invc_detail i LEFT JOIN ent1 ae ON i.DPT_AUTO_KEY = ae.DPT_AUTO_KEY", entity_ctes())
    if key == "invoice_long_term_flag":
        return _simple("SELECT i.INH_AUTO_KEY, i.IND_AUTO_KEY, i.SOD_AUTO_KEY, so.IsLTA FROM stg_invc_detail i LEFT JOIN "
                       "(SELECT NativeLineId, MAX(IsLTA) AS IsLTA FROM f_sales_order WHERE DivisionId = 1 GROUP BY NativeLineId) so "
                       "ON so.NativeLineId = i.SOD_AUTO_KEY")
    if key == "reverse_part_lookup":
        return _simple("SELECT po.NativeLineId, po.PartId, prt.NativeId AS PartAutoKey, prt.PartNumber FROM f_purchase_order po "
                       "LEFT JOIN pt_by_id prt ON prt.PartId = po.PartId", [part_by_id()])
    if key == "manufacturer_by_name":
        return _simple("SELECT st.STM_AUTO_KEY, st.IC_UDF_005, COALESCE(mfg.v, -1) AS ManufacturerId FROM stg_stock st "
                       "LEFT JOIN mfg ON rtrim(st.IC_UDF_005) = mfg.k",
                       [dim1("mfg", "d_manufacturer", "ManufacturerId", key="rtrim(ManufacturerName)")])
    if key == "age_band":
        m = f"((year({RUN_TS}) * 12 + month({RUN_TS})) - (year(st.REC_DATE) * 12 + month(st.REC_DATE)))"
        return _simple(f"SELECT st.STM_AUTO_KEY, st.REC_DATE, COALESCE((SELECT MIN(a.AgeId) FROM d_age a WHERE {m} "
                       "BETWEEN a.MinMonth AND a.MaxMonth), -1) AS AgeId FROM stg_stock st")
    if key == "prev_month_class":
        ctes = [part_by_id(), part1(),
                ("pc_all", "SELECT ih.AsOfDate, pt.PartNumber, ih.DivisionId, ih.ProductClass FROM f_inventory_history ih "
                           "LEFT JOIN pt_by_id pt ON pt.PartId = ih.PartId GROUP BY ALL"),
                ("pc", first_by("(SELECT * FROM pc_all WHERE DivisionId = 1)",
                                "PartNumber, year(AsOfDate) * 12 + month(AsOfDate)",
                                "AsOfDate DESC NULLS LAST, ProductClass DESC NULLS LAST"))]
        prev = "CAST(CAST(so.SHIP_DATE AS DATE) - INTERVAL 1 MONTH AS DATE)"
        return _simple(f"SELECT {SO}, pt.PartNumber, so.SHIP_DATE, COALESCE(pc.ProductClass, 'Z') AS ProductClass "
                       f"FROM stg_so_detail so LEFT JOIN part1 pt ON so.PNM_AUTO_KEY = pt.k LEFT JOIN pc ON "
                       f"pt.PartNumber = pc.PartNumber AND month({prev}) = month(pc.AsOfDate) AND year({prev}) = year(pc.AsOfDate)",
                       ctes)
    if key == "latest_po_cost":
        return _simple("SELECT PartAutoKey, PoUnitCost FROM pos", [part_by_id(), POS])
    if key == "cost_fallback":
        cost = f"COALESCE(NULLIF({money('so.UNIT_COST')}, 0), pos.PoUnitCost)"
        return _simple(f"SELECT {SO}, {cost} AS UnitCost, {money_mul(cost, 'so.QTY_ORDERED')} AS LineCost FROM stg_so_detail so "
                       "LEFT JOIN pos ON pos.PartAutoKey = so.PNM_AUTO_KEY", [part_by_id(), POS])
    if key == "tax_per_line":
        return _simple(f"SELECT i.INH_AUTO_KEY, i.IND_AUTO_KEY, t.Lines, {money_div('i.TAX_AMOUNT', 't.Lines')} AS TaxAmount "
                       "FROM stg_invc_detail i LEFT JOIN (SELECT INVC_NUMBER, COUNT(*) AS Lines FROM stg_invc_detail "
                       "GROUP BY INVC_NUMBER) t ON t.INVC_NUMBER = i.INVC_NUMBER")
    if key == "has_stock_flag":
        return _simple("SELECT pt.NativeId FROM f_inventory i LEFT JOIN pt_by_id pt ON pt.PartId = i.PartId "
                       "WHERE i.DivisionId = 1 GROUP BY pt.NativeId HAVING SUM(QtyOnHand) > 0", [part_by_id()])
    if key == "invoice_rollup":
        return _simple("SELECT NativeId, DPT_AUTO_KEY, MAX(InvoiceDate) AS InvoiceDate, CAST(SUM(LinePrice) AS DECIMAL(19,4)) "
                       "AS InvoicePrice, MAX(InvoiceNumber) AS InvoiceNumber FROM f_invoice WHERE DivisionId = 1 "
                       "GROUP BY NativeId, DPT_AUTO_KEY")
    if key == "account_lookup":
        ctes = [("apc", "SELECT APA_AUTO_KEY, MIN(GLA_AUTO_KEY) AS GLA_AUTO_KEY FROM stg_ap_account GROUP BY APA_AUTO_KEY"),
                ("gl", first_by("stg_gl_account", "GLA_AUTO_KEY", "ACCOUNT_TYPE_DESC ASC NULLS LAST, DESCRIPTION ASC NULLS LAST"))]
        return _simple(first_by("(SELECT ap.POH_AUTO_KEY, gl.ACCOUNT_TYPE_DESC, gl.DESCRIPTION FROM stg_ap_detail ap "
                                "LEFT JOIN apc ON ap.APA_AUTO_KEY = apc.APA_AUTO_KEY LEFT JOIN gl ON apc.GLA_AUTO_KEY = gl.GLA_AUTO_KEY)",
                                "POH_AUTO_KEY", "ACCOUNT_TYPE_DESC ASC NULLS LAST, DESCRIPTION ASC NULLS LAST",
                                "POH_AUTO_KEY, ACCOUNT_TYPE_DESC, DESCRIPTION"), ctes)
    if key == "last_receipt_date":
        return _simple("SELECT pod.PO_NUMBER, pod.ITEM_NUMBER, MAX(rc.ENTRY_DATE) AS last_rec_date FROM stg_rc_detail rc "
                       "JOIN stg_rc_header rh ON rh.RCH_AUTO_KEY = rc.RCH_AUTO_KEY JOIN stg_po_detail pod "
                       "ON rc.POD_AUTO_KEY = pod.POD_AUTO_KEY GROUP BY pod.PO_NUMBER, pod.ITEM_NUMBER")
    if key == "existence_join":
        return _simple("SELECT SMH_AUTO_KEY, INH_AUTO_KEY FROM stg_sm_header WHERE SMH_AUTO_KEY IN "
                       "(SELECT SMH_AUTO_KEY FROM stg_sm_detail)")
    if key == "receipt_totals":
        return _simple("SELECT * FROM totals", receipt_totals_ctes())
    if key == "receipt_dedupe":
        from slicewright.plans.receipts import TIEBREAK

        order = ", ".join(f"{_q(c)} ASC NULLS FIRST" for c in TIEBREAK)
        return _simple(f"SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY VendorId, PartId, LineNumber "
                       f"ORDER BY {order}) AS INTEGER) AS rn FROM totals) WHERE rn = 1", receipt_totals_ctes())
    if key == "latest_per_line":
        tb = _tb("stg_so_detail", {"SOH_AUTO_KEY", "SOD_AUTO_KEY", "ETLImportDate"})
        return _simple("SELECT SOH_AUTO_KEY, SOD_AUTO_KEY, ETLImportDate, PNM_AUTO_KEY, QTY_ORDERED, rownum FROM "
                       "(SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY SOH_AUTO_KEY, SOD_AUTO_KEY ORDER BY "
                       f"ETLImportDate DESC NULLS LAST, {tb}) AS INTEGER) AS rownum FROM stg_so_detail) WHERE rownum = 1")
    if key == "invoice_dedupe":
        tb = _tb("stg_invc_detail", {"INH_AUTO_KEY", "IND_AUTO_KEY"}, "i")
        return _simple("SELECT INH_AUTO_KEY, IND_AUTO_KEY, DivisionId, INVC_NUMBER, PNM_AUTO_KEY, QTY_SHIP, rn FROM "
                       "(SELECT i.*, ae.DivisionId, CAST(ROW_NUMBER() OVER (PARTITION BY i.INH_AUTO_KEY, i.IND_AUTO_KEY, "
                       f"ae.DivisionId ORDER BY {tb}) AS INTEGER) AS rn FROM stg_invc_detail i LEFT JOIN ent1 ae "
                       "ON i.DPT_AUTO_KEY = ae.DPT_AUTO_KEY) WHERE rn = 1", entity_ctes())
    if key == "inventory_dedupe":
        tb = _tb("stg_stock", {"STM_AUTO_KEY"}, "s")
        return _simple("SELECT STM_AUTO_KEY, DivisionId, PNM_AUTO_KEY, QTY_REC, rn FROM (SELECT s.*, ae.DivisionId, "
                       "CAST(ROW_NUMBER() OVER (PARTITION BY s.STM_AUTO_KEY, ae.DivisionId ORDER BY "
                       f"{tb}) AS INTEGER) AS rn FROM stg_stock s LEFT JOIN ent1 ae ON s.DPT_AUTO_KEY = ae.DPT_AUTO_KEY) "
                       "WHERE rn = 1", entity_ctes())
    if key == "po_dedupe":
        tb = _tb("stg_po_detail", {"POH_AUTO_KEY", "POD_AUTO_KEY"})
        return _simple("SELECT POH_AUTO_KEY, POD_AUTO_KEY, PNM_AUTO_KEY, QTY_ORDERED, rn FROM (SELECT *, CAST(ROW_NUMBER() "
                       f"OVER (PARTITION BY POH_AUTO_KEY, POD_AUTO_KEY ORDER BY {tb}) AS INTEGER) AS rn FROM stg_po_detail) "
                       "WHERE rn = 1")
    if key == "delete_where":
        return _simple(f"SELECT * FROM f_invoice WHERE NOT COALESCE(DPT_AUTO_KEY IN "
                       f"({', '.join(map(str, cfg.split_departments))}), FALSE)")
    raise KeyError(key)
