"""Staging, dimension and seed-fact relations derived from the TPC-H-style test tables.

Each relation stands for one table the warehouse-slice jobs read (ERP staging
``stg_*``, warehouse dimensions ``d_*``, seed facts ``f_*``).  The SQL is portable:
the same text runs in Spark (to build the inputs of every registered query) and in
DuckDB (inlined as CTEs into the oracle SQL), so both engines see identical rows.
``{ts}`` stands for the zone-less timestamp literal keyword of the engine and
``{unnest}`` for its array-expanding function (``explode`` / ``unnest``).

Every relation is cast to an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Fixture:
    name: str
    columns: tuple[tuple[str, str], ...]
    sql: str


# Helper: every line item with its order, customer and nation.
LI_SQL = (
    'select l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority, o.o_orderkey, o.o_orderstatus, '
    'c.c_nationkey, c.c_name, c.c_mktsegment, n.n_name from lineitem l join orders o on '
    'l.l_orderkey=o.o_orderkey join customer c on o.o_custkey=c.c_custkey join nation n on '
    'c.c_nationkey=n.n_nationkey'
)

FIXTURES: tuple[Fixture, ...] = (
    Fixture(
        'stg_sys_companies',
        (
            ('SYSCM_AUTO_KEY', 'int'),
            ('company_name', 'string'),
        ),
        (
            "select * from (values (0,'PARENT, LLC'),(1,'PARENT, LTD'),(2,'CHINA CO'),(3,'SEVENTH CO'),(9,'UNUSED')) "
            't(SYSCM_AUTO_KEY, company_name)'
        ),
    ),
    Fixture(
        'stg_division',
        (
            ('DIV_AUTO_KEY', 'int'),
            ('division_name', 'string'),
            ('SYSCM_AUTO_KEY', 'int'),
        ),
        (
            "select r_regionkey as DIV_AUTO_KEY, case r_name when 'EUROPE' then 'EMEA' when 'ASIA' then 'APAC' "
            'else r_name end as division_name, r_regionkey % 4 as SYSCM_AUTO_KEY from region'
        ),
    ),
    Fixture(
        'stg_department',
        (
            ('DPT_AUTO_KEY', 'int'),
            ('dept_name', 'string'),
            ('DIV_AUTO_KEY', 'int'),
            ('SYSCM_AUTO_KEY', 'int'),
        ),
        (
            'select 100+n_nationkey as DPT_AUTO_KEY, n_name as dept_name, n_regionkey as DIV_AUTO_KEY, case when '
            'n_nationkey >= 20 then n_nationkey % 4 else 0 end as SYSCM_AUTO_KEY from nation'
        ),
    ),
    Fixture(
        'stg_so_status',
        (
            ('SOS_AUTO_KEY', 'string'),
            ('DESCRIPTION', 'string'),
        ),
        (
            "select * from (values ('F','FILLED'),('O','OPEN')) t(SOS_AUTO_KEY, DESCRIPTION)"
        ),
    ),
    Fixture(
        'stg_contract_header',
        (
            ('CTH_AUTO_KEY', 'bigint'),
            ('CONTRACT_NUMBER', 'string'),
        ),
        (
            "select distinct l_partkey % 50 as CTH_AUTO_KEY, concat('CT', cast(l_partkey % 50 as varchar(9))) as "
            'CONTRACT_NUMBER from lineitem where l_partkey % 50 <> 10'
        ),
    ),
    Fixture(
        'stg_so_header',
        (
            ('SOH_AUTO_KEY', 'bigint'),
            ('SO_NUMBER', 'string'),
            ('DPT_AUTO_KEY', 'int'),
            ('SYSCM_AUTO_KEY', 'int'),
            ('SOS_AUTO_KEY', 'string'),
        ),
        (
            "select o_orderkey as SOH_AUTO_KEY, concat(case when o_orderpriority like '1-%' then 'SLA' else 'SO-' "
            'end, cast(o_orderkey as varchar(20))) as SO_NUMBER, 100+c_nationkey as DPT_AUTO_KEY, c_nationkey % 4 '
            'as SYSCM_AUTO_KEY, o_orderstatus as SOS_AUTO_KEY from orders join customer on o_custkey=c_custkey'
        ),
    ),
    Fixture(
        'stg_so_detail',
        (
            ('SOH_AUTO_KEY', 'bigint'),
            ('SOD_AUTO_KEY', 'bigint'),
            ('SO_NUMBER', 'string'),
            ('ITEM_NUMBER', 'int'),
            ('CQD_AUTO_KEY', 'bigint'),
            ('CMP_AUTO_KEY', 'bigint'),
            ('SYSUR_AUTO_KEY', 'bigint'),
            ('PNM_AUTO_KEY', 'bigint'),
            ('ALT_PNM_AUTO_KEY', 'bigint'),
            ('SPN_AUTO_KEY_LINE', 'bigint'),
            ('SPN_AUTO_KEY', 'bigint'),
            ('ROUTE_CODE', 'string'),
            ('WHS_AUTO_KEY', 'bigint'),
            ('CTH_AUTO_KEY', 'bigint'),
            ('CTD_AUTO_KEY', 'bigint'),
            ('ENTRY_DATE', 'timestamp'),
            ('SHIP_DATE', 'timestamp_ntz'),
            ('DELIVERY_DATE', 'timestamp_ntz'),
            ('NEXT_SHIP_DATE', 'timestamp_ntz'),
            ('UNIT_PRICE', 'decimal(19,4)'),
            ('UNIT_COST', 'decimal(19,4)'),
            ('DISCOUNT', 'decimal(19,4)'),
            ('QTY_ORDERED', 'decimal(19,4)'),
            ('QTY_DELIVERED', 'decimal(19,4)'),
            ('QTY_INVOICED', 'decimal(19,4)'),
            ('QTY_RESERVED', 'decimal(19,4)'),
            ('EXCHANGE_RATE', 'decimal(19,4)'),
            ('OPEN_FLAG', 'string'),
            ('LAST_MODIFIED', 'timestamp_ntz'),
            ('LAST_MODIFIED_LINE', 'timestamp_ntz'),
            ('BILL_ADDRESS2', 'string'),
            ('BILL_ADDRESS3', 'string'),
            ('BILL_ADDRESS4', 'string'),
            ('BILL_ADDRESS5', 'string'),
            ('ETLImportDate', 'timestamp_ntz'),
        ),
        (
            'select l_orderkey as SOH_AUTO_KEY, l_orderkey*10+l_linenumber as SOD_AUTO_KEY, concat(case when '
            "o_orderpriority like '1-%' then 'SLA' else 'SO-' end, cast(o_orderkey as varchar(20))) as SO_NUMBER, "
            'l_linenumber as ITEM_NUMBER, l_orderkey*10+l_linenumber as CQD_AUTO_KEY, o_custkey as CMP_AUTO_KEY, '
            'l_suppkey % 7 as SYSUR_AUTO_KEY, l_partkey as PNM_AUTO_KEY, l_partkey+1 as ALT_PNM_AUTO_KEY, case '
            'when l_linenumber % 2 = 0 then l_suppkey % 11 end as SPN_AUTO_KEY_LINE, o_custkey % 11 as '
            'SPN_AUTO_KEY, l_returnflag as ROUTE_CODE, l_suppkey % 12 as WHS_AUTO_KEY, case when l_partkey % 5 = '
            '0 then l_partkey % 50 end as CTH_AUTO_KEY, l_partkey as CTD_AUTO_KEY, case when l_orderkey % 97 = 0 '
            "then {ts} '0201-03-04 00:00:00' else o_orderdate end as ENTRY_DATE, l_shipdate as SHIP_DATE, "
            "l_shipdate + interval '3' day as DELIVERY_DATE, l_shipdate + interval '10' day as NEXT_SHIP_DATE, "
            'cast(l_extendedprice as decimal(19,4)) as UNIT_PRICE, case when l_linenumber % 3 = 0 then cast(0 as '
            'decimal(19,4)) else cast(cast(l_extendedprice as decimal(19,4))*cast(0.8 as decimal(3,2)) as '
            'decimal(19,4)) end as UNIT_COST, cast(l_discount as decimal(19,4)) as DISCOUNT, cast(l_quantity as '
            "decimal(19,4)) as QTY_ORDERED, case when l_linestatus='F' then cast(l_quantity as decimal(19,4)) "
            "else cast(0 as decimal(19,4)) end as QTY_DELIVERED, case when l_returnflag='R' then cast(l_quantity "
            'as decimal(19,4)) else cast(0 as decimal(19,4)) end as QTY_INVOICED, cast(l_linenumber as '
            'decimal(19,4)) as QTY_RESERVED, cast(1 as decimal(19,4)) as EXCHANGE_RATE, case when '
            "l_linestatus='O' then 'T' else 'F' end as OPEN_FLAG, l_shipdate as LAST_MODIFIED, l_shipdate as "
            "LAST_MODIFIED_LINE, c_name as BILL_ADDRESS2, c_mktsegment as BILL_ADDRESS3, concat('ZIP ', "
            "lpad(cast(o_custkey as varchar(9)),5,'0')) as BILL_ADDRESS4, n_name as BILL_ADDRESS5, l_shipdate as "
            'ETLImportDate from li'
        ),
    ),
    Fixture(
        'stg_invc_detail',
        (
            ('INH_AUTO_KEY', 'bigint'),
            ('IND_AUTO_KEY', 'bigint'),
            ('INVC_NUMBER', 'string'),
            ('ITEM_NUMBER', 'int'),
            ('SOD_AUTO_KEY', 'bigint'),
            ('INVOICE_DATE', 'timestamp_ntz'),
            ('ORDER_DATE', 'timestamp_ntz'),
            ('SHIP_DATE', 'timestamp_ntz'),
            ('POST_DATE', 'timestamp_ntz'),
            ('POST_DESC', 'string'),
            ('INVC_TYPE', 'string'),
            ('EXCHANGE_RATE', 'decimal(19,4)'),
            ('QTY_SHIP', 'decimal(19,4)'),
            ('QTY_BACK_ORDER', 'decimal(19,4)'),
            ('UNIT_COST', 'decimal(19,4)'),
            ('UNIT_PRICE', 'decimal(19,4)'),
            ('TAX_AMOUNT', 'decimal(19,4)'),
            ('DPT_AUTO_KEY', 'int'),
            ('CMP_AUTO_KEY', 'bigint'),
            ('SYSUR_AUTO_KEY', 'bigint'),
            ('PNM_AUTO_KEY', 'bigint'),
            ('SPN_AUTO_KEY', 'bigint'),
            ('ROUTE_CODE', 'string'),
            ('BILL_ADDRESS2', 'string'),
            ('BILL_ADDRESS3', 'string'),
            ('BILL_ADDRESS4', 'string'),
            ('BILL_ADDRESS5', 'string'),
            ('ETLImportDate', 'timestamp_ntz'),
        ),
        (
            "select l_orderkey as INH_AUTO_KEY, l_orderkey*10+l_linenumber as IND_AUTO_KEY, concat('IN', "
            'cast(l_orderkey as varchar(20))) as INVC_NUMBER, l_linenumber as ITEM_NUMBER, '
            "l_orderkey*10+l_linenumber as SOD_AUTO_KEY, l_shipdate + interval '1' day as INVOICE_DATE, "
            "o_orderdate as ORDER_DATE, l_shipdate as SHIP_DATE, l_shipdate + interval '2' day as POST_DATE, case "
            "when l_linestatus='F' then 'POSTED' else 'PENDING' end as POST_DESC, l_returnflag as INVC_TYPE, "
            'cast(1 as decimal(19,4)) as EXCHANGE_RATE, cast(l_quantity as decimal(19,4)) as QTY_SHIP, cast(0 as '
            'decimal(19,4)) as QTY_BACK_ORDER, cast(cast(l_extendedprice as decimal(19,4))*cast(0.8 as '
            'decimal(3,2)) as decimal(19,4)) as UNIT_COST, cast(l_extendedprice as decimal(19,4)) as UNIT_PRICE, '
            'cast(cast(l_tax as decimal(19,4))*100 as decimal(19,4)) as TAX_AMOUNT, 100+c_nationkey as '
            'DPT_AUTO_KEY, o_custkey as CMP_AUTO_KEY, l_suppkey % 7 as SYSUR_AUTO_KEY, l_partkey as PNM_AUTO_KEY, '
            'o_custkey % 11 as SPN_AUTO_KEY, l_returnflag as ROUTE_CODE, c_name as BILL_ADDRESS2, c_mktsegment as '
            "BILL_ADDRESS3, concat('ZIP ', lpad(cast(o_custkey as varchar(9)),5,'0')) as BILL_ADDRESS4, n_name as "
            "BILL_ADDRESS5, l_shipdate as ETLImportDate from li where l_returnflag <> 'N'"
        ),
    ),
    Fixture(
        'stg_stock',
        (
            ('STM_AUTO_KEY', 'bigint'),
            ('RCD_AUTO_KEY', 'bigint'),
            ('PNM_AUTO_KEY', 'bigint'),
            ('IC_UDF_006', 'string'),
            ('IC_UDF_005', 'string'),
            ('CMP_AUTO_KEY', 'bigint'),
            ('SYSUR_AUTO_KEY', 'bigint'),
            ('WHS_AUTO_KEY', 'bigint'),
            ('WHS_ORIGINAL', 'bigint'),
            ('LOC_AUTO_KEY', 'bigint'),
            ('LOC_ORIGINAL', 'bigint'),
            ('IND_AUTO_KEY', 'bigint'),
            ('POD_AUTO_KEY', 'bigint'),
            ('ORIGINAL_PO_NUMBER', 'string'),
            ('REC_DATE', 'timestamp_ntz'),
            ('QTY_REC', 'decimal(19,4)'),
            ('QTY_OH', 'decimal(19,4)'),
            ('QTY_RESERVED', 'decimal(19,4)'),
            ('QTY_AVAILABLE', 'decimal(19,4)'),
            ('UNIT_COST', 'decimal(19,4)'),
            ('UNIT_PRICE', 'decimal(19,4)'),
            ('HISTORICAL_FLAG', 'string'),
            ('CHANGE_TIMESTAMP', 'timestamp_ntz'),
            ('DPT_AUTO_KEY', 'int'),
            ('PCC_AUTO_KEY', 'bigint'),
            ('PART_CERT_NUMBER', 'string'),
            ('REVISION', 'string'),
            ('ETLImportDate', 'timestamp_ntz'),
        ),
        (
            'select l_orderkey*10+l_linenumber as STM_AUTO_KEY, l_orderkey*10+l_linenumber as RCD_AUTO_KEY, '
            "l_partkey as PNM_AUTO_KEY, concat('LOT', cast(l_partkey as varchar(20))) as IC_UDF_006, p_brand as "
            'IC_UDF_005, l_suppkey as CMP_AUTO_KEY, l_suppkey % 7 as SYSUR_AUTO_KEY, l_suppkey % 12 as '
            'WHS_AUTO_KEY, l_suppkey % 5 as WHS_ORIGINAL, l_partkey % 20 as LOC_AUTO_KEY, l_partkey % 10 as '
            'LOC_ORIGINAL, l_orderkey*10+l_linenumber as IND_AUTO_KEY, l_orderkey*10+l_linenumber as '
            "POD_AUTO_KEY, concat('PO-', cast(l_orderkey as varchar(20))) as ORIGINAL_PO_NUMBER, l_shipdate as "
            'REC_DATE, case when l_partkey % 101 = 0 then cast(300000 as decimal(19,4)) else cast(l_quantity as '
            "decimal(19,4)) end as QTY_REC, case when l_linestatus='O' then cast(l_quantity as decimal(19,4)) "
            'else cast(0 as decimal(19,4)) end as QTY_OH, cast(0 as decimal(19,4)) as QTY_RESERVED, '
            'cast(l_quantity as decimal(19,4)) as QTY_AVAILABLE, cast(cast(l_extendedprice as '
            'decimal(19,4))*cast(0.8 as decimal(3,2)) as decimal(19,4)) as UNIT_COST, cast(l_extendedprice as '
            "decimal(19,4)) as UNIT_PRICE, case when l_returnflag='A' then 'T' when l_returnflag='R' then 'F' end "
            'as HISTORICAL_FLAG, l_shipdate as CHANGE_TIMESTAMP, 100+c_nationkey as DPT_AUTO_KEY, l_partkey % 3 '
            "as PCC_AUTO_KEY, case when l_partkey % 2 = 0 then 'CERT' end as PART_CERT_NUMBER, case when "
            "l_partkey % 3 = 0 then 'B' end as REVISION, l_shipdate as ETLImportDate from li join part on "
            'l_partkey=p_partkey'
        ),
    ),
    Fixture(
        'stg_po_detail',
        (
            ('POH_AUTO_KEY', 'bigint'),
            ('POD_AUTO_KEY', 'bigint'),
            ('PO_NUMBER', 'string'),
            ('ITEM_NUMBER', 'int'),
            ('CMP_AUTO_KEY', 'bigint'),
            ('CMP_BUYER', 'bigint'),
            ('SYSUR_AUTO_KEY', 'bigint'),
            ('WHS_AUTO_KEY', 'bigint'),
            ('PNM_AUTO_KEY', 'bigint'),
            ('ALT_PNM_AUTO_KEY', 'bigint'),
            ('ROUTE_CODE', 'string'),
            ('DPT_AUTO_KEY', 'int'),
            ('ENTRY_DATE', 'timestamp'),
            ('NEXT_DELIVERY_DATE', 'timestamp_ntz'),
            ('COMMIT_SHIP_DATE2', 'string'),
            ('QTY_BACK_ORDER', 'decimal(19,4)'),
            ('QTY_ORDERED', 'decimal(19,4)'),
            ('QTY_REC', 'decimal(19,4)'),
            ('FACTOR', 'decimal(19,4)'),
            ('UOM_AUTO_KEY', 'bigint'),
            ('UNIT_COST', 'decimal(19,4)'),
            ('VENDOR_PRICE', 'decimal(19,4)'),
            ('OPEN_FLAG', 'string'),
            ('RESALE_FLAG', 'string'),
            ('DROP_SHIP', 'string'),
            ('LAST_MODIFIED', 'timestamp_ntz'),
            ('LAST_MODIFIEDLINE', 'timestamp_ntz'),
            ('Remarks', 'string'),
            ('CNC_AUTO_KEY', 'bigint'),
            ('ETLImportDate', 'timestamp_ntz'),
        ),
        (
            'select l_orderkey as POH_AUTO_KEY, l_orderkey*10+l_linenumber as POD_AUTO_KEY, case when l_orderkey '
            "% 10 = 0 then concat(case when o_orderpriority like '1-%' then 'SLA' else 'SO-' end, cast(o_orderkey "
            "as varchar(20))) else concat('PO-', cast(l_orderkey as varchar(20))) end as PO_NUMBER, l_linenumber "
            'as ITEM_NUMBER, l_suppkey as CMP_AUTO_KEY, o_custkey as CMP_BUYER, l_suppkey % 7 as SYSUR_AUTO_KEY, '
            'l_suppkey % 12 as WHS_AUTO_KEY, l_partkey as PNM_AUTO_KEY, l_partkey+1 as ALT_PNM_AUTO_KEY, '
            'l_returnflag as ROUTE_CODE, 100+c_nationkey as DPT_AUTO_KEY, case when l_orderkey % 97 = 0 then {ts} '
            "'0201-03-04 00:00:00' else o_orderdate end as ENTRY_DATE, l_shipdate + interval '7' day as "
            "NEXT_DELIVERY_DATE, case when l_partkey % 7 = 0 then 'TBD' else '1999-05-06' end as "
            'COMMIT_SHIP_DATE2, cast(0 as decimal(19,4)) as QTY_BACK_ORDER, cast(l_quantity as decimal(19,4)) as '
            "QTY_ORDERED, case when l_linestatus='F' then cast(l_quantity as decimal(19,4)) else cast(0 as "
            'decimal(19,4)) end as QTY_REC, cast(case l_partkey % 4 when 0 then 2 when 1 then 0.5 else 1 end as '
            'decimal(19,4)) as FACTOR, 1 + l_partkey % 5 as UOM_AUTO_KEY, case when l_partkey % 23 = 0 then '
            'cast(0 as decimal(19,4)) else cast(cast(l_extendedprice as decimal(19,4))*cast(0.8 as decimal(3,2)) '
            'as decimal(19,4)) end as UNIT_COST, cast(l_extendedprice as decimal(19,4)) as VENDOR_PRICE, case '
            "when l_linestatus='O' then 'T' else 'F' end as OPEN_FLAG, case when l_returnflag='R' then 'T' end as "
            "RESALE_FLAG, case when l_returnflag='A' then 'T' else 'F' end as DROP_SHIP, l_shipdate as "
            "LAST_MODIFIED, l_shipdate as LAST_MODIFIEDLINE, 'note' as Remarks, l_partkey % 6 as CNC_AUTO_KEY, "
            'l_shipdate as ETLImportDate from li'
        ),
    ),
    Fixture(
        'stg_rc_header',
        (
            ('RCH_AUTO_KEY', 'bigint'),
            ('SYSCM_AUTO_KEY', 'int'),
            ('CMP_AUTO_KEY', 'bigint'),
        ),
        (
            'select o_orderkey as RCH_AUTO_KEY, c_nationkey % 4 as SYSCM_AUTO_KEY, o_custkey % 10 as CMP_AUTO_KEY '
            'from orders join customer on o_custkey=c_custkey'
        ),
    ),
    Fixture(
        'stg_rc_detail',
        (
            ('RCD_AUTO_KEY', 'bigint'),
            ('RCH_AUTO_KEY', 'bigint'),
            ('POD_AUTO_KEY', 'bigint'),
            ('ITEM_NUMBER', 'int'),
            ('ENTRY_DATE', 'timestamp_ntz'),
        ),
        (
            'select l_orderkey*10+l_linenumber as RCD_AUTO_KEY, l_orderkey as RCH_AUTO_KEY, '
            'l_orderkey*10+l_linenumber as POD_AUTO_KEY, l_linenumber as ITEM_NUMBER, l_shipdate as ENTRY_DATE '
            'from li'
        ),
    ),
    Fixture(
        'stg_parts_master',
        (
            ('PNM_AUTO_KEY', 'bigint'),
        ),
        (
            'select p_partkey as PNM_AUTO_KEY from part'
        ),
    ),
    Fixture(
        'stg_companies',
        (
            ('CMP_AUTO_KEY', 'bigint'),
        ),
        (
            'select s_suppkey as CMP_AUTO_KEY from supplier'
        ),
    ),
    Fixture(
        'stg_warehouse',
        (
            ('WHS_AUTO_KEY', 'int'),
            ('warehouse_code', 'string'),
        ),
        (
            "select * from (values (0,'US-EAST'),(1,'COE1'),(2,'UK-HUB'),(3,'CN-02'),(4,'SHANGHAI'),(5,'XAIC "
            "C919'),(6,'XIAN LTA'),(7,'DE-N'),(8,'Germany'),(9,'VMI-7'),(10,'PDQ'),(11,'OTHER')) t(WHS_AUTO_KEY, "
            'warehouse_code)'
        ),
    ),
    Fixture(
        'stg_ap_detail',
        (
            ('POH_AUTO_KEY', 'bigint'),
            ('APA_AUTO_KEY', 'bigint'),
        ),
        (
            'select o_orderkey as POH_AUTO_KEY, o_custkey % 4 as APA_AUTO_KEY from orders'
        ),
    ),
    Fixture(
        'stg_ap_account',
        (
            ('APA_AUTO_KEY', 'int'),
            ('GLA_AUTO_KEY', 'int'),
        ),
        (
            'select * from (values (0,10),(1,11),(2,12)) t(APA_AUTO_KEY, GLA_AUTO_KEY)'
        ),
    ),
    Fixture(
        'stg_gl_account',
        (
            ('GLA_AUTO_KEY', 'int'),
            ('ACCOUNT_TYPE_DESC', 'string'),
            ('DESCRIPTION', 'string'),
        ),
        (
            "select * from (values (10,'ASSET','Inventory'),(11,'EXPENSE','Freight')) t(GLA_AUTO_KEY, "
            'ACCOUNT_TYPE_DESC, DESCRIPTION)'
        ),
    ),
    Fixture(
        'stg_cq_detail',
        (
            ('CQH_AUTO_KEY', 'bigint'),
            ('CQD_AUTO_KEY', 'bigint'),
            ('CQ_NUMBER', 'string'),
            ('ITEM_NUMBER', 'int'),
            ('CMP_AUTO_KEY', 'bigint'),
            ('SYSUR_AUTO_KEY', 'bigint'),
            ('PNM_AUTO_KEY', 'bigint'),
            ('ALT_PNM_AUTO_KEY', 'bigint'),
            ('SPN_AUTO_KEY_LINE', 'bigint'),
            ('SPN_AUTO_KEY', 'bigint'),
            ('DUE_DATE', 'timestamp'),
            ('DATE_CREATED', 'timestamp_ntz'),
            ('ENTRY_DATE', 'timestamp_ntz'),
            ('SENT_DATE', 'timestamp_ntz'),
            ('QTY_QUOTED', 'decimal(19,4)'),
            ('QTY_REQ', 'decimal(19,4)'),
            ('UNIT_COST', 'decimal(19,4)'),
            ('UNIT_PRICE', 'decimal(19,4)'),
            ('EXCHANGE_RATE', 'decimal(19,4)'),
            ('SO_FLAG', 'string'),
            ('SOD_LINK', 'string'),
            ('PRINTED', 'string'),
            ('HISTORICAL_FLAG', 'string'),
            ('DPT_AUTO_KEY', 'int'),
        ),
        (
            "select l_orderkey as CQH_AUTO_KEY, l_orderkey*10+l_linenumber as CQD_AUTO_KEY, concat('CQ', "
            'cast(l_orderkey as varchar(20))) as CQ_NUMBER, l_linenumber as ITEM_NUMBER, o_custkey as '
            'CMP_AUTO_KEY, l_suppkey % 7 as SYSUR_AUTO_KEY, l_partkey as PNM_AUTO_KEY, l_partkey+1 as '
            'ALT_PNM_AUTO_KEY, case when l_linenumber % 2 = 0 then l_suppkey % 11 end as SPN_AUTO_KEY_LINE, '
            "o_custkey % 11 as SPN_AUTO_KEY, case when l_orderkey % 97 = 0 then {ts} '0201-03-04 00:00:00' else "
            'l_shipdate end as DUE_DATE, o_orderdate as DATE_CREATED, o_orderdate as ENTRY_DATE, case when '
            "l_linestatus='F' then l_shipdate end as SENT_DATE, cast(l_quantity as decimal(19,4)) as QTY_QUOTED, "
            'cast(l_quantity as decimal(19,4)) as QTY_REQ, cast(cast(l_extendedprice as decimal(19,4))*cast(0.8 '
            'as decimal(3,2)) as decimal(19,4)) as UNIT_COST, cast(l_extendedprice as decimal(19,4)) as '
            "UNIT_PRICE, cast(1 as decimal(19,4)) as EXCHANGE_RATE, case when l_returnflag='R' then 'T' else 'F' "
            "end as SO_FLAG, case when l_returnflag='A' then 'T' end as SOD_LINK, 'T' as PRINTED, case when "
            "l_linestatus='F' then 'T' else 'F' end as HISTORICAL_FLAG, 100+c_nationkey as DPT_AUTO_KEY from li"
        ),
    ),
    Fixture(
        'stg_sm_header',
        (
            ('SMH_AUTO_KEY', 'bigint'),
            ('SOH_AUTO_KEY', 'bigint'),
            ('INH_AUTO_KEY', 'bigint'),
            ('SVC_AUTO_KEY', 'bigint'),
            ('CMP_AUTO_KEY', 'bigint'),
            ('SYSUR_AUTO_KEY', 'bigint'),
            ('CUR_AUTO_KEY', 'bigint'),
            ('SM_NUMBER', 'string'),
            ('TRACKING_NUMBER', 'string'),
            ('OPEN_FLAG', 'string'),
            ('SHIP_DATE', 'timestamp'),
            ('ENTRY_DATE', 'timestamp_ntz'),
            ('PACKER_NAME', 'string'),
            ('SM_UDF_002', 'string'),
            ('SHIP_PRIORITY', 'string'),
            ('SMS_UPDATE', 'timestamp_ntz'),
            ('DATE_CREATED', 'timestamp_ntz'),
            ('SMS_AUTO_KEY', 'bigint'),
            ('WHS_TO', 'bigint'),
        ),
        (
            'select o_orderkey as SMH_AUTO_KEY, o_orderkey as SOH_AUTO_KEY, o_orderkey as INH_AUTO_KEY, o_custkey '
            '% 8 as SVC_AUTO_KEY, o_custkey as CMP_AUTO_KEY, o_custkey % 7 as SYSUR_AUTO_KEY, o_custkey % 3 as '
            "CUR_AUTO_KEY, concat('SM', cast(o_orderkey as varchar(20))) as SM_NUMBER, concat('TRK', "
            "cast(o_custkey as varchar(20))) as TRACKING_NUMBER, case when o_orderstatus='O' then 'T' else 'F' "
            "end as OPEN_FLAG, case when o_orderkey % 97 = 0 then {ts} '0201-03-04 00:00:00' else o_orderdate + "
            "interval '4' day end as SHIP_DATE, o_orderdate as ENTRY_DATE, 'packer' as PACKER_NAME, "
            "'WAREHOUSE-LONG-NAME' as SM_UDF_002, substring(o_orderpriority,1,1) as SHIP_PRIORITY, o_orderdate + "
            "interval '5' day as SMS_UPDATE, o_orderdate as DATE_CREATED, o_custkey % 6 as SMS_AUTO_KEY, "
            'o_custkey % 12 as WHS_TO from orders'
        ),
    ),
    Fixture(
        'stg_sm_detail',
        (
            ('SMH_AUTO_KEY', 'bigint'),
            ('LINE_NUMBER', 'int'),
        ),
        (
            "select l_orderkey as SMH_AUTO_KEY, l_linenumber as LINE_NUMBER from lineitem where l_linestatus='F'"
        ),
    ),
    Fixture(
        'd_customer',
        (
            ('CustomerId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
        ),
        (
            'select c_custkey+200000 as CustomerId, c_custkey as NativeId, 1 as DivisionId from customer where '
            'c_custkey % 13 <> 0'
        ),
    ),
    Fixture(
        'd_part',
        (
            ('PartId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
            ('PartNumber', 'string'),
            ('UoM', 'string'),
        ),
        (
            "select p_partkey+100000 as PartId, p_partkey as NativeId, 1 as DivisionId, concat(p_name, '-', "
            "cast(p_partkey as varchar(9))) as PartNumber, case when p_size % 2 = 0 then 'EA' else 'LB' end as "
            'UoM from part where p_partkey % 17 <> 0'
        ),
    ),
    Fixture(
        'd_employee',
        (
            ('EmployeeId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
        ),
        (
            'select NativeId+300 as EmployeeId, NativeId, 1 as DivisionId from (select distinct l_suppkey % 7 as '
            'NativeId from lineitem) t where NativeId <> 3'
        ),
    ),
    Fixture(
        'd_sales_rep',
        (
            ('SalesRepId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
        ),
        (
            'select NativeId+400 as SalesRepId, NativeId, 1 as DivisionId from (select distinct o_custkey % 11 as '
            'NativeId from orders) t where NativeId <> 5'
        ),
    ),
    Fixture(
        'd_route',
        (
            ('RouteId', 'int'),
            ('RouteCode', 'string'),
            ('Source', 'string'),
            ('DivisionId', 'int'),
        ),
        (
            'select * from (values '
            "(1,'R','Sales',1),(2,'A','Sales',1),(3,'R','Purchasing',1),(4,'N','Purchasing',1),(5,'N','Sales',2)) "
            't(RouteId, RouteCode, Source, DivisionId)'
        ),
    ),
    Fixture(
        'd_warehouse',
        (
            ('WarehouseId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
        ),
        (
            'select WHS_AUTO_KEY+500 as WarehouseId, WHS_AUTO_KEY as NativeId, 1 as DivisionId from (select '
            'distinct l_suppkey % 12 as WHS_AUTO_KEY from lineitem) t where WHS_AUTO_KEY <> 4'
        ),
    ),
    Fixture(
        'd_location',
        (
            ('LocationId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
        ),
        (
            'select NativeId+600 as LocationId, NativeId, 1 as DivisionId from (select distinct l_partkey % 20 as '
            'NativeId from lineitem) t where NativeId <> 6'
        ),
    ),
    Fixture(
        'd_vendor',
        (
            ('VendorId', 'bigint'),
            ('NativeId', 'bigint'),
            ('DivisionId', 'int'),
        ),
        (
            'select s_suppkey+700000 as VendorId, s_suppkey as NativeId, 1 as DivisionId from supplier where '
            's_suppkey % 9 <> 0'
        ),
    ),
    Fixture(
        'd_age',
        (
            ('AgeId', 'int'),
            ('MinMonth', 'int'),
            ('MaxMonth', 'int'),
        ),
        (
            'select * from (values (1,null,12),(2,13,36),(3,37,60),(4,61,72),(5,73,2147483647),(6,null,null),(7,90,80)) t(AgeId, MinMonth, MaxMonth)'
        ),
    ),
    Fixture(
        'd_manufacturer',
        (
            ('ManufacturerId', 'int'),
            ('ManufacturerName', 'string'),
            ('DivisionId', 'int'),
        ),
        (
            'select distinct cast(substring(p_brand,7,3) as int)+800 as ManufacturerId, p_brand as '
            "ManufacturerName, 1 as DivisionId from part where p_brand <> 'Brand#7'"
        ),
    ),
    Fixture(
        'd_part_condition',
        (
            ('PartConditionId', 'int'),
            ('NativeId', 'int'),
            ('DivisionId', 'int'),
        ),
        (
            'select * from (values (1,0,1),(2,1,1),(3,2,2)) t(PartConditionId, NativeId, DivisionId)'
        ),
    ),
    Fixture(
        'd_currency',
        (
            ('CurrencyId', 'int'),
            ('NativeId', 'int'),
            ('DivisionId', 'int'),
        ),
        (
            'select * from (values (1,0,1),(2,1,1),(3,2,2)) t(CurrencyId, NativeId, DivisionId)'
        ),
    ),
    Fixture(
        'f_purchase_order',
        (
            ('NativeId', 'bigint'),
            ('NativeLineId', 'bigint'),
            ('PartId', 'bigint'),
            ('UnitCost', 'decimal(19,4)'),
            ('PODate', 'timestamp_ntz'),
            ('DPT_AUTO_KEY', 'int'),
            ('DivisionId', 'int'),
        ),
        (
            'select l_orderkey as NativeId, l_orderkey*10+l_linenumber as NativeLineId, l_partkey+100000 as '
            'PartId, cast(cast(l_extendedprice as decimal(19,4))*cast(0.7 as decimal(3,2)) as decimal(19,4)) as '
            'UnitCost, l_shipdate as PODate, 100+c_nationkey as DPT_AUTO_KEY, 1 as DivisionId from li'
        ),
    ),
    Fixture(
        'f_inventory_history',
        (
            ('AsOfDate', 'date'),
            ('PartId', 'bigint'),
            ('DivisionId', 'int'),
            ('ProductClass', 'string'),
        ),
        (
            # one snapshot row per part and month in which the part was shipped
            "select cast(date_trunc('month', l_shipdate) as date) as AsOfDate, l_partkey+100000 as PartId, 1 as "
            "DivisionId, max(case when p_size % 3 = 0 then 'A' when p_size % 3 = 1 then 'B' end) as ProductClass "
            'from lineitem join part on l_partkey=p_partkey group by 1, 2'
        ),
    ),
    Fixture(
        'f_sales_order',
        (
            ('NativeId', 'bigint'),
            ('NativeLineId', 'bigint'),
            ('SONumber', 'string'),
            ('IsLTA', 'boolean'),
            ('DPT_AUTO_KEY', 'int'),
            ('DivisionId', 'int'),
        ),
        (
            'select l_orderkey as NativeId, l_orderkey*10+l_linenumber as NativeLineId, concat(case when '
            "o_orderpriority like '1-%' then 'SLA' else 'SO-' end, cast(o_orderkey as varchar(20))) as SONumber, "
            "(concat(case when o_orderpriority like '1-%' then 'SLA' else 'SO-' end, cast(o_orderkey as "
            "varchar(20))) like 'SLA%') as IsLTA, 100+c_nationkey as DPT_AUTO_KEY, case when l_orderkey % 4 = 0 "
            'then 12 else 1 end as DivisionId from li'
        ),
    ),
    Fixture(
        'f_invoice',
        (
            ('NativeId', 'bigint'),
            ('NativeLineId', 'bigint'),
            ('InvoiceNumber', 'string'),
            ('InvoiceDate', 'timestamp_ntz'),
            ('LinePrice', 'decimal(19,4)'),
            ('DPT_AUTO_KEY', 'int'),
            ('DivisionId', 'int'),
        ),
        (
            "select l_orderkey as NativeId, l_orderkey*10+l_linenumber as NativeLineId, concat('IN', "
            "cast(l_orderkey as varchar(20))) as InvoiceNumber, l_shipdate + interval '1' day as InvoiceDate, "
            'cast(cast(l_extendedprice as decimal(19,4))*cast(l_quantity as decimal(19,4)) as decimal(19,4)) as '
            'LinePrice, 100+c_nationkey as DPT_AUTO_KEY, case when l_orderkey % 4 = 0 then 12 else 1 end as '
            "DivisionId from li where l_returnflag <> 'N'"
        ),
    ),
    Fixture(
        'f_inventory',
        (
            ('NativeId', 'bigint'),
            ('PartId', 'bigint'),
            ('QtyOnHand', 'decimal(19,4)'),
            ('DPT_AUTO_KEY', 'int'),
            ('DivisionId', 'int'),
        ),
        (
            'select l_orderkey*10+l_linenumber as NativeId, l_partkey+100000 as PartId, case when '
            "l_linestatus='O' then cast(l_quantity as decimal(19,4)) else cast(0 as decimal(19,4)) end as "
            'QtyOnHand, 100+c_nationkey as DPT_AUTO_KEY, case when l_orderkey % 4 = 0 then 12 else 1 end as '
            'DivisionId from li'
        ),
    ),
)

BY_NAME = {f.name: f for f in FIXTURES}
