"""SQL building blocks for the DuckDB oracle."""

from __future__ import annotations

import re

from slicewright.config import BASE_DIVISION, EntityConfig
from slicewright.sources.fixture_sql import BY_NAME, LI_SQL

DUCK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "decimal(19,4)": "DECIMAL(19,4)",
}

MONEY = "DECIMAL(19,4)"


def duck_type(t: str) -> str:
    return DUCK_TYPES[t]


def fixture_cte(name: str) -> str:
    fx = BY_NAME[name]
    cols = ", ".join(f'CAST("{c}" AS {duck_type(t)}) AS "{c}"' for c, t in fx.columns)
    return f"{name} AS (SELECT {cols} FROM ({fx.sql.format(ts='timestamp', unnest='unnest')}) q)"


def with_fixtures(ctes: list[tuple[str, str]], final: str) -> str:
    """WITH <needed fixtures>, <ctes> <final>."""
    body = " ".join(sql for _, sql in ctes) + " " + final
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in BY_NAME:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(BY_NAME[name].sql)
                needed.append(name)

    visit(body)
    uses_li = any(re.search(r"\bli\b", BY_NAME[n].sql) for n in needed)
    parts = []
    if uses_li:
        parts.append(f"li AS ({LI_SQL})")
    parts += [fixture_cte(n) for n in needed]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def entity_ctes(cfg: EntityConfig = EntityConfig()) -> list[tuple[str, str]]:
    """``entity`` (the classification view) and ``ent1`` (one row per department)."""
    whens = []
    for r in cfg.rules:
        conds = []
        if r.dept_keys is not None:
            conds.append(f"dept.DPT_AUTO_KEY IN ({', '.join(map(str, r.dept_keys))})")
        if r.company is not None:
            conds.append(f"syscm.company_name = {sql_str(r.company)}")
        if r.division is not None:
            conds.append(f"div.division_name = {sql_str(r.division)}")
        whens.append(f"WHEN {' AND '.join(conds)} THEN {sql_str(r.label)}")
    label = "CASE " + " ".join(whens) + " ELSE syscm.company_name END"
    div_whens = [f"WHEN DEPT_Definition = {sql_str(r.label)} THEN {r.division_id}" for r in cfg.rules]
    if cfg.fallback_company is not None:
        div_whens.append(f"WHEN company_name = {sql_str(cfg.fallback_company)} THEN {BASE_DIVISION}")
    division = "CAST(CASE " + " ".join(div_whens) + " END AS INTEGER)"
    overall = (
        "SELECT dept.dept_name, div.division_name, syscm.company_name, dept.DPT_AUTO_KEY, "
        f"{label} AS DEPT_Definition FROM stg_department dept "
        "JOIN stg_division div ON div.DIV_AUTO_KEY = dept.DIV_AUTO_KEY "
        "JOIN stg_sys_companies syscm ON syscm.SYSCM_AUTO_KEY = dept.SYSCM_AUTO_KEY"
    )
    return [
        ("ent_overall", overall),
        ("entity", f"SELECT *, {division} AS DivisionId FROM ent_overall"),
        (
            "ent1",
            "SELECT DPT_AUTO_KEY, DivisionId, DEPT_Definition FROM (SELECT *, ROW_NUMBER() OVER "
            "(PARTITION BY DPT_AUTO_KEY ORDER BY DivisionId ASC NULLS LAST, DEPT_Definition ASC NULLS LAST) AS r "
            "FROM entity) WHERE r = 1",
        ),
    ]


def dim1(name: str, table: str, id_col: str, key: str = "NativeId", where: str = "") -> tuple[str, str]:
    """Division-1 dimension, one row per native key (lowest surrogate id)."""
    w = f"DivisionId = {BASE_DIVISION}" + (f" AND {where}" if where else "")
    return (name, f"SELECT {key} AS k, MIN({id_col}) AS v FROM {table} WHERE {w} GROUP BY {key}")


def first_by(table: str, key: str, order: str, cols: str = "*") -> str:
    return (
        f"SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS __r "
        f"FROM {table}) WHERE __r = 1"
    )


def part_by_id() -> tuple[str, str]:
    return (
        "pt_by_id",
        first_by("d_part", "PartId", "NativeId ASC NULLS LAST, PartNumber ASC NULLS LAST",
                 "PartId, NativeId, PartNumber"),
    )


def part1() -> tuple[str, str]:
    """Division-1 part dimension, one row per native key: (k, PartId, PartNumber)."""
    return (
        "part1",
        first_by(f"(SELECT * FROM d_part WHERE DivisionId = {BASE_DIVISION})", "NativeId",
                 "PartId ASC NULLS LAST, PartNumber ASC NULLS LAST", "NativeId AS k, PartId, PartNumber, UoM"),
    )


def tiebreak(columns: list[str], exclude: set[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(f'{p}"{c}" ASC NULLS FIRST' for c in columns if c not in exclude)


def fixture_columns(name: str) -> list[str]:
    return [c for c, _ in BY_NAME[name].columns]


def date_floor(e: str) -> str:
    return (f"CASE WHEN CAST({e} AS TIMESTAMP) < TIMESTAMP '1000-01-01 00:00:00' "
            f"THEN TIMESTAMP '1900-01-01 00:00:00' ELSE CAST({e} AS TIMESTAMP) END")


def date_key(e: str) -> str:
    return f"CAST(strftime({e}, '%Y%m%d') AS INTEGER)"


def money(e: str) -> str:
    return f"CAST({e} AS {MONEY})"


def money_mul(a: str, b: str) -> str:
    return f"CAST(CAST({a} AS {MONEY}) * CAST({b} AS {MONEY}) AS {MONEY})"


def money_div(a: str, b: str, scale: int = 4, a_scale: int = 4, b_scale: int = 4) -> str:
    """Exact ``CAST(a / b AS decimal(.., scale))`` with HALF_UP (DuckDB divides decimals in double).

    ``a`` has ``a_scale`` decimals, ``b`` has ``b_scale``; the quotient is rounded in
    integer arithmetic.  Zero divisor → NULL.
    """
    na = f"CAST(CAST({a} AS DECIMAL(38,{a_scale})) * {10 ** a_scale} AS HUGEINT)"
    nb = f"CAST(CAST({b} AS DECIMAL(38,{b_scale})) * {10 ** b_scale} AS HUGEINT)"
    num = f"(abs({na}) * CAST({10 ** (scale + b_scale - a_scale)} AS HUGEINT))"
    den = f"abs({nb})"
    q = f"((2 * {num} + {den}) // NULLIF(2 * {den}, 0))"
    sgn = f"(sign({na}) * sign({nb}))"
    unit = "0." + "0" * (scale - 1) + "1"
    return (f"CAST(CAST({sgn} * {q} AS DECIMAL(18,0)) * CAST('{unit}' AS DECIMAL({scale + 1},{scale})) "
            f"AS DECIMAL(38,{scale}))")


def letter_flag(e: str) -> str:
    return f"COALESCE(rtrim({e}) = 'T', FALSE)"


def address(a2: str, a3: str, a4: str, a5: str) -> tuple[str, str]:
    """(country, zip) expressions, same rules as the Spark address split."""
    from slicewright.functions.address import COUNTRY_ALIASES, ZIP_PATTERN

    def line(c: str) -> str:
        t = f"upper(trim({c}))"
        return f"CASE WHEN length({t}) > 0 AND NOT regexp_matches({t}, '[0-9]') THEN {t} END"

    raw = f"COALESCE({line(a5)}, {line(a4)})"
    alias = " ".join(f"WHEN {raw} = {sql_str(a)} THEN {sql_str(n)}" for a, n in COUNTRY_ALIASES)
    country = f"CASE {alias} ELSE {raw} END"
    z = f"regexp_extract(concat_ws('|', {a4}, {a5}, {a3}, {a2}), '{ZIP_PATTERN}', 1)"
    return country, f"NULLIF({z}, '')"


def long_term_flag(e: str) -> str:
    h = f"substring({e}, 1, 3)"
    return f"COALESCE({h} LIKE '%L%' AND length(rtrim({h})) = 3, FALSE)"


#: The run clock of the test runs.
RUN_TS = "TIMESTAMP '2002-01-01 00:00:00'"
#: Departments of the split unit's division.
UNIT = "SELECT DPT_AUTO_KEY FROM ent1 WHERE DivisionId = 12"


def surrogate(dim: str, value: str, column: str, native: str = "NativeId", also: str = "") -> str:
    """The base division's surrogate key of a native key, or -1."""
    return (f"COALESCE((SELECT MIN(x.{column}) FROM {dim} x WHERE x.DivisionId = 1 AND x.{native} = {value}{also}), -1)")


def one_per(keys: str, order: str) -> str:
    return f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def nulls_first(columns, without=()) -> str:
    return ", ".join(f'"{c}" NULLS FIRST' for c in columns if c not in without)
