"""Entity classification of departments.

department ⋈ division ⋈ company (inner), then an ordered rule list gives the entity
label (first match wins; no match → the company name) and the label gives the
warehouse division id (no match → null, except the fallback company → base
division).  The result is one small row per department; it is broadcast (after a
check of estimated sizes) wherever a fact is classified.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, EntityConfig
from slicewright.operators.broadcast import broadcast_if_bounded
from slicewright.operators.dedupe import one_per_key


def _rule_condition(rule) -> Column:
    cond = F.lit(True)
    if rule.dept_keys is not None:
        cond = cond & F.col("DPT_AUTO_KEY").isin(*rule.dept_keys)
    if rule.company is not None:
        cond = cond & (F.rtrim("company_name") == F.lit(rule.company))
    if rule.division is not None:
        cond = cond & (F.rtrim("division_name") == F.lit(rule.division))
    return cond


def entity_dim(tables: Mapping[str, DataFrame], cfg: EntityConfig = EntityConfig()) -> DataFrame:
    dept = tables["stg_department"].select("DPT_AUTO_KEY", "dept_name", "DIV_AUTO_KEY", "SYSCM_AUTO_KEY")
    div = tables["stg_division"].select("DIV_AUTO_KEY", "division_name")
    co = tables["stg_sys_companies"].select("SYSCM_AUTO_KEY", "company_name")
    base = dept.join(div, "DIV_AUTO_KEY").join(co, "SYSCM_AUTO_KEY")

    label = None
    for r in cfg.rules:
        c = _rule_condition(r)
        label = F.when(c, F.lit(r.label)) if label is None else label.when(c, F.lit(r.label))
    label = label.otherwise(F.col("company_name"))

    division = None
    for r in cfg.rules:
        c = F.rtrim("DEPT_Definition") == F.lit(r.label)
        v = F.lit(r.division_id)
        division = F.when(c, v) if division is None else division.when(c, v)
    if cfg.fallback_company is not None:
        division = division.when(
            F.rtrim("company_name") == F.lit(cfg.fallback_company), F.lit(BASE_DIVISION)
        )

    return base.select(
        "dept_name", "division_name", "company_name", "DPT_AUTO_KEY", label.alias("DEPT_Definition")
    ).withColumn("DivisionId", division.cast("int"))


def entity_by_department(tables: Mapping[str, DataFrame], cfg: EntityConfig = EntityConfig()) -> DataFrame:
    """One (DPT_AUTO_KEY, DEPT_Definition, DivisionId) row per department, broadcastable.

    Built once per catalog object and configuration; its size is bounded by the department
    table's estimate, without running a job.
    """
    cache = getattr(tables, "_entity_cache", None)
    if cache is not None and cfg in cache:
        return cache[cfg]
    ent = entity_dim(tables, cfg)
    # a department key repeated in staging keeps its first classification
    # (one row a department: the department table bounds it)
    ent = broadcast_if_bounded(one_per_key(ent, "DPT_AUTO_KEY", ["DivisionId", "DEPT_Definition"]), tables["stg_department"])
    if cache is not None:
        cache[cfg] = ent
    return ent


def classify(
    df: DataFrame,
    entity: DataFrame,
    dept_col: str = "DPT_AUTO_KEY",
    division_out: str | None = "DivisionId",
    label_out: str | None = None,
) -> DataFrame:
    """Left-join the entity row of ``dept_col``; add the division id and/or label."""
    e = entity.select(
        F.col("DPT_AUTO_KEY").alias("__e_dpt"),
        F.col("DivisionId").alias("__e_div"),
        F.col("DEPT_Definition").alias("__e_label"),
    )
    j = df.join(e, F.col(dept_col) == F.col("__e_dpt"), "left")
    outs = []
    if division_out:
        outs.append(F.col("__e_div").alias(division_out))
    if label_out:
        outs.append(F.col("__e_label").alias(label_out))
    keep = [c for c in df.columns if c not in {division_out, label_out}]
    return j.select(*keep, *outs)
