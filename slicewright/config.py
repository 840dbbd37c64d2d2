"""Entity rules, division slices and run context.

The classification of departments into business entities is an ordered rule list
(first match wins).  The slices are parameterised by the division they keep and by
the few places where the per-entity views of the source system really differ
(tax-line scope, purchase-order cost scope, output column, division literal).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class EntityRule:
    """One branch of the ordered department classification.

    A rule matches when every given condition holds: department key in
    ``dept_keys``, company name equal to ``company``, division name equal to
    ``division``.  ``label`` is the entity label, ``division_id`` the warehouse
    division the label maps to.
    """

    label: str
    division_id: int
    dept_keys: tuple[int, ...] | None = None
    company: str | None = None
    division: str | None = None


# --- fixed values ----------------------------------------------------------------
# Split-unit departments: 106, 107, 108, 109, 110, 111, 112, 113, 114 (division 12).
# Division ids per entity: US 1, Seventh 7 (query key ahe), China 9, split unit 12, UK 23, APAC 24, EMEA 25.
# Load-time constants: receipt volume guard 0.8 of the rows already at the target,
# quantity-outlier threshold 290000 units, dimension scope division 1, default key -1,
# date floor: dates before 1000-01-01 become 1900-01-01, null receipt date matches
# 1990-01-01 in the receipt merge, product class default 'Z', test report code 'N/A'.
SPLIT_DEPARTMENTS: tuple[int, ...] = (106, 107, 108, 109, 110, 111, 112, 113, 114)
SPLIT_DIVISION = 12
BASE_DIVISION = 1
DIMENSION_DIVISION = 1
UNKNOWN_KEY = -1
VOLUME_GUARD_RATIO = 0.8
QTY_OUTLIER_THRESHOLD = 290000
DATE_FLOOR_LIMIT = _dt.date(1000, 1, 1)
DATE_FLOOR_VALUE = _dt.date(1900, 1, 1)
NULL_RECEIVED_DATE = _dt.date(1990, 1, 1)
DEFAULT_PRODUCT_CLASS = "Z"
NOT_APPLICABLE = "N/A"
# ----------------------------------------------------------------------------------

# Ordered classification of the test warehouse (neutral company names).
DEFAULT_RULES: tuple[EntityRule, ...] = (
    EntityRule("Split Unit", SPLIT_DIVISION, dept_keys=SPLIT_DEPARTMENTS),
    EntityRule("EMEA", 25, company="PARENT, LLC", division="EMEA"),
    EntityRule("UK", 23, company="PARENT, LTD"),
    EntityRule("APAC", 24, company="PARENT, LLC", division="APAC"),
    EntityRule("China", 9, company="CHINA CO"),
    EntityRule("US", 1, company="PARENT, LLC"),
    EntityRule("Seventh", 7, company="SEVENTH CO"),
)
# Company whose unlabelled departments still count as the base division.
DEFAULT_FALLBACK_COMPANY: str | None = "PARENT, LLC"


@dataclass(frozen=True)
class EntityConfig:
    rules: tuple[EntityRule, ...] = DEFAULT_RULES
    fallback_company: str | None = DEFAULT_FALLBACK_COMPANY

    def label_of(self, division_id: int) -> str:
        for r in self.rules:
            if r.division_id == division_id:
                return r.label
        raise KeyError(division_id)

    @property
    def split_departments(self) -> tuple[int, ...]:
        for r in self.rules:
            if r.division_id == SPLIT_DIVISION and r.dept_keys:
                return r.dept_keys
        return SPLIT_DEPARTMENTS


@dataclass(frozen=True)
class DivisionSlice:
    """Parameters of one entity slice of the sales-order and invoice families.

    ``split_unit`` selects the split-off unit's variant: invoice tax lines are counted
    over all lines of the invoice number, purchase-order costs are scoped by the
    fact's own division column (= base division), the invoice keeps
    ``DPT_AUTO_KEY`` instead of the entity label, and there is no label filter.
    ``literal_division`` makes the invoice's division column the constant division
    id rather than the entity's division (the base entity's variant).
    """

    key: str
    division_id: int
    split_unit: bool = False
    literal_division: bool = False


SLICES: dict[str, DivisionSlice] = {
    "split": DivisionSlice("split", SPLIT_DIVISION, split_unit=True),
    "us": DivisionSlice("us", 1, literal_division=True),
    "ahe": DivisionSlice("ahe", 7),
    "china": DivisionSlice("china", 9),
    "uk": DivisionSlice("uk", 23),
    "apac": DivisionSlice("apac", 24),
    "emea": DivisionSlice("emea", 25),
}


@dataclass(frozen=True)
class RunContext:
    """Identifiers and clock of one load run.

    ``run_ts`` replaces the database clock: every row stamped in one run gets the
    same value, and a re-run with the same context is repeatable.
    """

    run_ts: _dt.datetime = _dt.datetime(2002, 1, 1)
    unique_run_id: str = "UNDEFINED"
    parent_pipeline_id: str = "UNDEFINED"
    pipeline_id: str = "UNDEFINED"
    system_name: str = "Split Refresh"
    system_rank: int = 100
    extra: dict[str, str] = field(default_factory=dict)
    #: Collation that texts compare by (see sources.collation); None: letter by letter.
    collation: str | None = None
