"""DuckDB SQL for every registered query (the correctness oracle).

Each oracle is written from the rules as sets: the rows of a slice are picked first, lookups
are scalars of the picked row, and a load is what it deletes, updates, inserts and leaves.
The documented deterministic rules (total tie-breaks, one row per lookup key) are shared with
the Spark jobs.  Test relations are inlined as CTEs from the same portable SQL that builds
the Spark inputs.
"""

from slicewright.oracle.build import ORACLES, oracle_sql

__all__ = ["ORACLES", "oracle_sql"]
