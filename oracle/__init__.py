"""DuckDB SQL for the registered queries, over views of the same Parquet tables.

Written directly against the tables and in the plainest form (naive range joins, global window
functions, cross joins), so that it does not share the structure of the Spark queries it checks.
"""

from __future__ import annotations

from oracle.fleet import FLEET
from oracle.monitoring import MONITORING
from oracle.texts import TEXTS


def oracle_queries() -> dict[str, str]:
    return {**FLEET, **TEXTS, **MONITORING}
