"""Distinct table locks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmetrics.operators.numbering import number_rows


def active_locks(
    df: DataFrame,
    table: str = "hl_table",
    agent: str = "hl_agent_info",
    db: str = "hl_db",
    unknown: str = "Unknown",
) -> DataFrame:
    """Each (db, table, agent) with a table and a known agent, once.

    A missing agent drops out, a missing db is one value. Duplicates collapse
    in the map tasks, before the shuffle.
    """
    known = F.col(table).isNotNull() & (F.col(agent) != unknown)
    return df.filter(known).select(db, table, agent).distinct()


def numbered_locks(
    df: DataFrame,
    table: str = "hl_table",
    agent: str = "hl_agent_info",
    db: str = "hl_db",
    unknown: str = "Unknown",
) -> DataFrame:
    """`active_locks` by table, agent and db, numbered from 0 in `Index`."""
    return number_rows(active_locks(df, table, agent, db, unknown), [table, agent, db])
