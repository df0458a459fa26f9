"""Named queries over the test tables, each with its SQL counterpart where there is one."""

from tallyline.registry import (  # noqa: F401  (importing registers the queries)
    anomaly_queries,
    core_queries,
    ingest_queries,
    job_queries,
    kpi_queries,
    quality_queries,
    runlog_queries,
    source_queries,
    view_queries,
)
from tallyline.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
