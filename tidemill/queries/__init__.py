"""The registered queries: every operator over the whole tables, with its SQL twin."""

from tidemill.queries import (  # noqa: F401  (importing registers)
    document_queries,
    flow_queries,
    json_queries,
    keyed_queries,
    record_queries,
    redact_queries,
    registry_queries,
    stream_queries,
)
from tidemill.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
