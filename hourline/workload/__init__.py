"""The registered queries: every operator run over the given tables, with the equivalent SQL."""

from __future__ import annotations

from hourline.workload import (  # noqa: F401  (importing registers)
    accuracy, drift, features, models, panels, quality, storage, streams,
)
from hourline.workload.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
