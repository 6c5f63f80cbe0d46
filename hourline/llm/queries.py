"""All queries of the corpus operators (importing registers them)."""

from __future__ import annotations

from hourline.llm import (  # noqa: F401
    cells, chat, exact_dedup, fingerprints, licenses, minhash, mixing, packing, periodic, search, sharding, toxicity, warc,
)
from hourline.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
