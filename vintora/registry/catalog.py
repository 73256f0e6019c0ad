"""All registered queries by name."""

from __future__ import annotations

from vintora.registry import basics, marts, published
from vintora.registry.core import Query

ALL: dict[str, Query] = {q.name: q for q in (
    *basics.QUERIES, *marts.QUERIES, *published.QUERIES)}
