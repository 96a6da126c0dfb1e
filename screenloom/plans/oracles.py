"""DuckDB SQL twins of the registered queries."""

from __future__ import annotations

from screenloom.plans import reference_queries, screening_queries, text_queries, verdict_queries

ORACLES: dict[str, str] = {**verdict_queries.ORACLES, **reference_queries.ORACLES, **text_queries.ORACLES, **screening_queries.ORACLES}
