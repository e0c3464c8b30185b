"""All registered queries of the library and their SQL."""

from __future__ import annotations

from . import features, flows, lookup, merging, shaping, streams

MODULES = (features, merging, lookup, flows, shaping, streams)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
