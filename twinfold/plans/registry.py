"""All queries of the library outside the optional training-data subpackage, by name."""

from __future__ import annotations

from . import calls, content, records, sources

QUERIES, ORACLES = {}, {}
for _part in (records, content, calls, sources):
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES
