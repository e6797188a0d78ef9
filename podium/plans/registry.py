"""All queries outside the llm subpackage, with their SQL."""

from __future__ import annotations

from podium.plans import captions, inputs, people, periods, render, sequences

_MODULES = [sequences, people, captions, render, inputs]
QUERIES = {"p2_found": periods.p2_found}
SQL = {"p2_found": periods.P2_SQL}
for _m in _MODULES:
    QUERIES.update(_m.QUERIES)
    SQL.update(_m.SQL)
FLAGSHIP = sequences.speaker_stats
