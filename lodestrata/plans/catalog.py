"""All queries outside the llm subpackage, with the SQL that checks them."""

from __future__ import annotations

from . import dealt, pipeline, reference, streams

FLAGSHIP = "vote_fields"
_MODULES = (dealt, reference, pipeline, streams)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.ORACLES.items()}
