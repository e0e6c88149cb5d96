"""Every operator as a query over the driver tables, with its SQL counterpart."""

from __future__ import annotations


def all_queries() -> dict:
    from truerow.queries import changes, coverage, cycles, files, history, readiness, state, stored, targets

    modules = (state, coverage, readiness, history, changes, cycles, files, stored, targets)
    return {name: entry for module in modules for name, entry in module.QUERIES.items()}
