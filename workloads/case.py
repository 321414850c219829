"""A query with its oracle."""

from workloads.fixtures import oracle

CASES: dict[str, tuple] = {}


def case(name: str, sql: str | None = None):
    def keep(fn):
        CASES[name] = (fn, None if sql is None else oracle(sql))
        return fn

    return keep
