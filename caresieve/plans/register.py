"""Registration of a query beside its oracle."""

from __future__ import annotations


def registrar(queries: dict, oracle: dict):
    """A decorator factory: query(sql) registers the function under its name, with SQL if there is any."""

    def query(sql: str | None = None):
        def register(f):
            if f.__name__ in queries:
                raise ValueError(f"{f.__name__} is registered twice")
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return register

    return query
