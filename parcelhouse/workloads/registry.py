"""Registry of queries and their SQL."""

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its SQL, if SQL can state it."""

    def enter(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return enter
