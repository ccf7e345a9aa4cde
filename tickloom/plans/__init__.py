"""Registered queries over the given tables and their SQL counterparts."""


def all_queries():
    """Name to builder, and name to SQL, of every registered query."""
    from importlib import import_module

    from tickloom.plans import registry

    for name in MODULES:
        import_module(f"tickloom.plans.{name}")
    return registry.QUERIES, registry.ORACLES


MODULES = ("enrich_queries", "table_queries", "compare_queries", "ingest_queries", "stream_queries")
