"""The registered queries, by subject."""


def all_queries():
    """The registry, with every module of queries read."""
    from lumenfold.plans import benchmarks, documents, language, ledgers, markup, operations, records, registry, texts  # noqa: F401

    return registry
