"""Queries over the given tables and the SQL that checks them."""

from hackstand.catalog import registry


def load():
    from hackstand.catalog import audit, categories, marts, models, quality, serving, storage, streams, trips  # noqa: F401

    return registry.QUERIES
