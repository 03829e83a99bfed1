"""Registered queries; load() fills the registry."""

import importlib

MODULES = ("cell_queries", "series_queries", "catalogue_queries", "space_queries", "source_queries", "product_queries", "file_queries")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
