"""All named queries."""

import importlib

for _name in ("cleaning", "star", "series", "models", "files"):
    importlib.import_module(f"tidemark.catalog.{_name}")
