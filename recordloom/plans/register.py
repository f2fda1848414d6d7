"""Imports every module that registers queries."""

from . import audits, dictionaries, files, lookups, names, orders, picks, releases, resolution, texts, upkeep  # noqa: F401
