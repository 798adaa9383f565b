"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from .registry import ORACLES, QUERIES

from . import changes, keyed, learning, profiles, relational, scalars, streams, tables, texts  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
