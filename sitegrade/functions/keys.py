"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_text(*names: str) -> Column:
    """The columns' raw text, NULL as empty, without a separator."""
    return F.concat(*[F.coalesce(F.col(n), F.lit("")) for n in names])


def hash_key(*names: str) -> Column:
    """md5 over :func:`key_text`."""
    return F.md5(key_text(*names))
