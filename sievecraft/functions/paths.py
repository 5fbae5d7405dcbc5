"""Which paths of a repository are code, as expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_ignored_directory(path: Column, ignored: Iterable[str]) -> Column:
    """Whether a directory of the path (not the file's name) is one of the lower-case names."""
    parts = F.split(F.lower(path), "/")
    names = F.array(*(F.lit(x) for x in sorted(ignored))) if ignored else F.expr("cast(array() as array<string>)")
    return F.arrays_overlap(F.slice(parts, 1, F.size(parts) - 1), names)


def has_extension(path: Column, extensions: Iterable[str]) -> Column:
    out = F.lit(False)
    for x in extensions:
        out = out | F.lower(path).endswith(x.lower())
    return out


def eligible(path: Column, extensions: Iterable[str], ignored: Iterable[str]) -> Column:
    return ~in_ignored_directory(path, ignored) & has_extension(path, extensions)
