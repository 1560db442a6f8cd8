"""Small helpers that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

T = TypeVar("T")

# The white space and the words of every contract, as patterns for Java and RE2.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name}`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not among the ``dropped`` ones; null ids stay."""
    (gone,) = fresh(docs, "_gone")
    ids = dropped.select(col(id_col).alias(gone))
    return docs.join(ids, col(id_col) == col(gone), "left_anti")


def kept(key: str, build: Callable[[], T]) -> T:
    """What ``build`` gave the first time in this worker process; workers are reused between tasks.

    It hangs on a module that every worker has, since this package need not be there.
    """
    held = vars(sys.modules["pyspark"]).setdefault("_kept_by_roleatlas", {})
    if key not in held:
        held[key] = build()
    return held[key]
