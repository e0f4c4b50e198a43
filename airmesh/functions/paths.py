"""Column expressions over path arrays (``array<bigint>`` of vertex ids)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_SEPARATOR = " -> "


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def path_text(path, sep: str = PATH_SEPARATOR) -> Column:
    """``[1, 2, 3]`` → ``'1 -> 2 -> 3'``."""
    return F.array_join(F.transform(_c(path), lambda x: x.cast("string")), sep)


def text_path(text, sep: str = PATH_SEPARATOR) -> Column:
    """``'1 -> 2 -> 3'`` → ``[1, 2, 3]``."""
    return F.transform(F.split(_c(text), sep), lambda x: x.cast("bigint"))
