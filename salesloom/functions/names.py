"""Names of tables and columns. These run on the driver over a schema, never over rows."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

MAX_COLUMN_NAME = 300


def ascii_text(value: object) -> str:
    """Compatibility-decomposed text without its non-ASCII characters."""
    if not isinstance(value, str):
        return str(value)
    decomposed = unicodedata.normalize("NFKD", value)
    return "".join(ch for ch in decomposed if ch.isascii())


def table_name(label: str) -> str:
    """Label of a tab or source as a table name: ``Metas 2024 (v2)`` to ``metas_2024_v2``."""
    return "_".join(re.split(r"\W+", ascii_text(label))).strip("_").lower()


def column_name(label: object) -> str:
    """Header cell as a column name; ``col_`` goes before an empty name or a leading digit."""
    name = "_".join(re.findall(r"[A-Za-z0-9]+", ascii_text(label)))
    if not name or name[0].isdigit():
        name = f"col_{name}"
    return name[:MAX_COLUMN_NAME].lower()


def header_names(cells: Iterable[str | None]) -> list[str]:
    """Header cells, where every copy of a repeated one gets its position: ``x_0, x_1, y``."""
    header = ["" if cell is None else cell for cell in cells]
    copies = Counter(header)
    return [f"{cell}_{i}" if copies[cell] > 1 else cell for i, cell in enumerate(header)]


def unique_columns(labels: Iterable[object]) -> list[str]:
    """Column names for labels; a repeated name gets the next free number."""
    taken: set[str] = set()
    repeats: Counter[str] = Counter()
    names = []
    for base in map(column_name, labels):
        name = base
        while name in taken:
            repeats[base] += 1
            name = f"{base}_{repeats[base]}"
        taken.add(name)
        names.append(name)
    return names


def rename_columns(df: DataFrame) -> DataFrame:
    """The same rows under clean, distinct column names."""
    return df.toDF(*unique_columns(df.columns))


def qualified_name(layer: str | None, table: str, default: str = "default") -> str:
    """``layer.table``, with the blanks around the layer dropped and a default layer."""
    return f"{default if layer is None else layer.strip()}.{table}"
