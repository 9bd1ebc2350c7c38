"""Column and table names: one snake_case rule for every source."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Names that are keywords in some SQL dialect and so carry a suffix.
RESERVED_NAMES = {"date", "time", "timestamp", "order", "group", "select", "table"}

# A word is an optional run of capitals closed by lower-case letters or digits, a run
# of capitals alone, or '#' (read as "no") with whatever lower-case text hangs on it.
_WORD = re.compile(r"#[a-z0-9]*|[A-Z]*[a-z0-9]+|[A-Z]+")


def snake(name: str) -> str:
    """``Date of Service`` -> date_of_service, ``Patient #`` -> patient_no, ``PatGUID`` -> pat_guid."""
    words = [w.replace("#", "no").lower() for w in _WORD.findall(name)]
    joined = "_".join(words)
    return joined + "_col" if joined in RESERVED_NAMES else joined


def raw_table(folder: str, stem: str) -> str:
    """Raw table name of one delivered file."""
    return f"{snake(folder)}__{snake(stem)}"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`snake`; two headers meeting in one name is an error."""
    names = [snake(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)
