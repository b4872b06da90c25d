"""Numbers as text, and values as SQL text.

Expressions that repeat per question are put together as one SQL text: building them from
hundreds of Column calls costs more time on the driver than a small query takes to run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text, rounding the exact binary value and halves to even, as C and Python do.

    ``format_string`` rounds the shortest decimal text half up instead (0.125 -> 0.13).
    """
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float) -> str:
    return f"{float(value)!r}D"


def sql_name(*path: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in path)
