"""Column-level helpers: naming, ordering and small value lists."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: characters that stay in a normalized column name.
KEPT_CHARACTERS = r"0-9a-zA-Z`!@#$%^&*()_+~\-=\[\]{}:\";'<>?,.\\/"
_RUN_OF_OTHERS = f"[^{KEPT_CHARACTERS}]+"


def normalize_name(name: str) -> str:
    """Lower-case name; every run of other characters becomes one underscore,
    and one underscore is dropped from either end."""
    squeezed = re.sub(_RUN_OF_OTHERS, "_", name.lower())
    return re.sub(r"^_|_$", "", squeezed)


def normalize_name_text(name: Column) -> Column:
    """`normalize_name` for names held in a column."""
    squeezed = F.regexp_replace(F.lower(name), _RUN_OF_OTHERS, "_")
    return F.regexp_replace(squeezed, "^_|_$", "")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns at once; two columns may not end up with one name."""
    names = [normalize_name(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns share a normalized name: {clashes}")
    return df.toDF(*names)


def cols_to_front(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """The given columns first, the others after them by name."""
    rest = sorted(c for c in df.columns if c not in set(front))
    return df.select(*[quoted(c) for c in [*front, *rest]])


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def resolve(df: DataFrame, name: str) -> str:
    """The column of `df` called `name`, ignoring case; raises when there is none."""
    if name in df.columns:
        return name
    matches = [c for c in df.columns if c.lower() == name.lower()]
    if len(matches) != 1:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return matches[0]


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def first_value(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """Value of the row that comes first in `order_by`: one aggregate, no sort."""
    return df.agg(F.min_by(quoted(column), quoted(order_by)).alias(column))


def column_list(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """All values of a column as rows `(position, value)`, in the order of another column.

    The rows stay distributed: a list of any length has no single holder.
    """
    listed = df.select(quoted(order_by).alias("position"), quoted(column).alias("value"))
    return listed.orderBy("position", "value")
