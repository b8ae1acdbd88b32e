"""Keys of the catalog: `registry:schema` on the source side, `context:subject` on the target side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def schema_key(registry: str | Column, name: str | Column) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(c(registry), F.lit(":"), c(name))


def target_key(context: str | Column, subject: str | Column) -> Column:
    """`context:subject`, or the subject alone where the context is empty or null."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    context, subject = c(context), c(subject)
    return F.when(F.coalesce(context, F.lit("")) == "", subject).otherwise(F.concat(context, F.lit(":"), subject))


def compatibility_level(c: Column) -> Column:
    """One spelling per level: X_ALL is X_TRANSITIVE and DISABLED is NONE."""
    c = F.upper(c)
    return F.when(c == "DISABLED", "NONE").otherwise(F.regexp_replace(c, r"_ALL\z", "_TRANSITIVE"))
