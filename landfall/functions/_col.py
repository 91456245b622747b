from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """Accept a column name or a ``Column``."""
    return c if isinstance(c, Column) else F.col(c)


def null_string() -> Column:
    return F.lit(None).cast("string")


def sql_string(s: str) -> str:
    """A Spark SQL string literal for ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    """A Spark SQL reference to the column ``name``, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"
