"""Delimited export (K5): header, no index, one part file per task."""

from pyspark.sql import DataFrame


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "overwrite", line_sep: str | None = None) -> None:
    """Quotes where needed, a doubled quote inside; NULL and empty text as an empty
    field; blanks at either end of a value are kept. ``line_sep`` ends the records
    (a line feed unless given)."""
    writer = df.write.option("lineSep", line_sep) if line_sep else df.write
    (writer.mode(mode)
     .option("header", header)
     .option("sep", sep)
     .option("quote", '"')
     .option("escape", '"')
     .option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))
