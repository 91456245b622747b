"""Delimited landing files (S1, S2, S3), header check (R2), UTF-8 check (S5),
missing source (S6)."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from landfall.errors import HeaderError, SourceMissing
from landfall.operators.rows import has_open_quote, without_quoted

CORRUPT = "_corrupt_record"
#: Modification time of the file a row came from (``with_arrival``).
ARRIVED = "_arrived"


def _reader(spark: SparkSession, line_sep: str | None = None, glob: str | None = None):
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _csv_reader(spark: SparkSession, sep: str, multi_line: bool, encoding: str = "UTF-8",
                line_sep: str | None = None, glob: str | None = None):
    # Quote ``"`` with a doubled quote inside, as common delimited exports write.
    return (_reader(spark, line_sep, glob).option("sep", sep)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("encoding", encoding))


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def _split_header_line(line: str, sep: str) -> list[str] | None:
    """Fields of one header line (quotes, doubled quotes); None if a quoted
    name runs past the line."""
    try:
        return next(csv.reader([line], delimiter=sep, quotechar='"', doublequote=True, strict=True))
    except (csv.Error, StopIteration):
        return None


def read_header(spark: SparkSession, path: str, sep: str = "|", multi_line: bool = True,
                encoding: str = "UTF-8", glob: str | None = None) -> list[str]:
    """The header row as data: exact names, duplicates and case kept."""
    return read_head(spark, path, sep, multi_line, encoding, glob)[0]


def read_head(spark: SparkSession, path: str, sep: str = "|", multi_line: bool = True,
              encoding: str = "UTF-8", glob: str | None = None) -> tuple[list[str], str | None]:
    """The header row, and the record end to read the file with.

    A file whose header line ends in CR LF is read with that as the record end,
    so line ends inside quoted fields stay as landed; ``None`` leaves the reader
    to take any line end (LF files, where nothing is lost, and files of one
    column, where records cut at the wrong end could not be told from whole ones).

    One short job reading the first line of the first split. A missing source
    fails here (S6), before any sink is touched.
    """
    line_sep = None
    try:
        fields = None
        if encoding.replace("-", "").upper() == "UTF8":
            first = _reader(spark, "\n", glob).text(path).first()
            if first is None:
                raise HeaderError("file has no header row")
            line = first["value"].lstrip("\ufeff")
            line_sep = "\r\n" if line.endswith("\r") and "\r" not in line[:-1] else None
            fields = _split_header_line(line.split("\r")[0], sep)
        if fields is None:  # a header with a quoted line break, or another charset
            row = (_csv_reader(spark, sep, multi_line, encoding, line_sep, glob)
                   .option("header", False)
                   .csv(path)
                   .first())
            if row is None:
                raise HeaderError("file has no header row")
            fields = ["" if v is None else v for v in row]
    except AnalysisException as e:
        if _missing(e):
            raise SourceMissing("source not found") from None
        raise
    return fields, line_sep if len(fields) > 1 else None


def check_header(header: list[str], required=()) -> None:
    """R2: every name present once, required names there (exact case).

    Spark matches columns without case, so ``A`` and ``a`` count as duplicates.
    """
    if any(h.strip() == "" for h in header):
        raise HeaderError("header has an empty column name")
    lowered = [h.lower() for h in header]
    dups = sorted({h for h in header if lowered.count(h.lower()) > 1})
    if dups:
        raise HeaderError(f"duplicate column names: {dups}")
    missing = [c for c in required if c not in header]
    if missing:
        raise HeaderError(f"missing required columns: {missing}")
    for name in (CORRUPT, ARRIVED):
        if name in header:
            raise HeaderError(f"column name {name} is reserved")


def string_schema(columns, corrupt: str | None = CORRUPT) -> StructType:
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt:
        fields.append(StructField(corrupt, StringType(), True))
    return StructType(fields)


def read_delimited(spark: SparkSession, path: str, columns, sep: str = "|",
                   multi_line: bool = True, encoding: str = "UTF-8",
                   corrupt: str | None = CORRUPT, line_sep: str | None = None, glob: str | None = None) -> DataFrame:
    """Every column as text, blank lines skipped, short rows padded.

    The header of every file is checked against ``columns`` (``enforceSchema``
    off), so a folder of parts with a different header fails. Rows with a wrong
    field count keep their raw text in ``corrupt``. ``multi_line`` allows quoted
    line breaks but reads each file in one task; a feed whose producer writes no
    line break inside a field declares it off, and its files split by bytes.
    ``line_sep`` is the record end (``read_head`` finds it).
    """
    reader = (_csv_reader(spark, sep, multi_line, encoding, line_sep, glob)
              .schema(string_schema(columns, corrupt))
              .option("header", True)
              .option("enforceSchema", False)
              .option("mode", "PERMISSIVE"))
    if corrupt:
        # A parser that skips unread columns does not see that a row has too many.
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
    return reader.csv(path)


def read_table_text(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """S3: a header file read with every column as text (names from its header)."""
    return (_csv_reader(spark, sep, multi_line)
            .option("header", True)
            .option("inferSchema", False)
            .csv(path))


def with_arrival(df: DataFrame) -> DataFrame:
    """``df``, as read, with the modification time of each row's file (from the listing)."""
    return df.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def record_report(spark: SparkSession, path: str, sep: str = "|", line_sep: str | None = None,
                  encoding: str = "UTF-8", glob: str | None = None) -> DataFrame:
    """What reading a file line by line would get wrong: ``lines``, ``open_quotes`` (lines with a quoted
    field that does not end on them) and ``stray_ends`` (with ``line_sep`` CR LF: records with a bare
    line feed outside quotes). A plain splittable scan; only lines with a quote meet the regex."""
    lines = _reader(spark, line_sep, glob).option("encoding", encoding).text(path)
    quoted = F.instr("value", '"') > 0
    bare = F.instr("value", "\n") > 0
    return lines.agg(F.count(F.lit(1)).alias("lines"),
                     F.count_if(F.when(quoted, has_open_quote("value", sep)).otherwise(False)).alias("open_quotes"),
                     F.count_if(F.when(bare, F.instr(without_quoted("value", sep), "\n") > 0).otherwise(False)).alias("stray_ends"))


def count_invalid_utf8(spark: SparkSession, path: str, glob: str | None = None) -> int:
    """Number of lines that are not valid UTF-8.

    The text source hands over raw bytes, so the check is exact (a genuine
    U+FFFD passes); it is a plain splittable scan with no parsing.
    """
    return (_reader(spark, None, glob).text(path)
            .agg(F.count_if(~F.is_valid_utf8("value")).alias("bad"))
            .first()["bad"])


def utf8_report(spark: SparkSession, path: str) -> DataFrame:
    """S5 as a DataFrame: lines that are not valid UTF-8, and all lines."""
    return (spark.read.text(path)
            .agg(F.count_if(~F.is_valid_utf8("value")).alias("bad_lines"),
                 F.count(F.lit(1)).alias("lines")))


def without_blank_lines(df: DataFrame, columns) -> DataFrame:
    """Rows of a line of blanks are skipped, as empty lines are, at every file size: with several
    columns such a line is a short row whose raw text is blank, with one its only value is."""
    raw = F.col(CORRUPT)
    blank = raw.isNotNull() & (F.trim(F.translate(raw, "\t\r", "  ")) == "")
    if len(columns) == 1:
        blank = blank | F.coalesce(F.trim(F.col("`" + columns[0].replace("`", "``") + "`")) == "", F.lit(False))
    return df.filter(~blank)
