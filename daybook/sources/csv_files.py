"""Reading CSV exports.

One reader for both sources. Every column is text and only an empty cell is
null. A path may name one file or a folder of files with the same header; Spark
splits large files and reads the pieces on all executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.contracts import MALFORMED, POSITION, InputField
from daybook.errors import SchemaError
from daybook.functions.text import is_blank
from daybook.sources.headers import HeaderMatch, match_header

UNNAMED = "Unnamed: "

_SURPLUS_CELLS = "CSV row has more cells than the header: "
_TORN_CELL = "CSV cell spans lines: "
_OPEN_END = "line breaks in cells, but a quoted cell never ends"
# Whole cells, then one that opens with a quote and lasts to the end of the line.
_OPEN_CELL = (
    r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$'
)
_OTHER_HEADER = "CSV header does not conform to the schema"


def read_export(
    spark: SparkSession,
    path: str,
    wanted: Sequence[InputField],
    *,
    multi_line: bool | None = None,
) -> tuple[DataFrame, HeaderMatch]:
    """Read an export as text columns under canonical names.

    The result also carries the position of each row (``POSITION``), which
    gives "the first occurrence" a meaning on many executors.

    Quoted cells may hold line breaks. Spark cannot split files with such cells, so a pass over
    the lines looks for them first, and only files that have any are read whole; the others
    are split as usual. ``multi_line`` says what is known without that pass: True reads every
    file whole, False refuses line breaks in cells. A row with more cells than the header fails
    the read; a shorter one is padded with nulls. These failures show when the rows are read: see
    ``parse_failures``.
    """
    header = _header_row(spark, path)
    match = match_header(header, wanted)  # header problems are fatal before any scan
    torn = _torn_files(spark, path) if not multi_line else []
    if torn and multi_line is False:
        raise SchemaError(f"{path} is not a usable CSV export: {_TORN_CELL}{torn[0]}")

    if multi_line:
        rows = _rows(spark, path, header, match, whole=True)
    elif torn:
        plain = [p for p in _files(spark, path) if p not in set(torn)]
        rows = _rows(spark, list(map(_no_glob, torn)), header, match, whole=True)
        if plain:
            split = _rows(spark, list(map(_no_glob, plain)), header, match, whole=False)
            rows = split.unionByName(rows)
    else:
        rows = _rows(spark, path, header, match, whole=False)
    absent = {name: F.lit(None).cast("string") for name in match.absent}
    return rows.withColumns(absent), match


def _rows(
    spark: SparkSession, paths: str | list[str], header: list[str], match: HeaderMatch, whole: bool
) -> DataFrame:
    """Rows of files with one header, with their positions."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, MALFORMED)])
    scan = (
        spark.read.schema(schema)
        .options(
            header=True,
            # Each file of a folder must carry this header; a header with an
            # unnamed column cannot be compared by name.
            enforceSchema=any(name.startswith(UNNAMED) for name in header),
            escape='"',
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=MALFORMED,
            multiLine=whole,
        )
        .csv(paths)
        .select(
            "*",
            F.col("_metadata.file_path").alias(POSITION[0]),
            F.col("_metadata.file_block_start").alias(POSITION[1]),
            F.monotonically_increasing_id().alias(POSITION[2]),
        )
    )
    rows = scan.toDF(*match.columns, MALFORMED, *POSITION)
    if whole:  # here, unlike line by line, white-space-only lines arrive as rows
        rows = rows.where(F.col(MALFORMED).isNull() | ~is_blank(F.col(MALFORMED)))
    return rows.withColumn(MALFORMED, _refuse_malformed(F.col(MALFORMED), len(header), whole))


@contextmanager
def parse_failures(path: str) -> Iterator[None]:
    """Turn the failure of a job over an unparseable export into a schema error."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as exc:
        for line in str(exc).splitlines():
            if any(sign in line for sign in (_SURPLUS_CELLS, _TORN_CELL, _OTHER_HEADER)):
                raise SchemaError(f"{path} is not a usable CSV export: {line}") from exc
        raise


def _header_row(spark: SparkSession, path: str) -> list[str]:
    try:
        first = (
            spark.read.option("header", False)
            .option("escape", '"')
            .csv(path)
            .where(F.col("_metadata.file_block_start") == 0)
            .head(1)
        )
    except AnalysisException as exc:
        raise SchemaError(f"no CSV data at {path}") from exc
    if not first:
        raise SchemaError(f"no header in {path}: the CSV is empty")
    return [cell if cell else f"{UNNAMED}{i}" for i, cell in enumerate(first[0])]


def _torn_files(spark: SparkSession, path: str) -> list[str]:
    """Files in which some line opens a quoted cell that it does not close, by path.

    The parser sees such a line and the next as two rows, which may both have the right
    number of cells, so every line is judged by its quoting. A quote inside an unquoted cell is
    legal. Only lines with a quote are looked at, and each task sends its torn files' names.
    Such a file is read as one text, where a cell that never ends would swallow all that
    follows; with an odd number of quotes it cannot be told where cells end, so that is refused.
    Quotes are counted in torn files alone.
    """
    file = F.col("_metadata.file_path").alias("file")
    found = _open_lines(spark.read.text(path)).select(file).distinct()
    torn = sorted(r["file"] for r in found.collect())  # at most a row per file
    paths = [_plain_path(spark, uri) for uri in torn]
    if torn:
        quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
        lines = spark.read.text(list(map(_no_glob, paths))).where(F.col("value").contains('"'))
        odd = lines.groupBy(file).agg(F.sum(quotes).alias("quotes")).where("quotes % 2 = 1")
        if refused := odd.orderBy("file").head(1):
            raise SchemaError(f"{refused[0]['file']} is not a usable CSV export: {_OPEN_END}")
    return paths


def _open_lines(lines: DataFrame) -> DataFrame:
    """The lines that open a quoted cell and do not close it."""
    return lines.where(F.col("value").contains('"') & F.col("value").rlike(_OPEN_CELL))


def _files(spark: SparkSession, path: str) -> list[str]:
    return sorted(_plain_path(spark, uri) for uri in spark.read.text(path).inputFiles())


def _plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a URI with escapes stands for."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _no_glob(path: str) -> str:
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _refuse_malformed(raw: Column, width: int, multi_line: bool) -> Column:
    """Fail on a surplus cell or a torn quoted cell; null otherwise.

    Spark fills ``raw`` only for rows whose cell count differs from the header,
    so well-formed rows never reach the second parse.
    """
    cells = ", ".join(f"c{i} string" for i in range(width + 1))
    surplus = F.from_csv(raw, cells, {"escape": '"'})[f"c{width}"].isNotNull()
    verdict = F.when(
        raw.isNotNull() & surplus,
        F.raise_error(F.concat(F.lit(_SURPLUS_CELLS), raw)),
    )
    if not multi_line:
        quotes = F.length(raw) - F.length(F.replace(raw, F.lit('"'), F.lit("")))
        verdict = F.when(
            raw.isNotNull() & (quotes % 2 == 1),
            F.raise_error(F.concat(F.lit(_TORN_CELL), raw)),
        ).otherwise(verdict)
    return verdict.cast("string")
