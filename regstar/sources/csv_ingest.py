"""Batch CSV ingest with drifting headers.

Spark's CSV reader assigns columns by position when it is given a schema, and
with ``enforceSchema=false`` a header in another order fails the read. So
files are grouped by their header line:

1. one Spark job reads the beginning of every file: each file is a task of its
   own, which ends soon after it has the header, however long the file is; the
   driver opens no file;
2. per distinct header, one ``spark.read.csv`` with an all-string schema built
   from that header (so positions are right), then harmonise;
3. ``unionByName`` the harmonised groups.

All values are read as strings (no inference); empty fields read as NULL. The
driver holds the distinct headers and the paths of each, as Spark's reader plans
from a list of paths; ``streaming.ingest`` bounds them per micro-batch.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regstar.domain import registrations as R
from regstar.operators.harmonize import harmonize_columns

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Columns of rows kept with ``malformed=True``: the whole line of a malformed row, and its file.
MALFORMED, SOURCE_FILE = "_malformed", "_source_file"
#: Settings under which every file is a task of its own, read a few lines at a time.
A_FILE_A_TASK = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512"}
#: Batches after which a task leaves a file: a task that leaves one costs a Python worker, so short files are read to their end.
BATCHES = 64


def _headers_of(alone: bool, enough: int = BATCHES):
    """Rows (path, line) in file order to (path, header, problem); with a header and ``enough`` batches it ends if a task has one file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(path: str, header: str | None, problem: str | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (path, header, problem)], names=["path", "header", "problem"])

        def unfinished(path: str, header: str) -> pa.RecordBatch:
            return row(path, None, "a quote in the header is never closed" if header.strip() else "no header in a file that is not empty")

        path, header, done = None, "", True
        for n, b in enumerate(batches):
            for p, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if p != path:
                    if not done:
                        yield unfinished(path, header)
                    path, header, done = p, "", False
                if done:
                    continue
                header += line.removeprefix("\ufeff") if not header else "\n" + line
                if header.strip() and header.count('"') % 2 == 0:
                    yield row(path, header, None)
                    done = True
                elif not header.strip():
                    header = ""
            if done and alone and n + 1 >= enough:
                return
        if not done:
            yield unfinished(path, header)

    return run


def file_headers(spark: SparkSession, sources: Sequence[str], glob: str | None = None) -> DataFrame:
    """(path, header, problem) of every file with a line: its first line that is not blank, as Spark's reader takes it.

    Lines end at CR, LF or CRLF only, a quoted field may hold line ends, and no
    length is too long. ``problem`` says why a file has no header; ``path`` is
    URI-encoded. Compressed files and all file systems of Spark's reader work.
    """
    own = spark.newSession()  # for settings of this read alone
    for k, v in A_FILE_A_TASK.items():
        own.conf.set(k, v)
    reader = own.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(list(sources)).select("_metadata.file_path", "value")
    alone = lines.rdd.getNumPartitions() >= list_files(own, sources, glob).count()
    return lines.mapInArrow(_headers_of(alone), "path string, header string, problem string")


def list_files(spark: SparkSession, source: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """File paths under ``source`` (recursive), as a one-column frame; all files unless ``glob`` says which."""
    sources = [source] if isinstance(source, str) else list(source)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(sources).select("path")


def as_literal(path: str) -> str:
    """A path in which no character is a wildcard to Hadoop."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def split_header(line: str, sep: str = ",") -> list[str]:
    csv.field_size_limit(max(csv.field_size_limit(), len(line)))
    return next(csv.reader(io.StringIO(line), delimiter=sep), [])


def header_schema(headers: Sequence[str]) -> T.StructType:
    """All-string schema with unique positional names for one header layout."""
    return T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(headers))])


def extra_columns(headers: Sequence[str], aliases: Mapping[str, str], golden: Sequence[str]) -> dict[str, str]:
    """Name -> itself for the headers that no golden column takes: lower-cased, stripped, in order of position.

    A header without text is named by its position. A name that a golden column
    has in other letters gets ``_extra`` after it.
    """
    taken = {g.lower() for g in golden}
    out: dict[str, str] = {}
    for i, h in enumerate(headers):
        key = h.lower().strip()
        if key in aliases:
            continue
        key = key or f"_c{i}"
        out[key] = f"{key}_extra" if key in taken else key
    return out


def read_group(spark: SparkSession, paths: Sequence[str], header: str, sep: str = ",",
               aliases: Mapping[str, str] = R.HEADER_ALIASES, golden: Sequence[str] = R.GOLDEN_COLUMNS,
               malformed: bool = False, extra: bool = False) -> DataFrame:
    """Read files sharing one header line and harmonise them; see ``ingest_csv`` for ``malformed`` and ``extra``."""
    names = split_header(header, sep)
    schema = header_schema(names)
    reader = (spark.read.option("header", "true").option("sep", sep)
              .option("mode", "PERMISSIVE").option("multiLine", str("\n" in header).lower()))
    if malformed:  # without pruning, so that every row's fields are counted whatever is selected
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", "false")
    raw = reader.schema(schema).csv([as_literal(p) for p in paths])
    targets, headers = list(golden), list(names)
    if extra:
        more = extra_columns(names, aliases, golden)
        aliases = {**aliases, **more}
        targets += more.values()
        headers = [h if h.strip() else f"_c{i}" for i, h in enumerate(names)]
    if malformed:
        raw = raw.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        aliases = {**aliases, MALFORMED: MALFORMED, SOURCE_FILE: SOURCE_FILE}
        targets, headers = [*targets, MALFORMED, SOURCE_FILE], [*headers, MALFORMED, SOURCE_FILE]
    return harmonize_columns(raw, aliases, targets, headers=headers)


def ingest_csv_paths(spark: SparkSession, sources: Sequence[str], sep: str = ",",
                     aliases: Mapping[str, str] = R.HEADER_ALIASES, golden: Sequence[str] = R.GOLDEN_COLUMNS,
                     glob: str | None = None, malformed: bool = False, extra: bool = False) -> DataFrame | None:
    """Harmonised rows of all files of ``sources``; None if no file has a line."""
    groups: dict[str, list[str]] = {}
    for r in file_headers(spark, sources, glob).collect():  # one row a file
        if r["problem"] is not None:
            raise ValueError(f"{unquote(r['path'])}: {r['problem']}")
        groups.setdefault(r["header"], []).append(unquote(r["path"]))
    out = None
    for header in sorted(groups):
        rows = read_group(spark, groups[header], header, sep, aliases, golden, malformed, extra)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=extra)
    return out


def ingest_csv(spark: SparkSession, source: str | Sequence[str], sep: str = ",", glob: str | None = None,
               aliases: Mapping[str, str] = R.HEADER_ALIASES, golden: Sequence[str] = R.GOLDEN_COLUMNS,
               malformed: bool = False, extra: bool = False) -> DataFrame:
    """All files under ``source``, harmonised to ``golden`` (all strings).

    ``malformed`` adds the whole line of each row that has more or fewer fields
    than its header (NULL for the others) and the file of every row; the row's
    fields are read as far as they go either way. (Spark refuses a query that reads
    no other column than the malformed line; select one more, or store the rows.)
    ``extra`` keeps the columns that no golden column takes, under their own names.
    """
    sources = [source] if isinstance(source, str) else list(source)
    out = ingest_csv_paths(spark, sources, sep, aliases, golden, glob, malformed, extra)
    if out is None:
        names = [*golden, *((MALFORMED, SOURCE_FILE) if malformed else ())]
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType(), True) for c in names]))
    return out


def write_csv_parts(df: DataFrame, path: str, layouts: Sequence[tuple[Sequence[str], Sequence[str | None]]],
                    part_col: str, sep: str = ",") -> None:
    """Write ``df`` as CSV in several header layouts (test input for drifting headers).

    ``layouts[i]`` = (header names, source column per header, or None for an
    empty column); rows go to layout ``part_col % len(layouts)``.
    """
    n = len(layouts)
    for i, (names, sources) in enumerate(layouts):
        cols = [(F.col(s) if s else F.lit(None).cast("string")).alias(f"h{j}") for j, s in enumerate(sources)]
        part = df.filter(F.pmod(F.col(part_col).cast("long"), F.lit(n)) == i).select(*cols)
        tmp = part.toDF(*names)
        (tmp.write.mode("overwrite").option("header", "true").option("sep", sep)
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .csv(f"{path.rstrip('/')}/layout={i}"))
