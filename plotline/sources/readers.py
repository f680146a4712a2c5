"""Sources S1-S9: every read has a fixed schema and runs in parallel.

Article texts are read once as whole files in a parallel scan and joined
to the labels (J1), never opened per row.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotline.functions import labels as L
from plotline.sources import schemas


#: Options of the quoted TSV reader: like Python's csv reader, "" inside a
#: quoted field is one quote.
QUOTED_TSV = {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": "\u0000"}
#: What a null cell is written as; a text of backslashes and N gets one backslash
#: more (``escaped_cell``), so that it is not taken for null.
NULL_CELL = "\\N"
#: Options of CSV records, for reading and writing alike: multi-line quoted cells,
#: "" inside a quoted cell is one quote, white space is kept. Null, an empty and a
#: blank cell are three different things; an unquoted empty cell is null.
CSV_CELLS = {
    "escape": '"',
    "nullValue": NULL_CELL,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_RECORDS = {**CSV_CELLS, "multiLine": "true"}
#: Holds the raw record where a row can't be read as the schema says.
CORRUPT = "_corrupt_record"
_LIKE_NULL = r"^\\+N$"


def escaped_cell(c: Column) -> Column:
    """A text as it is written: see ``NULL_CELL``."""
    return F.when(c.rlike(_LIKE_NULL), F.concat(F.lit("\\"), c)).otherwise(c)


def unescaped_cell(c: Column) -> Column:
    return F.when(c.rlike(_LIKE_NULL), F.substring(c, F.lit(2), F.length(c))).otherwise(c)


def split_corrupt(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of rows with ``CORRUPT`` and ``file_path``: rejects
    are ``file_path, record, reason``. ``key`` is a column of the schema; reading it
    beside the raw record is what makes Spark keep the record."""
    # reads ``key`` too, and is no test that Spark hands to the parser, which would
    # apply it before the raw record is set
    bad = F.coalesce(F.col(CORRUPT), F.substring(key, 1, 0), F.lit("")) != ""
    rejects = df.where(bad).select("file_path", F.coalesce(F.col(CORRUPT), F.col(key)).alias("record"), F.col(key).alias("first"))
    reason = F.when(F.col("first").isNull(), F.lit("no field can be read")).otherwise(F.lit("does not fit the schema"))
    return df.where(~bad).drop(CORRUPT), rejects.select("file_path", "record", reason.alias("reason"))


def annotation_fields(line) -> list[F.Column]:
    """``article_id, narrative, subnarrative, more`` of a raw TSV line:
    quotes are literal, an absent cell is null, an empty one stays empty."""
    fields = F.split(line, "\t", -1)
    cells = [F.get(fields, F.lit(k)).alias(c) for k, c in enumerate(schemas.ANNOTATION.names)]
    return [*cells, F.slice(fields, F.lit(4), F.greatest(F.size(fields) - 3, F.lit(0))).alias("more")]


def read_annotations(spark: SparkSession, path, quoted: bool = False, recursive: bool = False) -> DataFrame:
    """TSV ``article_id, narrative, subnarrative`` without a
    header. ``quoted=False`` keeps ``"`` literal and every field (line
    reader; fields after the third are in ``more``, an absent cell is null,
    an empty one stays empty), ``True`` lets quotes group a field (CSV reader
    with tab). With ``recursive``,
    ``path`` is a folder searched for ``subtask-2-annotations.txt``; the
    language comes from the path (P13). Adds ``file_path`` and ``language``.
    """
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", True).option("pathGlobFilter", "subtask-2-annotations.txt")
    fp = F.col("_metadata.file_path")
    if quoted:
        df = r.schema(schemas.ANNOTATION).option("header", False).options(**QUOTED_TSV).csv(path)
    else:
        df = r.text(path).where(F.col("value") != "").select(*annotation_fields(F.col("value")), "_metadata")
    rel = fp
    if recursive and isinstance(path, str):
        # language from the path below the searched folder, not from the
        # folder's own location
        # (file paths are URI-encoded there)
        below = F.get(F.split(fp, re.escape(quote(path.rstrip("/"), safe="/:")) + "/", 2), 1)
        rel = F.coalesce(below, fp)
    return df.select("*", fp.alias("file_path"), L.language_of(rel).alias("language")).drop("_metadata")


def read_articles(spark: SparkSession, root: str) -> DataFrame:
    """``{root}/{release}/{lang}/raw-documents/{article_id}`` -> one row
    per file ``release, lang, article_id, content``."""
    df = spark.read.text(f"{root.rstrip('/')}/*/*/raw-documents/*", wholetext=True)
    fp = F.col("_metadata.file_path")
    pat = r"([^/]+)/([^/]+)/raw-documents/([^/]+)$"
    return df.select(
        F.regexp_extract(fp, pat, 1).alias("release"),
        F.regexp_extract(fp, pat, 2).alias("lang"),
        F.col("_metadata.file_name").alias("article_id"),
        F.col("value").alias("content"),
    )


def read_jsonl(spark: SparkSession, path, schema=schemas.NESTED_RECORD) -> DataFrame:
    """JSON lines with a fixed schema. A line that is no such record becomes
    nulls; ``read_jsonl_checked`` sets those lines apart."""
    return spark.read.schema(schema).json(path)


def parsed_lines(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines (``value, file_path``) -> ``(records, rejects)``: every line that
    is not blank is in one of them. Rejects: ``file_path, record, reason``."""
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    r = F.from_json("value", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.where(F.trim("value") != "").withColumn("__r", r)
    none = F.col("__r").isNull()
    bad = none | F.col(f"__r.{CORRUPT}").isNotNull()
    # nothing of the record but its raw text was read
    blank = F.lit(True)
    for c in schema.names:
        blank = blank & F.col(f"__r.`{c}`").isNull()
    reason = F.when(none | blank, F.lit("no field can be read")).otherwise(F.lit("does not fit the schema"))
    rejects = rows.where(bad).select("file_path", F.col("value").alias("record"), reason.alias("reason"))
    return rows.where(~bad).select(*[F.col(f"__r.`{c}`").alias(c) for c in schema.names]), rejects


def read_jsonl_checked(spark: SparkSession, path, schema=schemas.NESTED_RECORD) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of JSON lines; see ``parsed_lines``."""
    return parsed_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path")), schema)


def read_quoted_checked(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of a quoted annotation TSV: lines with fewer or
    more fields than three are rejects."""
    schema = T.StructType([*schemas.ANNOTATION.fields, T.StructField(CORRUPT, T.StringType())])
    # all fields are parsed whatever is selected: pruned, a line's length goes unseen
    options = {**QUOTED_TSV, "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
    df = spark.read.schema(schema).options(**options).csv(path)
    return split_corrupt(df.withColumn("file_path", F.col("_metadata.file_path")), "article_id")


def headers(spark: SparkSession, path, pattern: str | None = None) -> dict[tuple[str, ...], list[str]]:
    """The header of every file below ``path``: names -> files that have it. One
    scan of the lines, without parsing; a row for each file comes to the driver,
    which plans a read for each distinct header."""
    r = spark.read
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    lines = r.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    # lines of a split keep their order, and a file's first split starts at 0
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("value"))
    out: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file_path").toLocalIterator():
        names = tuple(next(csv.reader([row["value"].lstrip("\ufeff")]), []))
        # the path as a reader takes it: not URI-encoded, without glob characters
        plain = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(row["file_path"]))
        out.setdefault(names, []).append(plain)
    return out


def read_csv_by_name(
    spark: SparkSession, path, schema: T.StructType, pattern: str | None = None, extra: bool = False
) -> DataFrame:
    """CSV files whose columns go by the names in their headers, in any
    order; files with different headers are stacked by name. A column that a file
    lacks is null, one that the schema lacks is left out (``extra``: kept, as
    text). Adds ``file_path``."""
    known = {f.name: f.dataType for f in schema.fields}
    out = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file_path", T.StringType())]))
    for names, paths in headers(spark, path, pattern).items():
        if len(set(names)) < len(names):
            raise ValueError(f"a column is named twice in {paths[0]}: {names}")
        own = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
        df = spark.read.schema(own).option("header", True).options(**CSV_RECORDS).csv(paths)
        df = df.withColumn("file_path", F.col("_metadata.file_path"))
        texts = {n: unescaped_cell(F.col(f"`{n}`")) for n in names if isinstance(known.get(n, T.StringType()), T.StringType)}
        keep = [n for n in names if extra or n in known]
        cells = [texts.get(n, F.col(f"`{n}`")).alias(n) for n in keep]
        out = out.unionByName(df.select(*cells, "file_path"), allowMissingColumns=True)
    return out


def file_name(path: str = "file_path") -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_csv_records(spark: SparkSession, path, schema=schemas.FLAT_RECORD) -> DataFrame:
    """CSV with header and multi-line quoted cells, columns by name;
    ``fold_file`` keeps the source file name."""
    return read_csv_by_name(spark, path, schema).withColumn("fold_file", file_name()).drop("file_path")


def read_fold_files(
    spark: SparkSession, folder: str, schema=schemas.FOLD_PREDICTION, pattern: str = "fold*_predictions.csv"
) -> DataFrame:
    """Every ``fold{i}_predictions.csv`` of a folder, stacked by column
    name, with ``fold`` taken from the file name. A file may be a folder of part
    files of that name, as ``write_csv`` makes it."""
    df = read_csv_by_name(spark, f"{folder.rstrip('/')}/{pattern}", schema)
    number = re.escape(pattern).replace(r"\*", r"(\d+)", 1)
    fold = F.regexp_extract("file_path", f"{number}(?:/[^/]*)?$", 1).cast("int")
    return df.withColumn("fold", fold).drop("file_path")


def read_class_list(spark: SparkSession, path) -> DataFrame:
    """One class per line; blank lines dropped (Q10)."""
    return spark.read.text(path).select(F.col("value").alias("class")).where(F.trim("class") != "")


def parse_struct(df: DataFrame, col: str, schema=schemas.LABELS, literal: bool = False) -> DataFrame:
    """A nested column kept as text back to a struct: JSON or, with
    ``literal``, a Python literal (``labels.literal_to_json``). Text that is
    neither gives null."""
    text = L.literal_to_json(col) if literal else F.col(col)
    return df.withColumn(col, F.from_json(text, schema))


def read_entity_mentions(spark: SparkSession, path) -> DataFrame:
    """Entity mention TSV (schema only; no job reads it)."""
    return spark.read.schema(schemas.ENTITY_MENTION).option("sep", "\t").option("quote", "").csv(path)


def join_articles(lines: DataFrame, articles: DataFrame, keys=("article_id",)) -> DataFrame:
    """J1 + P1: attach quote-normalised content; ``content`` stays null for
    labels without an article (see ``missing_articles``)."""
    a = articles.select(*keys, L.normalize_quotes("content").alias("content"))
    return lines.join(a, list(keys), "left")


def missing_articles(joined: DataFrame) -> DataFrame:
    """Labels whose article text is missing (the reference fails on them)."""
    return joined.where(F.col("content").isNull())


def read_results(spark: SparkSession, path: str) -> DataFrame | None:
    """A results table that may not exist yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # nothing written yet
            return None
        raise
