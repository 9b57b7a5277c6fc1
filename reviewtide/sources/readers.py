"""Readers. Schemas are given, so no file is scanned just to guess types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewtide.functions.repair import repair_python_literal
from reviewtide.schemas import LAKE, REJECT, Fields, ddl, names

CORRUPT = "_corrupt_record"
NOT_JSON = "not JSON"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def repair_python_json(lines: DataFrame, column: str = "value", mode: str = "blind") -> DataFrame:
    return lines.withColumn(column, repair_python_literal(F.col(column), mode))


def parse_json_lines(lines: DataFrame, fields: Fields, column: str = "value") -> DataFrame:
    """Parse JSON lines; ``_corrupt_record`` holds a line that does not parse.

    A filter over a plain ``from_json`` would be pushed into it and prune the fields
    it checks, so that wrongly typed values pass, and every line would be parsed
    twice. The generator keeps the parse whole and single. It also leaves out blank
    lines, which parse to null: a filter on the line would repeat its repair.
    """
    schema = f"{ddl(fields)}, `{CORRUPT}` string"
    record = F.from_json(column, schema, {"columnNameOfCorruptRecord": CORRUPT})
    return lines.select(F.inline(F.array_compact(F.array(record))))


def drop_malformed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def count_malformed(parsed: DataFrame) -> DataFrame:
    """One row: ``records`` parsed and ``dropped`` as malformed."""
    return parsed.agg(*_malformed_counts())


def _malformed_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("records"), F.count(CORRUPT).alias("dropped")]


def read_dirty_json(
    spark: SparkSession,
    path: str,
    fields: Fields,
    mode: str = "blind",
    observation: Observation | None = None,
) -> DataFrame:
    """Text scan, repair and parse in one plan, without repaired copies on disk.

    ``observation`` counts ``records`` and ``dropped`` while the first action runs.
    """
    lines = repair_python_json(read_text(spark, path), mode=mode)
    parsed = parse_json_lines(lines, fields)
    if observation is not None:
        parsed = parsed.observe(observation, *_malformed_counts())
    return drop_malformed(parsed)


def reject_reason(line: Column, fields: Fields) -> Column:
    """Why a repaired line does not parse: it is no JSON, or which fields have another type."""
    wrong = []
    for name, type_ in fields:
        alone = F.from_json(
            line, f"`{name}` {type_}, `{CORRUPT}` string", {"columnNameOfCorruptRecord": CORRUPT}
        )
        wrong.append(F.when(alone[CORRUPT].isNotNull(), F.lit(name)))
    listed = F.array_join(F.array_compact(F.array(*wrong)), ", ")
    is_json = F.from_json(line, "map<string,string>").isNotNull()
    return F.when(is_json, F.concat(F.lit("wrong type: "), listed)).otherwise(F.lit(NOT_JSON))


def read_dirty_json_whole(
    spark: SparkSession,
    path: str,
    fields: Fields,
    mode: str = "blind",
    observation: Observation | None = None,
) -> DataFrame:
    """Records and rejects side by side, from one scan: the fields, and of a line that does
    not parse the ``reject_line`` as it was read and the ``reject_reason``; both are null for
    records. Blank lines are neither.

    ``observation`` counts as in :func:`read_dirty_json`.
    """
    lines = read_text(spark, path).withColumn("_raw", F.col("value"))
    schema = f"{ddl(fields)}, `{CORRUPT}` string"
    record = F.from_json(
        repair_python_literal(F.col("value"), mode), schema, {"columnNameOfCorruptRecord": CORRUPT}
    )
    parsed = lines.select("_raw", F.inline(F.array_compact(F.array(record))))
    if observation is not None:
        parsed = parsed.observe(observation, *_malformed_counts())
    bad = F.col(CORRUPT).isNotNull()
    line, reason = names(REJECT)
    return parsed.withColumns(
        {line: F.when(bad, F.col("_raw")), reason: F.when(bad, reject_reason(F.col(CORRUPT), fields))}
    ).drop("_raw", CORRUPT)


def records_of(whole: DataFrame) -> DataFrame:
    reason = names(REJECT)[1]
    return whole.filter(F.col(reason).isNull()).drop(*names(REJECT))


def rejects_of(whole: DataFrame) -> DataFrame:
    reason = names(REJECT)[1]
    return whole.filter(F.col(reason).isNotNull()).select(names(REJECT))


def read_json(spark: SparkSession, path: str, fields: Fields, malformed: str = "PERMISSIVE") -> DataFrame:
    """JSON files under an explicit schema; ``malformed`` is a Spark parse mode."""
    return spark.read.schema(ddl(fields)).option("mode", malformed).json(path)


def read_csv(spark: SparkSession, path: str, fields: Fields | None = None) -> DataFrame:
    """CSV with a header, all strings. Given ``fields`` are checked against the header."""
    reader = spark.read.option("header", True)
    if fields is not None:
        reader = reader.schema(ddl(fields)).option("enforceSchema", False)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, fields: Fields | None = None) -> DataFrame:
    reader = spark.read if fields is None else spark.read.schema(ddl(fields))
    return reader.parquet(path)


def read_lake(spark: SparkSession, path: str, fields: Fields = LAKE) -> DataFrame:
    """The partitioned lake. The schema keeps a category such as ``007`` a string."""
    return spark.read.schema(ddl(fields)).parquet(path).select(names(fields))


def read_folders(
    spark: SparkSession, base: str, folders: Iterable[str], fields: Fields
) -> DataFrame:
    """Some of the folders below ``base``; what their names say (``a=b``) are columns.

    No other folder is listed. A filter on such a column still picks folders.
    """
    paths = [f"{base}/{folder}" for folder in folders]
    if not paths:
        return spark.createDataFrame([], ddl(fields))
    return spark.read.schema(ddl(fields)).option("basePath", base).parquet(*paths).select(names(fields))


def read_lake_values(spark: SparkSession, path: str, fields: Fields = LAKE) -> DataFrame:
    """The lake with each row's own category, null or '', as ``categoryValue``.

    A filter on ``category`` still picks folders.
    """
    return spark.read.schema(f"{ddl(fields)}, categoryValue string").parquet(path)
