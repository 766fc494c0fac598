"""Readers: typed CSV inputs, stored tables narrowed to a schema, camera event
text, and the streaming message source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

ON_ERROR = ("fail", "drop")


def _check_on_error(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, got {on_error!r}")


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Keep rows where ``cond`` holds, evaluated on ``df``'s computed columns.

    A plain ``where`` after an expensive projection (JSON parse, split) is
    pushed below it by the optimizer with the expressions inlined, which
    evaluates the parse once more per condition. Expressing the filter as a
    generator (one-element array or NULL, then ``inline``) keeps it above the
    projection, so every parse runs once per row.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.inline(F.when(cond, F.array(row))))


def accept(df: DataFrame, ok: Column, message: Column, columns: Sequence[str], on_error: str) -> DataFrame:
    """``columns`` of the rows where ``ok`` holds. ``fail`` raises ``message``
    inside the task that meets the first other row; ``drop`` leaves such rows
    out (the ``split_*`` and ``*_with_rejects`` functions return them apart).

    The check sits in a generator. A projection would be pruned away when the
    caller selects other columns or only counts; a generator decides on the
    number of rows, so it runs whatever is selected.
    """
    _check_on_error(on_error)
    rows = F.array(F.struct(*[F.col(c) for c in columns]))
    if on_error == "drop":
        return df.select(F.inline(F.when(ok, rows)))
    kind = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in df.schema if f.name in columns]))
    order = [f.name for f in kind.elementType.fields]
    rows = F.array(F.struct(*[F.col(c) for c in order]))
    return df.select(F.inline(F.when(ok, rows).otherwise(F.raise_error(message).cast(kind)))).select(*columns)


def _all_present(required: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return cond


def require_columns(df: DataFrame, required: Sequence[str], on_error: str = "fail", what: str = "row") -> DataFrame:
    """Enforce non-NULL ``required`` columns: ``fail`` raises in the task that
    meets the first bad row, whatever is selected; ``drop`` leaves such rows
    out (``rejected_rows`` returns them)."""
    _check_on_error(on_error)
    if not required:
        return df
    names = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return accept(df, _all_present(required), F.concat(F.lit(f"{what}: required column is NULL: "), names), df.columns,
                  on_error)


def rejected_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that ``require_columns(..., on_error="drop")`` leaves out."""
    return keep_rows(df, ~_all_present(required))


CORRUPT = "_corrupt_record"


def _csv_lines(spark: SparkSession, path: str, schema: T.StructType, options: dict | None) -> DataFrame:
    """The declared fields and the raw text of records that don't parse. Every
    field is read whatever the caller selects: the checks below refer to all."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: Sequence[str] | None = None,
    on_error: str = "fail",
    options: dict | None = None,
) -> DataFrame:
    """Header CSV read positionally into ``schema`` (no inference).

    A record that doesn't convert, or lacks a required field (all by default;
    an empty field is NULL), fails the read (``fail``) or is left out
    (``drop``; ``read_csv_with_rejects`` returns it).
    """
    return read_csv_with_rejects(spark, path, schema, required, options)[0] if on_error == "drop" else _accepted(
        _csv_lines(spark, path, schema, options), schema, required, on_error, path)


def _accepted(df, schema, required, on_error, path):
    names = schema.fieldNames()
    ok = F.col(CORRUPT).isNull() & _all_present(names if required is None else required)
    shown = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*names)))
    return accept(df, ok, F.concat(F.lit(f"csv {path}: bad record: "), shown), names, on_error)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] | None = None,
                          options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): rejected has the raw record (``value``) and a
    ``reason``. Rows and rejected records together are all records."""
    df = _csv_lines(spark, path, schema, options)
    names = schema.fieldNames()
    ok = F.col(CORRUPT).isNull() & _all_present(names if required is None else required)
    bad = keep_rows(df, ~ok).select(
        F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*names))).alias("value"),
        F.when(F.col(CORRUPT).isNotNull(), "does not convert").otherwise("required field is empty").alias("reason"))
    return accept(df, ok, F.lit(""), names, "drop"), bad


def read_items_csv(spark: SparkSession, path: str, **kw) -> DataFrame:
    """(item_id, title, genres) from a header CSV; quoted commas are handled."""
    return read_csv_typed(spark, path, schemas.ITEMS, **kw)


def read_ratings_csv(spark: SparkSession, path: str, **kw) -> DataFrame:
    """(user_id, item_id, rating, ts) from a header CSV."""
    return read_csv_typed(spark, path, schemas.RATINGS, **kw)


def read_tags_csv(spark: SparkSession, path: str, **kw) -> DataFrame:
    """(user_id, item_id, tag, ts) from a header CSV."""
    return read_csv_typed(spark, path, schemas.TAGS, **kw)


def narrow(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the declared fields (column pruning reaches the scan)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    format: str = "parquet",  # noqa: A002
    options: dict | None = None,
) -> DataFrame:
    """A stored collection, narrowed to ``schema`` when given.

    ``format``/``options`` select the connector (parquet by default; a
    document-store connector works the same way when its jar is present).
    """
    reader = spark.read.format(format)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    return narrow(df, schema) if schema is not None else df


def _strip_quotes(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^'(.*)'$", "$1")


# Positions of the fields in a camera text line.
CAMERA_TEXT_FIELDS = {"camera_id": 0, "car_id": 2, "event_time": 4, "speed": 6, "road_id": 13}


def _camera_parts(lines: DataFrame, col: str) -> tuple[DataFrame, Column]:
    width = max(CAMERA_TEXT_FIELDS.values()) + 1
    body = lines.where(~F.coalesce(F.col(col).startswith(";"), F.lit(False))).select(
        F.split(F.col(col), ",").alias("_p"), F.col(col).alias("_raw"))
    typed = body.select(*[_strip_quotes(F.get("_p", i)).alias(n) for n, i in CAMERA_TEXT_FIELDS.items()],
                        (F.coalesce(F.size("_p"), F.lit(0)) >= width).alias("_ok"), "_raw")
    return typed, F.col("_ok")


def parse_camera_lines(lines: DataFrame, col: str = "value", on_error: str = "fail") -> DataFrame:
    """Comma-separated camera lines -> (camera_id, car_id, event_time, speed, road_id) strings.

    Lines starting with ';' are comments. A line with fewer than 14 fields
    fails the task (``fail``) or is left out (``drop``; ``split_camera_lines``
    returns it). Surrounding single quotes are stripped from every kept field.
    """
    typed, ok = _camera_parts(lines, col)
    message = F.concat(F.lit("camera line has too few fields: "), F.coalesce("_raw", F.lit("NULL")))
    return accept(typed, ok, message, list(CAMERA_TEXT_FIELDS), on_error)


def split_camera_lines(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, rejected): rejected holds the short lines, in column ``col``."""
    typed, ok = _camera_parts(lines, col)
    return (accept(typed, ok, F.lit(""), list(CAMERA_TEXT_FIELDS), "drop"),
            keep_rows(typed, ~ok).select(F.col("_raw").alias(col)))


def read_camera_text(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Camera event text file(s) -> string columns of ``parse_camera_lines``."""
    return parse_camera_lines(spark.read.text(path), "value", on_error)


def read_stream(
    spark: SparkSession,
    format: str = "text",  # noqa: A002
    options: dict | None = None,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    starting: str | None = None,
) -> DataFrame:
    """Subscribe to a stream of messages.

    ``format="kafka"`` with ``subscribe``/``kafka.bootstrap.servers`` options
    gives ``value`` as binary (cast to string here); ``starting`` maps to
    ``startingOffsets`` (``latest`` for ratings, ``earliest`` for cars in the
    reference). Offline, a file source (text / json / parquet directory) is
    used; ``maxFilesPerTrigger`` etc. pass through ``options``.
    """
    reader = spark.readStream.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    opts = dict(options or {})
    if starting:
        if format != "kafka":
            raise ValueError(f"starting={starting!r} needs format='kafka': a {format} source reads all files")
        opts.setdefault("startingOffsets", starting)
    for k, v in opts.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    if format == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"), "timestamp")
    return df
