"""Sinks: stored tables, search documents keyed by id, JSON event messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",  # noqa: A002
    options: dict | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Overwrite (by default) a named collection. Each task writes its own
    files and the job commits atomically, so a lost executor's task is simply
    re-run."""
    w = df.write.mode(mode).format(format)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep one row per key: the greatest row (deterministic). Keys are counted
    first, by hash and with partial sums; only rows of keys that occur twice or
    more are compared (a maximum over structs sorts its input)."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    n = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    counted = df.join(n, F.col(key).eqNullSafe(F.col("_k"))).drop("_k")
    again = counted.where("_n > 1").groupBy(key).agg(F.max(F.struct(*others)).alias("_row")).select(key, "_row.*")
    return counted.where("_n = 1").select(key, *others).unionByName(again)


def write_search_docs(
    df: DataFrame,
    path: str,
    id_col: str,
    format: str = "json",  # noqa: A002
    options: dict | None = None,
    mode: str = "overwrite",
    dedupe: bool = True,
) -> None:
    """Overwrite a document index whose document id is ``id_col``.

    A search index keeps one document per id, so rows are made unique on the
    key first. With a search-engine connector pass its format and options
    (the id mapping option is set from ``id_col``); offline, JSON documents.
    """
    docs = one_row_per_key(df, id_col) if dedupe else df
    opts = dict(options or {})
    if "elasticsearch" in format:
        opts.setdefault("es.mapping.id", id_col)
    write_table(docs, path, format=format, options=opts, mode=mode)


def to_event_json(df: DataFrame, columns: Sequence[str] | None = None, as_strings: bool = True) -> DataFrame:
    """One JSON object per row in ``value``; with ``as_strings`` every value is
    sent as a JSON string, as the reference's producer does."""
    cols = list(columns or df.columns)
    fields = [(F.col(c).cast("string") if as_strings else F.col(c)).alias(c) for c in cols]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def write_event_json(
    df: DataFrame,
    path: str | None = None,
    format: str = "text",  # noqa: A002
    options: dict | None = None,
    columns: Sequence[str] | None = None,
    mode: str = "append",
) -> None:
    """Publish events as JSON messages: to a topic (``format="kafka"`` with
    ``topic``/``kafka.bootstrap.servers`` options) or to text files offline."""
    msgs = to_event_json(df, columns)
    w = msgs.write.format(format).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path) if path else w.save()
