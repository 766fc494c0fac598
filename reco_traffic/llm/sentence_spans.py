"""Substring dedup by sentence spans and by word windows.

A text is cut into sentences: a line end always ends one; ``.``, ``!`` or ``?``
before white space ends one of at least ``MIN_SENTENCE`` words; a sentence over
``MAX_SENTENCE`` words counts as several of that many words. Words are compared
in lower case. From every sentence on, and back from every sentence, the shortest
run of at least ``span`` sentences and ``min_words`` words is hashed and held
against the whole corpus.

These cuts depend on what stands before, so longer passages are also found word
by word: every window of ``WINDOW`` words that stands at an earlier place is
repeated, wherever it begins and whatever marks it holds. Not all windows are
hashed. Of the runs of ``GRAM`` words inside a window the one with the smallest
hash is its mark; equal windows have equal marks, so only marks that stand at two
places matter. Places of a mark with the same words around it (all that any
window with this mark can hold) are settled at once; only where these differ, at
the ends of passages, are the windows of one place of each kind compared.

The first place of a span or window, by (doc_id, position), stays; words covered
by any other are removed, also within one document, where a window that overlaps
its first place goes only as far as it lies behind it. So a passage of over 50
words is removed whole, at any offset in a line; a shorter one only where it holds
a span of sentences. Fewer than ``MIN_SENTENCE`` words that a run of windows
reaches past a line end, into a line it does not cover to its other end, stay:
they are equal by chance more often than not.

Places are counted with partial sums and travel as (hash, document, position);
texts are read a second time for those windows.

Null and empty texts have no spans and stay as they are. Rows are named by
(doc_id, hash of id and text): rows that repeat both are one document and are
treated alike; a null doc_id comes first in order. Other columns pass through,
whatever their names: a row travels as one struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_scratch
from .common import IS_WORD, U, chunks, i64, keyed, prefix_hash, range_hash, split_words, text_buffers, word_hashes, written, written_at

SPAN, MIN_WORDS = 3, 30
MIN_SENTENCE, MAX_SENTENCE = 4, 16
WINDOW, GRAM = 51, 25
_LOW = (1 << 20) - 1
_END = np.zeros(256, bool)
_END[[46, 33, 63]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def sentences(raw: np.ndarray, off: np.ndarray):
    """(text, first word, end word) of every sentence, with the words' starts
    and ends."""
    low, ws, we, first = split_words(raw, off)
    n = len(ws)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none, low, ws, we
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    follow = np.append(raw[1:], np.uint8(32))
    last = np.zeros(len(raw), bool)
    last[off[1:][off[1:] > 0] - 1] = True
    stop = _END[raw] & (_SPACE[follow] | last)
    marks = lambda x: np.append(0, np.cumsum(x))
    gap_to = np.append(ws[1:], len(raw))
    count = marks(stop)
    soft = count[gap_to] > count[we]  # a sentence mark between this word and the next
    count = marks(raw == 10)
    hard = count[gap_to] > count[we]
    hard[first[1:][first[1:] > first[:-1]] - 1] = True  # the end of a text
    # words since the last line end, then greedy sentences inside the line
    ends = np.flatnonzero(hard) + 1
    starts = np.append(0, ends[:-1])
    soft_at = np.flatnonzero(soft | hard) + 1
    out = []
    at = 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        i = a
        while at < len(soft_at) and soft_at[at] <= a:
            at += 1
        k = at
        while i < b:
            while k < len(soft_at) and soft_at[k] - i < MIN_SENTENCE and soft_at[k] < b:
                k += 1
            j = min(int(soft_at[k]), i + MAX_SENTENCE, b)
            out.append(j)
            i = j
            while k < len(soft_at) and soft_at[k] <= i:
                k += 1
    end = np.array(out)
    begin = np.append(0, end[:-1])
    return text[begin], begin, end, low, ws, we


def runs(text: np.ndarray, begin: np.ndarray, end: np.ndarray, span: int, min_words: int):
    """(first, last) sentence of every span, each once."""
    n = np.arange(len(text))
    last = np.maximum(np.searchsorted(end, begin + min_words), n + span - 1)
    on = last < len(text)
    ahead = n[on], last[on]
    first = np.minimum(np.searchsorted(begin, end - min_words, "right") - 1, n - span + 1)
    back = first[first >= 0], n[first >= 0]
    a, b = (np.concatenate(x) for x in zip(ahead, back))
    same = text[a] == text[b]
    pair = np.unique(a[same] * (len(text) + 1) + b[same])
    return pair // (len(text) + 1), pair % (len(text) + 1)


def marks(prefix: np.ndarray, first: np.ndarray):
    """(window, mark): the first word of every window, and of the run of GRAM
    words with the smallest hash in it: the first of equal ones. Of the hash the
    upper 44 bits count."""
    width = WINDOW - GRAM + 1  # runs in a window
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.arange(max(len(prefix) - GRAM, 0))
    place = (start - first[text[: len(start)]]) & _LOW
    low = (range_hash(prefix, start, start + GRAM) & ~U(_LOW)) | place.astype(U)
    step = 1
    while step < width and len(low):
        move = min(step, width - step)
        low = np.minimum(low[:-move], low[move:])
        step += move
    at = np.flatnonzero(np.arange(len(low)) + WINDOW <= first[1:][text[: len(low)]])
    return at, at + (((low[at] & U(_LOW)).astype(np.int64) - place[at]) & _LOW)


def spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _h, at, n, hash, around): every span of docs (doc_id, _h, text):
    its first word and how many; and every mark, with n = 0 and a hash of the
    words around it."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                raw, off = text_buffers(part.column(2))
                text, begin, end, low, ws, we = sentences(raw, off)
                if not len(text):
                    continue
                first = np.searchsorted(ws, off)
                words = prefix_hash(word_hashes(low, ws, we))
                a, b = runs(text, begin, end, span, min_words)
                m = np.unique(marks(words, first)[1])
                row = np.concatenate([text[a], np.searchsorted(first, m, "right") - 1])
                at = np.concatenate([begin[a], m])
                n = np.concatenate([end[b] - begin[a], np.zeros(len(m), np.int64)])
                order = np.lexsort((at, row))
                row, at, n = row[order], at[order], n[order]
                code = range_hash(words, at, at + np.where(n > 0, n, GRAM))
                around = range_hash(words, np.maximum(at - (WINDOW - GRAM), first[row]), np.minimum(at + WINDOW, first[row + 1]))
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array((at - first[row]).astype(np.int32)), pa.array(n.astype(np.int32)), i64(code), i64(np.where(n > 0, U(0), around))], names=["doc_id", "_h", "at", "n", "hash", "around"])

    return docs.select(F.col("doc_id").cast("long"), "_h", "text").mapInArrow(run, "doc_id long, _h long, at int, n int, hash long, around long")


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, at, hash): the windows of docs (doc_id, _h, text, _marks) that
    have one of its marks."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                raw, off = text_buffers(part.column(2))
                low, ws, we, first = split_words(raw, off)
                words = prefix_hash(word_hashes(low, ws, we))
                lists = part.column(3)
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                mark = first[row] + lists.flatten().to_numpy()
                at, own = marks(words, first)
                at = at[np.isin(own, mark)]
                row = np.searchsorted(first, at, "right") - 1
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array((at - first[row]).astype(np.int32)), i64(range_hash(words, at, at + WINDOW))], names=["doc_id", "_h", "at", "hash"])

    return docs.select("doc_id", "_h", "text", "_marks").mapInArrow(run, "doc_id long, _h long, at int, hash long")


def later(places: DataFrame, name: str, *keys: str) -> DataFrame:
    """Of (doc_id, _h, at, ...), those that are not the first of their keys, with
    ``first``. Both sides are written, so that Spark can split a key with very
    many places over tasks in the join."""
    first = places.groupBy(*keys).agg(F.min(F.struct("doc_id", "_h", "at")).alias("first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return places.join(written(first, name), [*keys]).where(~F.struct("doc_id", "_h", "at").eqNullSafe(F.col("first")))


def repeated(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _h, at, n, span): the words of the non-first places of every
    repeated span (span is true) and window; at and n may reach past the text."""
    docs = keyed(docs, "text").select(F.col("doc_id").cast("long"), "_h", "text")
    found, path = written_at(spans(docs, span, min_words), "spans")
    twice = written(found.groupBy("hash").count().where("count > 1").select("hash"), "twice")
    again = written(found.join(twice, "hash"), "again")
    remove_scratch(docs.sparkSession, path)  # the largest table; from here on, its repeated part is enough
    spans_ = later(again.where("n > 0"), "first", "hash").select("doc_id", "_h", "at", "n", F.lit(True).alias("span")).distinct()

    at = again.where("n = 0")
    same = later(at, "first", "hash", "around")
    # one place of each kind, of marks with several
    kinds = written(at.groupBy("hash", "around").agg(F.min(F.struct("doc_id", "_h", "at")).alias("first")), "kinds")
    mixed = kinds.join(kinds.groupBy("hash").count().where("count > 1").select("hash"), "hash").select("first.*")
    mixed = mixed.groupBy("doc_id", "_h").agg(F.collect_set("at").alias("_marks")).toDF("_id", "_key", "_marks")
    ends = windows(docs.join(mixed, docs["doc_id"].eqNullSafe(mixed["_id"]) & (docs["_h"] == mixed["_key"])))
    ends = later(written(ends, "windows"), "first", "hash")

    def gone(rows, before):
        """From ``before`` words before at, but not into the first window."""
        own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_h") == F.col("first._h"))
        start = F.when(own, F.greatest(F.col("at"), F.col("first.at") + WINDOW)).otherwise(F.col("at")) - before
        rows = rows.select("doc_id", "_h", start.alias("_from"), (F.col("at") + WINDOW).alias("_to")).where("_from < _to")
        return rows.select("doc_id", "_h", F.col("_from").alias("at"), (F.col("_to") - F.col("_from")).alias("n"), F.lit(False).alias("span"))

    return spans_.unionByName(gone(same, WINDOW - GRAM)).unionByName(gone(ends, 0))


def cut(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, runs): the rows of docs, each as one struct, what stays of the
    text, and the byte ranges [start, end) removed, null where nothing is."""
    gone = repeated(docs, span, min_words).groupBy("doc_id", "_h").agg(F.collect_set(F.struct("at", "n", "span")).alias("_at"))  # of one document
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("_h").alias("_key"), "_at")
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
                    F.xxhash64(docs["doc_id"], docs["text"]).alias("_h"))
    d = d.join(gone, d["doc_id"].eqNullSafe(gone["_id"]) & (d["_h"] == gone["_key"]), "left")
    d = d.select("row", F.col("row")["text"].cast("string").alias("text"), "_at")  # the text moves once, inside its row
    ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                out = [without(t.as_py(), *(a.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))) for t, a in zip(part.column(1), part.column(2))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([r for _, r in out], ranges)], names=["row", "text", "runs"])

    # untouched rows need no Python
    kind = "array<struct<start: long, end: long>>"
    full = T.StructType([d.schema["row"], T.StructField("text", T.StringType()), T.StructField("runs", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    changed = d.where("_at is not null").mapInArrow(run, full)
    return d.where("_at is null").select("row", "text", F.lit(None).cast(kind).alias("runs")).unionByName(changed)


def remove(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows of docs with repeated passages taken out of text; n_chars, if
    there, is set anew where text changed."""
    row = F.col("row")
    new = {"text": F.when(F.col("runs").isNull(), row["text"]).otherwise(F.col("text").cast(docs.schema["text"].dataType))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("runs").isNull(), row["n_chars"]).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return cut(docs, span, min_words).select(*[new.get(c, row[c]).alias(c) for c in docs.columns])


def without(text: str, at, n, span):
    """The text without the words of the spans and windows (first word, number),
    and the byte ranges removed. A word reaches to the next one; what stands
    before the first word belongs to it."""
    raw = np.frombuffer(text.encode(), np.uint8)
    _, ws, _, _ = split_words(raw, np.array([0, len(raw)]))
    line = np.cumsum(raw == 10)[ws]
    at = at.astype(np.int64)

    def ranges(at, n):
        turn = np.zeros(len(ws) + 1, np.int64)
        np.add.at(turn, at, 1)
        np.add.at(turn, at + n, -1)
        turn = np.diff(np.concatenate([[0], (np.cumsum(turn)[:-1] > 0).astype(np.int8), [0]]))
        return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)

    to = np.minimum(at + n, len(ws))
    at = np.maximum(at, 0)
    n = to - at
    a, b = ranges(at[~span], n[~span])
    # a few words past a line end, of a line that goes on
    after = np.searchsorted(line, line[a], "right")
    a = np.where((a > 0) & (line[a - 1] == line[a]) & (after - a < MIN_SENTENCE), after, a)
    before = np.searchsorted(line, line[b - 1])
    b = np.where((b < len(ws)) & (line[np.minimum(b, len(ws) - 1)] == line[b - 1]) & (b - before < MIN_SENTENCE), before, b)
    a, b = ranges(np.concatenate([at[span], a]), np.concatenate([n[span], b - a]))
    edges = np.append(ws, len(raw))
    edges[0] = 0
    keep = np.ones(len(raw), bool)
    removed = [{"start": int(edges[i]), "end": int(edges[j])} for i, j in zip(a, b)]
    for r in removed:
        keep[r["start"] : r["end"]] = False
    return raw[keep].tobytes().decode(), removed


def query(spark, sf_dir: str) -> DataFrame:
    """One row per document: what stays of it and how much went."""
    out = cut(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    size = lambda c: F.octet_length(F.coalesce(F.col(c), F.lit(""))).cast("long")
    spans = F.when(F.col("runs").isNull(), F.lit(0)).otherwise(F.size("runs")).cast("long")
    return out.select("row.doc_id", size("row.text").alias("n_bytes"), (size("row.text") - size("text")).alias("n_removed"), spans.alias("n_spans"),
                      F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("kept_sha256"), "text")
