"""Shards of near equal size by sampled splitters.

Every record has a key: a hash of its text, then one of its id, then its row's
number. A sample of keys, each drawn with a probability in proportion to the
record's weight, gives quantile boundaries; records are partitioned by those
ranges, and a range that turns out overfull is sampled again, more densely, and
subdivided. Copies of one text are neighbours in the order of keys, but the id
follows in the key, so a text that a third of all rows repeat is cut like any
other stretch. A record that alone weighs over 1/64 of a shard is a range that
can't be subdivided; there are at most 64 per shard of those, and they go, the
heaviest first, to the shard that is lightest then. All other records fill the
shards up to one level in the order of their keys: record counts and weights are
summed per range, and positions inside a range are counted in that range's task.

The law ``bytes`` weighs a record by its text's UTF-8 bytes plus 16, so shards
differ by 1/32 of a shard at most as long as no single record exceeds one; the
law ``rows`` weighs each by 1, so counts differ by one at most. Samples steer
only the work: the result is the same for any sample.

DataFrame functions only. The texts are read once; rows of key and size are
written under spark.checkpoint.dir. The driver sees the splitters (at most
``MAX_RANGES`` and what overfull ranges need) and one load per shard.

Nulls: null text is empty with 0 bytes; null doc_id is a value of its own.
Repeated rows each take a slot. Empty tables give empty results. Other columns,
whatever their names, are carried along where ``keep`` names them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 40
EXTRA = 16
GRAIN = 64
RANGE_ROWS = 1 << 18
MIN_RANGES, MAX_RANGES = 64, 1 << 16
DRAWS = 16
OVERFULL = 4


def heads(docs: DataFrame, law: str, keep) -> DataFrame:
    """One row per record: the kept columns as ``row``, size, text_crc32, its
    weight under the law and its key, different for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    part = lambda c: F.substring(F.md5(c.cast("binary")), 1, 16)
    number = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    key = F.concat(part(text), part(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), number)
    size = F.octet_length(text).cast("long") + EXTRA
    return docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), size.alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       (size if law == "bytes" else F.lit(1).cast("long")).alias("weight"), key.alias("key"))


def below(marks: list, value: F.Column, kind: str) -> F.Column:
    """How many of the sorted ``marks`` are <= value, by binary search; the
    marks are one constant of the plan."""
    if not marks:
        return F.lit(0)
    table = F.split(F.lit(",".join(str(m) for m in marks)), ",").cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(marks).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.try_element_at(table, at + s) <= value, at + s).otherwise(at))


def quantiles(sample: DataFrame, draws: int) -> list[str]:
    """Every ``draws``-th key of a bounded sample."""
    n = F.row_number().over(Window.orderBy("key"))
    return [r["key"] for r in sample.select("key", n.alias("n")).where(F.col("n") % draws == 0).orderBy("key").collect()]


def splitters(records: DataFrame, rows: int, weight: int, range_rows: int = RANGE_ROWS, draws: int = DRAWS) -> list[str]:
    """Boundaries between ranges of near equal weight; no range holds more than
    ``OVERFULL`` times its share of weight or of rows."""
    n = max(MIN_RANGES, min(MAX_RANGES, -(-rows // range_rows)))
    luck = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    found = quantiles(records.where(luck < F.col("weight") * F.lit(n * draws / max(1, weight))), draws)
    for again in range(12, 44):
        cell = records.groupBy(below(found, F.col("key"), "string").alias("range")).agg(F.count("*").alias("rows"), F.sum("weight").alias("weight"))
        parts = F.greatest(F.ceil(F.col("rows") * n / rows), F.ceil(F.col("weight") * n / weight))
        over = cell.where((parts > OVERFULL) & (F.col("rows") > draws)).select("range", (parts * draws / F.col("rows")).alias("rate"))
        if not rows or not over.take(1):
            break
        luck = F.pmod(F.xxhash64("key", F.lit(again)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        inner = records.withColumn("range", below(found, F.col("key"), "string")).join(F.broadcast(over), "range")
        more = quantiles(inner.where(luck < F.col("rate")), draws)
        found = sorted({*found, *more})
    return found


def dealt(heavy: DataFrame, shards: int) -> DataFrame:
    """(key, weight, shard, slot): the few heavy records, the heaviest first,
    each to the lightest shard."""
    order = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "key")))
    pick = F.expr(f"""aggregate(heavy, named_struct('loads', array_repeat(0L, {shards}), 'at', cast(array() as array<int>)),
        (a, x) -> named_struct(
            'loads', transform(a.loads, (l, i) -> if(i = array_position(a.loads, array_min(a.loads)) - 1, l - x.w, l)),
            'at', concat(a.at, array(cast(array_position(a.loads, array_min(a.loads)) - 1 as int)))),
        a -> a.at)""")
    one = heavy.agg(order.alias("heavy")).select("heavy", pick.alias("at"))
    each = one.select(F.posexplode(F.arrays_zip("heavy", "at")).alias("n", "x"))
    slot = F.row_number().over(Window.partitionBy("x.at").orderBy("n")) - 1
    return each.select(F.col("x.heavy.key").alias("key"), (-F.col("x.heavy.w")).alias("weight"), F.col("x.at").alias("shard"), slot.cast("long").alias("slot"))


def thresholds(loads: list[int], rest: int) -> tuple[int, list[int]]:
    """(k, marks): loads are filled up to one level with ``rest`` more; marks
    are where a shard's share ends in the order of keys, in k-ths."""
    low, total, k, level = sorted(loads), 0, 1, 0
    for i, x in enumerate(low, 1):
        total += x
        if rest + total >= i * x:
            k, level = i, rest + total
    marks, at = [], 0
    for x in loads:
        at += max(0, level - k * x)
        marks.append(at)
    return k, marks[:-1]


def shard(docs: DataFrame, shards: int = SHARDS, law: str = "bytes", keep=None, range_rows: int = RANGE_ROWS, draws: int = DRAWS) -> DataFrame:
    """Every row of docs, its columns (or those of ``keep``) as struct ``row``,
    with size, text_crc32, shard (from 0) and slot (gapless from 0 in it)."""
    if law not in ("bytes", "rows"):
        raise ValueError(f"law {law}")
    every = written(heads(docs, law, keep or docs.columns), "shard_heads")
    rows, total = every.agg(F.count("*"), F.coalesce(F.sum("weight"), F.lit(0))).first()
    alone = F.col("weight") * (shards * GRAIN) > total
    heavy = written(dealt(every.where(alone).select("key", "weight"), shards), "shard_heavy")
    loads = [0] * shards
    first = [0] * shards
    for r in heavy.groupBy("shard").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect():
        loads[r["shard"]], first[r["shard"]] = r["w"], r["n"]
    rest = total - sum(loads)
    light = every.where(~alone)

    marks = splitters(light.select("key", "weight"), rows - sum(first), rest, range_rows, draws)
    light = light.withColumn("range", below(marks, F.col("key"), "string"))
    inside = Window.partitionBy("range").orderBy("key")
    light = light.withColumn("n", F.row_number().over(inside) - 1).withColumn("at", F.sum("weight").over(inside) - F.col("weight"))
    cell = every.where(~alone).groupBy(below(marks, F.col("key"), "string").alias("range")).agg(F.count("*").alias("rows"), F.sum("weight").alias("sum"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = cell.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("at0"))
    light = light.join(F.broadcast(base), "range")
    k, ends = thresholds(loads, rest)
    middle = (2 * (F.col("at") + F.col("at0")) + F.col("weight")) * k
    light = light.select("row", "size", "text_crc32", (F.col("n") + F.col("n0")).alias("n"), below([2 * e for e in ends], middle, "long").alias("shard"))
    light = written(light, "shard_places")
    start = light.groupBy("shard").agg(F.min("n").alias("start")).withColumn("skip", F.element_at(F.array(*[F.lit(x) for x in first]), F.col("shard") + 1))
    light = light.join(F.broadcast(start), "shard").select("row", "size", "text_crc32", "shard", (F.col("n") - F.col("start") + F.col("skip")).cast("long").alias("slot"))
    heavy = every.where(alone).join(F.broadcast(heavy.drop("weight")), "key").select("row", "size", "text_crc32", "shard", "slot")
    return light.unionByName(heavy)


def query(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=("doc_id",))
    return out.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
