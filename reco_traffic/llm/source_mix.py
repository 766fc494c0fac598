"""Mixing sources to target weights.

The words of each source are summed; the wanted total is shared by weight, no
source above ``cap`` times its own size, the excess reshared among the rest.
The repetition rate of a source is target / size. Every document is emitted
floor(rate) times, plus one hash-seeded Bernoulli copy whose probability is
the rate's fraction. The draws are spread evenly: documents of one source and
size class stand in the order of a hash of their id, and the k-th gets a copy
where k * fraction + u passes a whole number, u being one uniform per source
and class. So each document's copy has the stated probability, while a
source's words miss its target by a few documents at most.

Only a table of sources and a table of (source, class, bucket) counts are
aggregated before rows move; the numbering runs inside hash buckets, so a
source with a third of all rows is spread over ``buckets`` tasks per class.

Nulls: null text has size 0; null source is a source of its own, last in
order; null doc_id hashes as a value of its own. Repeated rows each take part.
Empty tables give empty results. Other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def unit(text: F.Column) -> F.Column:
    """Uniform in [0, 1) from the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target): one row per source. ``sizes`` has source
    and size. The windows run over sources, never over documents."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    w = F.array(*[F.lit(float(x)) for x in weights])
    by = by.withColumn("_n", F.row_number().over(order)).withColumn("_w", F.element_at(w, ((F.col("_n") - 1) % len(weights) + 1).cast("int")))
    by = by.withColumn("_cap", F.col("source_size") * F.lit(float(cap))).withColumn("_total", F.sum("source_size").over(every) * F.lit(float(share)))
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    by = by.withColumn("_before", F.sum("_cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)))
    by = by.withColumn("_rest", F.sum("_w").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    by = by.withColumn("_level", (F.col("_total") - F.coalesce("_before", F.lit(0.0))) / F.col("_rest"))
    by = by.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_n"), F.col("_level").alias("x")))).over(every)["x"])
    return by.select("source", "source_size", F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_level") * F.col("_w"))).alias("target"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 8, buckets: int = 256, keep=None) -> DataFrame:
    """Every row of docs, its columns (or those of ``keep``) as struct ``row``,
    with size, source_size, target and copies."""
    d = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), F.col("source"),
                    F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                    F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")).alias("_u"))
    d = d.withColumn("_class", F.length(F.bin("size"))).withColumn("_bucket", F.pmod(F.conv(F.substring("_u", 1, 4), 16, 10).cast("int"), F.lit(buckets)))
    counts = d.groupBy("source", "_class", "_bucket").agg(F.count("*").alias("_rows"), F.sum("size").alias("size"))
    targets = source_targets(counts.select("source", "size"), weights, share, cap).withColumnRenamed("source", "_s")
    before = Window.partitionBy("source", "_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    known = offsets.join(targets.withColumnRenamed("_s", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = known.withColumn("_rate", rate).withColumn("_v", unit(F.concat(F.lit(f"{seed}/"), F.coalesce("_s", F.lit("")), F.lit("/"), F.col("_c").cast("string")).cast("binary")))
    place = Window.partitionBy("source", "_class", "_bucket").orderBy("_u", "size")
    d = d.withColumn("_k", F.row_number().over(place) - 1)
    d = d.join(known, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")) & (F.col("_bucket") == F.col("_b")))
    k, part = F.col("_base") + F.col("_k"), F.col("_rate") - F.floor("_rate")
    extra = F.floor((k + 1) * part + F.col("_v")) - F.floor(k * part + F.col("_v"))
    return d.select("row", "size", "source_size", "target", (F.floor("_rate") + extra).cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: rows of docs, each as often as the plan says."""
    plan = mix_plan(docs, **options)
    return plan.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mix_plan(docs, keep=("doc_id",))
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
             md5('8:' || coalesce(doc_id::varchar, 'null')) as u from documents),
c as (select *, length(bin(size)) as class from d),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as n from c group by source),
w as (select *, [3.0, 1.0, 2.0][((n - 1) % 3 + 1)::int]::double as w, source_size * 2.0::double as cap, (sum(source_size) over ()) * 1.5::double as total from s),
l as (select *, (total - coalesce(sum(cap) over (order by cap / w, n rows between unbounded preceding and 1 preceding), 0.0))
             / sum(w) over (order by cap / w, n rows between current row and unbounded following) as level from w),
m as (select (arg_min(level, (cap / w, n)) filter (where level <= cap / w)) as level from l),
t as (select source, source_size, case when m.level is null then cap else least(cap, m.level * w) end as target from l, m),
r as (select source, source_size, target, case when source_size > 0 then target / source_size else 0.0 end as rate from t),
k as (select c.*, row_number() over (partition by source, class order by ('0x' || u[1:4])::bigint % 256, u, size) - 1 as k from c),
j as (select k.*, r.source_size, r.target, r.rate, r.rate - floor(r.rate) as part,
        ('0x' || md5('8/' || coalesce(k.source, '') || '/' || k.class)[1:13])::bigint / 4503599627370496.0::double as v
      from k join r on k.source is not distinct from r.source)
select doc_id, size, source_size, target, (size * (floor(rate) + floor((k + 1) * part + v) - floor(k * part + v)))::bigint as taken from j
"""
