"""Near-duplicate embeddings by a subspace pigeonhole join.

Vectors are scaled to length one and turned by a fixed random rotation, then
split into low-dimensional blocks. A cosine of ``threshold`` or more means a
squared distance of at most D = 2 - 2 * threshold; so in at least one block the
squared distance is within the block's share of D, proportional to its width.
Each block is joined by range: its first ``axes`` coordinates are cut into cells,
a vector stands in its own cell and probes every cell that its block radius
touches. Cells are counted first, and a crowded one is cut along as many further
coordinates of its block as its size asks for, so that more vectors mean smaller
cells. Inside a cell the vectors are split at medians, the probing ones going to
both sides within the radius, until few are left, and only those few are held
against the ones in reach: block distances decide on candidates, and the cosine
of the original vectors in double precision on links. A pair found in several
blocks counts only in the first block that holds it, so that links are counted
without ever listing or comparing the pairs of different tasks.

Equal vectors are collapsed first; they come back with their number. A cell
returns per vector its number of links and one edge that leads towards the
cell's smallest linked vector, not the pairs. A cell that is still crowded when
all coordinates are cut goes to several tasks, each with a part of its own and of
the probing vectors.

Vectors that are null, zero or hold null or non-finite components link with
nothing; they, and vectors of another width than the most common one, are their
own component. Rows with a null vec_id are returned with no links and a null
component. Rows repeating a vec_id: the vector smallest in order counts, and
one row is returned. Other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann_block import rows, safe_cosine, unit, usable
from .common import components, forest, written

THRESHOLD = 0.95
WIDTH = 8
AXES = 2
CELL = 3.0  # cell edge in block radii
CROWD = 32768
SHRINK = 2.0  # by how much one more coordinate is taken to thin out a cell
LEAF = 256  # vectors of a cell that are held together against those in reach
CHUNK = 1024
REACH = 16384


def rotation(width: int, seed: int = 6) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0]


def block_slices(width: int, block: int):
    return [slice(a, min(a + block, width)) for a in range(0, width, block)]


def cell_code(block: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """One integer per block and cell."""
    code = block.astype(np.int64)
    for k in range(cell.shape[1]):
        code = code * 1_000_003 + cell[:, k]
    return code


def home_cells(vectors: DataFrame, width: int, threshold: float, block: int, axes: int, cell: float) -> DataFrame:
    """(block, code, homes): how many vectors stand in each cell of the first axes."""
    turn, cuts = rotation(width), block_slices(width, block)
    budget = 2 - 2 * threshold

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8 * CHUNK):
                x = unit(rows(batch.slice(at, 8 * CHUNK).column("v"))) @ turn
                for b, cut in enumerate(cuts):
                    edge = cell * (np.sqrt(budget * (cut.stop - cut.start) / width) + 1e-9)
                    own = np.floor(x[:, cut][:, :axes] / edge).astype(np.int64)
                    code, many = np.unique(cell_code(np.full(len(own), b), own), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), b, np.int32)), pa.array(code), pa.array(many)], names=["block", "code", "homes"])

    return vectors.select("v").mapInArrow(run, "block int, code long, homes long").groupBy("block", "code").agg(F.sum("homes").alias("homes"))


def depths(vectors: DataFrame, width: int, threshold: float, block: int, axes: int, cell: float, crowd: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the crowded cells, sorted, and along how many coordinates each is
    cut: one per ``crowd`` vectors at most comes to the driver and the tasks."""
    found = home_cells(vectors, width, threshold, block, axes, cell).where(F.col("homes") > crowd).collect()
    found = sorted((r["code"], axes + int(np.ceil(np.log(r["homes"] / crowd) / np.log(SHRINK)))) for r in found)
    return np.array([f[0] for f in found], np.int64), np.array([min(block, f[1]) for f in found], np.int64)


def probes(vectors: DataFrame, width: int, threshold: float, block: int, axes: int, cell: float, deep) -> DataFrame:
    """(node, n, v, block, cell, home): each vector in the cells it touches
    in every block. A cell's name has all coordinates of its block, 0 for those
    along which it isn't cut."""
    turn, cuts = rotation(width), block_slices(width, block)
    budget = 2 - 2 * threshold
    kind = vectors.schema["v"].dataType.elementType.simpleString()
    codes, cut_along = deep

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = unit(rows(part.column("v"))) @ turn
                picks, out = [], []
                for b, cut in enumerate(cuts):
                    radius = np.sqrt(budget * (cut.stop - cut.start) / width) + 1e-9
                    edge = cell * radius
                    y = x[:, cut]
                    own = np.floor(y / edge).astype(np.int64)
                    lo, hi = np.floor((y - radius) / edge).astype(np.int64), np.floor((y + radius) / edge).astype(np.int64)
                    at_row, at_cell = np.arange(len(y)), np.zeros((len(y), 0), np.int64)
                    most = np.full(len(y), axes)
                    for k in range(y.shape[1]):
                        if k == axes and len(codes):
                            code = cell_code(np.full(len(at_row), b), at_cell)
                            spot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                            most = np.where(codes[spot] == code, cut_along[spot], axes)
                        on = most > k
                        n = np.where(on, (hi - lo + 1)[at_row, k], 1)
                        rep = np.repeat(np.arange(len(at_row)), n)
                        step = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
                        at_row, most, on = at_row[rep], most[rep], on[rep]
                        at_cell = np.column_stack([at_cell[rep], np.where(on, lo[at_row, k] + step, 0)])
                    picks.append(at_row)
                    home = ((at_cell == own[at_row]) | (np.arange(y.shape[1]) >= most[:, None])).all(axis=1)
                    full = np.zeros((len(at_row), block), np.int64)  # the last block may be narrower
                    full[:, : at_cell.shape[1]] = at_cell
                    out.append(np.column_stack([np.full(len(at_row), b), home, full]))
                pick, more = pa.array(np.concatenate(picks)), np.concatenate(out)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(more) + 1, dtype=np.int32) * block), pa.array(more[:, 2:].reshape(-1).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(c).take(pick) for c in ("node", "n", "v")] + [pa.array(more[:, 0].astype(np.int32)), cells, pa.array(more[:, 1] > 0)], names=["node", "n", "v", "block", "cell", "home"])

    return vectors.select("node", "n", "v").mapInArrow(run, "node long, n long, v array<float>, block int, cell array<int>, home boolean".replace("float", kind))


def near_parts(y: np.ndarray, y2: np.ndarray, radius: float, leaf: int = LEAF):
    """(i, j): a few rows of y at a time, close together, and the rows of y2
    that stand within ``radius`` of their box: median splits, overlapping."""
    stack = [(np.arange(len(y)), np.arange(len(y2)))]
    while stack:
        i, j = stack.pop()
        if not len(i) or not len(j):
            continue
        low, high = y[i].min(0), y[i].max(0)
        if len(i) <= leaf:
            j = j[((y2[j] >= low - radius) & (y2[j] <= high + radius)).all(axis=1)]
            for s in range(0, len(j), REACH):
                yield i, j[s : s + REACH]
            continue
        k = int((high - low).argmax())
        half = len(i) // 2
        by = np.argpartition(y[i, k], half)
        a, b = i[by[:half]], i[by[half:]]
        at = y2[j, k]
        stack += [(a, j[at <= y[a, k].max() + radius]), (b, j[at >= y[b, k].min() - radius])]


def linked(own: tuple, other: tuple, b: int, turn: np.ndarray, cuts, threshold: float):
    """Pairs (i, j) of own and other that count in block b: own node < other
    node, block distance within budget, in no earlier block, cosine enough."""
    budget, width = 2 - 2 * threshold, turn.shape[0]
    (node, v, x), (node2, v2, x2) = own, other
    share = lambda c: budget * (c.stop - c.start) / width + 1e-9
    y, y2 = x[:, cuts[b]], x2[:, cuts[b]]
    # squared block distances as one product, in single precision with room for its error
    a = np.column_stack([y, (y * y).sum(1), np.ones(len(y))]).astype(np.float32)
    c = np.column_stack([-2 * y2, np.ones(len(y2)), (y2 * y2).sum(1)]).astype(np.float32)
    i, j = np.divmod(np.flatnonzero(a @ c.T <= np.float32(share(cuts[b]) + 1e-5)), len(y2))
    first = node[i] < node2[j]
    i, j = i[first], j[first]
    good = safe_cosine(v[i], v2[j]) >= threshold
    i, j = i[good], j[good]
    for c in cuts[:b]:
        early = ((x[i][:, c] - x2[j][:, c]) ** 2).sum(1) <= share(c)
        i, j = i[~early], j[~early]
    late = ((y[i] - y2[j]) ** 2).sum(1) <= share(cuts[b])
    return i[late], j[late]


def links(vectors: DataFrame, width: int, threshold: float = THRESHOLD, block: int = WIDTH, axes: int = AXES, cell: float = CELL, crowd: int = CROWD) -> DataFrame:
    """(node, links, to): partial counts of links, weighted by ``n`` of the
    linked vector, and edges that connect what the links connect. Vectors hold
    node, n and v, different from each other."""
    deep = depths(vectors, width, threshold, block, axes, cell, crowd)
    p = written(probes(vectors, width, threshold, block, axes, cell, deep), "probes")
    key = ["block", "cell"]
    split = p.groupBy(*key).agg(F.count("*").alias("rows"), F.count(F.when(F.col("home"), 1)).alias("homes")).where("homes > 0")
    split = split.select(*key, F.ceil(F.col("homes") / crowd).cast("int").alias("a"), F.ceil(F.col("rows") / (4 * crowd)).cast("int").alias("b"))
    p = p.join(split, key)
    spot = lambda parts, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = p.where("home").select("node", "n", "v", *key, spot("a", 1).alias("i"), every("b").alias("j"))
    right = p.select("node", "n", "v", *key, spot("b", 2).alias("j"), every("a").alias("i"))
    right = right.toDF(*(f"{c}_" for c in right.columns))
    turn, cuts = rotation(width), block_slices(width, block)

    def run(key_, a: pa.Table, b: pa.Table) -> pa.Table:
        at, na, va = (a.column(c).combine_chunks() for c in ("node", "n", "v"))
        bt, nb, vb = (b.column(c).combine_chunks() for c in ("node_", "n_", "v_"))
        at, bt, na, nb = at.to_numpy(), bt.to_numpy(), na.to_numpy(), nb.to_numpy()
        if not len(at) or not len(bt):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})
        va, vb = rows(va).astype(float), rows(vb).astype(float)
        xa, xb = unit(va) @ turn, unit(vb) @ turn
        nodes = np.unique(np.concatenate([at, bt]))
        count, low = np.zeros(len(nodes), np.int64), nodes.copy()
        ia, ib = np.searchsorted(nodes, at), np.searchsorted(nodes, bt)
        edges: list[tuple] = []
        b = key_[0].as_py()
        radius = np.sqrt((2 - 2 * threshold) * (cuts[b].stop - cuts[b].start) / width) + 1e-6
        for e, e2 in near_parts(xa[:, cuts[b]], xb[:, cuts[b]], radius):
            # each pair once: in the own cell of its smaller node
            i, j = linked((at[e], va[e], xa[e]), (bt[e2], vb[e2], xb[e2]), b, turn, cuts, threshold)
            np.add.at(count, ia[e[i]], nb[e2[j]])
            np.add.at(count, ib[e2[j]], na[e[i]])
            if len(i):
                edges.append(forest(ia[e[i]], ib[e2[j]]))
        if edges:
            u, w = forest(*(np.concatenate(x) for x in zip(*edges)))
            np.minimum.at(low, w, nodes[u])
        some = np.flatnonzero((count > 0) | (low < nodes))
        return pa.table({"node": pa.array(nodes[some]), "links": pa.array(count[some]), "to": pa.array(low[some])})

    keys = [*key, "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*(f"{k}_" for k in keys))).applyInArrow(run, "node long, links long, to long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vec_id."""
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    v = usable(vectors).select("vec_id", F.col("v").cast(f"array<{kind}>").alias("v"))
    v = v.groupBy("vec_id").agg(F.min("v").alias("v"))
    row = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = row[0] if row else 1
    v = v.where(F.size("v") == width)
    same = written(v.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")), "vectors")
    member = written(v.select("vec_id", "v").join(same, "v").select("vec_id", "node", "n"), "members")
    found = written(links(same, width, threshold, **options), "links")
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    root = components(found.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")))
    out = member.join(count, "node", "left").join(root, "node", "left")
    out = out.select("vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    out = ids.join(out, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
with recursive v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null),
u as (select * from v where len([x for x in e if x is null or not isfinite(x)]) = 0 and len([x for x in e if x <> 0]) > 0),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from r join l on l.a = r.b),
c as (select a as vec_id, min(b) as component_id from r group by a),
n as (select a as vec_id, count(distinct b) as n from l group by a)
select c.vec_id, coalesce(n.n, 0)::bigint as n_links, component_id, c.vec_id = component_id as kept from c left join n using (vec_id)
"""
