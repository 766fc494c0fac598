"""Vector codes by exact integer k-means over parts, on anchors-hierarchy trees.

A vector's components become integers, floor(4096 x); it is cut into 8 parts, and
each part position has a codebook of 16 entries, fitted in 6 rounds of assigning
every part to its nearest entry and replacing entries by floored means.

Vectors are taken in blocks of ``BLOCK``. Over each part position of a block a
metric tree is built middle-out, once: about sqrt(n) anchors, each new one the
point farthest from its anchor, take over the points that are nearer to them;
inside each anchor the same is done again; and the anchors' balls are merged
upward, the pair with the smallest common ball first. A ball caches the exact sum
and count of its parts. In a round, all balls of a level are visited at once, each
with the candidate entries inherited from its parent: an entry leaves the list
where another is strictly nearer for every point of the ball. A ball with one
candidate left is owned whole and adds its cached sum and count; a leaf that
is still shared compares its points with its remaining candidates in integers.
Bounds carry a margin above the error of doubles and ties are never pruned, so
results are those of the plain computation, ties to the lower index included.

The trees are written under spark.checkpoint.dir; a round reads them, sends the
codebooks (16 vectors) to the tasks and returns one sum per entry and task.

Rows whose vector is null or holds null or non-finite components are left out.
Vectors are filled up with zeros to the width of the longest, rounded up to a
multiple of 8, so mixed and odd widths have a defined result. Components beyond
``LIMIT`` in size (2**15) would overflow the sums and raise an error. Equal
vec_ids start codebooks in the order of their vectors, null ids come last; with
fewer than 16 vectors codebooks are smaller. Repeated rows each count. An empty
table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK, LEAF = 4096, 32
LIMIT = 1 << 15


# ---- trees -------------------------------------------------------------------


def anchors(x: np.ndarray, many: int) -> np.ndarray:
    """The anchor of each point, numbered from 0; fewer than ``many`` where
    points coincide."""
    at, owner = [0], np.zeros(len(x), np.int64)
    far = np.sqrt(((x - x[0]) ** 2).sum(1))
    while len(at) < many:
        new = int(far.argmax())
        if far[new] <= 0:
            break
        # a point nearer to its anchor than half the way to the new one stays
        half = np.sqrt(((x[at] - x[new]) ** 2).sum(1)) / 2
        some = np.flatnonzero(far >= half[owner])
        d = np.sqrt(((x[some] - x[new]) ** 2).sum(1))
        won = d < far[some]
        some = some[won]
        owner[some], far[some] = len(at), d[won]
        at.append(new)
    return owner


class Builder:
    """Nodes of one tree: children, or the points of a leaf."""

    def __init__(self, x: np.ndarray):
        self.x, self.kids, self.leaf = x, [], []
        self.root = self.build(np.arange(len(x)))

    def node(self, kids, leaf) -> int:
        self.kids.append(kids)
        self.leaf.append(leaf)
        return len(self.kids) - 1

    def build(self, points: np.ndarray) -> int:
        if len(points) <= LEAF:
            return self.node(None, points)
        x = self.x[points]
        owner = anchors(x, max(2, int(len(points) ** 0.5)))
        many = int(owner.max()) + 1
        if many == 1:
            return self.node(None, points)
        order = np.argsort(owner, kind="stable")
        groups = np.split(order, np.cumsum(np.bincount(owner, minlength=many))[:-1])
        centre = np.stack([x[g].mean(0) for g in groups])
        radius = np.array([np.sqrt(((x[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre)])
        size = np.array([len(g) for g in groups], float)
        return self.merge([self.build(points[g]) for g in groups], centre, radius, size)

    def merge(self, nodes: list[int], centre, radius, size) -> int:
        """One ball of all, joining the two with the smallest common ball."""
        between = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
        cost = (between + radius[:, None] + radius[None]) / 2
        np.fill_diagonal(cost, np.inf)
        alive = np.ones(len(nodes), bool)
        for _ in range(len(nodes) - 1):
            i, j = divmod(int(cost.argmin()), len(nodes))
            c = (centre[i] * size[i] + centre[j] * size[j]) / (size[i] + size[j])
            radius[i] = max(np.sqrt(((c - centre[i]) ** 2).sum()) + radius[i], np.sqrt(((c - centre[j]) ** 2).sum()) + radius[j])
            centre[i], size[i], alive[j] = c, size[i] + size[j], False
            nodes[i] = self.node((nodes[i], nodes[j]), None)
            cost[j, :] = cost[:, j] = np.inf
            row = (np.sqrt(((centre - c) ** 2).sum(1)) + radius + radius[i]) / 2
            row[~alive] = np.inf
            row[i] = np.inf
            cost[i, :] = cost[:, i] = row
        return nodes[int(np.flatnonzero(alive)[0])]


FIELDS = (("order", np.int32), ("points", np.int32), ("begin", np.int32), ("end", np.int32), ("left", np.int32), ("right", np.int32), ("radius", np.float64))


def grow(points: np.ndarray) -> bytes:
    """The tree over points (integers, one row each)."""
    b = Builder(points.astype(float))
    n = len(b.kids)
    begin, end = np.zeros(n, np.int32), np.zeros(n, np.int32)
    order: list[np.ndarray] = []
    at, stack = 0, [(b.root, False)]
    while stack:
        k, done = stack.pop()
        if not done:
            begin[k] = at
            stack.append((k, True))
            if b.kids[k]:
                stack += [(b.kids[k][1], False), (b.kids[k][0], False)]
            else:
                order.append(b.leaf[k])
                at += len(b.leaf[k])
        else:
            end[k] = at
    perm = np.concatenate(order).astype(np.int32)
    p = points[perm]
    total = np.concatenate([np.zeros((1, p.shape[1]), np.int64), np.cumsum(p, axis=0)])
    centre = (total[end] - total[begin]) / (end - begin)[:, None]
    radius = np.array([((p[s:e] - c) ** 2).sum(1).max() for s, e, c in zip(begin, end, centre)])
    tree = {"order": perm, "points": p, "begin": begin, "end": end, "radius": np.sqrt(radius) * (1 + 1e-9) + 1e-6,
            "left": [k[0] if k else -1 for k in b.kids], "right": [k[1] if k else -1 for k in b.kids]}
    head = np.array([len(p), p.shape[1], n, b.root], np.int64)
    return head.tobytes() + b"".join(np.ascontiguousarray(tree[f], kind).tobytes() for f, kind in FIELDS)


class Tree:
    """A stored tree, with the cached sums, counts and centres of its balls."""

    def __init__(self, blob: bytes):
        n, d, m, self.root = np.frombuffer(blob, np.int64, 4).tolist()
        at = 32
        for f, kind in FIELDS:
            many = {"order": n, "points": n * d}.get(f, m)
            setattr(self, f, np.frombuffer(blob, kind, many, at))
            at += many * np.dtype(kind).itemsize
        self.points = self.points.reshape(n, d).astype(np.int64)
        total = np.concatenate([np.zeros((1, d), np.int64), np.cumsum(self.points, axis=0)])
        self.count = (self.end - self.begin).astype(np.int64)
        self.sum = total[self.end] - total[self.begin]
        self.centre = self.sum / self.count[:, None]

    def owned(self, entries: np.ndarray):
        """(node, entry) of the balls that one entry owns whole, and (point,
        entry, distance) of the points compared one by one; also how many
        distances were taken."""
        e = entries.astype(float)
        apart = np.sqrt(((e[:, None] - e[None]) ** 2).sum(2))
        node, may = np.array([self.root]), np.ones((1, len(e)), bool)
        balls, shared, work = [], [], 0
        while len(node):
            c, r = self.centre[node], self.radius[node]
            work += int(may.sum())
            d = np.where(may, ((c[:, None] - e[None]) ** 2).sum(2), np.inf)
            best = d.argmin(1)
            least = d[np.arange(len(node)), best]
            reach = 2 * r[:, None] * apart[best]
            # |x-best|^2 - |x-j|^2 is linear in x: its largest value in the ball is below 0
            with np.errstate(invalid="ignore"):
                may = may & ~(d - least[:, None] > reach + 1e-9 * (d + least[:, None] + reach) + 1e-6)
            one = may.sum(1) == 1
            balls.append((node[one], best[one]))
            node, may = node[~one], may[~one]
            leaf = self.left[node] < 0
            shared.append((node[leaf], may[leaf]))
            node, may = node[~leaf], may[~leaf]
            node, may = np.concatenate([self.left[node], self.right[node]]), np.concatenate([may, may])
        leaf, may = np.concatenate([s[0] for s in shared]), np.concatenate([s[1] for s in shared])
        many = self.count[leaf]
        first = np.repeat(self.begin[leaf] - (np.cumsum(many) - many), many)
        point = first + np.arange(int(many.sum()))
        may = np.repeat(may, many, axis=0)
        code, error = np.zeros(len(point), np.int64), np.full(len(point), np.iinfo(np.int64).max)
        for j, x in enumerate(entries):
            some = np.flatnonzero(may[:, j])
            d = ((self.points[point[some]] - x) ** 2).sum(1)
            work += len(some)
            nearer = d < error[some]
            some = some[nearer]
            code[some], error[some] = j, d[nearer]
        balls = np.concatenate([b[0] for b in balls]), np.concatenate([b[1] for b in balls])
        return balls, (point, code, error), work

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, sum) of the points nearest to each entry."""
        (node, own), (point, code, _), _ = self.owned(entries)
        n, s = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        np.add.at(n, own, self.count[node])
        np.add.at(s, own, self.sum[node])
        for j in range(len(entries)):
            mine = point[code == j]
            n[j] += len(mine)
            s[j] += self.points[mine].sum(0)
        return n, s

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every point, in the order it came."""
        (node, own), (point, code, error), _ = self.owned(entries)
        out = np.zeros(len(self.order), np.int64)
        for k, j in zip(node.tolist(), own.tolist()):
            out[self.begin[k] : self.end[k]] = j
        out[point] = code
        d = ((self.points - entries[out]) ** 2).sum(1)
        back = np.empty((2, len(out)), np.int64)
        back[:, self.order] = out, d
        return back[0], back[1]


# ---- Spark -------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows whose vector is whole and finite."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(x.isNotNull() & ~bad).select("vec_id", "label", x.cast("array<double>").alias("v"))


def integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE x) of the vectors, zeros behind shorter ones."""
    size = np.asarray(column.value_lengths())
    if any(n == width for n in size[:1]) and (size == width).all():
        x = np.asarray(column.flatten()).reshape(-1, width)
    else:
        x = np.zeros((len(column), width))
        x[np.arange(width) < size[:, None]] = np.asarray(column.flatten())
    if len(x) and np.abs(x).max(initial=0) > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT}; scale the vectors down")
    return np.floor(x * SCALE).astype(np.int64)


def cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def forest(vectors: DataFrame, width: int, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """(ids, labels, trees): one row per block of vectors, a tree per part."""
    kind = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def grown(batches):
        held, many = [], 0

        def out():
            t = pa.Table.from_batches(held).combine_chunks()
            x = cut(integers(t.column("v").combine_chunks() if t.column("v").num_chunks != 1 else t.column("v").chunk(0), width), parts)
            lists = [pa.array([t.column(c).to_pylist()], pa.list_(t.schema.field(c).type)) for c in ("vec_id", "label")]
            return pa.RecordBatch.from_arrays([*lists, pa.array([[grow(p) for p in x]], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - many)
                held.append(part)
                many += part.num_rows
                batch = batch.slice(part.num_rows)
                if many == block:
                    yield out()
                    held, many = [], 0
        if many:
            yield out()

    return vectors.mapInArrow(grown, f"ids array<{kind['vec_id']}>, labels array<{kind['label']}>, trees array<binary>")


def improved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, position) after one round."""

    def tally(batches):
        n, s = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.column("trees"):
                for p, blob in enumerate(row.as_py()):
                    a, b = Tree(blob).sums(books[p])
                    n[p] += a
                    s[p] += b
        p, j = (x.ravel() for x in np.indices(n.shape))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(j), pa.array(n.ravel()), pa.array(s.reshape(len(p), -1).tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "s"])

    each = trees.select("trees").mapInArrow(tally, "part long, entry long, n long, s array<long>").where("n > 0")
    flat = each.select("part", "entry", "n", F.posexplode("s").alias("at", "x"))
    out = books.copy()
    for r in flat.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        out[r["part"], r["entry"], r["at"]] = r["x"] // r["n"]
    return out


def coded(trees: DataFrame, books: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""

    def assign(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in ("ids", "labels"))
                found = [Tree(blob).codes(books[p]) for p, blob in enumerate(batch.column("trees")[k].as_py())]
                code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                text = pa.array([r.tobytes().hex() for r in code])
                yield pa.RecordBatch.from_arrays([ids, labels, text, pa.array(sum(e for _, e in found))], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(assign, f"vec_id {id_type}, label {label_type}, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per vector."""
    v = usable(vectors)
    longest = v.agg(F.max(F.size("v")).alias("n")).first()["n"]
    width = -(-(longest or 0) // parts) * parts
    first = v.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    start = integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width)
    books = np.stack(cut(start, parts))
    trees = written(forest(v, width, parts, block), "vector_trees")
    for _ in range(rounds):
        if len(first):
            books = improved(trees, books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kind = {c: v.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    out = written(coded(trees, books, kind["vec_id"], kind["label"]), "vector_codes")
    by = out.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    out = out.join(by, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle(width: int = 64) -> str:
    """The plain computation, every part against every entry in every round."""
    w = width // PARTS
    near = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    assign = lambda r: f"select p.n, p.part, min({{'d': {near}, 'entry': c.entry}}) as a, any_value(p.x) as x from p join c{r} c using (part) group by p.n, p.part"
    mean = ", ".join(f"(sum(x[{i}]) - ((sum(x[{i}]) % count(*)) + count(*)) % count(*)) // count(*)" for i in range(1, w + 1))
    steps = []
    for r in range(ROUNDS):
        steps.append(f"a{r} as materialized ({assign(r)})")
        steps.append(f"m{r} as materialized (select part, a.entry as entry, [{mean}]::bigint[] as x from a{r} group by part, a.entry)")
        steps.append(f"c{r + 1} as materialized (select part, entry, coalesce(m.x, c.x) as x from c{r} c left join m{r} m using (part, entry))")
    return f"""
with v as materialized (select vec_id, label, row_number() over (order by vec_id, embedding) as n, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as x
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select n, part, x[part * {w} + 1 : part * {w} + {w}] as x from v, range({PARTS}) t(part)),
c0 as materialized (select part, n - 1 as entry, x from p where n <= {ENTRIES}),
{", ".join(steps)},
f as materialized ({assign(ROUNDS)}),
h as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as codebooks_sha256 from c{ROUNDS}),
e as (select v.vec_id, v.label, string_agg(printf('%02x', a.entry), '' order by part) as code, sum(a.d)::bigint as error from f join v using (n) group by v.n, v.vec_id, v.label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from e, h
"""


ORACLE = _oracle()
