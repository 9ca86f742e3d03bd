"""Lloyd's rounds over integer vectors by two trees.

Vectors are dealt into blocks, and each block gets a cover tree once: points are taken farthest first, so those taken while
the next is farther than 2**i form a net of that scale, and a point hangs below the nearest one of the coarser net. Points
that are not taken lie in the leaf of the nearest one that is. A node's vectors stand together, and it knows their centre,
radius and sum. In a round the centroids form a tree of their own; pairs of nodes are followed from both roots, and a pair
goes when another one's greatest distance is below its least. Where one centroid is left a node's sum counts at once,
without a look at its vectors; at leaves the vectors meet the centroids that are left, in whole numbers.

A round gathers counts and sums by centroid and component on the driver: these are the model, not the data.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._store import table

CLUSTERS, ROUNDS, SEED, COMPONENTS = 8, 10, 3, 64
#: Vectors of a block, points of its tree, components up to which squared distances fit in 64 bits.
BLOCK, NET, SMALL = 2048, 128, 1 << 26
LONG = (1 << 63) - 1


def _scaled(flat: np.ndarray) -> np.ndarray:
    return np.floor(1024 * flat.astype(np.float64))


def clean(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, embedding of the vectors that take part: of so many components, none null or non-finite once multiplied by 1024."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * 1024) == float("inf")))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where((F.size("embedding") == components) & ~bad)


class Tree:
    """Nodes in preorder: where their points begin and end, the node after their own, centre and radius."""

    def __init__(self, begin, end, after, centre, radius) -> None:
        self.begin, self.end, self.after = (np.asarray(x, np.int32) for x in (begin, end, after))
        self.centre, self.radius = centre, radius

    def leaf(self, node: np.ndarray) -> np.ndarray:
        return self.after[node] == node + 1

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes, and for each the place of its parent in nodes."""
        kids, of, at, here = [], [], nodes + 1, np.arange(len(nodes))
        while len(at):
            inside = at < self.after[nodes[here]]
            at, here = at[inside], here[inside]
            kids.append(at)
            of.append(here)
            at = self.after[at]
        return np.concatenate(kids), np.concatenate(of)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(((x - p) ** 2).sum(-1))


def cover_tree(x: np.ndarray, most: int = NET) -> tuple[np.ndarray, Tree]:
    """The order in which the points stand below their nodes, and the tree. Equal points share a leaf."""
    scale = max(1.0, float(np.abs(x).max(initial=0)))
    y = x / scale  # squares of very large components would be infinite
    near, owner = _distances(y, y[0]), np.zeros(len(y), np.int64)
    taken, far = [0], [np.inf]
    while len(taken) < most and (top := near.max()) > 0:
        taken.append(int(near.argmax()))
        far.append(float(top))
        d = _distances(y, y[taken[-1]])
        closer = d < near
        near[closer], owner[closer] = d[closer], len(taken) - 1
    level = np.floor(np.log2(np.array(far[1:]))).astype(int) if len(far) > 1 else np.zeros(0, int)
    kids: list[dict[int, list[int]]] = [{} for _ in taken]
    points = y[taken]
    for j in range(1, len(taken)):
        coarser = np.flatnonzero(np.concatenate(([True], level[: j - 1] > level[j - 1])))
        parent = int(coarser[_distances(points[coarser], points[j]).argmin()])
        kids[parent].setdefault(int(level[j - 1]), []).append(j)
    order: list[np.ndarray] = []
    begin, end, after, count = [], [], [], 0

    def visit(j: int, scales: list[int]) -> None:
        nonlocal count
        node = len(begin)
        begin.append(count), end.append(0), after.append(0)
        if scales:  # the point itself at the next scale, then the points that hang below it there
            visit(j, scales[1:])
            for kid in kids[j][scales[0]]:
                visit(kid, sorted(kids[kid], reverse=True))
        else:
            own = np.flatnonzero(owner == j)
            order.append(own)
            count += len(own)
        end[node], after[node] = count, len(begin)

    visit(0, sorted(kids[0], reverse=True))
    placed = np.concatenate(order)
    z = y[placed]
    centre = np.stack([z[a:b].mean(0) for a, b in zip(begin, end)])
    radius = np.array([_distances(z[a:b], c).max() for a, b, c in zip(begin, end, centre)])
    return placed, Tree(begin, end, after, centre * scale, radius * scale * (1 + 1e-9))


def meet(own: Tree, other: Tree, visit) -> None:
    """Follows pairs of nodes; visit(nodes, candidates, sole) gets nodes with each candidate leaf of the other tree.

    sole: the nodes have one candidate each. Otherwise they are leaves and their points still have to be compared."""
    scale = max(1.0, float(np.abs(own.centre).max(initial=0)), float(np.abs(other.centre).max(initial=0)))
    a, b = own.centre / scale, other.centre / scale
    ra, rb = own.radius / scale, other.radius / scale
    v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(v):
        d = _distances(a[v], b[c])
        reach = ra[v] + rb[c]
        best = np.full(len(own.begin), np.inf)
        np.minimum.at(best, v, d + reach)
        keep = d - reach <= best[v] + 1e-9 * (1 + best[v])
        v, c = v[keep], c[keep]
        ends = other.leaf(c)
        many = np.bincount(v, minlength=len(own.begin))
        sole = ends & (many[v] == 1)
        if sole.any():
            visit(v[sole], c[sole], True)
        v, c, ends = v[~sole], c[~sole], ends[~sole]
        # A node's candidates are split as long as one is the larger, or the node can't be.
        wide = np.zeros(len(own.begin), bool)
        wide[v[~ends & ((rb[c] >= ra[v]) | own.leaf(v))]] = True
        split = wide[v] & ~ends
        kept = wide[v] & ends
        rest = ~wide[v]
        done = rest & own.leaf(v)  # then all its candidates are leaves
        if done.any():
            visit(v[done], c[done], False)
        down = rest & ~own.leaf(v)
        kids, of = other.children(c[split]) if split.any() else (v[:0], v[:0])
        below, place = own.children(v[down]) if down.any() else (v[:0], v[:0])
        v, c = np.concatenate((v[split][of], v[kept], below)), np.concatenate((kids, c[kept], c[down][place]))


def _whole(x: np.ndarray) -> np.ndarray:
    """Whole numbers that add and multiply exactly: 64 bits where squared distances fit, else Python's."""
    if np.abs(x).max(initial=0) < SMALL:
        return x.astype(np.int64)
    return np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)


class Centroids:
    """Centroids as Python's whole numbers, with their tree."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.rows = rows
        flat = np.array([[float(v) for v in r] for r in rows])
        order, self.tree = cover_tree(flat, len(rows))
        self.order = order
        self.small = all(abs(v) < SMALL for r in rows for v in r)
        self.whole = np.array(rows, np.int64 if self.small else object)
        self.sha256 = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in rows]

    def numbers(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The centroids of leaves, equal ones in one, and for each the place of its leaf."""
        n = self.tree.end[leaves] - self.tree.begin[leaves]
        of = np.repeat(np.arange(len(leaves)), n)
        at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.tree.begin[leaves][of]
        return self.order[at], of


class Block:
    """Vectors below a cover tree, with what a node's vectors sum to."""

    def __init__(self, vectors: np.ndarray, tree: Tree, sums: np.ndarray) -> None:
        self.vectors, self.tree, self.sums = vectors, tree, sums

    @classmethod
    def build(cls, x: np.ndarray) -> tuple[np.ndarray, Block]:
        order, tree = cover_tree(x)
        whole = _whole(x[order])
        return order, cls(whole, tree, np.stack([whole[a:b].sum(0) for a, b in zip(tree.begin, tree.end)]))

    def row(self) -> list:
        tree, small = self.tree, self.vectors.dtype != object
        vectors = self.vectors.astype(np.int32) if small else self.vectors.astype(np.float64)
        sums = self.sums if small else self.sums.astype(np.float64)
        return [small, vectors.tobytes(), sums.tobytes(), np.stack((tree.begin, tree.end, tree.after)).tobytes(), tree.radius.tobytes()]

    @classmethod
    def of(cls, small: bool, vectors: bytes, sums: bytes, nodes: bytes, radius: bytes, components: int) -> Block:
        begin, end, after = np.frombuffer(nodes, np.int32).reshape(3, -1)
        held = np.frombuffer(sums, np.int64 if small else np.float64).reshape(-1, components)
        own = np.frombuffer(vectors, np.int32 if small else np.float64).reshape(-1, components)
        own = own.astype(np.int64) if small else _whole(own)
        tree = Tree(begin, end, after, held / (end - begin)[:, None].astype(np.float64), np.frombuffer(radius))
        return cls(own, tree, held if small else np.stack([own[a:b].sum(0) for a, b in zip(begin, end)]))

    def _compare(self, v: np.ndarray, c: np.ndarray, rows: np.ndarray, got: np.ndarray) -> None:
        """Every vector of the nodes v with the centroids c, pair by pair; ties go to the smaller number."""
        order = np.argsort(v, kind="stable")
        v, c = v[order], c[order]
        sizes = (self.tree.end[v] - self.tree.begin[v]).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))  # a node's pairs stay together
        chunk = np.repeat((np.cumsum(sizes)[first] // 8192), np.diff(np.append(first, len(v))))
        for which in np.unique(chunk):
            own = np.flatnonzero(chunk == which)
            n = sizes[own]
            of = np.repeat(own, n)
            at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.tree.begin[v[of]]
            gap = self.vectors[at] - rows[c[of]]
            d = (gap * gap).sum(1)
            i = np.argsort(c[of], kind="stable")
            i = i[np.argsort(d[i], kind="stable")]
            i = i[np.argsort(at[i], kind="stable")]
            best = i[np.concatenate(([True], at[i][1:] != at[i][:-1]))]
            got[at[best]] = c[of[best]]

    def assign(self, centroids: Centroids) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Nodes that have one centroid, and the centroid of every other vector (-1: a node has it)."""
        sole_nodes: list[tuple[int, int]] = []
        got = np.full(len(self.vectors), -1, np.int64)
        rows = centroids.whole if self.vectors.dtype != object else centroids.whole.astype(object)

        def visit(v: np.ndarray, c: np.ndarray, sole: bool) -> None:
            if sole:
                alone = centroids.alike[c]
                sole_nodes.extend(zip(v[alone].tolist(), centroids.least[c[alone]].tolist()))
                v, c = v[~alone], c[~alone]
            if len(v):
                numbers, of = centroids.numbers(c)
                self._compare(v[of], numbers, rows, got)

        meet(self.tree, centroids.tree, visit)
        return sole_nodes, got


class Centroids:
    """Centroids as whole numbers, with their tree; alike and least: whether a leaf's centroids are equal, and the first of them."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.rows = rows
        self.order, self.tree = cover_tree(np.array([[float(v) for v in r] for r in rows]), len(rows))
        self.whole = np.array(rows, np.int64 if all(abs(v) < SMALL for r in rows for v in r) else object)
        held = [self.order[a:b] for a, b in zip(self.tree.begin, self.tree.end)]
        self.alike = np.array([len({tuple(rows[i]) for i in h}) == 1 for h in held])
        self.least = np.array([h.min() for h in held])

    def numbers(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The centroids of leaves, and for each the place of its leaf."""
        n = (self.tree.end[leaves] - self.tree.begin[leaves]).astype(np.int64)
        of = np.repeat(np.arange(len(leaves)), n)
        return self.order[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.tree.begin[leaves[of]]], of

    def told(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in self.rows]


_BLOCK = "ids array<long>, small boolean, vectors binary, sums binary, nodes binary, radius binary"


def _blocks(components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            x = _scaled(rows.column("embedding").combine_chunks().flatten().to_numpy()).reshape(-1, components)
            order, made = Block.build(x)
            ids = rows.column("vec_id").combine_chunks().cast(pa.int64()).take(pa.array(order))
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([v]) for v in made.row())], [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= BLOCK:
                yield block(rows.slice(0, BLOCK))
                rows = rows.slice(BLOCK)
            held = rows.to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return run


def _read(batches: Iterator[pa.RecordBatch], components: int) -> Iterator[tuple[pa.Array, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, *rest = (batch.column(c)[i] for c in range(6))
            yield ids.values, Block.of(*(v.as_py() for v in rest), components)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as sums of 2**(32 i) parts that can be added up in 64 bits."""
    i = 0
    while not -(1 << 40) < value < 1 << 40:
        yield i, value & 0xFFFFFFFF
        value >>= 32
        i += 1
    yield i, value


def _sums(centroids: Centroids, components: int):
    """cluster, component (-1: how many vectors), limb, value: what a task's vectors sum to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.rows)
        total, count = np.zeros((k, components), object), np.zeros(k, np.int64)
        for _, block in _read(batches, components):
            nodes, got = block.assign(centroids)
            for node, c in nodes:
                total[c] += block.sums[node]
                count[c] += block.tree.end[node] - block.tree.begin[node]
            for c in np.unique(got[got >= 0]):
                own = got == c
                total[c] += block.vectors[own].sum(0)
                count[c] += own.sum()
        rows = [(c, d, i, v) for c in np.flatnonzero(count).tolist() for d, n in enumerate([*total[c].tolist(), int(count[c])]) for i, v in _limbs(int(n))]
        if rows:
            c, d, i, v = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(i, pa.int32()), pa.array(v, pa.int64())], ["cluster", "component", "limb", "value"])

    return run


def _assigned(centroids: Centroids, components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _read(batches, components):
            nodes, got = block.assign(centroids)
            for node, c in nodes:
                got[block.tree.begin[node] : block.tree.end[node]] = c
            gap = block.vectors - centroids.whole[got]
            d = [min(int(v), LONG) for v in (gap * gap).sum(1)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(got.astype(np.int32)), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def start(good: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors of the smallest hashes, at most so many as clusters."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = good.select("embedding").orderBy(told, "embedding").limit(clusters).collect()
    return [[int(v) for v in _scaled(np.array(r["embedding"]))] for r in rows]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part.

    Components become floor(1024 x). Rounds assign every vector to its nearest centroid by squared distance, equal ones to
    the smaller number, and move centroids that have vectors to the floored means; sums are exact. Rounds stop early where
    no centroid moves, as later ones would change nothing. Distances and their sums above 2**63 - 1 are given as that.

    Null vectors, those of other lengths and those with null or non-finite components (also once multiplied by 1024) take
    no part. Rows with the same vec_id are each a vector; a null vec_id is hashed like an empty one and carried along. With
    fewer vectors than clusters each starts one; equal vectors may start several, of which the first has them all. Other
    columns are ignored. An empty table gives no rows."""
    spark = vectors.sparkSession
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    good = clean(vectors, components)
    rows = start(good, clusters, seed)
    if not rows:
        return spark.createDataFrame([], out)
    blocks = table(good.mapInArrow(_blocks(components), _BLOCK), "blocks")
    for _ in range(rounds):
        found = blocks.mapInArrow(_sums(Centroids(rows), components), "cluster int, component int, limb int, value long").groupBy("cluster", "component", "limb").agg(F.sum("value").alias("value"))
        total: dict[tuple[int, int], int] = {}
        for r in found.collect():  # clusters times components
            total[r["cluster"], r["component"]] = total.get((r["cluster"], r["component"]), 0) + (r["value"] << 32 * r["limb"])
        moved = [[total[c, d] // total[c, components] for d in range(components)] if (c, 0) in total else own for c, own in enumerate(rows)]
        if moved == rows:
            break
        rows = moved
    last = Centroids(rows)
    assigned = table(blocks.mapInArrow(_assigned(last, components), "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    told = [(c, min(d, LONG), min(sum(sums.values()), LONG), last.told()[c]) for c, d in sums.items()]
    known = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(*(c.split()[0] for c in out.split(", ")))


def cluster_sql() -> str:
    """The same in SQL for DuckDB: every vector meets every centroid in each round."""
    nearest = """
a{i} as materialized (select vec_id, rid, e, cid as cluster, dist as distance from (select *, row_number() over (partition by rid order by dist, cid) as place
  from (select vec_id, rid, v.e, cid, cast(list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) as bigint) as dist from v cross join c{i} as c)) where place = 1)"""
    moved = """,
s{i} as (select cluster, j, sum(x) as s, count(*) as n from (select cluster, unnest(range(1, 65)) as j, unnest(e) as x from a{i}) group by 1, 2),
m{i} as (select cluster as cid, list(cast((s - ((s % n) + n) % n) // n as bigint) order by j) as e from s{i} group by 1),
c{j} as materialized (select cid, coalesce(m.e, c.e) as e from c{i} as c left join m{i} as m using (cid)),"""
    steps = "".join(nearest.format(i=i) + (moved.format(i=i, j=i + 1) if i < ROUNDS else "") for i in range(ROUNDS + 1))
    return f"""
with v as materialized (select vec_id, row_number() over () as rid, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e from embeddings
  where len(embedding) = {COMPONENTS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (select row_number() over (order by sha256('{SEED}:' || vec_id)) - 1 as cid, e from v order by 1 limit {CLUSTERS}),{steps}
select vec_id, cast(cluster as integer) as cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
  sha256(array_to_string(c.e, ',')) as centroid_sha256 from a{ROUNDS} join c{ROUNDS} as c on cid = cluster"""


def op11_clusters(spark, sf_dir: str) -> DataFrame:
    """All embeddings in eight clusters."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
