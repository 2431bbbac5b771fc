"""Nearest neighbours by vantage-point trees, one per shard.

Largest inner product becomes smallest Euclidean distance: the length of a
query does not change its ranking, so queries are taken at length 1; vectors
are dealt into bands of like length, scaled to the top of their band, and get
one more component that brings them to length 1. So the distances of a band
tell directions apart whatever other lengths there are, and no component is too
large to be squared. Each shard of a band holds a tree: a node has a vantage
point and the distance ranges of its two halves, a leaf a block of vectors. A
search descends to the nearest leaf first and then visits every child that the
triangle inequality does not rule out. ``relax`` divides the search radius in
that test: 1, the default, is exact; more prunes more, and misses most where the
queries lie far from the vectors. Queries go through a tree together, in blocks. Products in a leaf only pick candidates; these are ranked by the exact
score on the original vectors, ties by least id, however many tie.

Copies of one vector are one entry of the index, which lists their smallest
ids, so groups of copies cost nothing.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows with a null id. A row is its id: rows with
the query's id are never its neighbours, and equal rows count once. Vectors
are compared only with vectors of the same number of components. With fewer
candidates than asked for, all of them are returned.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wrenchlake.operators.skew import bounded
from wrenchlake.session import materialise

SHARD_ROWS = 8_192
LEAF_ROWS = 128
QUERY_BLOCK = 1_024
RELAX = 1.0
# Bands of vector length for each doubling of it.
BANDS = 4
# What products and distances of points of length 1 may be off by rounding, generously.
ROUNDING = 1e-9


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions of length 1, and binary logarithms of the lengths; no component is too large or small for it."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    units = vectors / top
    lengths = np.sqrt((units**2).sum(axis=1, keepdims=True))
    return units / lengths, (np.log2(top) + np.log2(lengths))[:, 0]


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vec (little-endian doubles), dim and band (of length) of the distinct rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, bands = [], [], []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vec_id is None or not values or None in values:
                    continue
                vector = np.array(values, "<f8")
                if np.isfinite(vector).all() and vector.any():
                    ids.append(vec_id)
                    vectors.append((vector + 0.0).tobytes())  # -0.0 becomes 0.0
                    bands.append(int(np.floor(_units(vector[None])[1][0] * BANDS)))
            sizes = pa.array([len(v) // 8 for v in vectors], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), sizes, pa.array(bands, pa.int32())], ["vec_id", "vec", "dim", "band"]
            )

    own = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec"))
    return own.mapInArrow(run, "vec_id long, vec binary, dim int, band int").dropDuplicates(["vec_id", "vec"])


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)


class Tree:
    """A vantage-point tree over rows of equal length; ``order`` lists the rows by leaf."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.points, self.leaf_rows = points, leaf_rows
        self.order = np.arange(len(points))
        # Per node: vantage point, distance range of the inner and the outer half, bounds in order, children.
        self.nodes: list[tuple] = []
        self._build(0, len(points))
        self.points = points[self.order]

    def _build(self, start: int, stop: int) -> int:
        node = len(self.nodes)
        self.nodes.append((start, stop))
        if stop - start > self.leaf_rows:
            rows = self.order[start:stop]
            vantage = self.points[rows[(node * 7919) % len(rows)]]
            distance = np.sqrt(((self.points[rows] - vantage) ** 2).sum(1))
            ranked = np.argsort(distance, kind="stable")
            self.order[start:stop], distance = rows[ranked], distance[ranked]
            half = len(rows) // 2
            ranges = (distance[0], distance[half - 1], distance[half], distance[-1])
            inner = self._build(start, start + half)
            outer = self._build(start + half, stop)
            self.nodes[node] = (start, stop, vantage, ranges, inner, outer)
        return node

    def search(self, queries: np.ndarray, k: int, relax: float, score, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows (-1: none) of the k best found for each query: highest score first, ties by least id.

        ``queries`` and points have length 1. ``score(query rows, rows)`` is the
        exact measure, which rises with the product of the two but for rounding;
        it is taken of all rows whose product comes near the k-th.
        """
        n = len(queries)
        best, rows, near = np.full((n, k), -np.inf), np.full((n, k), -1), np.full((n, k), -np.inf)
        seen = np.full(n, -1)

        def take(leaf: int, active: np.ndarray) -> None:
            start, stop = self.nodes[leaf][:2]
            active = active[seen[active] != leaf]
            if not len(active):
                return
            product = queries[active] @ self.points[start:stop].T
            least = near[active].min(1)  # -inf until k are found
            if product.shape[1] > k:
                least = np.maximum(least, np.partition(product, -k, axis=1)[:, -k])
            q, own = np.nonzero(product >= least[:, None] - ROUNDING)
            if not len(q):
                return
            touched, place = np.unique(q, return_inverse=True)
            old = active[touched]
            new_rows = self.order[start + own]
            group = np.concatenate([np.repeat(np.arange(len(touched)), k), place])
            scores = np.concatenate([best[old].ravel(), score(active[q], new_rows)])
            found = np.concatenate([rows[old].ravel(), new_rows])
            close = np.concatenate([near[old].ravel(), product[q, own]])
            named = np.where(found >= 0, ids[np.maximum(found, 0)], np.iinfo(np.int64).max)
            order = np.lexsort((named, found < 0, -scores, group))
            rank = np.arange(len(order)) - np.searchsorted(group[order], np.arange(len(touched)))[group[order]]
            kept = order[rank < k]
            best[old], rows[old], near[old] = (x[kept].reshape(-1, k) for x in (scores, found, close))

        def home(node: int, active: np.ndarray) -> None:
            if len(self.nodes[node]) == 2:
                take(node, active)
                seen[active] = node
                return
            _, _, vantage, ranges, inner, outer = self.nodes[node]
            inside = np.sqrt(((queries[active] - vantage) ** 2).sum(1)) <= ranges[1]
            for child, own in ((inner, active[inside]), (outer, active[~inside])):
                if len(own):
                    home(child, own)

        def visit(node: int, active: np.ndarray) -> None:
            if len(self.nodes[node]) == 2:
                take(node, active)
                return
            _, _, vantage, (low_in, high_in, low_out, high_out), inner, outer = self.nodes[node]
            distance = np.sqrt(((queries[active] - vantage) ** 2).sum(1))
            inside = distance <= high_in
            for first in (True, False):  # each query's nearer half first, then the other with the radius it has by then
                for child, low, high, own in ((inner, low_in, high_in, inside == first), (outer, low_out, high_out, inside != first)):
                    # Points of length 1 at a product p are sqrt(2 - 2 p) apart.
                    radius = np.sqrt(np.maximum(2 - 2 * (near[active].min(1) - ROUNDING), 0)) / relax + ROUNDING
                    reach = own & (distance - radius <= high) & (distance + radius >= low)
                    if reach.any():
                        visit(child, active[reach])

        if n and len(self.points):
            every = np.arange(n)
            home(0, every)
            visit(0, every)
        return best, rows


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """One row per shard (dim, band, shard, entries) over the frame of ``usable``, and the list of the shards.

    A shard holds about ``shard_rows`` vectors of one band of length, dealt out
    by a hash of the vector, copies of a vector being one row by then.
    """
    by_vector = Window.partitionBy("vec").orderBy("vec_id")
    firsts = rows.withColumn("_n", F.row_number().over(by_vector)).filter(F.col("_n") <= k + 1)
    entries = materialise(firsts.groupBy("dim", "band", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    sizes = entries.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("n"))
    sizes = materialise(sizes, "shard_counts")
    dealt = entries.join(sizes, ["dim", "band"]).withColumn("shard", F.pmod(F.xxhash64("vec"), F.col("n")).cast("int")).drop("n")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim, band, shard = (x.as_py() for x in key)
        table = table.sort_by([("vec", "ascending")])
        ids = table.column("ids").to_pylist()
        blob = _dump(points=_matrix(table.column("vec").to_pylist()), ids=np.concatenate(ids), sizes=np.array([len(x) for x in ids]))
        whole = [pa.array([x], pa.int32()) for x in (dim, band, shard)]
        return pa.table([*whole, pa.array([blob], pa.binary())], names=["dim", "band", "shard", "entries"])

    index = materialise(dealt.groupBy("dim", "band", "shard").applyInArrow(run, "dim int, band int, shard int, entries binary"), "shards")
    return index, index.select("dim", "band", "shard")


def pack_queries(key: tuple, table: pa.Table) -> pa.Table:
    """One row (dim, block, queries) of a block, the same whatever order its rows arrive in.

    Rows of a blob are counted as query_row, so a task that runs again after a
    lost executor must number the queries as the first one did.
    """
    dim, block = (x.as_py() for x in key)
    table = table.sort_by([("vec_id", "ascending"), ("vec", "ascending")])
    blob = _dump(points=_matrix(table.column("vec").to_pylist()), ids=table.column("vec_id").to_numpy())
    return pa.table([pa.array([dim], pa.int32()), pa.array([block], pa.int32()), pa.array([blob], pa.binary())], names=["dim", "block", "queries"])


def search(index: DataFrame, shards: DataFrame, queries: DataFrame, k: int, relax: float = RELAX, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest entries found for each query (a frame of ``usable``).

    Each block of queries meets each shard once. A shard's answers are at most
    k + 1 entries for a query, and the best of all shards are ranked by query.
    """
    n_queries = queries.count()
    blocks = max(1, math.ceil(n_queries / query_block))
    keep = k + 1

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int"))
    together = dealt.select("dim", "block", "vec_id", "vec").groupBy("dim", "block").applyInArrow(pack_queries, "dim int, block int, queries binary")
    spread = together.join(bounded(shards), "dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                place = tuple(batch.column(name)[at].as_py() for name in ("dim", "band", "shard"))
                if place != held:
                    stored = np.load(io.BytesIO(batch.column("entries")[at].as_py()))
                    points, ids, sizes = stored["points"], stored["ids"], stored["sizes"]
                    units, lengths = _units(points)
                    # Within the band, lengths against its top; one more component brings all points to length 1.
                    share = np.minimum(np.exp2(lengths - (place[1] + 1) / BANDS), 1.0)
                    tree = Tree(np.column_stack([units * share[:, None], np.sqrt(1 - share**2)]))
                    cuts, held = np.cumsum([0, *sizes]), place
                    first_ids = ids[cuts[:-1]]
                asked = np.load(io.BytesIO(batch.column("queries")[at].as_py()))
                own, vectors = asked["ids"], asked["points"]

                def score(q: np.ndarray, row: np.ndarray, vectors=vectors, points=points) -> np.ndarray:
                    out = np.empty(len(q))
                    with np.errstate(over="ignore", invalid="ignore"):
                        for a in range(0, len(q), 8_192):
                            out[a : a + 8_192] = (vectors[q[a : a + 8_192]] * points[row[a : a + 8_192]]).sum(1)
                    return np.nan_to_num(out, nan=-np.inf, posinf=np.inf, neginf=-np.inf)

                asking = np.column_stack([_units(vectors)[0], np.zeros(len(own))])
                scores, rows = tree.search(asking, min(keep, len(points)), relax, score, first_ids)
                row, column = np.nonzero(rows >= 0)
                entry, scores = rows[row, column], scores[row, column]
                copies = sizes[entry]
                first = np.repeat(cuts[entry] - np.cumsum(copies) + copies, copies)
                found = ids[first + np.arange(copies.sum())]
                pairs = np.repeat(row, copies)
                other = found != own[pairs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[pairs][other]), pa.array(pairs[other]), pa.array(found[other]), pa.array(np.repeat(scores, copies)[other]),
                     pa.array(np.full(int(other.sum()), batch.column("block")[at].as_py(), np.int32)),
                     pa.array(np.full(int(other.sum()), place[0], np.int32))],
                    ["query_id", "query_row", "vec_id", "score", "block", "dim"],
                )

    met = spread.join(index, ["dim", "band", "shard"]).select("dim", "band", "shard", "block", "entries", "queries")
    found = met.sortWithinPartitions("dim", "band", "shard").mapInArrow(run, "query_id long, query_row long, vec_id long, score double, block int, dim int")
    best = Window.partitionBy("dim", "block", "query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, wanted, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", relax: float = RELAX) -> DataFrame:
    """The k nearest rows of ``table`` for each of its rows that ``wanted`` (a condition on vec_id) picks."""
    rows = materialise(usable(table, id_column, vector_column), "vectors")
    index, shards = build_index(rows, k)
    return search(index, shards, rows.filter(wanted), k, relax)
