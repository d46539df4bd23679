"""Exact search for the largest inner products over vectors keyed by nearest pivot and distance to it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns
from tidemark.operators.ranking import with_position
from tidemark.shared import new_folder

TOP = 20
SCALE = 64
PIVOTS = 32
#: Rows that the pivots are chosen from, those with the smallest hash of id and vector. The pivots only order the work.
PIVOT_SAMPLE = 2048
#: A part is what one task searches at a time, an annulus the rows of a part that are pruned together.
PART_ROWS, PART_BYTES = 1 << 16, 64 << 20
ANNULUS_ROWS = 1024
SLAB_QUERIES = 1024
#: Slack of a bound that was computed in doubles, as a share of the largest squared length. A distance near 0 is
#: the root of a difference, so it is off by some 1e-7 of the longest vector.
SLACK = 1e-6

_FOUND = {"row": "long", "query_id": "long", "vec_id": "long", "score": "long"}


@dataclass
class Space:
    """What all tasks know: ``reach`` is the largest squared length, ``pivots`` are points with one more coordinate.

    A vector x becomes (x, sqrt(reach - |x|^2)) and a query (q, 0). All such vectors have length sqrt(reach), so the nearest
    ones to a query are those of the largest inner products, and the triangle inequality bounds them.
    """

    reach: float
    dtype: str
    pivots: np.ndarray

    def of_dims(self, dims: int) -> np.ndarray:
        """The pivots for vectors of ``dims`` components: cut, or filled with zeros. Any points will do as pivots."""
        out = np.zeros((len(self.pivots), dims + 1))
        width = min(dims, self.pivots.shape[1] - 1)
        out[:, :width], out[:, dims] = self.pivots[:, :width], self.pivots[:, -1]
        return out

    def distances(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Distance of each row to each pivot."""
        x = vectors.astype(np.float64)
        square = (x * x).sum(axis=1)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.reach - square, 0))
        pivots = self.of_dims(x.shape[1])
        total = (square + last * last)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots[:, :-1].T + np.outer(last, pivots[:, -1]))
        return np.sqrt(np.maximum(total, 0))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component x as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def is_usable(vector: Column) -> Column:
    """Whether there is a vector and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def choose_pivots(sample: list[list[int]], reach: float, wanted: int = PIVOTS) -> np.ndarray:
    """Farthest-first pivots out of the sample, in the space with one more coordinate."""
    width = max(map(len, sample), default=0)
    points = np.zeros((len(sample), width + 1))
    for k, x in enumerate(sample):
        points[k, : len(x)] = x
        points[k, -1] = np.sqrt(max(reach - float(np.dot(points[k, :-1], points[k, :-1])), 0))
    chosen = [0] if sample else []
    gap = ((points - points[0]) ** 2).sum(axis=1) if sample else np.zeros(0)
    while chosen and len(chosen) < wanted and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen] if chosen else np.zeros((1, 1))


def _products(left: np.ndarray, right: np.ndarray, space: Space) -> np.ndarray:
    """Exact inner products: in the narrowest arithmetic that holds them, and clipped to 64 bits if none does."""
    most = space.reach * (1 + SLACK)
    if most < 2**24:
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return left.astype(np.int64) @ right.astype(np.int64).T
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class Part:
    """The rows of one part, in annuli around their pivots."""

    def __init__(self, space: Space, dims: int, ids: np.ndarray, no_id: np.ndarray, vectors: np.ndarray):
        self.space, self.ids, self.no_id, self.vectors = space, ids, no_id, vectors
        distance = space.distances(vectors)
        pivot, self.annuli = distance.argmin(axis=1), []
        near = distance[np.arange(len(ids)), pivot]
        order = np.lexsort((near, pivot))
        starts = np.flatnonzero(np.r_[True, np.diff(pivot[order]) != 0]) if len(order) else []
        for a, b in zip(starts, [*starts[1:], len(order)]):
            for at in range(a, b, ANNULUS_ROWS):
                rows = order[at : min(at + ANNULUS_ROWS, b)]
                self.annuli.append((int(pivot[rows[0]]), float(near[rows[0]]), float(near[rows[-1]]), rows))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest score that each query can have in each annulus, by the triangle inequality."""
        distance = self.space.distances(queries, query=True)
        square = (queries.astype(np.float64) ** 2).sum(axis=1)
        out = np.empty((len(queries), len(self.annuli)))
        for k, (pivot, low, high, _) in enumerate(self.annuli):
            gap = np.maximum(0, np.maximum(distance[:, pivot] - high, low - distance[:, pivot]))
            out[:, k] = (square + self.space.reach - gap * gap) / 2
        return out + SLACK * (1 + self.space.reach)

    def search(self, queries: np.ndarray, query_ids: np.ndarray, tau: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows of the part, scores) of each query that may be among its best, none below its ``tau``.

        Annuli are taken outwards, nearest first, and the search stops when no query's best score can lie further out.
        """
        bound = self.bounds(queries)
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(queries))]
        tau = tau.astype(np.float64).copy()
        peak = bound.max(axis=0, initial=-np.inf)
        for k in np.argsort(-peak, kind="stable").tolist():
            if peak[k] < tau.min():
                break
            live = np.flatnonzero(bound[:, k] >= tau)
            if not len(live):
                continue
            rows = self.annuli[k][3]
            score = _products(queries[live], self.vectors[rows], self.space)
            hit = score >= tau[live][:, None]
            hit &= (self.ids[rows][None, :] != query_ids[live][:, None]) | self.no_id[rows][None, :]
            for j in np.flatnonzero(hit.any(axis=1)).tolist():
                q, at = live[j], np.flatnonzero(hit[j])
                r, s = np.concatenate([held[q][0], rows[at]]), np.concatenate([held[q][1], score[j, at]])
                if len(s) > TOP:
                    best = np.lexsort((self.ids[r], self.no_id[r], -s))[:TOP]
                    r, s = r[best], s[best]
                    tau[q] = max(tau[q], s[-1])
                held[q] = r, s
        return held


_SLAB = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("dims", pa.int32()), *[(c, pa.binary()) for c in ("ids", "no_id", "rows", "vectors", "tau")]])


def _slabs(placed: DataFrame, kind: int, dtype: str, most: int) -> DataFrame:
    """Rows (part, dims, id, position, vector, tau) as binary slabs of up to ``most`` rows of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, dims, rows, tau = (batch.column(c).to_numpy() for c in ("part", "dims", "position", "tau"))
            ids, no_id = batch.column("id").fill_null(0).to_numpy(), batch.column("id").is_null().to_numpy(zero_copy_only=False)
            values, ends = batch.column("vector").flatten().to_numpy().astype(dtype), np.cumsum(dims, dtype=np.int64)
            starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (dims[1:] != dims[:-1])]) if len(part) else []
            for first, end in zip(starts, [*starts[1:], len(part)]):
                for a in range(first, end, most):
                    b = min(a + most, end)
                    made = (part[a], kind, dims[a], *[x.tobytes() for x in (ids[a:b], no_id[a:b], rows[a:b], values[ends[a] - dims[a] : ends[b - 1]], tau[a:b])])
                    yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(made, _SLAB)], schema=_SLAB)

    if "tau" not in placed.columns:
        placed = placed.withColumn("tau", F.lit(float("-inf")))
    columns = ", ".join(f"{c} int" for c in _SLAB.names[:3]) + "".join(f", {c} binary" for c in _SLAB.names[3:])
    return placed.select("part", "dims", "id", "position", "vector", "tau").mapInArrow(run, columns)


def _search_parts(slabs: DataFrame, space, keep_queries: bool) -> DataFrame:
    """Search each part for the query slabs that came to it; with ``keep_queries`` give back each query's best score of rank ``TOP`` as well."""
    schema = ", ".join(f"{c} {kind}" for c, kind in {**_FOUND, "tau": "double"}.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = space.value
        part, pieces, built = None, [], {}

        def array(values, dtype):
            return np.frombuffer(values, dtype=dtype)

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["part"] != part:
                    part, pieces, built = row["part"], [], {}
                dims = row["dims"]
                ids, no_id, at = array(row["ids"], np.int64), array(row["no_id"], bool), array(row["rows"], np.int64)
                vectors = array(row["vectors"], known.dtype).reshape(len(ids), dims)
                if row["kind"] == 0:  # rows of the part come first
                    pieces.append((dims, ids, no_id, vectors))
                    continue
                if dims not in built:
                    own = [p for p in pieces if p[0] == dims]
                    columns = [np.concatenate([p[k] for p in own]) for k in (1, 2, 3)] if own else [ids[:0], no_id[:0], vectors[:0]]
                    built[dims] = Part(known, dims, *columns)
                index = built[dims]
                found = index.search(vectors, ids, array(row["tau"], np.float64))
                sizes = [len(s) for _, s in found]
                r, s = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                last = np.array([f[1].min() if len(f[1]) == TOP else -np.inf for f in found], dtype=np.float64)
                columns = [np.repeat(at, sizes), np.repeat(ids, sizes), pa.array(index.ids[r], mask=index.no_id[r]), s, np.repeat(last, sizes)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[*_FOUND, "tau"])

    found = slabs.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, schema)
    return found if keep_queries else found.drop("tau")


def top_inner_products(vectors: DataFrame, is_query: Column, *, id_column: str = "vec_id", vector_column: str = "embedding", top: int = TOP, part_rows: int = PART_ROWS) -> DataFrame:
    """The ``top`` largest inner products of each query among all rows but its own, exactly.

    Components count as floor(64 * x). ``is_query`` is a condition on the columns of ``vectors``. The rows are ordered by (number of
    components, nearest pivot, distance, id) and cut into parts of equal size, so that a hot pivot or many equal vectors are
    many parts. Each query is searched for in the part it lies in first; the score it reaches there then bounds
    the search in all other parts, which read queries in slabs: parts and slabs are of bounded size, whatever the table's.

    Returns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``. Ties go to the smaller id, a null id last. Vectors that are null or hold a null
    or a component that is not finite take no part; vectors of another number of components than the query's are no
    candidates, and neither are rows with the query's id. Repeated rows are candidates each; a repeated query gives its result
    each time. Scores beyond 64 bits are clipped. A row without id is never a query. An empty table gives an empty result, other
    columns are not read.
    """
    if top != TOP:
        raise ValueError(f"top is fixed at {TOP}")
    spark = vectors.sparkSession
    context = spark.sparkContext
    folder = new_folder(spark, "search-vectors")
    whole = vectors.where(is_usable(F.col(vector_column)))
    whole = whole.select(F.col(id_column).alias("id"), scaled(F.col(vector_column)).alias("vector"), F.coalesce(is_query & F.col(id_column).isNotNull(), F.lit(False)).alias("is_query"))
    whole.withColumn("dims", F.size("vector")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most = F.max(F.greatest(F.abs(F.array_max("vector").cast("double")), F.abs(F.array_min("vector").cast("double"))))
    n, reach, largest, dims = rows.agg(F.count("*"), F.max(square), most, F.max("dims")).first()
    largest, reach = largest or 0.0, reach or 0.0
    dtype = next(t for t, limit in (("int8", 127), ("int16", 2**15 - 1), ("int32", 2**31 - 1), ("int64", float("inf"))) if largest <= limit)
    sample = rows.select("vector").orderBy(F.xxhash64("id", "vector")).limit(PIVOT_SAMPLE).collect() if (dims or 0) * PIVOT_SAMPLE * 8 <= PART_BYTES else rows.select("vector").limit(PIVOTS).collect()
    space = Space(reach, dtype, choose_pivots([r["vector"] for r in sample], reach))
    shared = context.broadcast(space)  # PIVOTS vectors

    placed = with_position(_keyed(rows, shared), ["dims", "pivot", "distance", "id"], copies=True)
    part_rows = max(1, min(part_rows, PART_BYTES // max(1, 8 * (dims or 1))))
    parts = -(-n // part_rows)
    numbered = new_folder(spark, "search-parts")
    placed.withColumn("part", F.floor((F.col("position") - 1) / part_rows).cast("int")).write.parquet(numbered)
    placed = spark.read.parquet(numbered)

    data = _slabs(placed, 0, dtype, ANNULUS_ROWS)
    queries = _slabs(placed.where("is_query"), 1, dtype, SLAB_QUERIES)
    at_home = new_folder(spark, "search-home")
    _search_parts(data.unionByName(queries), shared, True).write.parquet(at_home)
    home = spark.read.parquet(at_home)
    found = home.select("row", "query_id", "vec_id", "score")
    if parts > 1:
        reached = home.groupBy("row").agg(F.max("tau").alias("tau"))
        asked = placed.where("is_query").join(reached, F.col("position") == F.col("row"), "left")
        asked = asked.withColumn("tau", F.coalesce("tau", F.lit(float("-inf")))).sortWithinPartitions("position")
        bounded = _slabs(asked, 1, dtype, SLAB_QUERIES)
        spread = bounded.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("to"), "*").where("to <> part").drop("part").withColumnRenamed("to", "part")
        found = found.unionByName(_search_parts(data.unionByName(spread), shared, False))
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").isNull(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _keyed(rows: DataFrame, space) -> DataFrame:
    """Rows with nearest ``pivot`` and ``distance`` to it."""

    def work():
        known = space.value

        def step(part):
            pivot, distance = [0] * len(part["dims"]), [0.0] * len(part["dims"])
            by_dims: dict[int, list[int]] = {}
            for k, d in enumerate(part["dims"]):
                by_dims.setdefault(d, []).append(k)
            for d, at in by_dims.items():
                gap = known.distances(np.array([part["vector"][k] for k in at], dtype=np.float64).reshape(len(at), d))
                for k, p, x in zip(at, gap.argmin(axis=1).tolist(), gap.min(axis=1).tolist()):
                    pivot[k], distance[k] = p, x
            return {"pivot": pivot, "distance": distance}

        return step

    return add_columns(rows, ["id", "is_query", "dims", "vector"], ["dims", "vector"], work, {"pivot": "int", "distance": "double"})
