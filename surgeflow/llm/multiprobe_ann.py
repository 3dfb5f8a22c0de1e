"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the largest inner product. Vectors are indexed by bands of their
norms, a ratio of ``BAND`` wide; those of a band are divided by its largest norm
and given one more coordinate that brings each to length 1, queries are scaled
to length 1: the nearest of a band by distance is then the nearest by inner
product. A query probes every band alike, whatever its size.
Each of ``TABLES`` hash tables cuts ``HASHES`` Gaussian projections into cells
of ``WIDTH``; a query visits its own bucket and those next to it (each
coordinate one cell down, up, or as it is) in the order of their estimated
success, the sum of squared distances from its projections to the cells'
borders. The candidates of all tables are ranked by their exact inner products
on the original vectors, in double precision.

How many buckets a query visits follows from what it finds. It begins with
``FIRST`` a table in every band. Its k-th score then says how near an unseen row
must be to matter: for a row at just that distance the projections differ by
Gaussians of that width, so the chance that it lies in none of the buckets
visited is the product over the tables of one minus the sum of the buckets'
chances. In each band the query visits, in a second turn, as many buckets as
bring that chance to ``MISS``; none where the band's norms cannot reach the k-th
score; and all rows where the buckets next to its own do not suffice. A query
without ``k`` rows goes on with ``GROWTH`` times as many buckets, with all rows
at last. Near neighbours are thus found in few buckets, far ones in many, by one
rule for every query.

Nothing is capped: every row is indexed in every table, all rows of a visited
bucket are candidates, and however many share a bucket, its rows are cut into
blocks of about ``BLOCK_ROWS`` that each meet the queries that visit it, in
parts of about ``QUERY_LIMIT``. A block returns its best ``k`` per query, later
only those that reach the k-th score of the turn before, which lose none of the
overall best.

Vectors that are null, empty, zero, hold a null or non-finite component, or have
not the most frequent length take no part (neither as query nor as candidate).
Rows with equal ids count as one candidate with the better score, and as one
query (the vector that sorts first). Null ids take no part. Other columns are
not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, partitions, settled

TABLES, HASHES, WIDTH = 3, 8, 2.5
PROBES = 3**HASHES  # buckets of a table next to a query's, its own included
FIRST, GROWTH = 8, 32
MISS = 0.05
BAND = 2**0.25
BLOCK_ROWS = 16_384  # rows of a table that a task scores, two times that at most
QUERY_LIMIT = 65_536  # visits to a block that a task holds, two times that at most
QUERY_ROWS = 128  # queries scored at once against a block
PLAN_ROWS = 64  # queries whose visits are worked out at once
SEED = 20250
STEPS = np.array(list(itertools.product((0, -1, 1), repeat=HASHES)), np.int64)  # perturbations of a bucket
_erf = np.frompyfunc(math.erf, 1, 1)


def _over_steps(parts: np.ndarray, op: np.ufunc) -> np.ndarray:
    """For each step ``op`` over its coordinates' parts (queries x hashes x stay, down, up)."""
    out = parts[:, 0]
    for j in range(1, parts.shape[1]):
        out = op(out[:, :, None], parts[:, j, None, :]).reshape(len(parts), -1)
    return out


class Hasher:
    """Projections, offsets and bucket codes of all tables for one dimension."""

    def __init__(self, dim: int):
        rng = np.random.default_rng(SEED)
        self.a = rng.standard_normal((TABLES, dim + 1, HASHES))
        self.b = rng.random((TABLES, HASHES)) * WIDTH
        self.code = rng.integers(1, 2**62, (TABLES, HASHES)) * 2 + 1
        self.band_code = rng.integers(1, 2**62, TABLES) * 2 + 1

    def cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell coordinates and the places within the cells."""
        p = (x @ self.a[table] + self.b[table]) / WIDTH
        c = np.floor(p)
        return c.astype(np.int64), p - c

    def codes(self, cells: np.ndarray, table: int) -> np.ndarray:
        return (cells * self.code[table]).sum(-1)

    def band(self, bands: np.ndarray, table: int) -> np.ndarray:
        """What a band adds to the codes of its buckets."""
        return bands.astype(np.int64) * self.band_code[table]

    def order(self, q: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per query the steps best first, the codes of their buckets, its places within its cells."""
        cells, place = self.cells(q, table)
        cost = _over_steps(np.stack([np.zeros_like(place), place**2, (1 - place) ** 2], -1), np.add)
        best = np.argsort(cost, axis=1, kind="stable")
        return best, self.codes(cells, table)[:, None] + self.codes(STEPS, table)[best], place

    def probes(self, q: np.ndarray, table: int) -> np.ndarray:
        """Codes of the buckets next to each query, best first."""
        return self.order(q, table)[1]


def missed(orders: list[tuple[np.ndarray, np.ndarray, np.ndarray]], distance: np.ndarray) -> np.ndarray:
    """Per query (row) the chance that a row at ``distance`` is in none of the first 1, 2, ... buckets."""
    out = np.ones((len(distance), PROBES))
    for best, _, place in orders:
        edges = np.stack([-place - 1, -place, 1 - place, 2 - place], -1) * (WIDTH / distance)[:, None, None]
        chance = np.diff(_erf(edges / math.sqrt(2)).astype(np.float64) / 2, axis=-1)[..., [1, 0, 2]]
        out *= 1 - np.cumsum(np.take_along_axis(_over_steps(chance, np.multiply), best, 1), 1)
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _packed(m: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(m)]


def _unpacked(rows: pa.ChunkedArray, dim: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows.to_pylist()), dtype).reshape(-1, dim).astype(np.float64)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row; equal rows give equal results wherever they stand."""
    return np.einsum("ij,ij->i", a, b)


def best_of(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, seen: np.ndarray,
            k: int, kth: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the ``k`` nearest of the rows ``seen`` (queries x rows) but those
    of its own id, and but those below a score ``kth`` that it has reached k times
    (NaN: none): rows of (query's place, id, exact score)."""
    seen = seen & (ids != qids[:, None])
    rough = q.astype(np.float32) @ x.astype(np.float32).T
    rough[~seen] = -np.inf
    edge = np.full(len(q), -np.inf) if kth is None else np.where(np.isnan(kth), -np.inf, kth)
    if x.shape[0] > k and np.isinf(edge).any():
        edge = np.maximum(edge, np.partition(rough, x.shape[0] - k, axis=1)[:, x.shape[0] - k])
    # single precision and ties: keep all that come near the k-th
    slack = 1e-5 * np.sqrt((q * q).sum(1) * (x * x).sum(1).max())
    at, on = np.nonzero(seen & (rough >= (edge - slack)[:, None]))
    score = exact(x[on], q[at])
    order = np.lexsort((ids[on], -score, at))
    at, on, score = at[order], on[order], score[order]
    first = np.searchsorted(at, np.arange(len(q)))
    keep = np.arange(len(at)) - first[at] < k
    return at[keep], ids[on[keep]], score[keep]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, dict[int, tuple[float, int]]]:
    """Rows that take part (``vec_id``, ``v``, ``band``), their dimension, and each band's
    largest norm and number of rows."""
    v = F.col("v")
    fine = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(fine)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = rows.withColumn("norm", norm).withColumn(  # norms about 1 lie in the middle of a band
        "band", F.coalesce(F.floor(F.log("norm") / math.log(BAND) + 0.5).cast("long"), F.lit(0).cast("long")))
    sizes = rows.groupBy(F.size("v").alias("dim"), "band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top"))
    sizes = sizes.groupBy("dim").agg(F.sum("n").alias("n"), F.collect_list(F.struct("band", "top", "n")).alias("bands"))
    got = sizes.orderBy(F.desc("n"), F.desc("dim")).first()  # its bands: as many as the norms' range has
    rows = rows.drop("norm")
    if got is None:
        return rows, 0, {}
    return rows.where(F.size("v") == got["dim"]), got["dim"], {b["band"]: (b["top"] or 1.0, b["n"]) for b in got["bands"]}


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found for each
    row of which ``is_query`` (on ``vec_id``) holds."""
    spark = vectors.sparkSession
    rows, dim, bands = usable(vectors, id_col, vec_col)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    single = rows.schema["v"].dataType.elementType.simpleString() == "float"
    dtype = "<f4" if single else "<f8"
    probed = np.array(sorted(bands), np.int64)
    groups = -(-sum(n for _, n in bands.values()) // BLOCK_ROWS)  # a block returns k rows a query: no more blocks than the rows need
    hasher = Hasher(dim)

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = _matrix(b.column(1), dim).astype(dtype)
            band, ids = b.column(2).to_numpy(), b.column(0).to_numpy()
            x = raw.astype(np.float64) / np.array([bands[i][0] for i in band.tolist()])[:, None]
            x = np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]], 1)
            for t in range(TABLES):
                code = hasher.codes(hasher.cells(x, t)[0], t) + hasher.band(band, t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), t, np.int32)), pa.array((code % groups).astype(np.int32)), pa.array(code),
                     pa.array(ids), pa.array(_packed(raw), pa.binary())], names=["tab", "grp", "code", "vec_id", "v"])

    def span(orders: list, kth: np.ndarray, norm: np.ndarray, top: float, seen: int, limit: int) -> np.ndarray:
        """Up to which bucket each query visits a band; beyond ``PROBES``: all rows."""
        upto = np.full(len(kth), limit if seen < PROBES else PROBES + 1)
        known = np.flatnonzero(~np.isnan(kth))
        if len(known):
            near = kth[known] / (norm[known] * top)
            distance = np.sqrt(np.maximum(2 - 2 * near, 1e-12))
            enough = (missed([(b[known], c, p[known]) for b, c, p in orders], distance) > MISS).sum(1) + 1
            upto[known] = np.where(near > 1 + 1e-9, 0, enough)
        return upto

    def visit(seen: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for a in range(0, b.num_rows, PLAN_ROWS):
                    yield from plan(b.slice(a, PLAN_ROWS))

        def batch(out: list[list]) -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=["tab", "grp", "query_id", "kth", "q", "codes"])

        def plan(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            raw = _matrix(b.column(1), dim).astype(dtype)
            ids, kth = b.column(0).to_numpy(), b.column(2).cast(pa.float64()).to_numpy(zero_copy_only=False)
            wide = raw.astype(np.float64)
            norm = np.sqrt((wide * wide).sum(1))
            q = np.concatenate([unit(wide), np.zeros((len(raw), 1))], 1)
            packed = _packed(raw)
            orders = [hasher.order(q, t) for t in range(TABLES)]
            upto = np.stack([span(orders, kth, norm, bands[band][0], seen, limit) for band in probed.tolist()])
            whole = (upto > PROBES).any(0)
            for i, t in itertools.product(range(len(probed)), range(TABLES)):
                codes, out = orders[t][1] + hasher.band(probed[i], t), [[] for _ in range(6)]
                for j in np.flatnonzero((upto[i] > seen) & ~whole):
                    p = codes[j, seen:upto[i, j]]
                    g = p % groups
                    order = np.argsort(g, kind="stable")
                    cut = np.flatnonzero(np.diff(g[order], prepend=-1))
                    for x, z in zip(cut, np.append(cut[1:], len(g))):
                        for o, v in zip(out, (t, int(g[order[x]]), ids[j], kth[j], packed[j], p[order[x:z]].tobytes())):
                            o.append(v)
                yield batch(out)
            all_rows = np.flatnonzero(whole).tolist()  # once: every block of one table's groups
            n = len(all_rows)
            yield batch([[0] * n, [None] * n, ids[all_rows], kth[all_rows], [packed[j] for j in all_rows], [None] * n])

        return run

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            code, ids = left["code"].to_numpy(), left["vec_id"].to_numpy()
            x = _unpacked(left["v"], dim, dtype)
            known, bucket = np.unique(code, return_inverse=True)
            q, qids, kth = _unpacked(right["q"], dim, dtype), right["query_id"].to_numpy(), right["kth"].to_numpy()
            codes = right["codes"].to_pylist()
            for a in range(0, len(q), QUERY_ROWS):
                some = slice(a, a + QUERY_ROWS)
                visited = np.zeros((len(q[some]), len(known)), bool)
                for i, c in enumerate(codes[some]):
                    if c is None:  # meets all rows
                        visited[i] = True
                        continue
                    c = np.frombuffer(c, np.int64)
                    at = np.minimum(np.searchsorted(known, c), len(known) - 1)
                    visited[i, at[known[at] == c]] = True
                at, got, score = best_of(ids, x, qids[some], q[some], visited[:, bucket], k, kth[some])
                for o, v in zip(out, (qids[some][at], got, score)):
                    o.append(v)
        cat = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.table({"query_id": pa.array(cat[0].astype(np.int64)), "vec_id": pa.array(cat[1].astype(np.int64)),
                         "score": pa.array(cat[2].astype(np.float64))})

    placed = rows.mapInArrow(index, "tab int, grp int, code long, vec_id long, v binary")
    blocks = placed.groupBy("tab", "grp").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK_ROWS)).alias("blocks"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    key = ["tab", "grp", "block", "part"]

    def met(visits: DataFrame, blocks: DataFrame) -> DataFrame:
        """What the queries find in the buckets they visit."""
        sizes = (visits.groupBy("tab", "grp").agg(F.ceil(F.count(F.lit(1)) / (2 * QUERY_LIMIT)).alias("parts"))
                 .join(blocks, ["tab", "grp"]))
        left = (placed.join(sizes, ["tab", "grp"]).withColumn("block", F.expr("pmod(xxhash64(vec_id), blocks)"))
                .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("blocks", "parts"))
        right = (visits.join(sizes, ["tab", "grp"]).withColumn("part", F.expr("pmod(xxhash64(query_id), parts)"))
                 .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))).drop("blocks", "parts"))
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query_id long, vec_id long, score double")

    with Workspace(spark, "op2") as ws:
        blocks = ws.write(blocks, "blocks")
        queries = ws.write(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).repartition(partitions(spark), "vec_id"), "queries")
        going, seen, limit, found = queries.withColumn("kth", F.lit(None).cast("double")), 0, FIRST, None
        while True:  # two turns for queries that find k rows in their first buckets, four at most
            visits = going.mapInArrow(visit(seen, min(limit, PROBES)), "tab int, grp int, query_id long, kth double, q binary, codes binary")
            groups_of = F.expr(f"if(grp is null, sequence(0, {groups - 1}), array(grp))")
            visits = ws.write(visits.withColumn("grp", F.explode(groups_of)), f"visits-{limit}")
            if visits.isEmpty():
                break
            new = met(visits, blocks)
            if found is not None:
                new = new.unionByName(found.drop("rank"))
            new = new.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
            found = ws.write(new.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), f"found-{limit}")
            if seen >= PROBES:
                break
            kth = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
            going = going.where("kth is null").drop("kth").join(kth, "vec_id", "left")
            seen, limit = min(limit, PROBES), limit * GROWTH
        if found is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return settled(found, "op2")


def brute_force(ids: np.ndarray, x: np.ndarray, qid: int, q: np.ndarray, k: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` nearest of all rows."""
    _, got, score = best_of(ids, x, np.array([qid]), q[None], np.ones((1, len(ids)), bool), k)
    return got, score
