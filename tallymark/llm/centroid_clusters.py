"""k-means over integer vectors, with centroids ruled out in rotated coordinates.

Vectors of exactly `DIMENSIONS` finite components are scaled to integers,
floor(`SCALE` * x). All arithmetic that decides a result is exact: squared distances in
64-bit integers, centroids as floors of exact component sums.

1. One pass sums the vectors' products; the eigenvectors of their 64 x 64 covariance are
   the rotation. A table keeps each vector's integers, its `LEADING` first rotated
   coordinates and the norm of the rest.
2. For a centroid rotated alike, the distance of the leading coordinates plus the squared
   difference of the rest norms is never more than the full distance. A round measures
   the centroid with the least such bound exactly, rules out those whose bound (less a
   margin for rounding) exceeds that, and measures the survivors exactly. Ties go to the
   smaller number.
3. Every task adds up its own vectors by cluster, so a round sends some thousand numbers a
   task, whatever the sizes of clusters; the driver holds the centroids only.

The first centroids are the kept vectors with the least sha256 of "2:<vec_id>". Vectors
that aren't kept have no row. Rows that repeat a vec_id, or vectors that repeat, count
each; equal hashes are ordered by the vectors. A null vec_id is assigned but is no first
centroid. With fewer vectors than centroids each is one; an empty table gives an empty
table. Components beyond 2 ** `WIDEST` after scaling fail the job, as 64 bits would not
hold their distances. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.session import written_once

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
LEADING, WIDEST = 48, 27
PAIRS = 1 << 15  # measured at a time
Batches = Iterator[pa.RecordBatch]


def _flat(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind, copy=False)


def scaled(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors of the right shape as integers."""
    x = F.col("embedding").cast("array<double>")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter((F.size("embedding") == dimensions) & fit)
    floor = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    wide = F.exists(x, lambda c: F.abs(c) * scale >= float(1 << WIDEST))
    checked = F.when(wide, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(floor)
    return rows.select("vec_id", checked.cast("array<long>").alias("v"))


def _products(width: int):
    def run(batches: Batches) -> Batches:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = _flat(batch.column("v"), width, np.float64)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "value"])

    return run


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the covariance, by falling variance, as columns.

    Whatever rotation comes out of the floating-point sums, bounds stay bounds.
    """
    rows = vectors.select("v").mapInArrow(_products(width), "at long, value double").groupBy("at").agg(F.sum("value")).collect()
    total = np.zeros((width + 1) ** 2)
    for at, value in rows:
        total[at] = value
    total = total.reshape(width + 1, width + 1)
    n = max(1.0, total[-1, -1])
    mean = total[-1, :-1] / n
    _, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return axes[:, ::-1]


def projected(x: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates, and the norm of the others."""
    turned = x.astype(np.float64) @ axes
    return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(1))


def _rotated(axes: np.ndarray, leading: int, width: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            lead, rest = projected(_flat(batch.column("v"), width), axes, leading)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rest) + 1) * lead.shape[1], pa.int32()), pa.array(lead.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), lists, pa.array(rest)], names=["vec_id", "v", "lead", "rest"])

    return run


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each vector, and how many exact distances that took."""
    c_lead, c_rest = projected(centroids, axes, lead.shape[1])
    squares = (lead**2).sum(1) + rest**2
    c_squares = (c_lead**2).sum(1) + c_rest**2
    bound = (lead**2).sum(1)[:, None] - 2 * lead @ c_lead.T + (c_lead**2).sum(1) + (rest[:, None] - c_rest) ** 2
    bound -= 1e-9 * (squares[:, None] + c_squares) + 1e-3  # far more than rounding
    guess = bound.argmin(1)
    best = _measured(x, centroids, np.arange(len(x)), guess)
    open_to = bound <= best[:, None]
    open_to[np.arange(len(x)), guess] = False
    who, which = np.nonzero(open_to)
    exact = _measured(x, centroids, who, which)
    # least distance, then smallest number
    order = np.lexsort((which, exact, who))
    first = order[np.append(True, np.diff(who[order]) > 0)] if len(who) else order
    cluster, at = guess.copy(), who[first]
    better = (exact[first] < best[at]) | ((exact[first] == best[at]) & (which[first] < guess[at]))
    cluster[at[better]], best[at[better]] = which[first][better], exact[first][better]
    return cluster, best, len(x) + len(who)


def _measured(x: np.ndarray, centroids: np.ndarray, who: np.ndarray, which: np.ndarray) -> np.ndarray:
    out = np.empty(len(who), np.int64)
    for a in range(0, len(who), PAIRS):
        d = x[who[a : a + PAIRS]] - centroids[which[a : a + PAIRS]]
        out[a : a + PAIRS] = np.einsum("ij,ij->i", d, d)
    return out


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, axes: np.ndarray, leading: int):
    x = _flat(batch.column("v"), centroids.shape[1])
    lead = _flat(batch.column("lead"), leading, np.float64)
    return x, *nearest(x, lead, batch.column("rest").to_numpy(), centroids, axes)


def _sums(centroids: np.ndarray, axes: np.ndarray, leading: int):
    """Per cluster its size and component sums over the task's vectors, and the exact distances taken."""

    def run(batches: Batches) -> Batches:
        k, width = centroids.shape
        total, measured = np.zeros((k, width + 1), np.int64), 0
        for batch in batches:
            x, cluster, _, taken = _assigned(batch, centroids, axes, leading)
            order = np.argsort(cluster, kind="stable")
            full, first = np.unique(cluster[order], return_index=True)
            if len(full):
                total[full, :-1] += np.add.reduceat(x[order], first)
                total[full, -1] += np.diff(np.append(first, len(order)))
            measured += taken
        at = np.arange(total.size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), measured))], names=["at", "value"])

    return run


def _labels(centroids: np.ndarray, axes: np.ndarray, leading: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            _, cluster, distance, _ = _assigned(batch, centroids, axes, leading)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, leading: int = LEADING, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, cluster, distance), the final centroids, and the exact distances of each round."""
    kept = written_once(scaled(vectors, dimensions, scale), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.filter("vec_id is not null").select("v", order.alias("h")).orderBy("h", "v").limit(clusters).collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(-1, dimensions)
    if not len(centroids):
        return kept.limit(0).selectExpr("vec_id", "0 as cluster", "0L as distance"), centroids, []
    axes = rotation(kept, dimensions)
    table = written_once(kept.mapInArrow(_rotated(axes, leading, dimensions), "vec_id long, v array<long>, lead array<double>, rest double"), "rotated")
    taken = []
    for _ in range(rounds):
        rows = table.select("v", "lead", "rest").mapInArrow(_sums(centroids, axes, leading), "at long, value long")
        sums = np.zeros(centroids.size + len(centroids) + 1, np.int64)
        for at, value in rows.groupBy("at").agg(F.sum("value")).collect():
            sums[at] = value
        taken.append(int(sums[-1]))
        total = sums[:-1].reshape(len(centroids), -1)
        full = total[:, -1] > 0
        centroids = centroids.copy()
        centroids[full] = total[full, :-1] // total[full, -1:]
    return table.mapInArrow(_labels(centroids, axes, leading), "vec_id long, cluster int, distance long"), centroids, taken


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, centroids, _ = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    labels = written_once(labels, "labels")
    sums = {r.cluster: int(r.total) for r in labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    # a row per centroid
    digest = [(i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    known = spark.createDataFrame(digest, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labels.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The same by plain distances, a step per round."""
    steps = [
        f"""x AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIMENSIONS}
), n AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM x)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM x WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CLUSTERS})
)""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, min(k) AS k, min(d) AS d FROM (
    SELECT *, min(d) OVER (PARTITION BY r) AS least FROM (
      SELECT r, vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM n CROSS JOIN c{i}
    )
  ) WHERE d = least GROUP BY r, vec_id, v
)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, list(((s - ((s % q) + q) % q) // q)::BIGINT ORDER BY j) AS m
    FROM (SELECT k, j, sum(e) AS s, count(*) AS q FROM (SELECT k, unnest(v) AS e, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY k, j) GROUP BY k
  ) USING (k)
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f""" SELECT a.vec_id, a.k::INTEGER AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (k)"""
    )


SQL = _sql()
