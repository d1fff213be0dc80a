"""Near duplicates by b-bit MinHash.

Every document becomes the set of its distinct word shingles. Minima of
`BANDS * ROWS` hash functions give band keys; two sets of similarity s share
at least one of them with probability 1 - (1 - s**ROWS)**BANDS, at s = 0.8 all
but 1 in 7 million. Of each minimum only the low `BITS` bits are kept, packed into
longs; comparing them by bit counts, corrected for chance collisions of 2**-BITS,
estimates the similarity of a candidate pair with a standard error of 0.034, and
pairs estimated more than `SLACK` (six of these) below the threshold go. The others
are confirmed on their full sets.

Links are looked for in two steps that never list all pairs of a bucket:

1. equal sets are one class; every class is compared with the least class of each
   of its buckets, and confirmed links are joined into components;
2. where a bucket still spans several components, its classes form a cluster. A
   class can only reach the threshold with shingles that another class of the
   cluster has too; classes with too few such shingles are out. The rest, minus the
   cluster's largest component on one side, is compared in blocks inside tasks; only
   links come out of them.

Null and wordless texts have an empty set and link with nothing. Rows without a
doc_id link with nothing and have no component. Repeated rows get equal results; rows
that repeat a doc_id with another text are documents of their own: inside, a hash of
doc_id and text (`node`) stands for a document. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.components import components
from tallymark.llm.filters import likely
from tallymark.session import written_once

BANDS, ROWS, BITS = 40, 5, 2
SLACK = 0.2
LANES = 64 // BITS
BLOCK_SHINGLES, BLOCK = 1_000_000, 1 << 18
FEATURES = "own long, doc_id long, n_shingles long, h1 long, h2 long, packed array<long>, bands array<long>"


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(4)
    draws = rng.integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
    return draws[0], draws[1] | np.uint64(1)


def shingle_sets(block: T.Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, end to end, with offsets."""
    data = T.LOWER[block.data]
    words = T.words(data, block.offsets)
    hashes = T.span_hashes(T.prefix_sums(data), words.starts, words.ends)
    rolled, whole = T.shingles(hashes, words.first, size)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if 0 < b - a < size:  # the whole sequence is the one shingle
            sets.append(T.shingles(hashes[a:b], np.array([0, b - a]), int(b - a))[0][:1] ^ np.uint64(b - a))
        else:
            sets.append(np.unique(rolled[a:b][whole[a:b]]))
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])


def _features(size: int):
    xors, odds = _functions()
    schema = pa.schema(
        [(n, pa.int64()) for n in ("own", "doc_id", "n_shingles", "h1", "h2")]
        + [(n, pa.list_(pa.int64())) for n in ("packed", "bands")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in T.blocks(batch, most=BLOCK):
                flat, offsets = shingle_sets(block, size)
                full = np.flatnonzero(np.diff(offsets))
                n = len(full)
                minima = np.zeros((BANDS * ROWS, n), np.uint64)
                sums = np.zeros((2, len(block.ids)), np.uint64)
                if n:
                    for k in range(BANDS * ROWS):
                        minima[k] = np.minimum.reduceat((flat ^ xors[k]) * odds[k], offsets[full])
                    sums[0, full] = np.add.reduceat(T.mix(flat), offsets[full])
                    sums[1, full] = np.add.reduceat(T.mix(flat ^ T.BYTE_VALUE[1]), offsets[full])
                # a product's low bits depend on few bits of its factors: keep those of a mixed minimum
                low = T.mix(minima) & np.uint64((1 << BITS) - 1)
                words = -(-BANDS * ROWS // LANES)
                packed = np.zeros((n, words), np.uint64)
                for k in range(BANDS * ROWS):
                    packed[:, k // LANES] |= low[k] << np.uint64(BITS * (k % LANES))
                bands = np.zeros((n, BANDS), np.uint64)
                for i in range(BANDS):
                    key = np.full(n, i, np.uint64)
                    for row in minima[i * ROWS : (i + 1) * ROWS]:
                        key = T.mix(key ^ row) + np.uint64(1)
                    bands[:, i] = key
                has = (np.diff(offsets) > 0).astype(np.int64)
                yield T.arrow(
                    schema,
                    [
                        *(pa.array(batch.column(c)[block.rows.start : block.rows.stop], pa.int64()) for c in ("own", "doc_id")),
                        np.diff(offsets),
                        *T.signed(sums),
                        T.list_array(T.signed(packed).ravel(), np.concatenate([[0], np.cumsum(has * words)])),
                        T.list_array(T.signed(bands).ravel(), np.concatenate([[0], np.cumsum(has * BANDS)])),
                    ],
                )

    return run


def _sets(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in T.blocks(batch, most=BLOCK):
                flat, offsets = shingle_sets(block, size)
                yield T.arrow(schema, [block.ids, T.list_array(T.signed(flat), offsets)])

    return run


def estimate(left: Column, right: Column) -> Column:
    """Similarity from packed low bits, corrected for collisions by chance."""
    ones = sum(1 << (BITS * i) for i in range(LANES))
    ones -= (1 << 64) if ones >= 1 << 63 else 0

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        spread = bits
        for i in range(1, BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(bits, i))
        return F.bit_count(spread.bitwiseAND(F.lit(ones)))

    apart = F.aggregate(F.zip_with(left, right, differing), F.lit(0), lambda total, x: total + x)
    chance = 2.0**-BITS
    return (1 - apart / float(BANDS * ROWS) - chance) / (1 - chance)


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose packed bits don't rule the threshold out."""
    left = classes.select(F.col("doc_id").alias("a"), F.col("packed").alias("pa"))
    right = classes.select(F.col("doc_id").alias("b"), F.col("packed").alias("pb"))
    near = estimate(F.col("pa"), F.col("pb")) >= percent / 100 - SLACK
    return pairs.join(left, "a").join(right, "b").filter(near).select("a", "b").distinct()


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) of the wanted documents, which alone are shuffled."""
    wanted = written_once(wanted, "wanted")
    sets = likely(docs, wanted, _sets(size), "doc_id long, shingles array<long>")
    return written_once(sets.join(wanted, "doc_id", "left_semi"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    whole = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "a").join(right, "b").filter(100 * both >= percent * whole).select("a", "b")


def _links_between(percent: int):
    """Links between two blocks of classes of one cluster."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        xs, ys = rows[rows["asks"]], rows[~rows["asks"]]
        found: list[tuple[int, int]] = []
        if len(xs) and len(ys):
            sizes = ys["shingles"].map(len).to_numpy()
            flat = np.concatenate(ys["shingles"].to_list())
            owner = np.repeat(np.arange(len(ys)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner, ids = flat[order], owner[order], ys["doc_id"].to_numpy()
            other = ys["component"].to_numpy()
            for doc_id, component, shingles in zip(xs["doc_id"], xs["component"], xs["shingles"], strict=True):
                a, b = np.searchsorted(flat, shingles, "left"), np.searchsorted(flat, shingles, "right")
                n = b - a
                hits = owner[np.repeat(b - np.cumsum(n), n) + np.arange(n.sum())]
                both = np.bincount(hits, minlength=len(ids))
                link = (100 * both >= percent * (sizes + len(shingles) - both)) & (other != component)
                found += [(doc_id, i) for i in ids[link]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _rest(members: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links between different components of a bucket; None where every bucket has but one."""
    mixed = members.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("doc_id").alias("b"))
    mixed = mixed.filter("low < high").select("band", "b")
    open_rows = written_once(members.join(mixed, "band").select(F.col("doc_id").alias("a"), "b", "component"), "mixed")
    if open_rows.isEmpty():
        return None
    named = open_rows.select(F.col("a").alias("doc_id"), "component").distinct()
    clusters = components(open_rows.select("a", "b")).withColumnsRenamed({"node": "doc_id", "component": "cluster"})
    named = named.join(clusters, "doc_id", "left").withColumn("cluster", F.coalesce("cluster", "doc_id"))
    sets = _sets_of(docs, named.select("doc_id").distinct(), size)
    full = written_once(named.join(sets, "doc_id").withColumn("n", F.size("shingles")), "clusters")
    # shingles that only this class of the cluster has can't be part of a link
    spread = full.select("cluster", "doc_id", F.explode("shingles").alias("shingle"))
    shared = spread.groupBy("cluster", "shingle").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("times"))
    lone = shared.filter("low = high").groupBy(F.col("low").alias("doc_id")).agg(F.sum("times").alias("lone"))
    smallest = written_once(full.groupBy("cluster").agg(F.min("n").alias("smallest")), "smallest")
    fit = full.join(lone, "doc_id", "left").join(smallest, "cluster")
    usable = F.col("n") - F.coalesce("lone", F.lit(0))
    partner = F.greatest(F.col("smallest"), F.ceil(F.col("n") * percent / 100))
    fit = fit.filter((100 + percent) * usable >= percent * (F.col("n") + partner)).drop("lone", "smallest")
    fit = written_once(fit, "fit")
    by_component = fit.groupBy("cluster", "component").agg(F.count("*").alias("docs"), F.sum("n").alias("volume"))
    by_cluster = by_component.groupBy("cluster").agg(
        F.max_by("component", F.struct("docs", "component")).alias("largest"),
        F.sum("volume").alias("volume"),
        (F.sum("volume") - F.max_by("volume", F.struct("docs", "component"))).alias("smaller"),
        F.count("*").alias("parts"),
    )
    blocks = lambda volume: F.ceil(F.col(volume) / BLOCK_SHINGLES).cast("int")
    by_cluster = by_cluster.filter("parts > 1").select("cluster", "largest", blocks("smaller").alias("nx"), blocks("volume").alias("ny"))
    fit = fit.join(written_once(by_cluster, "volumes"), "cluster")
    own = lambda count: F.pmod(F.xxhash64("doc_id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    keys = ["cluster", "bx", "by"]
    columns = [*keys, "doc_id", "component", "shingles"]
    xs = fit.filter("component <> largest").withColumn("bx", own("nx")).withColumn("by", every("ny")).select(*columns, F.lit(True).alias("asks"))
    ys = fit.withColumn("by", own("ny")).withColumn("bx", every("nx")).select(*columns, F.lit(False).alias("asks"))
    return xs.union(ys).groupBy(*keys).applyInPandas(_links_between(percent), "a long, b long")


def _node(docs: DataFrame) -> Column:
    """A document's key: its doc_id with its text; null without a doc_id."""
    return F.when(docs["doc_id"].isNotNull(), F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])))


def _groups(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(doc_id, node, n_shingles, component_id, kept) for every row."""
    # the steps below call a document's node its doc_id
    nodes = docs.select(_node(docs).alias("doc_id"), "text", F.col("doc_id").alias("own"))
    rows = written_once(nodes.mapInArrow(_features(shingle_words), FEATURES), "signatures")
    real = rows.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "h1", "h2"]
    least = F.min(F.struct("own", "doc_id")).alias("least")
    classes = written_once(
        real.groupBy(*key).agg(F.min("doc_id").alias("doc_id"), least, *(F.first(c).alias(c) for c in ("packed", "bands"))), "classes"
    )
    banded = classes.select("doc_id", F.explode("bands").alias("band"))
    firsts = banded.groupBy("band").agg(F.min("doc_id").alias("a"), F.count("*").alias("docs")).filter("docs > 1").drop("docs")
    buckets = written_once(banded.join(firsts, "band"), "buckets")
    pairs = written_once(_near(buckets.filter("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct(), classes, percent), "pairs")
    docs = nodes.filter("doc_id is not null").drop("own")
    sets = _sets_of(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), shingle_words)
    links = written_once(_confirmed(pairs, sets, percent), "confirmed")
    found = components(links)
    members = buckets.select("band", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    more = _rest(members.withColumn("component", F.coalesce("component", "doc_id")), docs, shingle_words, percent)
    if more is not None:
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    reached = classes.select(*key, "doc_id", "least").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    reached = written_once(reached.select(*key, "least", F.coalesce("component", "doc_id").alias("component")), "reached")
    # of a component stays the least doc_id, and of its texts one
    heads = reached.groupBy("component").agg(F.min("least").alias("head"))
    reached = reached.drop("least").join(heads, "component").select(*key, "head")
    out = rows.filter("doc_id is not null").select("own", "doc_id", *key).join(reached, key, "left")
    out = out.unionByName(rows.filter("doc_id is null").select("own", "doc_id", *key), allowMissingColumns=True)
    linked = F.col("n_shingles") > 0
    return out.select(
        F.col("own").alias("doc_id"),
        F.col("doc_id").alias("node"),
        "n_shingles",
        F.when(linked, F.col("head.own")).otherwise(F.col("own")).alias("component_id"),
        F.coalesce(~linked | (F.col("head.doc_id") == F.col("doc_id")), F.lit(True)).alias("kept"),
    )


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Documents link where 100 * common >= percent * all distinct shingles;
    component_id is the smallest doc_id reachable over links, kept marks it.
    """
    return _groups(docs, shingle_words, percent).drop("node")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """Documents with all their columns, one of each group of near duplicates."""
    gone = _groups(docs, 5, 80).filter("not kept").select(F.col("node").alias("_gone")).distinct()
    return docs.join(gone, _node(docs) == gone["_gone"], "left_anti")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(T.documents(spark, sf_dir), shingle_words=4)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) q USING (doc_id)
"""
