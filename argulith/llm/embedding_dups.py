"""Embedding near-duplicates by product quantisation.

A coarse quantiser deals unit vectors into inverted lists; what a vector differs from its list's
centre is coded per subspace. A query meets the codes of enough lists by table lookups, and what the
lookups cannot exclude is compared exactly. Nothing is lost on the way:

- A vector within ``r`` of the query can lie in list c only if the query is at most ``r`` beyond the
  plane between c and its own nearest centre; exactly those lists are probed.
- A lookup gives the distance to a vector's code, and the vector is at most its stored coding error
  from there; only what is farther than ``r`` plus that error is excluded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argulith.llm.common import query, table
from argulith.llm.components import components, tile_roots
from argulith.session import stage

THRESHOLD = 0.98
SAMPLE_VECTORS = 16_384  # vectors, about, that train the quantisers; every vector is indexed
LISTS_MOST = 1_024
SUBSPACE = 4  # components per code
CODES = 64  # codes per subspace
TILE_ROWS = 4_096  # vectors, and queries, that meet in one task at a time
TILE_BYTES = 32 << 20  # of vectors on either side of a tile; wide vectors make tiles of fewer rows
QUERY_ROWS = 128  # queries of a tile whose distances stand as a matrix
PAIR_BYTES = 16 << 20  # of vectors fetched for pairs at a time
SLACK = 1e-6  # far above rounding, far below any distance that matters
SEED = 42


def usable(label: Column, vector: Column) -> Column:
    """Rows that may link: a label, and a vector without nulls, of finite components, not all zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of huge components stay finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def padded(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: min(len(vector), width)] = vector[:width]
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0)


def centres(rows: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of a sample; fewer if the sample has fewer distinct rows."""
    rng = np.random.default_rng(SEED)
    rows = np.ascontiguousarray(rows)
    found = np.unique(rows[rng.permutation(len(rows))[: 4 * count]], axis=0)
    found = found[rng.permutation(len(found))[:count]]
    for _ in range(rounds):
        near = np.concatenate([squared(rows[i : i + 4096], found).argmin(1) for i in range(0, len(rows), 4096)])
        sums, sizes = np.zeros_like(found), np.bincount(near, minlength=len(found))
        np.add.at(sums, near, rows)
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], found)
    return found


class Quantiser:
    """Coarse centres and, per subspace, the centres of what is left."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.coarse = centres(sample, lists)
        rest = sample - self.coarse[squared(sample, self.coarse).argmin(1)]
        self.books = [centres(rest[:, i : i + SUBSPACE], CODES) for i in range(0, sample.shape[1], SUBSPACE)]

    def parts(self, rest: np.ndarray) -> list[np.ndarray]:
        """Squared distances of every subspace of ``rest`` to the centres of its book."""
        return [squared(rest[:, i * SUBSPACE : (i + 1) * SUBSPACE], book) for i, book in enumerate(self.books)]

    def encode(self, rows: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Per unit vector: its list, its codes, its coding error, and the lists it must probe."""
        far = squared(rows, self.coarse)
        own = far.argmin(1)
        rest = rows - self.coarse[own]
        parts = self.parts(rest)
        codes = np.stack([p.argmin(1) for p in parts], axis=1).astype(np.uint8)
        errors = np.zeros_like(rest)
        for i, book in enumerate(self.books):
            span = slice(i * SUBSPACE, (i + 1) * SUBSPACE)
            errors[:, span] = rest[:, span] - book[codes[:, i]]
        between = np.sqrt(squared(self.coarse, self.coarse))[own]
        beyond = far - far[np.arange(len(rows)), own][:, None]
        probes = beyond <= 2 * radius * between + SLACK
        return own, codes, np.linalg.norm(errors, axis=1), [np.flatnonzero(p) for p in probes]


def coded(vectors: DataFrame, quantiser: Quantiser, width: int, radius: float) -> DataFrame:
    """``(row, label, size, copies, list, probes, vector, codes, error)`` of the distinct vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("vector").to_pylist()
            rows = unit(padded(raw, width))
            own, codes, errors, probes = quantiser.encode(rows, radius)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("label"), pa.array([len(v) for v in raw], pa.int32()),
                    batch.column("copies"), pa.array(own, pa.int32()),
                    pa.array([p.tolist() for p in probes], pa.list_(pa.int32())),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors, pa.float64()),
                ],
                names=["row", "label", "size", "copies", "list", "probes", "vector", "codes", "error"],
            )

    schema = "row long, label int, size int, copies long, list int, probes array<int>, vector binary, codes binary, error double"
    return vectors.mapInArrow(run, schema)


def _matrix(column: pd.Series, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), width)


def _linked(part: np.ndarray, vectors: np.ndarray, near: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs among the near ones whose cosine reaches the threshold.

    Vectors are unit vectors in double precision, so the product is the cosine. Where many pairs are near,
    one matrix product has them all; else the few pairs' vectors are fetched, some at a time.
    """
    a, b = np.nonzero(near)
    if len(a) > near.size // 32:
        cosines = part @ vectors.T
        return np.nonzero(near & (cosines >= threshold))
    at_once = max(1, PAIR_BYTES // (8 * vectors.shape[1]))
    linked = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), at_once):
        some = slice(at, at + at_once)
        linked[some] = np.einsum("ij,ij->i", part[a[some]], vectors[b[some]]) >= threshold
    return a[linked], b[linked]


def tile_links(members: pd.DataFrame, queries: pd.DataFrame, quantiser: Quantiser, threshold: float) -> pd.DataFrame:
    """Links between the members of one list and some queries: per row, how many, and a root.

    Pairs stay here: out go, per query, the number of rows it links to (copies counted), and, per row
    with a link, the smallest row of its component inside the tile.
    """
    radius = math.sqrt(2 - 2 * threshold)
    vectors = _matrix(members["vector"], np.float64, quantiser.coarse.shape[1])
    codes = _matrix(members["codes"], np.uint8, len(quantiser.books))
    reach = radius + members["error"].to_numpy() + SLACK
    centre = quantiser.coarse[int(members["list"].iloc[0])]
    ids, copies = members["row"].to_numpy(), members["copies"].to_numpy()
    asked, asked_ids = _matrix(queries["q_vector"], np.float64, vectors.shape[1]), queries["q_row"].to_numpy()
    nodes, place = np.unique(np.concatenate([ids, asked_ids]), return_inverse=True)
    counts, roots = np.zeros(len(asked_ids), dtype=np.int64), np.arange(len(nodes))
    for first in range(0, len(asked), QUERY_ROWS):
        part = asked[first : first + QUERY_ROWS]
        tables = quantiser.parts(part - centre)
        far = np.zeros((len(part), len(ids)))
        for i, lookup in enumerate(tables):
            far += lookup[:, codes[:, i]]
        near = (far <= reach[None] ** 2) & (asked_ids[first : first + len(part), None] != ids[None])
        a, b = _linked(part, vectors, near, threshold)
        counts[first : first + len(part)] += np.bincount(a, weights=copies[b], minlength=len(part)).astype(np.int64)
        # Only the components so far are kept, never the links.
        left, right = place[len(ids) + first + a], place[b]
        roots = tile_roots(np.concatenate([left, np.arange(len(nodes))]), np.concatenate([right, roots]), len(nodes))
    found = pd.DataFrame({"row": asked_ids, "links": counts, "root": asked_ids})
    edges = pd.DataFrame({"row": nodes, "links": 0, "root": nodes[roots]})
    out = pd.concat([found[found["links"] > 0], edges[edges["row"] != edges["root"]]])
    return out.astype("int64")


def link_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    sample_vectors: int = SAMPLE_VECTORS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(key, n_links, component_id, kept)``, one row per row of ``df``.

    Rows link if their labels are equal and their vectors' cosine, in double precision, is
    ``threshold`` or more. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest key reachable by links, the own included, and ``kept`` says that it is the own. Rows
    with a null label, or with a vector that is null, empty, zero, or holds nulls or non-finite
    values, link with nothing; vectors of different lengths neither. Equal vectors of a label count as
    one with copies, so a third of all rows may be copies; repeated rows are copies of each other. A
    null key is never the smallest unless there is no other, and never kept. An empty table gives
    no rows.

    Lists are cut into blocks of ``tile_rows`` members and as many queries, so a list that holds a
    third of all rows is many tasks of bounded size.
    """
    own = df.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"), F.col(vector).alias("vector"))
    rows = stage(own.withColumn("able", usable(F.col("label"), F.col("vector"))), "vectors")
    able = rows.filter("able")
    distinct = (
        able.groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    distinct = stage(distinct, "distinct")
    total, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    alone = rows.filter(~F.col("able")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if not total:
        return _finished(alone, key)
    sampled = distinct.select("vector").sample(min(1.0, sample_vectors / total), SEED).collect()
    sampled = sampled or distinct.select("vector").head(1)
    sample = unit(padded([r[0] for r in sampled], width))
    quantiser = Quantiser(sample, min(LISTS_MOST, max(1, math.ceil(math.sqrt(total) / 8))))
    index = stage(coded(distinct.select("row", "label", "copies", "vector"), quantiser, width, math.sqrt(2 - 2 * threshold)), "coded")

    tile_rows = min(tile_rows, max(1, TILE_BYTES // (8 * width)))
    where = ["label", "size", "list"]
    probing = index.select("row", "label", "size", F.explode("probes").alias("list"), "vector")
    held = index.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("blocks"))
    asking = probing.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("turns"))
    plan = stage(held.join(asking, where), "tiles")  # a row per list: what it is cut into

    def part(count: str) -> Column:
        return F.pmod(F.xxhash64("row"), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    members = (
        index.drop("probes").join(plan, where).withColumn("block", part("blocks")).withColumn("turn", every("turns"))
    )
    queries = probing.join(plan, where).withColumn("turn", part("turns")).withColumn("block", every("blocks"))
    by = [*where, "block", "turn"]
    asked = queries.select(*by, "row", "vector").toDF(*[f"q_{c}" for c in [*by, "row", "vector"]])
    tiles = (
        members.select(*by, "row", "copies", "vector", "codes", "error")
        .groupBy(*by)
        .cogroup(asked.groupBy(*[f"q_{c}" for c in by]))
    )

    def meet(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if ours.empty or theirs.empty:
            return pd.DataFrame({"row": [], "links": [], "root": []}, dtype="int64")
        return tile_links(ours, theirs, quantiser, threshold)

    found = stage(tiles.applyInPandas(meet, "row long, links long, root long"), "found")
    counts = found.groupBy("row").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    rooted = (
        distinct.join(roots.withColumnRenamed("node", "row"), "row", "left")
        .join(counts, "row", "left")
        .select(
            "label", "vector", "first", F.coalesce("root", "row").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    known = rooted.join(least, "root").select(
        F.col("label").alias("label_2"), F.col("vector").alias("vector_2"), "n_links", "component_id"
    )
    back = able.join(known, (F.col("label") == F.col("label_2")) & (F.col("vector") == F.col("vector_2")))
    return _finished(alone.unionByName(back.select("id", "n_links", "component_id")), key)


def _finished(rows: DataFrame, key: str) -> DataFrame:
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return rows.select(F.col("id").alias(key), "n_links", "component_id", kept.alias("kept"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS n, vec_id AS m FROM embeddings
  UNION
  SELECT r.n, p.b FROM r JOIN p ON p.a = r.m
)
SELECT e.vec_id, CAST((SELECT count(*) FROM p WHERE p.a = e.vec_id) AS BIGINT) AS n_links,
  (SELECT min(m) FROM r WHERE r.n = e.vec_id) AS component_id,
  (SELECT min(m) FROM r WHERE r.n = e.vec_id) = e.vec_id AS kept
FROM embeddings e
"""


@query("op3_embedding_dups", OP3_SQL)
def op3_embedding_dups(spark, sf_dir: str) -> DataFrame:
    """Links and components of every vector."""
    return link_vectors(table(spark, sf_dir, "embeddings"))
