"""Embedding near-duplicates and exact top-k against brute force."""

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from argulith.llm import embedding_dups, topk

VEC = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def clustered(rows: int, noise: float, seed: int) -> list[tuple]:
    """A hot group of near copies, chains that reach beyond the threshold, copies, and noise."""
    rng = np.random.default_rng(seed)
    hot = rng.normal(size=16)
    hot /= np.linalg.norm(hot)
    made = [hot + rng.normal(size=16) * noise for _ in range(rows // 3)]
    made += list(rng.normal(size=(rows // 3, 16)))
    angle = np.linspace(0, 3, rows // 3)
    made += [np.cos(a) * np.eye(16)[0] + np.sin(a) * np.eye(16)[1] for a in angle]
    made += [made[0]] * 5
    return [(i, [float(np.float32(x)) for x in v], i % 2) for i, v in enumerate(made)]


def plain_links(rows: list[tuple], threshold: float = 0.98) -> dict:
    def able(v, label):
        return label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ids = [r[0] for r in rows]
    links, root = {i: 0 for i in ids}, {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, v, a) in enumerate(rows):
        for j, w, b in rows[n + 1 :]:
            if a == b and able(v, a) and able(w, b) and len(v) == len(w):
                x, y = np.array(v, dtype=float), np.array(w, dtype=float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    low, high = sorted((find(i), find(j)))
                    root[high] = low
    return {i: (links[i], find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("noise, tile_rows", [(0.02, 4_096), (0.05, 50)])
def test_links_equal_all_pairs(spark, noise, tile_rows):
    rows = clustered(450, noise, 5)
    got = embedding_dups.link_vectors(spark.createDataFrame(rows, VEC), tile_rows=tile_rows).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == plain_links(rows)


def test_links_odd_tables(spark):
    one = [0.5, 0.5, 0.0, 0.1]
    rows = [
        (1, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0] * 4, 1),
        (8, [0.5, None, 0.0, 0.1], 1), (9, [0.5, NAN, 0.0, 0.1], 1), (10, [INF, 0.5, 0.0, 0.1], 1), (11, one[:2], 1),
        (12, [5.0, 5.0, 0.0, 1.0], 1), (13, [3e38, 3e38, 0.0, 6e37], 1), (14, [-0.5, -0.5, 0.0, -0.1], 1),
    ]
    table = spark.createDataFrame(rows, VEC).withColumn("row", F.lit("own"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dups.link_vectors(table).collect()}
    assert got == plain_links(rows)
    again = embedding_dups.link_vectors(spark.createDataFrame([(1, one, 1), (1, one, 1), (None, one, 1)], VEC)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in again) == [
        (0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True),
    ]
    assert embedding_dups.link_vectors(spark.createDataFrame([], VEC)).collect() == []


def test_probes_and_codes_exclude_no_neighbour():
    rng = np.random.default_rng(1)
    rows = embedding_dups.unit(rng.normal(size=(600, 10)))
    close = embedding_dups.unit(rows + rng.normal(size=rows.shape) * 0.03)
    quantiser = embedding_dups.Quantiser(rows, 20)
    radius = (2 - 2 * 0.98) ** 0.5
    own, codes, errors, _ = quantiser.encode(rows, radius)
    _, _, _, probes = quantiser.encode(close, radius)
    near = (rows * close).sum(1) >= 0.98
    assert near.sum() > 300
    for i in np.flatnonzero(near):
        assert own[i] in probes[i]
        tables = quantiser.parts(close[i : i + 1] - quantiser.coarse[own[i]])
        far = sum(t[0, c] for t, c in zip(tables, codes[i])) ** 0.5
        assert far <= radius + errors[i] + embedding_dups.SLACK


@pytest.mark.parametrize("noise", [0.0005, 0.02])
def test_a_dense_tile_of_wide_vectors_stays_small(noise):
    """Thousands of near copies of 768 components: a few hundred megabytes, and the links of the product."""
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(4)
    rows = embedding_dups.unit(rng.normal(size=768) / 768**0.5 + rng.normal(size=(2_048, 768)) * noise)
    quantiser = embedding_dups.Quantiser(rows[:512], 1)
    _, codes, errors, _ = quantiser.encode(rows, 0.2)
    held = [r.tobytes() for r in rows]
    ids = np.arange(len(rows))
    members = pd.DataFrame({"row": ids, "copies": 1, "list": 0, "vector": held, "codes": [c.tobytes() for c in codes], "error": errors})
    queries = pd.DataFrame({"q_row": ids, "q_vector": held})
    tracemalloc.start()
    found = embedding_dups.tile_links(members, queries, quantiser, 0.98)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    linked = rows @ rows.T >= 0.98
    want = {i: int(n) - 1 for i, n in enumerate(linked.sum(axis=1)) if n > 1}
    got = found[found["links"] > 0]
    assert dict(zip(got["row"], got["links"])) == want and peak < 250 << 20
    if noise < 0.001:
        assert set(found[found["root"] != found["row"]]["root"]) == {0}


def plain_top(rows: list[tuple], k: int) -> dict:
    ints = {
        i: [int(np.floor(256 * float(x))) for x in v]
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    found = {}
    for q in (i for i in ints if i % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q]
        found[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return found


@pytest.mark.parametrize("chunk_rows, block_rows", [(32_768, 2_048), (40, 3)])
def test_top_k_equals_brute_force(spark, chunk_rows, block_rows):
    rows = clustered(300, 0.05, 9)
    rows += [(1_000 + i, [0.1] * 16, 0) for i in range(20)]  # ties
    rows += [(2_000, None, 0), (2_050, [0.1, None], 0), (2_100, [NAN], 0), (2_150, [], 0), (2_200, [1.0], 0), (2_250, [0.0] * 20, 0)]
    rows += [(None, [0.1] * 16, 0)]
    vectors = spark.createDataFrame(rows, VEC).select("vec_id", topk.scaled(F.col("embedding")).alias("ints"))
    done = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, chunk_rows, block_rows).collect()
    got = {}
    for r in done:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == plain_top(rows, 5)


def test_top_k_of_few_and_no_rows(spark):
    def top(rows):
        vectors = spark.createDataFrame(rows, VEC).select("vec_id", topk.scaled(F.col("embedding")).alias("ints"))
        found = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0")).collect()
        return [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found]

    assert top([]) == []
    assert top([(0, [1.0], 0)]) == []
    assert sorted(top([(0, [1.0], 0), (3, [0.5], 0), (3, [0.5], 0)])) == [(0, 1, 3, 32768), (0, 2, 3, 32768)]


def test_no_pairs_of_rows_are_joined(spark, sf_dir):
    for query in (topk.op7_exact_topk, embedding_dups.op3_embedding_dups):
        plan = plan_of(query(spark, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
