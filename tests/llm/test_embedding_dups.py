import numpy as np
import pytest

from sharelens.llm.embedding_dups import embedding_near_duplicates
from sharelens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x int"


def brute_force(rows, cosine=0.93):
    units = []
    for _, vector, label in rows:
        ok = label is not None and vector and None not in vector
        values = np.array(vector, np.float32).astype(np.float64) if ok else np.zeros(1)
        good = ok and np.isfinite(values).all() and (values != 0).any()
        units.append(values / np.linalg.norm(values) if good else None)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, u in enumerate(units):
        for j in range(i):
            v = units[j]
            if u is None or v is None or rows[i][2] != rows[j][2] or len(u) != len(v):
                continue
            if u @ v >= cosine:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    out = []
    for i, row in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        first = min(same) if same else None
        out.append((row[0], links[i], first, row[0] == first))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def clusters(seed, dims, n=25):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        center = rng.standard_normal(dims)
        for _ in range(rng.integers(1, 7)):
            noise = rng.choice([0.0, 0.1, 0.25, 0.4]) * rng.standard_normal(dims)
            scale = rng.choice([1.0, 1e-3, 50.0])
            rows.append([float(v) for v in np.float32((center + noise) * scale)])
    return [(i, v, int(rng.integers(0, 2))) for i, v in enumerate(rows)]


@pytest.mark.parametrize("dims,cell_rows", [(64, 2048), (64, 3), (5, 4), (1, 5)])
def test_against_all_pairs(spark, dims, cell_rows):
    rows = clusters(dims, dims)
    one = rows[0][1]
    rows += [(900, one, 0), (901, one, 0), (901, one, 0), (902, one, 1), (None, one, 0), (903, one, None)]
    rows += [(904, None, 0), (905, [], 0), (906, [0.0] * dims, 0), (907, [None] + [1.0] * (dims - 1), 0)]
    rows += [(908, [float("nan")] * dims, 0), (909, [float("inf")] * dims, 0), (910, one + [0.0], 0)]
    frame = spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA)
    assert found(embedding_near_duplicates(frame, cell_rows=cell_rows)) == brute_force(rows)


def test_nothing(spark):
    assert embedding_near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_all_pairs(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert found(QUERIES["op8_embedding_near_dedup"](spark, "/root/testdata/sf0.001")) == brute_force(rows)
