import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import smallest

from quarry.llm import embdedup


def brute(rows, threshold=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for k, (a, v) in enumerate(ok) for b, w in ok[:k] if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold]
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    c = smallest([i for i, _ in rows if i is not None], links)
    return {i: (n[i], c[i], c[i] == i) if i is not None else (0, None, True) for i, _ in rows}


def got(df, **kw):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embdedup.near_duplicates(df, **kw).collect()}


@pytest.mark.parametrize("window,block", [(256, 4096), (16, 64)])
def test_links_and_components(spark, window, block):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 32))
    dense = v[0] + rng.normal(scale=0.05, size=(200, 32))  # more than a window
    loose = np.concatenate([v[k] + rng.normal(scale=0.2, size=(6, 32)) for k in range(1, 30)])
    rows = [(int(i), [float(np.float32(x)) for x in w]) for i, w in enumerate(np.concatenate([v, dense, loose, v[:20], np.repeat(v[40:41], 90, 0)]))]
    found = got(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), window=window, block=block)
    expected = brute(rows)
    links = sum(n for n, _, _ in expected.values())
    assert sum(n for n, _, _ in found.values()) <= links and sum(n for n, _, _ in found.values()) >= 0.98 * links
    assert np.mean([found[i] == expected[i] for i in expected]) > 0.98


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]),
            (None, [1.0, 0.0]), (10, [1.0, 0.45]), (11, [3e38, 3e38]), (12, [1e-40, 1e-40]), (13, [-1.0, 0.0]), (14, [0.0, -0.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, key string, node string")
    assert got(df) == brute([(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert got(df.limit(0)) == {}


def test_recall_on_given_vectors(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(spark.read.parquet(f"{sf}/embeddings.parquet")) == brute(rows)


def test_recall_over_many_vectors(spark, tmp_path):
    """100,000 vectors, a third of them in a cone of mutual cosine 0.6, with pairs planted at 0.9 and a little above."""
    rng, n, dims = np.random.default_rng(8), 100_000, 64
    v = rng.normal(size=(n, dims))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    axis = v[0].copy()
    v[:n // 3] = 0.6 ** 0.5 * axis + 0.4 ** 0.5 * v[:n // 3]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    at = rng.permutation(n)[:4000]
    for a, b in at.reshape(-1, 2):
        w = rng.normal(size=dims)
        w -= (w @ v[a]) * v[a]
        c = rng.uniform(0.9005, 0.92)
        v[b] = c * v[a] + (1 - c * c) ** 0.5 * w / np.linalg.norm(w)
    v = v.astype(np.float32)
    pq.write_table(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), dims).cast(pa.list_(pa.float32()))}),
                   tmp_path / "v.parquet", row_group_size=10_000)
    x = v.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = []
    for k in range(0, n, 2000):
        i, j = np.nonzero(x[k:k + 2000] @ x[k:].T >= 0.9)
        links += [(int(a), int(b)) for a, b in zip(k + i, k + j) if a < b]
    assert len(links) >= 2000
    component = smallest(range(n), links)
    found = got(spark.read.parquet(str(tmp_path / "v.parquet")))
    linked = np.mean([found[a][1] == found[b][1] for a, b in links])
    print(f"links {len(links)}, found {linked:.4f}")
    assert linked >= 0.998
    assert np.mean([found[a][1] == component[a] for pair in links for a in pair]) >= 0.995
    assert sum(f[0] for f in found.values()) <= 2 * len(links)
