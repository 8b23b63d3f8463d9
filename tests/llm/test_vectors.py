import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripleloom.llm import binary_codes, bit_sliced
from tripleloom.llm.queries import TOP_K, op8_bit_sliced_top_k

KIND = "vec_id long, embedding array<float>, label int, v string, node string, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, "v", "n", 2) for i, x in rows], KIND)


def clusters(seed, groups=12, size=8, dims=32, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims)) / np.sqrt(dims)
    rows = np.concatenate([c + rng.normal(scale=spread * s, size=(size, dims)) / np.sqrt(dims) * 4 for c, s in zip(centres, np.linspace(0.2, 2, groups))])
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rows)]


NAN, INF = float("nan"), float("inf")
BAD = [(900, None), (901, []), (902, [0.0] * 32), (903, [NAN] * 32), (904, [1.0] * 31 + [INF]), (905, [None] + [1.0] * 31)]


def slow_links(rows, least=0.95):
    good = [(i, np.array(x)) for i, x in rows if x and None not in x and np.isfinite(x).all() and any(x)]
    links = {i: 0 for i, _ in rows}
    parent = {i: i for i, _ in rows}
    for a in range(len(good)):
        for b in range(a):
            (i, x), (j, y) = good[a], good[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links[i] += 1
                links[j] += 1
                low, high = sorted((parent[i], parent[j]))
                parent = {k: low if p == high else p for k, p in parent.items()}
    return {i: (links[i], parent[i], parent[i] == i) for i in links}


@pytest.mark.parametrize("block", [1024, 7])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(binary_codes, "BLOCK", block)
    rows = clusters(3)
    rows += [(200 + i, x) for i, (_, x) in enumerate(rows[:10])]  # copies
    rows += [(300 + i, [2.5 * y for y in x]) for i, (_, x) in enumerate(rows[20:25])]  # of other length
    rows += [(400, [1.0, 0.0]), (401, [1.0, 0.01]), (402, [0.0, 1.0]), (403, [3.0]), (404, [4.0]), (405, [-4.0])] + BAD
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in binary_codes.near_vectors(table(spark, rows)).collect()}
    assert found == slow_links(rows)


def test_recall_on_the_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = {r["vec_id"]: r["n_links"] for r in binary_codes.near_vectors(vectors).collect()}
    true = dict(zip([r[0] for r in rows], linked.sum(1).tolist()))
    assert all(found[i] <= true[i] for i in true) and sum(found.values()) >= 0.97 * sum(true.values())


def test_recall_at_the_threshold(spark):
    """Pairs of a cosine just over 0.95 are the hardest ones to find."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.952 * a + np.sqrt(1 - 0.952**2) * b).tolist())]
    found = binary_codes.near_vectors(table(spark, rows)).where("n_links > 0").count()
    assert found >= 0.97 * len(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    signs, factor = binary_codes.codes(x)
    turned = x @ binary_codes.rotation(64, 0)
    estimate = (np.unpackbits(signs, axis=1).astype(float) * 2 - 1) @ turned.T / (8 * factor[:, None])
    off = ~np.eye(300, dtype=bool)
    assert abs((estimate - x @ x.T)[off].mean()) < 0.002
    assert (binary_codes.upper_bounds(x, signs, factor) >= x @ x.T)[off].mean() > 0.99


def test_same_ids_and_empty_table(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (2, [9.0, 0.0, 0.0])]
    found = sorted((tuple(r) for r in binary_codes.near_vectors(table(spark, rows)).collect()), key=str)
    assert found == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (None, 0, None, None)]
    assert binary_codes.near_vectors(table(spark, [])).count() == 0


def slow_top(rows, k, scale=64.0):
    good = [(i, np.floor(np.array(x, float) * scale).astype(int)) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all()]
    out = []
    for i, q in good:
        if i % 20 == 0:
            scored = sorted((-int(q @ x), j) for j, x in good if j != i and len(x) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("part,parts,chunk", [(1024, 64, 64), (10, 2, 3)])
def test_top_k_matches_brute_force(spark, part, parts, chunk):
    rows = clusters(5) + [(300 + i, [float(i % 3)] * 32) for i in range(60)]  # many ties
    rows += [(1000, [1.0, 2.0]), (1001, [-7.5, 2.0]), (1020, [1e9, -1e9]), (1040, [0.5]), (None, [1.0, 2.0])] + BAD
    found = bit_sliced.top_k(table(spark, rows), F.col("vec_id") % 20 == 0, k=7, part=part, parts=parts, chunk=chunk)
    assert sorted(tuple(r) for r in found.collect()) == slow_top(rows, 7)


def test_top_k_of_huge_components(spark):
    """Scores beyond 2^40, 2^63 and 2^1000: no crash, no two true scores tied, null where no long holds the score."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(30, 3)) * [1.0, 1e9, 1e3])]
    rows += [(100, [1e9, 1e9, 0.0]), (101, [3e10, 0.0, 1.0]), (102, [4e10, 0.0, 1.0]), (103, [1e300, -1e300, 5.0]), (120, [1e300, 2.0, 1e-300])]
    kind = "vec_id long, embedding array<double>"
    found = bit_sliced.top_k(spark.createDataFrame(rows, kind), F.col("vec_id") % 20 == 0, k=40).collect()
    exact = {i: [bit_sliced.floored(c, 64.0) for c in x] for i, x in rows}
    for q in (0, 20, 100, 120):
        scored = sorted((-sum(a * b for a, b in zip(exact[q], x)), j) for j, x in exact.items() if j != q)
        expected = [(n + 1, j, -s if -(2**63) <= -s < 2**63 else None) for n, (s, j) in enumerate(scored)]
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q) == expected


def test_top_k_of_nothing(spark):
    assert bit_sliced.top_k(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert bit_sliced.top_k(table(spark, [(1, [1.0]), (2, [2.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert bit_sliced.top_k(table(spark, [(20, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_against_sql(spark, tiny):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tiny}/embeddings.parquet'")
    assert sorted(tuple(r) for r in op8_bit_sliced_top_k(spark, tiny).collect()) == sorted(con.execute(TOP_K).fetchall())
