import numpy as np
import pytest

from tallyhouse.llm import embedding_dups
from tallyhouse.llm.queries import op2_embedding_near_duplicates


def brute_force(vectors, threshold=0.95):
    """Links of each vector and the smallest place reachable."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = unit @ unit.T >= threshold
    least = np.arange(len(vectors))
    while True:
        new = np.array([least[row].min() for row in close])
        if (new == least).all():
            return close.sum(1) - 1, least
        least = new


@pytest.fixture(scope="module")
def vectors():
    """Random vectors, copies, a crowd around one centre, and pairs at and about the threshold."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 32))
    crowd = base[0] + 0.15 * rng.normal(size=(150, 32))
    rows = [base, base[:30], crowd]
    for cosine in (0.93, 0.95 + 1e-6, 0.96, 0.98):
        unit = base[100:200] / np.linalg.norm(base[100:200], axis=1, keepdims=True)
        away = rng.normal(size=unit.shape)
        away -= (away * unit).sum(1, keepdims=True) * unit
        rows.append(cosine * unit + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away, axis=1, keepdims=True))
    return np.concatenate(rows)


@pytest.mark.parametrize("chunk_rows", [4096, 8])  # the second splits most buckets
def test_recall_and_exactness(spark, vectors, chunk_rows):
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = embedding_dups.near_duplicates(table, chunk_rows=chunk_rows).orderBy("vec_id").collect()
    links, least = brute_force(vectors)
    got = np.array([r["n_links"] for r in found])
    assert (got <= links).all()
    assert got.sum() >= 0.99 * links.sum()
    assert np.mean([r["component"] == want for r, want in zip(found, least, strict=True)]) >= 0.99


def partners(base, cosine, rng):
    """A vector at a cosine from each given one."""
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=unit.shape) * base.std(0)
    away -= (away * unit).sum(1, keepdims=True) * unit
    return cosine * unit + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away, axis=1, keepdims=True)


def shapes():
    """Vectors as embeddings may lie, each with a partner just above the threshold."""
    rng = np.random.default_rng(9)
    n, d = 1200, 64
    mean = rng.normal(size=d)
    mean *= 3 * np.sqrt(d) / np.linalg.norm(mean)
    wide = rng.normal(size=(n, d))
    yield "isotropic", wide
    yield "shifted", wide + mean
    yield "mixed", np.concatenate([wide[: n // 2], 4 * mean + 0.9 * np.linalg.norm(mean) / 3 * wide[n // 2 :] / 4])
    yield "decaying", wide * (0.9 ** np.arange(d))
    yield "cone", 0.7 * wide + mean / 3


@pytest.mark.parametrize("name, base", list(shapes()), ids=lambda x: x if isinstance(x, str) else "")
def test_recall_on_shapes(spark, name, base):
    rng = np.random.default_rng(4)
    vectors = np.concatenate([base, partners(base, 0.951, rng)])
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = embedding_dups.near_duplicates(table).orderBy("vec_id").collect()
    links, _ = brute_force(vectors)
    got = np.array([r["n_links"] for r in found])
    recall = got.sum() / links.sum()
    codes = embedding_dups.learn(vectors, len(vectors), 0.95, 0.002)
    print(f"{name}: {links.sum()} links, recall {recall:.4f}, {codes.tables} tables of {codes.table_bits} bits")
    assert codes.table_bits  # by codes, not in blocks
    assert (got <= links).all() and recall >= 0.99


def test_query_with_planted_partners(spark, tmp_path):
    """The sample vectors hold no link of their own, so every tenth gets a partner."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    base = np.array([r["embedding"] for r in given.orderBy("vec_id").collect()], np.float64)
    planted = partners(base[::10], 0.951, np.random.default_rng(6))
    rows = [(10**6 + i, row.tolist()) for i, row in enumerate(planted)]
    both = given.union(spark.createDataFrame(rows, given.schema)).selectExpr("*", "0 AS label")
    both.write.parquet(str(tmp_path / "embeddings.parquet"))
    found = op2_embedding_near_duplicates(spark, str(tmp_path)).where("n_links > 0").collect()
    vectors = np.array([r["embedding"] for r in both.orderBy("vec_id").collect()], np.float64)
    links, _ = brute_force(vectors)
    assert links.sum() >= 2 * len(planted)
    assert sum(r["n_links"] for r in found) >= 0.99 * links.sum()


def test_codes_are_balanced(vectors):
    codes = embedding_dups.learn(vectors, len(vectors), 0.95, 0.002)
    keys = codes.keys(vectors)
    bits = keys[:, :, None] >> np.arange(codes.table_bits) & 1
    assert abs(bits.mean() - 0.5) < 0.05


def test_odd_rows(spark, folders):
    rows = op2_embedding_near_duplicates(spark, folders["odd"]).collect()
    links = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in rows)
    alone = [(str(i), 0, str(i), True) for i in (0, 1, 2, 3, 4, 5, 8)]
    # 6 twice, 7, 11 and the one without an id are one class; 9 and 10 are parallel.
    crowd = [("6", 4, "6", True)] * 2 + [("7", 4, "6", False), ("11", 4, "6", False), ("None", 4, "6", False)]
    assert links == sorted([*alone, *crowd, ("9", 1, "9", True), ("10", 1, "9", False)])
