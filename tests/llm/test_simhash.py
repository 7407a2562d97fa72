import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import simhash
from tallyhouse.llm.components import components, stars
from tallyhouse.llm.queries import op8_simhash_near_duplicates


def reached(pairs):
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {x: root(x) for x in label}


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in ["", "a", "A b C", "a b c d e f", "xÉ y\x0bz w é Ü a b c A B " * 50]:
        assert simhash.fingerprint(text, 4, 42, chunk=7) == plain_fingerprint(text)


def clustered(rng, centres=200):
    prints = list(rng.integers(0, 1 << 64, centres, dtype=np.uint64))
    for base in prints[:]:
        for _ in range(int(rng.integers(0, 8))):
            bits = rng.choice(64, int(rng.integers(1, 7)), replace=False)
            prints.append(base ^ np.bitwise_xor.reduce(np.uint64(1) << bits.astype(np.uint64)))
    return np.unique(np.array(prints, np.uint64))


def test_every_pair_meets_at_an_anchor():
    prints = clustered(np.random.default_rng(3))
    rows, anchors, homes = simhash.anchored(prints)
    at_home = {}
    for row, anchor in zip(rows[homes], anchors[homes], strict=True):
        at_home.setdefault(anchor, []).append(row)
    met = {(row, other) for row, anchor in zip(rows, anchors, strict=True) for other in at_home.get(anchor, ())}
    near = np.bitwise_count(prints[:, None] ^ prints) <= 4
    assert {tuple(pair) for pair in np.argwhere(near)} <= met


def test_links_and_components(spark):
    prints = clustered(np.random.default_rng(4), 60)
    signed = prints.view("<i8")
    near = np.argwhere(np.bitwise_count(prints[:, None] ^ prints) <= 4)
    want = reached([(int(signed[a]), int(signed[b])) for a, b in near if a != b])
    table = spark.createDataFrame([(int(x),) for x in signed], "print long")
    for homes_a_chunk in (4096, 2):  # the second cuts nearly every anchor into chunks
        found = components(simhash.links(table, 4, homes_a_chunk)).collect()
        got = {r["node"]: r["component"] for r in found}
        assert got == {node: least for node, least in want.items() if node != least}


def test_components_of_a_chain(spark):
    n = 500
    order = np.random.default_rng(5).permutation(n).tolist()
    pairs = [(order[i], order[i + 1]) for i in range(n - 1)]
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()
    assert {r["node"]: r["component"] for r in found} == {i: 0 for i in range(1, n)}
    high, low = stars(np.array([3, 2, 9]), np.array([2, 1, 8]))
    assert dict(zip(high.tolist(), low.tolist(), strict=True)) == {2: 1, 3: 1, 9: 8}


def test_documents(spark, folders):
    rows = op8_simhash_near_duplicates(spark, folders["odd"]).collect()
    texts = spark.read.parquet(f"{folders['odd']}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    want = [(i, plain_fingerprint(t)) for i, t in texts]
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in rows) == sorted((str(i), f"{p:016x}") for i, p in want)
    prints = sorted({p for _, p in want})
    classes = reached([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 4])
    least = {}
    for i, p in want:
        if i is not None:
            least[classes[p]] = min(i, least.get(classes[p], i))
    assert {(r["fingerprint"], r["component_id"]) for r in rows} == {(f"{p:016x}", least.get(classes[p])) for _, p in want}
