import random

import numpy as np
import xxhash

from cierre.llm import graph, simhash
from tests.llm.helpers import TEXTS, documents, empty


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=3):
    """Smallest place of each value's class, by all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_rows():
    rng = random.Random(6)
    words = [f"w{n}" for n in range(50)]
    base = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(5)]
    rows = []
    for i in range(80):
        t = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((1000 - i, " ".join(t)))
    return rows


def test_matches_all_pairs(spark):
    rows = TEXTS + near_rows()
    got = simhash.near_duplicates(documents(spark, rows, long=False)).collect()
    fps = [fingerprint(t) for _, t in rows]
    root = classes(fps)
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((i, f"{f:016x}", low.get(r)) for (i, _), f, r in zip(rows, fps, root)), key=key)
    assert sorted(map(tuple, got), key=key) == want


def test_shards_and_trees_find_every_pair(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3000, 4)).astype(np.uint64)
    near = np.concatenate([base, base ^ flips[:, 0] ^ flips[:, 1], base ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2] ^ flips[:, 3]])
    monkeypatch.setattr(simhash, "SHARD_SIZE", 700)
    marked = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(near.view(np.int64))], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(marked).collect()}
    a, b = [], []
    for s in range(0, len(near), 500):
        x, y = np.nonzero(np.bitwise_count(near[s : s + 500, None] ^ near[None, :]) <= 3)
        a.append(x + s), b.append(y)
    root = graph.local_roots(len(near), np.concatenate(a), np.concatenate(b))
    assert got == {i: int(r) for i, r in enumerate(root)}


def test_long_text_and_empty_table(spark):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents(spark)).collect() if r["doc_id"] in (100, 101)}
    assert got[100]["component_id"] == got[101]["component_id"] == 100
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.representatives(empty(spark)).collect() == []


def test_representatives(spark):
    docs = documents(spark, TEXTS + near_rows(), long=False)
    got = simhash.representatives(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    classes_ = {(r["component_id"], r["fingerprint"]) for r in simhash.near_duplicates(docs).collect()
                if r["doc_id"] is not None and r["doc_id"] == r["component_id"]}
    assert len([r for r in rows if r["doc_id"] is not None]) == len(classes_)
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert sum(r["doc_id"] == 9 and r["text"] == "a" for r in rows) == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, k) for k in range(201, 260)] + [(300, 301), (301, 300), (7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(101)} == {0} and {got[i] for i in range(200, 260)} == {200} and got[301] == 300
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hubs_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(graph, "MANY", 3)
    monkeypatch.setattr(graph, "PARTS", 5)
    rng = np.random.default_rng(5)
    edges = [(0, k) for k in range(1, 80)] + [(500, 500 + k) for k in range(1, 40)] + [(60, 530), (900, 901)]
    edges += [tuple(map(int, rng.integers(1000, 1400, 2))) for _ in range(300)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()))
    a, b = map(np.array, zip(*edges))
    root = graph.local_roots(2000, a, b)
    assert got == {n: int(root[n]) for e in edges if e[0] != e[1] for n in e}
