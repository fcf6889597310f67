"""Graph algorithms against plain-Python versions of their definitions on random graphs.

The graphs include a hub holding a large share of all edges, self-loops and
isolated vertices, and are run with and without salting of hot vertices.
"""

import random
from collections import Counter, defaultdict

import pytest

from netfeat.operators.components import connected_components
from netfeat.operators.graph import Graph
from netfeat.operators.labels import label_propagation
from netfeat.operators.pagerank import pagerank
from netfeat.operators.skew import SkewConfig


def random_graph(seed, n=60, m=150, hub_share=0.35):
    rnd = random.Random(seed)
    ids = [f"v{i:03d}" for i in range(n)]
    edges = set()
    hub = ids[rnd.randrange(n)]
    while len(edges) < m:
        if rnd.random() < hub_share:
            a, b = (hub, rnd.choice(ids)) if rnd.random() < 0.5 else (rnd.choice(ids), hub)
        else:
            a, b = rnd.choice(ids[: n // 2]), rnd.choice(ids[: n // 2])  # second half: isolated or sparse
        edges.add((a, b))
    # a few extra chains in the second half, to make several components
    for i in range(n // 2, n - 3, 4):
        edges.add((ids[i], ids[i + 1]))
        edges.add((ids[i + 2], ids[i + 1]))
    return ids, sorted(edges)


def components_ref(ids, edges):
    parent = {v: v for v in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = defaultdict(list)
    for v in ids:
        groups[find(v)].append(v)
    return {v: min(g) for g in groups.values() for v in g}


def pagerank_ref(ids, edges, reset=0.15, rounds=5):
    out = Counter(a for a, _ in edges)
    r = {v: 1.0 for v in ids}
    for _ in range(rounds):
        s = defaultdict(float)
        for a, b in edges:
            s[b] += r[a] / out[a]
        r = {v: reset + (1 - reset) * s[v] for v in ids}
    total = sum(r.values())
    return {v: x * len(ids) / total for v, x in r.items()}


def labels_ref(ids, edges, rounds=5):
    lab = {v: v for v in ids}
    for _ in range(rounds):
        votes = defaultdict(Counter)
        for a, b in edges:
            votes[b][lab[a]] += 1
            votes[a][lab[b]] += 1
        lab = {v: (min(votes[v].items(), key=lambda kv: (-kv[1], kv[0]))[0] if votes[v] else lab[v]) for v in ids}
    return lab


def make_graph(spark, ids, edges, skew, snapshots=2):
    """The same graph under two snapshot keys, to exercise the batched path."""
    vs = [(s, v) for s in range(snapshots) for v in ids]
    es = [(s, a, b) for s in range(snapshots) for a, b in edges]
    v = spark.createDataFrame(vs, "snap int, id string")
    e = spark.createDataFrame(es, "snap int, src string, dst string")
    return Graph(v, e, ("snap",), skew)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("threshold", [1_000_000, 4], ids=["plain", "salted"])
def test_against_reference_implementations(spark, seed, threshold):
    ids, edges = random_graph(seed)
    g = make_graph(spark, ids, edges, SkewConfig(threshold=threshold))
    if threshold == 4:
        assert g.hot() is not None  # the hub (and more) is salted

    comp_ref = components_ref(ids, edges)
    comp = {(r.snap, r.id): r.component for r in connected_components(g).collect()}
    assert comp == {(s, v): c for s in range(2) for v, c in comp_ref.items()}

    pr_ref = pagerank_ref(ids, edges)
    pr = {(r.snap, r.id): r.pagerank for r in pagerank(g).collect()}
    for (s, v), x in pr.items():
        assert x == pytest.approx(pr_ref[v], rel=1e-9, abs=1e-12)
    assert len(pr) == 2 * len(ids)

    lab_ref = labels_ref(ids, edges)
    lab = {(r.snap, r.id): r.label for r in label_propagation(g).collect()}
    assert lab == {(s, v): x for s in range(2) for v, x in lab_ref.items()}


def test_long_chain_components(spark):
    """A path of 200 vertices: plain min-label spreading would need 200 rounds."""
    ids = [f"p{i:04d}" for i in range(200)]
    rnd = random.Random(5)
    order = ids[:]
    rnd.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(len(order) - 1)]
    g = make_graph(spark, ids, edges, SkewConfig(), snapshots=1)
    comp = {r.id: r.component for r in connected_components(g).collect()}
    assert set(comp.values()) == {min(ids)}
    from netfeat.operators import components as C

