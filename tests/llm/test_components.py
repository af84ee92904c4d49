import random

from lakeledger.llm.components import connected_components


def brute(edges):
    label = {}
    for u, v in edges:
        a, b = label.setdefault(u, u), label.setdefault(v, v)
        if a != b:
            label = {k: (a if x == b else x) for k, x in label.items()}
    return label


def same_partition(got, label):
    groups = {}
    for node, comp in got:
        groups.setdefault(comp, set()).add(node)
    want = {}
    for node, lab in label.items():
        want.setdefault(lab, set()).add(node)
    return sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_random_graphs_paths_and_stars(spark, monkeypatch):
    from lakeledger.llm import components
    # no forests inside tasks: the rounds must do all the work
    monkeypatch.setattr(components, "_forests", lambda batches: batches)
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(120)]
    star = [(1000, 1001 + i) for i in range(200)]
    dust = [(2000 + rng.randrange(150), 2000 + rng.randrange(150)) for _ in range(100)]
    edges = [e for e in path + star + dust if e[0] != e[1]]
    df = spark.createDataFrame(edges + [(5, 5), (None, 3)], "u long, v long").repartition(5)
    got = [tuple(r) for r in connected_components(df).collect()]
    assert same_partition(got, brute(edges))


def test_string_nodes_and_no_edges(spark):
    df = spark.createDataFrame([("a", "b"), ("c", "b"), ("x", "y")], "u string, v string")
    got = [tuple(r) for r in connected_components(df).collect()]
    assert same_partition(got, brute([("a", "b"), ("c", "b"), ("x", "y")]))
    assert connected_components(df.where("u = 'none'")).collect() == []
