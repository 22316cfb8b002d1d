import random

import pyarrow as pa
import pytest

from changelake.llm import components as module
from changelake.llm.components import components, star


def brute_force(edges):
    label = {node: node for edge in edges for node in edge if edge[0] != edge[1]}
    for _ in range(len(label)):
        for one, two in edges:
            if one != two:
                label[one] = label[two] = min(label[one], label[two])
    return label


def graph(draw, nodes, edges):
    out = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(edges)]
    chain = [(1000 + n, 1001 + n) for n in range(30)]
    centre = [(2099, 2000 + n) for n in range(90)]
    out += chain + centre + out[:5] + [(v, u) for u, v in out[:5]] + [(5000, 5000)]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_stars_equal_brute_force(seed):
    draw = random.Random(seed)
    edges = [edge for edge in graph(draw, 60, 40) if edge[0] != edge[1]]
    label = brute_force(edges)
    u, v = star(*(pa.array([edge[end] for edge in edges]) for end in (0, 1)))
    assert dict(zip(u.to_pylist(), v.to_pylist())) == {node: root for node, root in label.items() if node != root}
    assert len(u) == len(set(u.to_pylist()))
    coded = [[edge[end].to_bytes(2, "big") for edge in edges] for end in (0, 1)]
    assert [int.from_bytes(each, "big") for each in star(*map(pa.array, coded))[1].to_pylist()] == v.to_pylist()


@pytest.mark.parametrize("local, heavy", [(1 << 19, 4096), (40, 4096), (40, 3), (7, 1)])
def test_components_at_every_bound(spark, monkeypatch, local, heavy):
    monkeypatch.setattr(module, "HEAVY", heavy)
    edges = graph(random.Random(local), 80, 60)
    found = components(spark.createDataFrame(edges, "u long, v long").repartition(4), local).collect()
    assert dict(map(tuple, found)) == brute_force(edges)
    assert len(found) == len(brute_force(edges))


def test_no_edges_and_nulls(spark):
    assert components(spark.createDataFrame([], "u binary, v binary")).collect() == []
    assert components(spark.createDataFrame([(None, 1), (2, None), (3, 3)], "u long, v long")).collect() == []
