import random

from tablewright.llm.components import components
from tests.llm.support import roots


def found(spark, links):
    nodes, _ = components(spark.createDataFrame(links, "a long, b long"))
    return {r.node: r.root for r in nodes.collect()}


def test_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 2000 + i) for i in range(50)]
    expected = roots({x for pair in links for x in pair}, links)
    got = found(spark, links)
    assert all(got.get(x, x) == root for x, root in expected.items())


def test_no_links(spark):
    assert found(spark, []) == {}
    assert found(spark, [(3, 3)]) == {}
