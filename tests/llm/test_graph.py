import random

from evalspark.llm.graph import components
from helpers import roots


def test_chains_stars_and_random_graphs(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)]
    links += [(200 + rng.randrange(80), 200 + rng.randrange(80)) for _ in range(60)] + [(7, 7), (None, 3), (300, None)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == roots({x for e in real for x in e}, real)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
