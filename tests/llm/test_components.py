import random

from harborline.llm.components import connected_components


def test_chains_stars_and_repeats(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 560)] + [(7, 7), (1, 2), (2, 1),
        (None, 3), (9, None)]
    r.shuffle(links)
    got = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    want = {i: 100 for i in range(100, 181)} | {i: 500 for i in range(500, 560)} | {1: 1, 2: 1}
    assert got == want


def test_none(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
