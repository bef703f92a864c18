"""Near copies: what a run costs in shuffles, and the paths that many rows take."""

import random

import pytest

from traceops.llm import components as spreading
from traceops.llm import jaccard, storage
from traceops.llm.components import components
from traceops.llm.storage import checkpointed


def shuffles(spark, run):
    """How many shuffles Spark numbers during the run, with no table broadcast but those that ask for it: one of many files looks large."""
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        start = spark._jsc.sc().newShuffleId()
        run()
        return spark._jsc.sc().newShuffleId() - start - 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def groups(pairs):
    """The smallest node of each node's component."""
    label = {x: x for p in pairs for x in p}
    while True:
        was = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == was:
            return label


@pytest.fixture
def many(monkeypatch):
    """Every table counts as a long one."""
    for module in (spreading, jaccard):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    for function in (storage.small, storage.sized):
        monkeypatch.setattr(function, "__defaults__", (0,))


def graphs():
    rng = random.Random(4)
    yield [(i, 10_000) for i in range(300)] + [(0, i) for i in range(200, 400)]
    yield [(i, i + 1) for i in range(60)] + [(200, 190), (190, 200), (190, 200), (7, 7), (500, 500)]
    yield [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]


def held(spark, pairs):
    found = components(checkpointed(spark.createDataFrame(pairs, "a BIGINT, b BIGINT"))).collect()
    assert len({r.node for r in found}) == len(found)
    return {r.node: r.component for r in found}


def test_components_against_brute_force(spark):
    for pairs in graphs():
        assert held(spark, pairs) == groups(pairs)
    assert held(spark, [(1, 1)]) == {1: 1}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_components_of_many_pairs(spark, many):
    for pairs in graphs():
        assert held(spark, pairs) == groups(pairs)


def test_components_of_a_group_with_its_smallest_node_in_the_middle_take_one_round(spark):
    pairs = checkpointed(spark.createDataFrame([(0, i) for i in range(1, 50)] + [(i, 0) for i in range(1, 50)], "a BIGINT, b BIGINT"))
    found = []
    # labels, and the counts of rows
    n = shuffles(spark, lambda: found.extend(components(pairs).collect()))
    print("shuffles of components", n)
    assert n <= 4
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(50)}


def copies(spark):
    rng = random.Random(11)
    base = [[f"v{rng.randint(0, 300)}" for _ in range(rng.randint(20, 90))] for _ in range(5)]
    rows = []
    for i in range(150):
        text = list(base[i % 5])
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = f"v{rng.randint(0, 300)}"
        rows.append((i, " ".join(text)))
    return rows + [(150, None), (151, "a b"), (152, "A  B"), (None, rows[0][1]), (3, rows[4][1])]


def linked(rows):
    """Row number: smallest doc_id that links reach."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    pairs = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if a and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 80 * len(a | b)]
    label = groups(pairs)
    least = {}
    for i, c in label.items():
        least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    return sorted([(key, len(sets[i]), least[label[i]] if i in label else key) for i, (key, _) in enumerate(rows)], key=str)


def test_few_and_many_pairs_give_the_same_links(spark, request):
    rows = copies(spark)
    docs = checkpointed(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    want = linked(rows)

    def got():
        return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()], key=str)

    assert got() == want
    request.getfixturevalue("many")
    assert got() == want


def test_near_copies_take_few_shuffles(spark):
    """A shuffle costs a task for each of its partitions, however few rows it has."""
    docs = checkpointed(spark.createDataFrame(copies(spark), "doc_id BIGINT, text STRING"))
    n = shuffles(spark, lambda: jaccard.jaccard_components(docs).collect())
    print("shuffles", n)
    assert n <= 75
