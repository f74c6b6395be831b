"""Near-duplicate vectors against brute force, with one ball that holds a third of the rows."""

import numpy as np
import pytest

from yieldloom.llm import embeddings

LEAST = 0.93


def ball(rng, n, size, angle):
    center, noise = np.eye(size)[0], rng.normal(size=(n, size))
    noise[:, 0] = 0
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return np.cos(angle) * center + np.sin(angle) * noise


@pytest.mark.parametrize("inside", [0.95, 0.93])
def test_a_ball_of_a_third_of_the_rows(spark, monkeypatch, inside):
    monkeypatch.setattr(embeddings, "PIVOTS_LEAST", 1000)
    rng = np.random.default_rng(3)
    vectors = np.concatenate([ball(rng, 1200, 64, np.arccos(np.sqrt(inside))), rng.normal(size=(2400, 64))])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embeddings.linked(df, LEAST).collect()}
    links = vectors @ vectors.T >= LEAST
    assert [got[i]["n_links"] for i in range(len(vectors))] == (links.sum(axis=1) - 1).tolist()
    assert {got[i]["component_id"] for i in range(1200)} == {0}
    found, there = embeddings.recall(df, LEAST, 50)
    assert found == there > 0


def leaning(rng, n, size, mean):
    """Unit vectors whose cosines with each other have this mean, half of them near copies of another one."""
    common = np.zeros(size)
    common[0] = np.sqrt(mean)
    own = rng.normal(size=(n // 2, size))
    near = own + rng.normal(size=own.shape) * rng.uniform(0.1, 0.6, size=n // 2)[:, None]
    own = np.concatenate([own, near])
    own[:, 0] = 0
    return common + np.sqrt(1 - mean) * own / np.linalg.norm(own, axis=1)[:, None]


@pytest.mark.parametrize("mean", [0.5, 0.8])
def test_vectors_with_a_common_direction(spark, mean):
    vectors = leaning(np.random.default_rng(5), 3000, 64, mean)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    nodes = embeddings.nodes_of(df, "vec_id", "embedding", "label")
    index = embeddings.index_of(nodes, LEAST)
    described = embeddings._described(nodes, index).selectExpr("max(size(lists)) AS most", "avg(size(lists)) AS mean").first()
    assert described["most"] <= 110 and described["mean"] <= 105
    links = (vectors @ vectors.T >= LEAST).sum() - len(vectors)
    got = embeddings.linked(df, LEAST).groupBy().sum("n_links").first()[0]
    assert 0.9 * links <= got <= links


def brute_force(rows):
    """Links and smallest ids, for rows of (id, vector, label)."""
    usable = {}
    for at, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[at] = np.array(v) / np.linalg.norm(v)
    near = {at: {o for o in usable if o != at and rows[o][2] == rows[at][2] and len(rows[o][1]) == len(rows[at][1])
                 and usable[o] @ usable[at] >= LEAST} for at in usable}
    out = []
    for at, (key, _, _) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            more = near.get(todo.pop(), set()) - seen
            seen |= more
            todo += more
        least = min((rows[o][0] for o in seen if rows[o][0] is not None), default=None)
        out.append((key, len(near.get(at, ())), least, key is not None and key == least))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.1], 0), (3, [1.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None),
        (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [nan, 1.0], 0), (10, [inf, 1.0], 0), (11, [None, 1.0], 0),
        (12, [1.0, 0.0, 0.0], 0), (13, [1.0, 0.0, 0.1], 0), (None, [1.0, 0.01], 0), (None, [0.0, 1.0], 0),
        (2, [2.0, 0.1], 0), (14, [-1.0, 0.0], 0), (15, [1e-200, 0.0], 0), (16, [1e200, 0.0], 0),
    ]
    schema = "vec_id long, embedding array<double>, label int, n_links string, node string, lists string, copies string"
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    got = [tuple(r) for r in embeddings.linked(df, LEAST).collect()]
    # Brute force by plain norms: the vectors that only differ in scale are given to it at an ordinary one.
    plain = [(k, [1.0, 0.0] if k in (15, 16) else v, label) for k, v, label in rows]
    assert sorted(got, key=key) == sorted(brute_force(plain), key=key)
    none = embeddings.linked(df.limit(0), LEAST)
    assert none.count() == 0 and none.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_clusters_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + rng.normal(size=16) * 0.25).tolist(), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in embeddings.linked(df, LEAST).collect()) == brute_force(rows)
