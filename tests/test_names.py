"""Similar names and clusters against brute force, also with every group treated as too large."""

import random

import pytest
from pyspark.sql import functions as F

from yieldloom.operators import names

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "theta", "kappa"]


def random_names(seed, n, most):
    rng = random.Random(seed)
    return sorted({" ".join(rng.sample(WORDS, rng.randint(1, most))) for _ in range(n)}) + ["solo", "the 12"]


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute_pairs(all_names, threshold):
    sets = {" ".join(sorted(n.split())): set(n.split()) for n in all_names if n not in ("solo", "the 12")}
    keys = sorted(sets)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if jaccard(sets[a], sets[b]) >= threshold}


def brute_clusters(all_names, threshold):
    key = {n: " ".join(sorted(n.split())) for n in all_names}
    parent = {k: k for k in key.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_pairs(all_names, threshold):
        parent[find(b)] = find(a)
    out = {}
    for n in all_names:
        mates = [n] if n in ("solo", "the 12") else [m for m in all_names if m not in ("solo", "the 12") and find(key[m]) == find(key[n])]
        out[n] = min(mates)
    return out


@pytest.mark.parametrize("group_limit, threshold", [(0, 0.5), (0, 0.75), (2, 0.6), (5, 0.5), (200, 0.5)])
def test_pairs_and_clusters(spark, group_limit, threshold):
    listed = random_names(group_limit + int(threshold * 100), 60, 6)
    df = spark.createDataFrame([(n,) for n in listed], "name string")
    keys = names.name_keys(df)
    pairs = names.similar_keys(keys, threshold, group_limit=group_limit).collect()
    assert {tuple(r) for r in pairs} == brute_pairs(listed, threshold)
    assert len(pairs) == len(set(pairs))
    got = {r["name"]: r["cluster"] for r in names.cluster_names(df, threshold=threshold, group_limit=group_limit).collect()}
    assert got == brute_clusters(listed, threshold)


def test_links_stay_few_in_a_hot_group(spark):
    """Names around one common word: pairs grow with the square, links do not."""
    rows = [(f"dragon extra{i:c}{i:c}x".replace(" extra", " w"),) for i in range(97, 97 + 26)] + [("dragon",)]
    keys = names.name_keys(spark.createDataFrame(rows, "name string"))
    links = names.similar_keys(keys, 0.5, links_only=True, group_limit=3).count()
    assert links <= 2 * len(rows)
    clusters = names.cluster_names(spark.createDataFrame(rows, "name string"), group_limit=3)
    assert clusters.select("cluster").distinct().count() == 1


@pytest.mark.parametrize("group_limit, threshold", [(0, 0.5), (3, 0.6)])
def test_classes_expand_to_all_pairs(spark, group_limit, threshold):
    listed = random_names(7, 60, 6)
    keys = names.name_keys(spark.createDataFrame([(n,) for n in listed], "name string"))
    pairs, members = names.similar_classes(keys, threshold, group_limit)
    got = {tuple(r) for r in pairs.unionByName(names.expand_classes(members)).collect()}
    assert got == brute_pairs(listed, threshold)
    rows = members.collect()
    for row in rows:
        mates = [m for m in rows if m["class"] == row["class"] and m["key"] != row["key"]]
        linked = [m for m in mates if (row["is_lo"] and m["is_hi"]) or (row["is_hi"] and m["is_lo"])]
        assert row["n_links"] == len(linked)
        assert row["representative"] <= row["key"] or not row["is_lo"]


def test_classes_grow_with_members_not_with_pairs(spark):
    """All names share two of three words: every pair is similar, 300 * 299 / 2 of them."""
    df = spark.range(300).select(F.concat(F.lit("red tower w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("name"))
    keys = names.name_keys(df)
    pairs, members = names.similar_classes(keys, 0.5, group_limit=50)
    members = members.filter("n_links = 299")
    assert pairs.count() == 0 and members.count() <= 3 * 300
    assert names.expand_classes(members).count() == 300 * 299 // 2


def grown(spark, listed, path, batches, **options):
    for number, batch in enumerate(batches, 1):
        names.grow_clusters(spark.createDataFrame([(n,) for n in batch], "name string"), path, number, **options)
    df = spark.createDataFrame([(n,) for n in listed], "name string")
    return {r["name"]: r["cluster"] for r in names.grown_clusters(df, path).collect()}


@pytest.mark.parametrize("group_limit, threshold, most", [(2, 0.6, 4), (200, 0.75, 6)])
def test_grown_clusters_equal_a_rebuild(spark, tmp_path, group_limit, threshold, most):
    listed = random_names(11, 40, most)
    shuffled = random.Random(1).sample(listed, len(listed))
    batches = [shuffled[:20], shuffled[15:]]
    got = grown(spark, listed, str(tmp_path / "store"), batches, threshold=threshold, group_limit=group_limit)
    assert got == brute_clusters(listed, threshold)


def test_a_late_name_joins_all_clusters_into_one(spark, tmp_path):
    """Two separate chains, then a name between them with a smaller root; a repeated run changes nothing."""
    path = str(tmp_path / "store")
    first, second = ["red tower", "red tower gate", "blue lake", "blue lake shore"], ["red tower blue lake"]
    assert len(set(grown(spark, first, path, [first]).values())) == 2
    expected = {n: "blue lake" for n in first + second}
    for _ in range(2):
        names.grow_clusters(spark.createDataFrame([(n,) for n in second], "name string"), path, 2)
        df = spark.createDataFrame([(n,) for n in first + second], "name string")
        assert {r["name"]: r["cluster"] for r in names.grown_clusters(df, path).collect()} == expected
    again = spark.createDataFrame([(n,) for n in second], "name string")
    names.grow_clusters(again, path, 3)
    assert {r["name"]: r["cluster"] for r in names.grown_clusters(df, path).collect()} == expected


def test_only_changed_components_are_relabelled(spark):
    forest = spark.createDataFrame([("a", "a"), ("b", "a"), ("d", "d"), ("e", "d"), ("f", "d"), ("x", "x"), ("y", "x")], "node string, root string")
    links = spark.createDataFrame([("b", "f"), ("n", "y"), ("o", "p"), ("a", "b")], "a string, b string")
    got = {tuple(r) for r in names.extend_forest(forest, links, parts=2).collect()}
    assert got == {("d", "a"), ("e", "a"), ("f", "a"), ("n", "n"), ("x", "n"), ("y", "n"), ("o", "o"), ("p", "o")}


@pytest.mark.parametrize("parts", [1, 3, 10_000])
def test_components_around_hubs(spark, parts):
    """A hub with a third of all nodes, with hubs sent to all tasks or not."""
    pairs = spark.range(1, 90).selectExpr(
        "lpad(id, 3, '0') as a", "lpad(case when id <= 30 then 50 when id < 60 then id + 1 else 60 + id % 7 end, 3, '0') as b"
    )
    got = {r["node"]: r["root"] for r in names.connected_components(pairs, parts).collect()}
    parent = {n: n for n in got}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in pairs.collect():
        a, b = sorted((find(r["a"]), find(r["b"])))
        parent[b] = a
    assert got == {n: find(n) for n in got}


def test_scopes_do_not_mix(spark):
    df = spark.createDataFrame([("a", "red tower"), ("a", "tower red"), ("b", "red towers")], "s string, name string")
    got = {(r["s"], r["name"]): r["cluster"] for r in names.cluster_names(df, scope="s").collect()}
    assert got == {("a", "red tower"): "red tower", ("a", "tower red"): "red tower", ("b", "red towers"): "red towers"}


def test_components_of_a_long_chain(spark):
    pairs = spark.range(40).select(
        F.format_string("n%02d", F.col("id")).alias("a"), F.format_string("n%02d", F.col("id") + 1).alias("b")
    )
    got = names.connected_components(pairs).collect()
    assert len(got) == 41 and {r["root"] for r in got} == {"n00"}


def test_no_pairs(spark):
    df = spark.createDataFrame([("red tower",), ("blue lake",)], "name string")
    assert {tuple(r) for r in names.cluster_names(df).collect()} == {("red tower", "red tower"), ("blue lake", "blue lake")}


def test_resolve_exact_before_singular(spark):
    wanted = spark.createDataFrame([("coins",), ("coin",), ("boots",), ("x",)], "item string")
    dim = spark.createDataFrame([("coin", 1), ("boots", 2), ("boot", 3)], "name string, id int")
    got = {r["item"]: r["id"] for r in names.resolve_names(wanted, "item", dim, "name", ["id"]).collect()}
    assert got == {"coins": 1, "coin": 1, "boots": 2, "x": None}


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "a"), ("g", "b"), ("h", "z")], "k string, v string")
    assert {tuple(r) for r in names.most_frequent(df, ["k"], "v", "m").collect()} == {("g", "a"), ("h", "z")}
