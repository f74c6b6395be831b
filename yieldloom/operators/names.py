"""Name lookup, similar names and name clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import canon_tokens, singular
from ..session import cut_lineage, save
from ..sources import keyed_store

# Groups up to this size are compared pair by pair; larger ones are narrowed by a further word first.
GROUP_LIMIT = 200
# A key with at least one of so many parts of all rows is a hub; there can be no more hubs than parts.
HUB_PARTS = 10_000


def _join_counted(many: DataFrame, few: DataFrame, on: str, total: int, parts: int = HUB_PARTS) -> DataFrame:
    """Inner join to one row per key, where ``few.n_rows`` says how many of the ``total`` rows have the key.

    Hubs are ``parts`` keys at most, so they go to all tasks, and their rows stay where they are. What is shuffled
    has no key with more than ``total / parts`` rows.
    """
    if total <= parts:
        return many.join(F.broadcast(few.drop("n_rows")), on)  # no more keys than rows
    is_hub = F.col("n_rows") * parts >= total
    hubs = F.broadcast(few.filter(is_hub).drop("n_rows"))
    rest = many.join(hubs.select(on), on, "left_anti").join(few.filter(~is_hub).drop("n_rows"), on)
    return many.join(hubs, on).unionByName(rest)


def resolve_names(df: DataFrame, name: str, dimension: DataFrame, dim_name: str, columns: Sequence[str]) -> DataFrame:
    """Left lookup of a lower-case name: exact first, else without its plural ``s``.

    Of dimension rows with one name the one with the greatest columns answers, so the lookup never adds rows.
    """
    lookup = dimension.groupBy(F.col(dim_name).alias("dim_name")).agg(F.max(F.struct(*columns)).alias("found"))
    exact = lookup.select(F.col("dim_name").alias("exact_name"), F.col("found").alias("exact"))
    plural = lookup.select(F.col("dim_name").alias("singular_name"), F.col("found").alias("by_singular"))
    return (
        df.join(exact, F.col(name) == F.col("exact_name"), "left")
        .join(plural, singular(F.col(name)) == F.col("singular_name"), "left")
        .withColumn("found", F.coalesce("exact", "by_singular"))
        .select(*df.columns, *[F.col(f"found.{c}").alias(c) for c in columns])
    )


def name_keys(names: DataFrame, name: str = "name", scope: str | None = None) -> DataFrame:
    """Distinct names with their canonical key and words; names of different scopes share no word."""
    scope_col = F.lit("") if scope is None else F.concat(F.col(scope), F.lit("/"))
    return (
        names.select(scope_col.alias("scope"), F.col(name).alias("name"))
        .distinct()
        .withColumn("tokens", F.transform(canon_tokens(F.col("name")), lambda w: F.concat(F.col("scope"), w)))
        .withColumn("key", F.array_join("tokens", " "))
    )


def _needed(a: Column, b: Column, threshold: float) -> Column:
    """Shared words that two sets of these sizes need for a Jaccard ratio of at least the threshold."""
    return F.ceil((a + b) * threshold / (1 + threshold) - 1e-9).cast("int")


def _ranked_sets(keys: DataFrame) -> DataFrame:
    """Distinct word sets with their words ordered rarest first; without a column ``fresh`` all of them are."""
    fresh = F.col("fresh") if "fresh" in keys.columns else F.lit(True)
    sets = keys.filter(F.size("tokens") > 0).groupBy("key", "tokens").agg(F.max(fresh).alias("fresh"))
    words = cut_lineage(sets.select("key", "fresh", F.explode("tokens").alias("word")))
    frequency = words.groupBy("word").agg(F.count(F.lit(1)).alias("n_sets")).withColumn("n_rows", F.col("n_sets"))
    ordered = _join_counted(words, frequency, "word", words.count()).groupBy("key", "fresh").agg(
        F.array_sort(F.collect_list(F.struct("n_sets", "word"))).alias("w")
    )
    return ordered.select("key", "fresh", F.transform("w", lambda x: x["word"]).alias("words")).withColumn(
        "n", F.size("words")
    )


def _compare(left: DataFrame, right_on: list[str], condition: Column, threshold: float) -> DataFrame:
    """Pairs inside small groups that really reach the threshold."""
    shared = F.array_intersect("l.words", "r.words")
    joined = left.alias("l").join(left.alias("r"), [F.col(f"l.{c}") == F.col(f"r.{c}") for c in right_on])
    return joined.filter(
        (F.col("l.key") < F.col("r.key"))
        & (F.col("l.fresh") | F.col("r.fresh"))
        & condition
        & (F.size(shared) >= _needed(F.col("l.n"), F.col("r.n"), threshold))
    )


def _all_of(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def similar_classes(
    keys: DataFrame, threshold: float = 0.5, group_limit: int = GROUP_LIMIT
) -> tuple[DataFrame, DataFrame | None]:
    """Similar canonical keys without writing out the pairs of large groups: ``(pairs, members)``.

    Exact, without comparing all pairs. Two sets can only be similar when they share one of their
    rarest words, so sets meet at such a word. A word shared by more than ``group_limit`` sets is not
    paired up: its sets are split by the sizes of both partners, and by a second, third, ... shared
    word, until a group is small or its shared words alone already prove every pair in it similar.

    ``pairs`` (a < b) are those of small groups. A proven group gives one row a member instead: ``members``
    (class, key, representative, is_lo, is_hi, n_links), where each key of the smaller size (``is_lo``) is similar to each of
    the greater (``is_hi``), ``representative`` is the smallest of the former and ``n_links`` counts a member's partners in
    the class. All similar pairs are in ``pairs`` or in a class, some in several; ``expand_classes`` writes them
    out. ``members`` is None if there is no such group.

    With a boolean column ``fresh`` only pairs with at least one fresh key are looked for; a class with a fresh
    member still lists all its members.
    """
    sets = cut_lineage(_ranked_sets(keys))
    n = F.col("n")
    prefix = n - F.ceil(n * threshold - 1e-9).cast("int") + 1
    met = cut_lineage(sets.select("*", F.posexplode(F.slice("words", F.lit(1), prefix)).alias("pos", "sig")))
    sizes = met.groupBy("sig").agg(F.count(F.lit(1)).alias("members"), F.max("fresh").alias("any_fresh"))
    sizes = sizes.withColumn("n_rows", F.col("members")).filter(F.col("any_fresh") & (F.col("members") > 1)).drop("any_fresh")
    met = _join_counted(met, sizes, "sig", met.count())
    first_shared = F.element_at(F.array_intersect("l.words", "r.words"), 1) == F.col("l.sig")
    pairs = [
        _compare(met.filter(F.col("members") <= group_limit), ["sig"], first_shared, threshold).select(
            F.col("l.key").alias("a"), F.col("r.key").alias("b")
        )
    ]
    classes = []

    hot = met.filter(F.col("members") > group_limit).drop("members")
    partner = hot.select(F.col("sig").alias("psig"), F.col("n").alias("m")).distinct()
    hot = (
        hot.join(partner, (F.col("sig") == F.col("psig")) & (F.col("m") >= n * threshold - 1e-9) & (F.col("m") * threshold - 1e-9 <= n))
        .drop("psig")
        .withColumn("lo", F.least("n", "m"))
        .withColumn("hi", F.greatest("n", "m"))
        .withColumn("need", _needed(n, F.col("m"), threshold))
        .filter(F.col("pos") <= n - F.col("need"))
    )
    group = ["sig", "lo", "hi"]
    words_shared = 1
    while True:
        hot = cut_lineage(hot)
        if hot.isEmpty():
            break
        is_lo, is_hi = F.col("n") == F.col("lo"), F.col("n") == F.col("hi")
        counts = hot.groupBy(*group).agg(
            F.count_if(is_lo).alias("n_lo"),
            F.count_if(is_hi).alias("n_hi"),
            F.count(F.lit(1)).alias("members"),
            F.max("fresh").alias("any_fresh"),
            F.min(F.when(is_lo, F.col("key"))).alias("hub"),
        ).filter(F.col("any_fresh") & (F.col("n_lo") > 0) & (F.col("n_hi") > 0) & (F.col("members") > 1))
        alive = hot.join(counts, group)
        proven = F.col("need") <= words_shared
        partners = F.when(is_lo & is_hi, F.col("members") - 1).when(is_lo, F.col("n_hi")).otherwise(F.col("n_lo"))
        classes.append(
            alive.filter(proven).select(
                F.concat_ws("\t", *group).alias("class"), "key", F.col("hub").alias("representative"),
                is_lo.alias("is_lo"), is_hi.alias("is_hi"), partners.alias("n_links"),
            )
        )
        small = F.col("members") <= group_limit
        across = (F.col("l.lo") == F.col("l.hi")) | (F.col("l.n") != F.col("r.n"))
        pairs.append(
            _compare(alive.filter(~proven & small), group, across, threshold).select(
                F.col("l.key").alias("a"), F.col("r.key").alias("b")
            )
        )
        last = n - F.col("need") + words_shared
        following = F.when(
            last >= F.col("pos") + 1, F.sequence(F.col("pos") + 1, last)
        )
        hot = (
            alive.filter(~proven & ~small)
            .withColumn("next", F.explode(following))
            .withColumn("sig", F.concat_ws(" ", "sig", F.element_at("words", F.col("next") + 1)))
            .withColumn("pos", F.col("next"))
            .drop("next", "n_lo", "n_hi", "members", "any_fresh", "hub")
        )
        words_shared += 1
    return _all_of(pairs).distinct(), _all_of(classes) if classes else None


def expand_classes(members: DataFrame) -> DataFrame:
    """All pairs (a < b) of similar keys that classes stand for; their number grows with the square of a class."""
    lo, hi = members.filter("is_lo").alias("l"), members.filter("is_hi").alias("r")
    a, b = F.col("l.key"), F.col("r.key")
    return lo.join(hi, "class").filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def similar_keys(
    keys: DataFrame, threshold: float = 0.5, links_only: bool = False, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """Pairs (a < b) of canonical keys whose words have a Jaccard ratio of at least the threshold.

    With ``links_only`` a class gives one link a member, to its representative, instead of all its pairs. The pairs
    returned then have the same connected components, but their number grows linearly.
    """
    pairs, members = similar_classes(keys, threshold, group_limit)
    if members is None:
        return pairs
    if links_only:
        # Every member is similar to every one of the smaller size, so linking all to one of those is enough.
        star = members.filter("key <> representative")
        more = star.select(F.least("representative", "key").alias("a"), F.greatest("representative", "key").alias("b"))
    else:
        more = expand_classes(members)
    return pairs.unionByName(more).distinct()


def _changed(a: DataFrame) -> tuple:
    row = a.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(pairs: DataFrame, parts: int = HUB_PARTS) -> DataFrame:
    """(node, root) for every node of the pairs; root is the smallest node of its component.

    Alternating large-star and small-star rounds: the number of rounds grows with the logarithm of the
    node count and edges never multiply. Each round takes minima with partial aggregates and joins them
    back with hubs sent to all tasks, so a node with very many neighbours is spread over all tasks.
    """
    edges = cut_lineage(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )
    before = _changed(edges)
    while before[0] > 0:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_rows")).withColumn("m", F.least("u", "m"))
        # Large star: neighbours above a node move to the smallest node it knows.
        edges = (
            _join_counted(both.filter("v > u"), low, "u", 2 * before[0], parts)
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: a node and its lower neighbours move to the lowest of them.
        low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_rows"))
        edges = (
            _join_counted(edges, low, "u", before[0], parts)  # edges are no more than they were
            .filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = cut_lineage(edges)
        now = _changed(edges)
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


def cluster_names(
    names: DataFrame, name: str = "name", scope: str | None = None, threshold: float = 0.5,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """(scope, name, cluster): names joined by chains of similar names; a name without words stays alone.

    The cluster is called by its smallest member. Names with equal words count as one node.
    """
    keys = cut_lineage(name_keys(names, name, scope))
    component = connected_components(similar_keys(keys, threshold, links_only=True, group_limit=group_limit))
    placed = (
        keys.join(component, keys["key"] == component["node"], "left")
        .withColumn(
            "root",
            F.when(F.size("tokens") == 0, F.concat_ws("\t", F.lit("alone"), "scope", "name")).otherwise(
                F.coalesce("root", "key")
            ),
        )
        .select("scope", "name", "root")
    )
    placed = cut_lineage(placed)
    label = placed.groupBy("root").agg(F.min("name").alias("cluster"), F.count(F.lit(1)).alias("n_rows"))
    out = _join_counted(placed, label, "root", placed.count())
    scope_cols = [] if scope is None else [F.rtrim(F.col("scope"), F.lit("/")).alias(scope)]
    return out.select(*scope_cols, F.col("name").alias(name), "cluster")


def extend_forest(forest: DataFrame, links: DataFrame, parts: int = HUB_PARTS) -> DataFrame:
    """Rows (node, root) that links (a, b) add to a forest or change in it; ``forest`` has one row a node.

    Links are lifted to the roots they join, so rounds run on the roots of touched components alone; of the
    forest only components that get another root are rewritten.
    """
    links = cut_lineage(links.select("a", "b").distinct())
    total = 2 * links.count()
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_rows"))
    ends = ends.join(forest.select("node", F.col("root").alias("held")), "node", "left")
    ends = cut_lineage(ends.withColumn("root", F.coalesce("held", "node")))
    of = {c: ends.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"), "n_rows") for c in ("a", "b")}
    lifted = _join_counted(cut_lineage(_join_counted(links, of["a"], "a", total, parts)), of["b"], "b", total, parts)
    merged = connected_components(lifted.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), parts)
    merged = cut_lineage(merged.select(F.col("node").alias("root"), F.col("root").alias("new_root")))
    moved = merged.filter("root <> new_root").join(forest.groupBy("root").agg(F.count(F.lit(1)).alias("n_rows")), "root")
    changed = _join_counted(forest, moved, "root", forest.count(), parts).select("node", F.col("new_root").alias("root"))
    added = ends.filter("held is null").select("node").join(merged.withColumnRenamed("root", "node"), "node", "left")
    return changed.unionByName(added.select("node", F.coalesce("new_root", "node").alias("root")))


def grow_clusters(
    names: DataFrame, path: str, number: int, name: str = "name", threshold: float = 0.5, group_limit: int = GROUP_LIMIT,
) -> None:
    """Fold names into the stored clusters below ``path`` as run ``number``; a run that is repeated changes nothing.

    The store (``keyed_store``) has a row a canonical key: its words, its smallest name and the root of its component.
    New keys are compared with each other and with those stored keys that share a word with them; stored keys are
    not compared among themselves again. Written are new keys, keys with a smaller name and keys that get
    another root. Names without words are not stored: each is a cluster of its own.
    """
    spark = names.sparkSession
    came = name_keys(names, name).filter(F.size("tokens") > 0).groupBy("key", "tokens").agg(F.min("name").alias("first_name"))
    came = save(came, "came-keys")
    if keyed_store.manifest(spark, path, number)["buckets"]:
        held = save(keyed_store.read(spark, path, ["key"], ["run"], before=number), "held-keys")
    else:
        held = spark.createDataFrame([], "key string, tokens array<string>, first_name string, root string, run bigint")
    fresh = save(came.join(held, "key", "left_anti"), "fresh-keys")
    words = fresh.select(F.explode("tokens").alias("word")).distinct()
    near = held.select("key", F.explode("tokens").alias("word")).join(words, "word", "left_semi").select("key").distinct()
    compared = fresh.select("key", "tokens", F.lit(True).alias("fresh")).unionByName(
        held.join(near, "key", "left_semi").select("key", "tokens", F.lit(False).alias("fresh"))
    )
    links = similar_keys(compared, threshold, links_only=True, group_limit=group_limit)
    forest = held.select(F.col("key").alias("node"), "root")
    roots = save(extend_forest(forest, links).select(F.col("node").alias("key"), F.col("root").alias("new_root")), "new-roots")
    known = held.select("key", "tokens", "first_name", "root").unionByName(fresh.withColumn("root", F.col("key")))
    smaller = came.select("key", F.col("first_name").alias("came_name"))
    rows = (
        known.join(roots, "key", "left").join(smaller, "key", "left").join(fresh.select("key", F.lit(True).alias("is_fresh")), "key", "left")
        .filter("is_fresh or new_root is not null or came_name < first_name")
        .select(
            "key", "tokens", F.least("first_name", "came_name").alias("first_name"), F.coalesce("new_root", "root").alias("root"),
            F.lit(number).cast("bigint").alias("run"),
        )
    )
    keyed_store.fold(save(rows, "changed-keys"), path, number, ["key"], ["run"])


def grown_clusters(names: DataFrame, path: str, name: str = "name") -> DataFrame:
    """(name, cluster) of names that the stored clusters have taken in, as ``cluster_names`` gives them."""
    held = save(keyed_store.read(names.sparkSession, path, ["key"], ["run"]).select("key", "root", "first_name"), "held-keys")
    label = held.groupBy("root").agg(F.min("first_name").alias("cluster"), F.count(F.lit(1)).alias("n_rows"))
    placed = _join_counted(held, label, "root", held.count()).select("key", "cluster")
    keys = name_keys(names, name).select("name", "key")
    return keys.join(placed, "key", "left").select(F.col("name").alias(name), F.coalesce("cluster", "name").alias("cluster"))


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Most frequent value of each group; of equally frequent ones the smallest."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(alias))


