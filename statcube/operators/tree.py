"""Category trees and code hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from statcube.operators.catalog import LEAF, dataflow_counts, scheme_counts
from statcube.session import cut_lineage


def _depths(nodes: DataFrame) -> tuple[DataFrame, int]:
    """(scheme_id, id, parent, depth) of the nodes that reach a root, and the doublings that the deepest took.

    Pointers only: a row points at some ancestor and, each round, takes over where that one points.  After
    round k all nodes up to depth 2^k are done.  Depths have no gaps, so a round that finishes none is the last:
    whatever still points then sits on a cycle, or below one or a missing parent.
    """
    start = nodes.select("scheme_id", "id", "parent").distinct()
    rows = start.withColumns({"_next": F.col("parent"), "depth": F.lit(1), "_fresh": F.col("parent").isNull()})
    rounds = 0
    while True:
        seen = Observation()
        pending = F.col("_next").isNotNull()
        rows = cut_lineage(rows.observe(seen, F.count_if("_fresh").alias("done"), F.count_if(pending).alias("open")))
        if rows.isEmpty() or not seen.get["done"]:
            return rows.where(~pending).drop("_next", "_fresh"), max(rounds - 1, 0)
        if not seen.get["open"]:
            return rows.drop("_next", "_fresh"), rounds
        ahead = rows.select("scheme_id", F.col("id").alias("_next"), F.col("_next").alias("_then"), F.col("depth").alias("_more"))
        climbed = rows.where(pending).join(ahead, ["scheme_id", "_next"]).select(
            "scheme_id", "id", "parent", F.col("_then").alias("_next"), (F.col("depth") + F.col("_more")).alias("depth"),
            F.col("_then").isNull().alias("_fresh"))
        rows = rows.where(~pending).withColumn("_fresh", F.lit(False)).unionByName(climbed)
        rounds += 1


def materialise_paths(nodes: DataFrame) -> DataFrame:
    """Paths of parent/child rows (scheme_id, id, parent, ...): dotted path and depth.

    Rows that never reach a root (cycles, missing parents) are found on pointers alone and left out before
    any text is built; then the paths of the rest double in as many rounds as the deepest needs.
    """
    extra = [c for c in nodes.columns if c not in ("scheme_id", "id", "parent")]
    rooted, rounds = _depths(nodes)
    walk = rooted.withColumns({"_next": F.col("parent"), "cat_path": F.col("id")})
    for _ in range(rounds):
        ahead = walk.select("scheme_id", F.col("id").alias("_next"), F.col("_next").alias("_then"), F.col("cat_path").alias("_path"))
        walk = cut_lineage(walk.join(ahead, ["scheme_id", "_next"], "left").select(
            "scheme_id", "id", "parent", "depth", F.col("_then").alias("_next"), F.concat_ws(".", "_path", "cat_path").alias("cat_path")))
    found = walk.select(F.col("scheme_id").alias("_scheme"), F.col("id").alias("_id"), F.col("parent").alias("_parent"), "cat_path", "depth")
    same = (F.col("scheme_id") == F.col("_scheme")) & (F.col("id") == F.col("_id")) & F.col("parent").eqNullSafe(F.col("_parent"))
    tail = F.length("cat_path") - F.length("id") - 1
    return nodes.join(found, same).select(
        "scheme_id", F.col("id").alias("cat_id"), *extra, "cat_path",
        F.when(F.col("depth") > 1, F.substring("cat_path", F.lit(1), tail)).otherwise("").alias("parent_path"),
        "depth",
    )


def subtree(categories: DataFrame, scheme: str, cat_id: str) -> DataFrame:
    """A category and everything below it."""
    inside = categories.where(F.col("scheme_id") == scheme)
    roots = inside.where(F.col("cat_id") == cat_id).agg(F.min("cat_path")).scalar()
    return inside.where((F.col("cat_path") == roots) | F.col("cat_path").startswith(F.concat(roots, F.lit("."))))


def limit_depth(categories: DataFrame, depth: int, root_depth: int | Column | None = None) -> DataFrame:
    """Levels down to ``depth`` below the root.

    Without a root the list of schemes is the first level, so categories start at 2.
    """
    deepest = F.lit(depth - 1) if root_depth is None else F.lit(depth) + root_depth
    return categories.where(F.col("depth") <= deepest)


def tree_rows(categories: DataFrame, links: DataFrame) -> DataFrame:
    """Category rows with the number of dataflows directly below."""
    return categories.join(dataflow_counts(links), LEAF, "left").select(
        "scheme_id", "cat_id", "cat_path",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("cat_name", "cat_description", "parent_path")],
        "depth", F.coalesce("n_df", F.lit(0)).alias("n_df"),
    )


def scheme_rows(categories: DataFrame, links: DataFrame) -> DataFrame:
    """Schemes with the number of dataflows anywhere below."""
    schemes = categories.select("scheme_id", "scheme_name").distinct()
    return schemes.join(scheme_counts(links), "scheme_id", "left").select(
        "scheme_id", "scheme_name", F.coalesce("n_df", F.lit(0)).alias("n_df")
    )


def selectable_leaves(values: DataFrame) -> DataFrame:
    """Selectable codes reached from the roots through non-selectable ones only.

    ``values`` has dimension_id, id, name, parent, is_selectable.  Breadth first: a code
    met before is not met again, which also ends cycles.
    """
    keys = ["dimension_id", "id"]
    nodes = values.select(
        *keys, F.coalesce("name", F.lit("")).alias("name"), "parent",
        F.coalesce("is_selectable", F.lit(True)).alias("is_selectable"),
    ).where(F.coalesce("id", F.lit("")) != "")
    rest = ["name", "parent", "is_selectable"]

    def one_each(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_n")).select(*keys, "_n.*")

    seen = cut_lineage(one_each(nodes.where(F.col("parent").isNull())))
    frontier = seen
    while not frontier.where(~F.col("is_selectable")).isEmpty():
        inner = frontier.where(~F.col("is_selectable")).select("dimension_id", F.col("id").alias("parent"))
        children = one_each(nodes.join(inner.distinct(), ["dimension_id", "parent"], "left_semi"))
        frontier = cut_lineage(children.join(seen.select(*keys), keys, "left_anti").select(*nodes.columns))
        seen = seen.unionByName(frontier)
    return seen.where("is_selectable").select(*keys, "name")


def codelist_hierarchy(codelist: DataFrame) -> DataFrame:
    return codelist.select("id", "name", "parent", "order").orderBy(F.col("order").asc_nulls_first(), "id")


def rollup_parent(df: DataFrame, dim: str, hierarchy: DataFrame, value: str = "OBS_VALUE") -> DataFrame:
    """Observations summed from child codes to their parents.

    Rows are summed per child first, so the join and the final sum move little even
    when one code holds much of the cube.
    """
    others = [c for c in df.columns if c not in (dim, value)]
    per_child = df.groupBy(dim, *others).agg(F.sum(value).alias(value))
    parents = hierarchy.where(F.col("parent").isNotNull()).select(
        F.col("id").alias("_child"), F.col("parent").alias("_parent")
    )
    return (
        per_child.join(parents, F.col(dim) == F.col("_child"))
        .groupBy(F.col("_parent").alias(dim), *others)
        .agg(F.sum(value).alias(value))
    )


def classify_category_or_dataflow(
    ids: DataFrame, categories: DataFrame, links: DataFrame, scheme: str
) -> DataFrame:
    """What each id is: scheme, category, dataflow here, dataflow elsewhere, or unknown.

    ``scheme_id`` and ``cat_id`` say where a category or dataflow was found.
    """
    asked = ids.select("id").distinct()
    schemes = categories.select(F.col("scheme_id").alias("id")).distinct().join(asked, "id", "left_semi")
    cats = (
        categories.select(F.col("cat_id").alias("id"), "scheme_id").join(asked, "id", "left_semi")
        .groupBy("id").agg(
            F.max(F.col("scheme_id") == scheme).alias("_cat_here"), F.min("scheme_id").alias("_cat_scheme")
        )
    )
    flows = (
        links.select(F.col("df_id").alias("id"), *LEAF).join(asked, "id", "left_semi")
        .groupBy("id").agg(
            F.min(F.when(F.col("scheme_id") == scheme, F.struct(*LEAF))).alias("_here"),
            F.min(F.struct(*LEAF)).alias("_any"),
        )
    )
    place = F.coalesce("_here", "_any")
    kind = (
        F.when(F.col("_scheme"), "scheme")
        .when(F.col("_cat_here"), "category")
        .when(F.col("_here").isNotNull(), "dataflow")
        .when(F.col("_any").isNotNull(), "dataflow_elsewhere")
        .when(F.col("_cat_scheme").isNotNull(), "category_elsewhere")
        .otherwise("unknown")
    )
    in_category = kind.isin("category", "category_elsewhere")
    found_in = F.when(kind == "category", scheme).when(in_category, F.col("_cat_scheme"))
    of_flow = kind.isin("dataflow", "dataflow_elsewhere")
    return (
        asked.join(schemes.withColumn("_scheme", F.lit(True)), "id", "left")
        .join(cats, "id", "left").join(flows, "id", "left")
        .select(
            "id", kind.alias("kind"),
            F.coalesce(found_in, F.when(of_flow, place["scheme_id"])).alias("scheme_id"),
            F.when(of_flow, F.element_at(F.split(place["cat_path"], r"\."), -1)).alias("cat_id"),
        )
    )
