"""Data, hub and metadata messages in JSON as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from statcube.model import TIME, VALUE
from statcube.sources.nested import objects, parsed, part, text, unfold, walk

# --- observations ------------------------------------------------------------

_DIMENSION = "array<struct<id:string,keyPosition:int,values:array<struct<id:string>>>>"
_STRUCTURE = f"struct<dimensions:struct<series:{_DIMENSION},observation:{_DIMENSION}>>"
_SETS = "array<struct<series:map<string,struct<observations:map<string,array<string>>>>>>"
_DATA = f"structure:{_STRUCTURE},dataSets:{_SETS}"
_MESSAGE = f"struct<data:struct<{_DATA}>,{_DATA}>"


def flatten_sdmx_json(
    df: DataFrame, column: str, dims: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per observation, with a column for each of ``dims``.

    Parts of a series key follow the dimensions by descending key position.  A missing
    first array element is written as null before parsing.
    """
    repaired = F.replace(F.col(column), F.lit("[,"), F.lit("[null,"))
    parsed = df.select(*keep, F.from_json(repaired, _MESSAGE).alias("_m"))
    body = parsed.select(
        *keep, F.coalesce("_m.data.structure", "_m.structure").alias("_structure"),
        F.explode(F.coalesce("_m.data.dataSets", "_m.dataSets")).alias("_set"),
    )
    by_position = F.sort_array(
        F.transform(
            F.col("_structure.dimensions.series"),
            lambda d, i: F.named_struct(
                F.lit("p"), -F.coalesce(d["keyPosition"], F.lit(0)), F.lit("i"), i, F.lit("d"), d
            ),
        )
    )
    series = body.select(
        *keep, F.col("_structure.dimensions.observation").alias("_obs_dims"),
        by_position["d"].alias("_dims"), F.explode("_set.series").alias("_key", "_series"),
    ).where(F.size("_series.observations") > 0)
    # Ids and codes are worked out once per series; an observation only looks its codes up.
    ids = F.concat("_dims.id", "_obs_dims.id")
    place = F.when(F.size(ids) > 0, F.map_from_arrays(ids, F.sequence(F.lit(0), F.size(ids) - 1)))
    of_key = F.zip_with("_dims", F.split("_key", ":"), lambda d, part: F.get(d["values"], part.cast("int"))["id"])
    places = [f"_place{i}" for i in range(len(dims))]
    coded = series.select(
        *keep, "_obs_dims", F.size("_dims").alias("_n"), of_key.alias("_codes"),
        *[place[d].alias(p) for d, p in zip(dims, places)], F.col("_series.observations").alias("_observations"),
    )
    observations = coded.select(
        *keep, "_obs_dims", "_n", "_codes", *places, F.explode("_observations").alias("_index", "_values")
    )

    def code(p: str) -> Column:
        dimension = F.get("_obs_dims", F.col(p) - F.col("_n"))
        of_index = F.get(dimension["values"], F.col("_index").cast("int"))["id"]
        return F.when(F.col(p) < F.col("_n"), F.get("_codes", F.col(p))).otherwise(of_index)

    return observations.select(
        *keep, *[code(p).alias(d) for d, p in zip(dims, places)],
        F.get("_values", F.lit(0)).try_cast("double").alias(VALUE),
    )


# --- hub catalog -------------------------------------------------------------


def bare_id(identifier: Column) -> Column:
    """Flow id of ``agency,id,version``; a text without commas is the id itself."""
    return F.coalesce(F.get(F.split(identifier, ","), F.lit(1)), identifier)


def _tops(catalog: dict) -> list[dict]:
    return [top for group in objects(catalog.get("categoryGroups")) for top in objects(group.get("categories"))]


def _children(category: dict) -> list[dict]:
    return objects(category.get("childrenCategories"))


def _flows(category: dict) -> list[str]:
    listed = category.get("datasetIdentifiers")
    return [text(f) for f in listed if f is not None] if isinstance(listed, list) else []


def flatten_hub_catalog(df: DataFrame, column: str, node: str) -> DataFrame:
    """Catalog rows of hub catalogs, one JSON catalog per node.

    Datasets and titles become rows and meet by node and id in one grouping.  A dataflow listed twice keeps its first
    place, by node and then position; of several titles the last wins.  Its name is the title, else the
    label of its category, else its id.
    """

    def rows_of(message: str | None) -> Iterator[tuple]:
        catalog, seq = parsed(message), 0
        for category, _ in walk(_tops(catalog), lambda c, s: (_children(c), s), None):
            for full in _flows(category):
                yield False, seq, full, text(category.get("label"))
                seq += 1
        titles = catalog.get("datasetMap")
        for place, (full, entry) in enumerate(titles.items() if isinstance(titles, dict) else ()):
            yield True, place, full, text(part(entry, "title"))

    rows = unfold(df, column, [node], rows_of, "is_title boolean, seq int, full_id string, name string")
    listed, title = ~F.col("is_title"), F.col("is_title")
    per_node = rows.groupBy(F.col(node), bare_id(F.col("full_id")).alias("df_id")).agg(
        F.min(F.when(listed, F.struct("seq", "full_id", "name"))).alias("_first"),
        F.max(F.when(title, F.struct("seq", "name"))).alias("_title"),
    ).where("_first IS NOT NULL")
    best = per_node.groupBy("df_id").agg(F.min(F.struct(node, "_first", "_title")).alias("_b"))
    name = F.coalesce(*[F.nullif(c, F.lit("")) for c in (F.col("_b._title.name"), F.col("_b._first.name"))], F.col("df_id"))
    version = F.get(F.split("_b._first.full_id", ","), F.lit(2))
    return best.select(
        "df_id", F.coalesce(version, F.lit("1.0")).alias("version"), name.alias("df_description"),
        F.lit(None).cast("string").alias("df_structure_id"), F.lit(True).alias("has_constraint"), F.col(f"_b.{node}").alias(node),
    )


_CATEGORY = (
    "scheme_id string, scheme_name string, cat_id string, cat_path string, cat_name string, parent_path string, depth int"
)


def _hub_categories(message: str | None) -> Iterator[tuple[tuple, list[str]]]:
    """Category rows of a hub catalog with their dataset identifiers.

    A category without id is skipped with everything below it.
    """
    for top in _tops(parsed(message)):
        scheme = (text(top.get("id")) or "", text(top.get("label")) or "")

        def below(category: dict, state: tuple[str, int]) -> tuple[list[dict], tuple[str, int]]:
            own = text(category.get("id")) or ""
            return (_children(category), (f"{state[0]}{own}.", state[1] + 1)) if own else ([], state)

        own = [(top, ("", 1))] if _flows(top) else []
        for category, (prefix, depth) in [*own, *walk(_children(top), below, ("", 1))]:
            name = text(category.get("id")) or ""
            if name:
                yield (*scheme, name, prefix + name, text(category.get("label")) or "", prefix[:-1], depth), _flows(category)


def flatten_hub_categories(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Categories of hub catalogs: top categories are schemes.

    A top category that holds dataflows itself also appears as a first-level category.
    """

    def rows_of(message: str | None) -> Iterator[tuple]:
        return (row for row, _ in _hub_categories(message))

    return unfold(df, column, keep, rows_of, _CATEGORY).withColumn("cat_description", F.lit(None).cast("string"))


def flatten_hub_tree(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Links dataflow to category of hub catalogs (categories: ``flatten_hub_categories``)."""

    def rows_of(message: str | None) -> Iterator[tuple]:
        return ((full, row[0], row[3]) for row, flows in _hub_categories(message) for full in flows)

    links = unfold(df, column, keep, rows_of, "full_id string, scheme_id string, cat_path string")
    return links.select(*keep, bare_id(F.col("full_id")).alias("df_id"), "scheme_id", "cat_path")


def flatten_hub_structure(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Dimensions of a hub structure in order, the time dimension left out."""
    kind = (
        "timeDimension string, "
        "criteria array<struct<id:string,label:string,extra:struct<DataStructureRef:string>>>"
    )
    parsed = df.select(*keep, F.from_json(F.col(column), kind).alias("_m"))
    ordinary = F.filter(
        "_m.criteria",
        lambda c: (F.coalesce(c["id"], F.lit("")) != "") & ~c["id"].eqNullSafe(F.col("_m.timeDimension")),
    )
    dims = parsed.select(*keep, F.posexplode(ordinary).alias("_i", "_c"))
    return dims.select(
        *keep, F.col("_c.id").alias("dimension_id"), (F.col("_i") + 1).alias("position"),
        F.get(F.split("_c.extra.DataStructureRef", r"\+"), F.lit(1)).alias("codelist_id"),
        F.nullif(F.col("_c.label"), F.lit("")).alias("label"),
    )


def flatten_hub_values(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """(dimension, code) of hub value lists; time and empty codes are skipped."""
    kind = "criteria array<struct<id:string,values:array<struct<id:string>>>>"
    parsed = df.select(*keep, F.explode(F.from_json(F.col(column), kind)["criteria"]).alias("_c"))
    codes = parsed.select(*keep, F.col("_c.id").alias("dimension_id"), F.explode("_c.values.id").alias("code_id"))
    return codes.where((F.upper("dimension_id") != TIME) & (F.col("dimension_id") != "") & (F.col("code_id") != ""))


# --- metadata reports --------------------------------------------------------


def _reported(message: str | None, wanted: Sequence[str], lang: str) -> tuple:
    """Per wanted id, the text of the first attribute with that id that has one, parents before children.

    The plain text, else the wanted language, else English, else the first language.
    """
    sets = objects(part(parsed(message), "data", "metadataSets"))
    reports = [r for s in sets for r in objects(s.get("reports"))]
    tops = [a for r in reports for a in objects(part(r, "attributeSet", "reportedAttributes"))]
    found: dict[str, str] = {}
    for node, _ in walk(tops, lambda a, s: (objects(part(a, "attributeSet", "reportedAttributes")), s), None):
        name = text(node.get("id"))
        if name in wanted and name not in found:
            texts = node.get("texts") if isinstance(node.get("texts"), dict) else {}
            first = next(iter(texts.values()), None)
            options = (text(t) for t in (node.get("text"), texts.get(lang), texts.get("en"), first))
            best = next((t for t in options if t), None)
            if best:
                found[name] = best
    return tuple(found.get(name) for name in wanted)


def flatten_metadata_report(
    df: DataFrame, column: str, attributes: dict[str, str], lang: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Reported attributes as columns: ``attributes`` maps column names to attribute ids."""
    wanted = list(attributes.values())
    schema = T.StructType([T.StructField(name, T.StringType()) for name in attributes]).toDDL()
    return unfold(df, column, keep, lambda message: [_reported(message, wanted, lang)], schema)
