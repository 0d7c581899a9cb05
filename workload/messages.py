"""Queries on files and messages: written from the tables by Spark, then read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statcube.operators.analyze import annotation_census
from statcube.operators.archive import release_feed
from statcube.sources import messages_json as js, messages_xml as xml, tabular
from statcube.sources.calendar import flatten_calendar
from workload.cubes import ALL
from workload.registry import Data, query

# --- files -------------------------------------------------------------------


def _csv_of_obs(d: Data, marker: str | None = None) -> str:
    path = d.scratch("observations") + ".csv"
    cube = d.obs
    if marker is not None:
        cube = cube.withColumns({
            "STATUS": F.when(F.col("STATUS") == "F", marker).otherwise(F.col("STATUS")),
            "OBS_VALUE": F.when(F.col("FLAG") == "A", marker).otherwise(F.col("OBS_VALUE").cast("string")),
        })
    tabular.write_output(cube, path)
    return path


@query("read_observations", f"SELECT {ALL} FROM {{obs}}")
def _(d: Data) -> DataFrame:
    return tabular.read_observations(d.spark, _csv_of_obs(d))


@query("read_suppressed_csv", """
    SELECT FREQ, GEO, SUPP, FLAG, nullif(STATUS, 'F') AS STATUS, TIME_PERIOD,
           CASE WHEN FLAG <> 'A' THEN OBS_VALUE END AS OBS_VALUE FROM {obs}
""")
def _(d: Data) -> DataFrame:
    return tabular.read_suppressed_csv(d.spark, _csv_of_obs(d, tabular.SUPPRESSED))


@query("read_local", "SELECT page_id::VARCHAR AS page_id, url, html FROM {pages}")
def _(d: Data) -> DataFrame:
    path = d.scratch("pages") + ".tsv"
    d.pages.write.options(header="true", sep="\t", escape='"').csv(path)
    return tabular.read_local(d.spark, path, multi_line=True)


@query("write_output", "SELECT doc_id, text, lang, source, n_chars FROM {documents}")
def _(d: Data) -> DataFrame:
    path = d.scratch("documents") + ".json"
    tabular.write_output(d.documents, path)
    return d.spark.read.schema(d.documents.schema).json(path)


@query("write_archive", "SELECT provider, df_id, dimension_id, code_id FROM {avail}")
def _(d: Data) -> DataFrame:
    path = d.scratch("archive") + ".parquet"
    tabular.write_archive(d.avail, path, "dimension_id")
    return d.spark.read.parquet(path).select("provider", "df_id", F.col("dimension_id").cast("string"), "code_id")


# --- XML ---------------------------------------------------------------------


def _x(text: Column) -> Column:
    """Escape text for XML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _message(template: str, **parts: str | Column) -> Column:
    """Message text from a template with ``<<name>>`` places for columns."""
    pieces: list[Column] = []
    rest = template
    while "<<" in rest:
        before, _, tail = rest.partition("<<")
        name, _, rest = tail.partition(">>")
        value = parts.get(name, name)
        column = F.col(value).cast("string") if isinstance(value, str) else value
        pieces += [F.lit(before), F.coalesce(column, F.lit(""))]
    return F.concat(*pieces, F.lit(rest))


HEAD = (
    '<m:Structure xmlns:m="http://example.org/m" xmlns:s="http://example.org/s" xmlns:c="http://example.org/c">'
    "<m:Structures>"
)
TAIL = "</m:Structures></m:Structure>"


def _dataflow_messages(d: Data) -> DataFrame:
    """One message per part: a named dataflow with annotations, and one named in Italian only."""
    template = HEAD + (
        '<s:Dataflows><s:Dataflow id="DF_<<p_partkey>>" agencyID="<<p_type>>" version="1.<<p_size>>">'
        "<c:Annotations><c:Annotation><c:AnnotationType>KEYWORDS</c:AnnotationType>"
        '<c:AnnotationText xml:lang="it">it <<p_name>></c:AnnotationText>'
        '<c:AnnotationText xml:lang="en"> <<p_name>> </c:AnnotationText></c:Annotation>'
        "<c:Annotation><c:AnnotationTitle><<p_size>></c:AnnotationTitle><c:AnnotationType>SIZE</c:AnnotationType>"
        "</c:Annotation><c:Annotation><c:AnnotationTitle>late</c:AnnotationTitle>"
        "<c:AnnotationType>SIZE</c:AnnotationType></c:Annotation>"
        "<c:Annotation><c:AnnotationType>READY_<<p_type>></c:AnnotationType></c:Annotation></c:Annotations>"
        '<c:Name xml:lang="it">Nome <<p_name>></c:Name><c:Name xml:lang="en"><<p_name>> &amp; co</c:Name>'
        '<s:Structure><Ref id="<<p_brand>>"/></s:Structure></s:Dataflow>'
        '<s:Dataflow id="IT_<<p_partkey>>" version="2.0"><c:Name xml:lang="it">Solo <<p_name>></c:Name></s:Dataflow>'
        "</s:Dataflows>"
    ) + TAIL
    return d.spread("part").select(_message(template).alias("message"))


@query("flatten_dataflows", """
    SELECT p_type || ',DF_' || p_partkey AS df_id, '1.' || p_size AS version, p_name || ' & co' AS df_description,
           p_brand AS df_structure_id FROM {part}
    UNION ALL SELECT 'IT_' || p_partkey, '2.0', 'Solo ' || p_name, NULL FROM {part}
""")
def _(d: Data) -> DataFrame:
    elements = xml.parse_elements(_dataflow_messages(d), "message", "Dataflow")
    return xml.flatten_dataflows(elements, "en", prefix_agency=True)


@query("read_elements", """
    SELECT 'DF_' || p_partkey AS df_id, '1.' || p_size AS version, 'Nome ' || p_name AS df_description,
           p_brand AS df_structure_id FROM {part}
""")
def _(d: Data) -> DataFrame:
    path = d.scratch("messages")
    name = F.array(
        F.struct(F.lit("en").alias("_lang"), F.col("p_name").alias("_VALUE")),
        F.struct(F.lit("it").alias("_lang"), F.concat(F.lit("Nome "), "p_name").alias("_VALUE")),
    )
    flows = d.spread("part").select(
        F.concat(F.lit("DF_"), F.col("p_partkey").cast("string")).alias("_id"),
        F.concat(F.lit("1."), F.col("p_size").cast("string")).alias("_version"), name.alias("Name"),
        F.struct(F.struct(F.col("p_brand").alias("_id")).alias("Ref")).alias("Structure"),
    )
    flows.write.format("xml").options(rootTag="Dataflows", rowTag="Dataflow").save(path)
    return xml.flatten_dataflows(xml.read_elements(d.spark, path, "Dataflow"), "it")


@query("flatten_annotations", """
    SELECT 'DF_' || p_partkey AS df_id, 'KEYWORDS' AS annotation_type, NULL AS title, p_name AS text, NULL::VARCHAR AS url
    FROM {part}
    UNION ALL SELECT 'DF_' || p_partkey, 'SIZE', p_size::VARCHAR, NULL, NULL FROM {part}
    UNION ALL SELECT 'DF_' || p_partkey, 'READY_' || p_type, NULL, NULL, NULL FROM {part}
""")
def _(d: Data) -> DataFrame:
    elements = xml.parse_elements(_dataflow_messages(d), "message", "Dataflow")
    return xml.flatten_annotations(elements, "de")


@query("annotation_columns", """
    SELECT 'DF_' || p_partkey AS df_id, 'it ' || p_name AS df_keywords, p_size::VARCHAR AS df_size,
           CASE WHEN p_type = 'PROMO' THEN 'true' END AS df_promo, NULL::VARCHAR AS df_broken FROM {part}
""")
def _(d: Data) -> DataFrame:
    config = {
        "keywords": {"type": "KEYWORDS"}, "size": {"type": "SIZE", "value": "title"},
        "promo": {"type": "READY_PROMO", "value": "presence"}, "broken": {"type": 7, "value": "text"},
    }
    elements = xml.parse_elements(_dataflow_messages(d), "message", "Dataflow")
    return xml.annotation_columns(xml.flatten_annotations(elements, "it"), config)


@query("annotation_census", """
    SELECT t AS annotation_type, count(*) AS n_df, round(count(*) / (SELECT count(*) FROM {part}), 4) AS share
    FROM (SELECT unnest(['KEYWORDS', 'SIZE', 'READY_' || p_type]) AS t FROM {part}) GROUP BY t
""")
def _(d: Data) -> DataFrame:
    elements = xml.parse_elements(_dataflow_messages(d), "message", "Dataflow")
    return annotation_census(xml.flatten_annotations(elements, "en"))


def _structure_messages(d: Data) -> DataFrame:
    """One data structure per part: a local codelist, one by concept, one without position."""
    concept = '<s:ConceptIdentity><Ref id="C<<p_size>>" maintainableParentID="<<p_brand>>" agencyID="X"/></s:ConceptIdentity>'
    template = HEAD + (
        '<s:DataStructures><s:DataStructure id="DSD_<<p_partkey>>"><s:DataStructureComponents><s:DimensionList>'
        f'<s:Dimension id="SECOND" position="2">{concept}</s:Dimension>'
        '<s:Dimension id="FIRST" position="1"><s:LocalRepresentation><s:Enumeration><Ref id="CL_<<p_type>>"/>'
        "</s:Enumeration></s:LocalRepresentation></s:Dimension>"
        f'<s:Dimension id="LOST">{concept}</s:Dimension>'
        "</s:DimensionList></s:DataStructureComponents></s:DataStructure></s:DataStructures>"
    ) + TAIL
    return d.spread("part").select(_message(template).alias("message"))


@query("flatten_dimensions", """
    SELECT 'DSD_' || p_partkey AS structure_id, 'FIRST' AS dimension_id, 1 AS position, 'CL_' || p_type AS codelist_id
    FROM {part} UNION ALL SELECT 'DSD_' || p_partkey, 'SECOND', 2, NULL FROM {part}
""")
def _(d: Data) -> DataFrame:
    dims = xml.flatten_dimensions(xml.parse_elements(_structure_messages(d), "message", "DataStructure"))
    return dims.select("structure_id", "dimension_id", "position", "codelist_id")


@query("resolve_concept_codelists", """
    SELECT 'DSD_' || p_partkey AS structure_id, 'FIRST' AS dimension_id, 'CL_' || p_type AS codelist_id FROM {part}
    UNION ALL SELECT 'DSD_' || p_partkey, 'SECOND', CASE WHEN p_size > 10 THEN 'CL_' || p_brand || '_' || p_size END
    FROM {part}
""")
def _(d: Data) -> DataFrame:
    template = HEAD + (
        '<s:Concepts><s:ConceptScheme id="<<p_brand>>"><s:Concept id="C<<p_size>>"><<inner>></s:Concept>'
        "</s:ConceptScheme></s:Concepts>"
    ) + TAIL
    inner = F.when(
        F.col("p_size") > 10,
        _message('<s:CoreRepresentation><s:Enumeration><Ref id="CL_<<p_brand>>_<<p_size>>"/></s:Enumeration>'
                 "</s:CoreRepresentation>"),
    )
    messages = d.spread("part").select(_message(template, inner=inner).alias("message"))
    concepts = xml.flatten_concepts(xml.parse_elements(messages, "message", "ConceptScheme"))
    dims = xml.flatten_dimensions(xml.parse_elements(_structure_messages(d), "message", "DataStructure"))
    return xml.resolve_concept_codelists(dims, concepts).select("structure_id", "dimension_id", "codelist_id")


@query("flatten_codelist", """
    SELECT 'CL_' || c_nationkey AS codelist_id, 'it' AS lang, 'C' || c_custkey AS id, c_name AS name,
           CASE WHEN c_acctbal > 0 THEN 'N' || c_nationkey END AS parent,
           CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END AS "order", 0 AS seq FROM {customer}
""")
def _(d: Data) -> DataFrame:
    template = HEAD + (
        '<s:Codelists><s:Codelist id="CL_<<c_nationkey>>"><s:Code id="C<<c_custkey>>">'
        '<c:Annotations><c:Annotation id="OTHER"><c:AnnotationText>5</c:AnnotationText></c:Annotation>'
        '<c:Annotation id="ORDER"><c:AnnotationText xml:lang="it"> <<order>> </c:AnnotationText></c:Annotation>'
        '</c:Annotations><c:Name xml:lang="it"><<c_name>></c:Name><<parent>></s:Code></s:Codelist></s:Codelists>'
    ) + TAIL
    order = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey").cast("string")).otherwise(F.lit("9.5x"))
    parent = F.when(F.col("c_acctbal") > 0, _message('<s:Parent><Ref id="N<<c_nationkey>>"/></s:Parent>'))
    messages = d.spread("customer").select(_message(template, order=order, parent=parent).alias("message"))
    return xml.flatten_codelist(xml.parse_elements(messages, "message", "Codelist"), "it")


def _constraint_messages(d: Data) -> DataFrame:
    """One constraint per line item, attached to the dataflow of its part."""
    template = HEAD + (
        '<s:Constraints><s:ContentConstraint id="CC"><s:ConstraintAttachment><s:Dataflow>'
        '<Ref id="P<<l_partkey>>_DF_<<l_suppkey>>"/></s:Dataflow></s:ConstraintAttachment><s:CubeRegion>'
        '<c:KeyValue id="FLAG"><c:Value><<l_returnflag>></c:Value><c:Value> </c:Value></c:KeyValue>'
        '<c:KeyValue id="STATUS"><c:Value>X</c:Value></c:KeyValue>'
        '<c:KeyValue id="STATUS"><c:Value><<l_linestatus>></c:Value><c:Value>T</c:Value></c:KeyValue>'
        '<c:KeyValue id="EMPTY"><c:Value/></c:KeyValue></s:CubeRegion></s:ContentConstraint></s:Constraints>'
    ) + TAIL
    return d.spread("lineitem").select("l_orderkey", "l_linenumber", _message(template).alias("message"))


@query("flatten_constraints", """
    SELECT DISTINCT l_orderkey, l_linenumber, 'FLAG' AS dimension_id, l_returnflag AS code_id FROM {lineitem}
    UNION SELECT l_orderkey, l_linenumber, 'STATUS', l_linestatus FROM {lineitem}
    UNION SELECT l_orderkey, l_linenumber, 'STATUS', 'T' FROM {lineitem}
""")
def _(d: Data) -> DataFrame:
    keep = ["l_orderkey", "l_linenumber"]
    elements = xml.parse_elements(_constraint_messages(d), "message", "ContentConstraint", keep)
    return xml.flatten_constraints(elements)


@query("flatten_bulk_constraints", """
    SELECT DISTINCT 'P' || l_partkey AS df_id, 'FLAG' AS dimension_id, l_returnflag AS code_id FROM {lineitem}
    UNION SELECT 'P' || l_partkey, 'STATUS', l_linestatus FROM {lineitem}
    UNION SELECT 'P' || l_partkey, 'STATUS', unnest(['T', 'X']) FROM {lineitem}
""")
def _(d: Data) -> DataFrame:
    elements = xml.parse_elements(_constraint_messages(d), "message", "ContentConstraint")
    return xml.flatten_bulk_constraints(elements)


@query("bulk_long_ids", "SELECT DISTINCT 'P' || l_partkey || '_DF_' || l_suppkey AS long_id FROM {lineitem}")
def _(d: Data) -> DataFrame:
    return xml.bulk_long_ids(xml.parse_elements(_constraint_messages(d), "message", "ContentConstraint"))


@query("flatten_series_keys", """
    SELECT DISTINCT 'FLAG' AS dimension_id, l_returnflag AS code_id FROM {lineitem}
    UNION SELECT 'SUPP', l_suppkey::VARCHAR FROM {lineitem}
""")
def _(d: Data) -> DataFrame:
    template = (
        '<g:GenericData xmlns:g="http://example.org/g"><g:DataSet><g:Series><g:SeriesKey>'
        '<g:Value id="FLAG" value="<<l_returnflag>>"/><g:Value id="SUPP" value="<<l_suppkey>>"/>'
        '<g:Value id="NONE" value=""/></g:SeriesKey></g:Series></g:DataSet></g:GenericData>'
    )
    messages = d.spread("lineitem").select(_message(template).alias("message"))
    return xml.flatten_series_keys(xml.parse_elements(messages, "message", "Series"))


@query("flatten_category_scheme", """
    SELECT 'S' || s_suppkey AS scheme_id, s_name AS scheme_name, unnest(['A', 'B', 'C', 'D']) AS cat_id,
           unnest(['A', 'A.B', 'A.B.C', 'D']) AS cat_path,
           unnest(['top ' || s_name, '', 'nation ' || s_nationkey, 'Only']) AS cat_name,
           unnest(['', 'middle', '', '']) AS cat_description, unnest(['', 'A', 'A.B', '']) AS parent_path,
           unnest([1, 2, 3, 1]) AS depth
    FROM {supplier}
""")
def _(d: Data) -> DataFrame:
    template = HEAD + (
        '<s:CategorySchemes><s:CategoryScheme id="S<<s_suppkey>>"><c:Name xml:lang="en"><<s_name>></c:Name>'
        '<s:Category id="A"><c:Name xml:lang="en">top <<s_name>></c:Name>'
        '<s:Category id="B"><c:Description>middle</c:Description>'
        '<s:Category id="C"><c:Name xml:lang="en">nation <<s_nationkey>></c:Name></s:Category></s:Category></s:Category>'
        '<s:Category id="D"><c:Name xml:lang="it">Only</c:Name></s:Category>'
        '<s:Category><s:Category id="HIDDEN"/></s:Category></s:CategoryScheme></s:CategorySchemes>'
    ) + TAIL
    messages = d.spread("supplier").select(_message(template).alias("message"))
    return xml.flatten_category_scheme(xml.parse_elements(messages, "message", "CategoryScheme"), "en")


def _deep_paths(levels: int) -> str:
    names = [f"'L{i}'" for i in range(levels)]
    paths = ", ".join("'" + ".".join(f"L{i}" for i in range(n + 1)) + "'" for n in range(levels))
    return f"unnest([{', '.join(names)}]) AS cat_id, unnest([{paths}]) AS cat_path, unnest(range(1, {levels + 1}))::INT AS depth"


def _deep_scheme_sql(levels: int) -> str:
    return f"SELECT 'S' || s_suppkey AS scheme_id, {_deep_paths(levels)}, 'end ' || s_name AS last_name FROM {{supplier}}"


def _deep_scheme(d: Data, levels: int) -> DataFrame:
    inner = "".join(f'<s:Category id="L{i}">' for i in range(levels)) + '<c:Name xml:lang="en">end <<s_name>></c:Name>'
    template = HEAD + (
        '<s:CategorySchemes><s:CategoryScheme id="S<<s_suppkey>>"><c:Name xml:lang="en">end <<s_name>></c:Name>'
        f'{inner}{"</s:Category>" * levels}</s:CategoryScheme></s:CategorySchemes>'
    ) + TAIL
    messages = d.spread("supplier").select(_message(template).alias("message"))
    rows = xml.flatten_category_scheme(xml.parse_elements(messages, "message", "CategoryScheme"), "en")
    return rows.select("scheme_id", "cat_id", "cat_path", "depth", F.col("scheme_name").alias("last_name"))


@query("flatten_category_scheme_12_levels", _deep_scheme_sql(12))
def _(d: Data) -> DataFrame:
    return _deep_scheme(d, 12)


@query("flatten_category_scheme_40_levels", _deep_scheme_sql(40))
def _(d: Data) -> DataFrame:
    return _deep_scheme(d, 40)


@query("flatten_categorisation", """
    SELECT 'X,DF_' || p_partkey AS df_id, p_brand AS scheme_id, p_type || '.' || p_size AS cat_path FROM {part}
    WHERE p_type <> 'SMALL' AND p_size <> 5
""")
def _(d: Data) -> DataFrame:
    template = HEAD + (
        '<s:Categorisations><s:Categorisation><s:Source><Ref id="DF_<<p_partkey>>" agencyID="X" class="<<kind>>"/>'
        '</s:Source><s:Target><Ref id="<<p_type>>.<<p_size>>" maintainableParentID="<<scheme>>"/></s:Target>'
        "</s:Categorisation></s:Categorisations>"
    ) + TAIL
    kind = F.when(F.col("p_type") == "SMALL", "Codelist").otherwise("Dataflow")
    scheme = F.when(F.col("p_size") != 5, F.col("p_brand"))
    messages = d.spread("part").select(_message(template, kind=kind, scheme=scheme).alias("message"))
    return xml.flatten_categorisation(xml.parse_elements(messages, "message", "Categorisation"), prefix_agency=True)


# --- JSON --------------------------------------------------------------------


@query("flatten_sdmx_json", """
    SELECT l_returnflag AS FLAG, l_linestatus AS STATUS, unnest(['2020', '2021']) AS TIME_PERIOD,
           unnest([l_quantity, NULL]) AS OBS_VALUE FROM {lineitem}
""")
def _(d: Data) -> DataFrame:
    # FLAG has position 0 and STATUS 1, so a key reads STATUS:FLAG.
    template = (
        '{"structure":{"dimensions":{"series":['
        '{"id":"FLAG","keyPosition":0,"values":[{"id":"A"},{"id":"N"},{"id":"R"}]},'
        '{"id":"STATUS","keyPosition":1,"values":[{"id":"F"},{"id":"O"}]}],'
        '"observation":[{"id":"TIME_PERIOD","values":[{"id":"2020"},{"id":"2021"}]}]}},'
        '"dataSets":[{"series":{"<<status>>:<<flag>>":{"observations":{"0":[<<l_quantity>>],"1":[,"x"]}}}}]}'
    )

    def index(codes: str, column: str) -> Column:
        return (F.instr(F.lit(codes), F.col(column)) - 1).cast("string")

    message = _message(template, status=index("FO", "l_linestatus"), flag=index("ANR", "l_returnflag"))
    messages = d.spread("lineitem").select(message.alias("message"))
    return js.flatten_sdmx_json(messages, "message", ["FLAG", "STATUS", "TIME_PERIOD"])


def _hub_messages(d: Data) -> DataFrame:
    """One hub catalog per supplier: a dataset on the top category and one further down."""
    template = (
        '{"categoryGroups":[{"categories":[{"id":"T<<s_suppkey>>","label":"Top <<s_name>>",'
        '"datasetIdentifiers":["X,D<<s_suppkey>>,2.0","X,SHARED,1.1"],"childrenCategories":['
        '{"id":"L1","label":"Level","childrenCategories":[{"id":"L2","label":"Leaf <<s_nationkey>>",'
        '"datasetIdentifiers":["X,E<<s_suppkey>>"],"childrenCategories":[]}]}]}]}],'
        '"datasetMap":{"X,D<<s_suppkey>>,2.0":{"title":"Title <<s_name>>"},"X,SHARED,1.1":{"title":""}}}'
    )
    return d.spread("supplier").select("s_suppkey", _message(template).alias("message"))


@query("flatten_hub_catalog", """
    SELECT 'D' || s_suppkey AS df_id, '2.0' AS version, 'Title ' || s_name AS df_description,
           NULL::VARCHAR AS df_structure_id, true AS has_constraint, s_suppkey FROM {supplier}
    UNION ALL SELECT 'E' || s_suppkey, '1.0', 'Leaf ' || s_nationkey, NULL, true, s_suppkey FROM {supplier}
    UNION ALL (SELECT 'SHARED', '1.1', 'Top ' || s_name, NULL, true, s_suppkey FROM {supplier} ORDER BY s_suppkey LIMIT 1)
""")
def _(d: Data) -> DataFrame:
    return js.flatten_hub_catalog(_hub_messages(d), "message", "s_suppkey")


@query("flatten_hub_tree", """
    SELECT s_suppkey, unnest(['D' || s_suppkey, 'SHARED', 'E' || s_suppkey]) AS df_id, 'T' || s_suppkey AS scheme_id,
           unnest(['T' || s_suppkey, 'T' || s_suppkey, 'L1.L2']) AS cat_path FROM {supplier}
""")
def _(d: Data) -> DataFrame:
    return js.flatten_hub_tree(_hub_messages(d), "message", ["s_suppkey"])


@query("flatten_hub_categories", """
    SELECT 'T' || s_suppkey AS scheme_id, 'Top ' || s_name AS scheme_name, unnest(['T' || s_suppkey, 'L1', 'L2']) AS cat_id,
           unnest(['T' || s_suppkey, 'L1', 'L1.L2']) AS cat_path,
           unnest(['Top ' || s_name, 'Level', 'Leaf ' || s_nationkey]) AS cat_name, unnest(['', '', 'L1']) AS parent_path,
           unnest([1, 1, 2]) AS depth, NULL::VARCHAR AS cat_description FROM {supplier}
""")
def _(d: Data) -> DataFrame:
    return js.flatten_hub_categories(_hub_messages(d), "message")


def _deep_hub(d: Data, levels: int) -> DataFrame:
    opened = "".join(f'{{"id":"L{i}","label":"n{i}","childrenCategories":[' for i in range(levels - 1))
    leaf = f'{{"id":"L{levels - 1}","label":"leaf","datasetIdentifiers":["X,D<<s_suppkey>>,1.0"]}}'
    template = (
        '{"categoryGroups":[{"categories":[{"id":"T<<s_suppkey>>","label":"Top","childrenCategories":['
        f'{opened}{leaf}{"]}" * (levels - 1)}]}}]}}],"datasetMap":{{}}}}'
    )
    return d.spread("supplier").select("s_suppkey", _message(template).alias("message"))


def _deep_hub_sql(levels: int) -> str:
    path = ".".join(f"L{i}" for i in range(levels))
    return f"SELECT s_suppkey, 'D' || s_suppkey AS df_id, 'T' || s_suppkey AS scheme_id, '{path}' AS cat_path FROM {{supplier}}"


@query("flatten_hub_tree_12_levels", _deep_hub_sql(12))
def _(d: Data) -> DataFrame:
    return js.flatten_hub_tree(_deep_hub(d, 12), "message", ["s_suppkey"])


@query("flatten_hub_tree_40_levels", _deep_hub_sql(40))
def _(d: Data) -> DataFrame:
    return js.flatten_hub_tree(_deep_hub(d, 40), "message", ["s_suppkey"])


@query("flatten_hub_catalog_wide", """
    SELECT 'D' || s_suppkey AS df_id, '1.' || (s_suppkey % 9) AS version,
           CASE WHEN s_suppkey % 5 = 0 THEN 'Nation ' || s_nationkey ELSE 'late ' || s_name END AS df_description,
           s_nationkey FROM {supplier}
""")
def _(d: Data) -> DataFrame:
    # One catalog per nation; every dataset has two titles, of which the last counts, or none.
    key = F.concat(F.lit("X,D"), F.col("s_suppkey").cast("string"), F.lit(",1."), (F.col("s_suppkey") % 9).cast("string"))
    other = F.concat(F.lit("Y,D"), F.col("s_suppkey").cast("string"), F.lit(",0"))
    title = F.struct(F.concat(F.lit("late "), "s_name").alias("title"))
    pairs = F.when(F.col("s_suppkey") % 5 != 0, F.array(F.struct(key, F.struct(F.lit("early").alias("title"))), F.struct(other, title)))
    per_nation = d.supplier.groupBy("s_nationkey").agg(
        F.collect_list(key).alias("_ids"), F.map_from_entries(F.flatten(F.collect_list(pairs))).alias("datasetMap"))
    top = F.struct(F.lit("T").alias("id"), F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("label"),
                   F.col("_ids").alias("datasetIdentifiers"))
    groups = F.array(F.struct(F.array(top).alias("categories")))
    messages = per_nation.select("s_nationkey", F.to_json(F.struct(groups.alias("categoryGroups"), "datasetMap")).alias("message"))
    return js.flatten_hub_catalog(messages, "message", "s_nationkey").select("df_id", "version", "df_description", "s_nationkey")


@query("flatten_hub_structure", """
    SELECT p_partkey, 'FREQ' AS dimension_id, 1 AS position, 'CL_FREQ' AS codelist_id, NULL::VARCHAR AS label FROM {part}
    UNION ALL SELECT p_partkey, p_type, 2, 'CL_' || p_type, p_name FROM {part}
""")
def _(d: Data) -> DataFrame:
    template = (
        '{"timeDimension":"TIME_PERIOD","criteria":[{"id":"FREQ","label":"","extra":{"DataStructureRef":"X+CL_FREQ+1.0"}},'
        '{"id":"TIME_PERIOD","label":"Time"},'
        '{"id":"<<p_type>>","label":"<<p_name>>","extra":{"DataStructureRef":"X+CL_<<p_type>>+1.0"}}]}'
    )
    messages = d.spread("part").select("p_partkey", _message(template).alias("message"))
    return js.flatten_hub_structure(messages, "message", ["p_partkey"])


@query("flatten_hub_values", """
    SELECT o_orderkey, 'STATUS' AS dimension_id, unnest([o_orderstatus, o_orderpriority]) AS code_id FROM {orders}
""")
def _(d: Data) -> DataFrame:
    template = (
        '{"criteria":[{"id":"STATUS","values":[{"id":"<<o_orderstatus>>"},{"id":""},{"id":"<<o_orderpriority>>"}]},'
        '{"id":"time_period","values":[{"id":"2020"}]},{"id":"NONE","values":[]}]}'
    )
    messages = d.spread("orders").select("o_orderkey", _message(template).alias("message"))
    return js.flatten_hub_values(messages, "message", ["o_orderkey"])


@query("flatten_metadata_report", """
    SELECT doc_id, CASE WHEN lang = 'de' THEN 'plain ' || source ELSE text END AS prose,
           'x?id=' || n_chars AS link, NULL::VARCHAR AS missing FROM {documents}
""")
def _(d: Data) -> DataFrame:
    quoted = F.to_json(F.struct(F.col("text").alias("en"), F.lit("altro").alias("fr")))
    template = (
        '{"data":{"metadataSets":[{"reports":[{"attributeSet":{"reportedAttributes":[{"id":"OTHER","attributeSet":'
        '{"reportedAttributes":[{"id":"PROSE","text":"<<plain>>","texts":<<texts>>},{"id":"PROSE","text":"second"}]}},'
        '{"id":"LINK","text":"x?id=<<n_chars>>"}]}}]}]}}'
    )
    plain = F.when(F.col("lang") == "de", F.concat(F.lit("plain "), "source"))
    messages = d.documents.select("doc_id", _message(template, plain=plain, texts=quoted).alias("message"))
    wanted = {"prose": "PROSE", "link": "LINK", "missing": "NOWHERE"}
    return js.flatten_metadata_report(messages, "message", wanted, "it", ["doc_id"])


def _deep_report(d: Data, levels: int) -> DataFrame:
    opened = '{"id":"MID","attributeSet":{"reportedAttributes":[' * levels
    template = (
        '{"data":{"metadataSets":[{"reports":[{"attributeSet":{"reportedAttributes":['
        f'{opened}{{"id":"PROSE","texts":<<texts>>}}{"]}}" * levels}]}}}}]}}]}}}}'
    )
    quoted = F.to_json(F.struct(F.col("text").alias("en")))
    messages = d.documents.select("doc_id", _message(template, texts=quoted).alias("message"))
    return js.flatten_metadata_report(messages, "message", {"prose": "PROSE", "middle": "MID"}, "it", ["doc_id"])


@query("flatten_metadata_report_12_levels", "SELECT doc_id, nullif(text, '') AS prose, NULL::VARCHAR AS middle FROM {documents}")
def _(d: Data) -> DataFrame:
    return _deep_report(d, 12)


@query("flatten_metadata_report_40_levels", "SELECT doc_id, nullif(text, '') AS prose, NULL::VARCHAR AS middle FROM {documents}")
def _(d: Data) -> DataFrame:
    return _deep_report(d, 40)


# --- calendar ----------------------------------------------------------------


def _calendars(d: Data) -> DataFrame:
    template = (
        "BEGIN:VCALENDAR\nBEGIN:VEVENT\nUID:<<uid>>\nSUMMARY;LANGUAGE=en:<<summary>> \nDTSTART;VALUE=DATE:<<day>>\n"
        "X-THEME:<<theme>>\nX-CATEGORY:<<category>>\\, Euro\nEND:VEVENT\nBEGIN:VEVENT\nUID:x<<uid>>\n"
        "X-CATEGORY:Other\nEND:VEVENT\nEND:VCALENDAR\n"
    )
    day = F.replace(F.col("date"), F.lit("-"), F.lit(""))
    return d.releases.select(_message(template, day=day).alias("text"))


@query("flatten_calendar", """
    SELECT uid, summary, date, theme, category || '|Euro' AS categories FROM {releases}
    UNION ALL SELECT 'x' || uid, '', '', '', 'Other' FROM {releases}
""")
def _(d: Data) -> DataFrame:
    return flatten_calendar(_calendars(d), "text").withColumn("categories", F.array_join("categories", "|"))


@query("release_feed", """
    SELECT uid, summary, date, theme FROM {releases}
    WHERE category = 'Data release' AND date <= '1999-06-30' AND theme = 'science' ORDER BY date DESC, uid LIMIT 10
""")
def _(d: Data) -> DataFrame:
    feed = release_feed(flatten_calendar(_calendars(d), "text"), "1999-06-30", "science")
    return feed.select("uid", "summary", "date", "theme")
