"""Structure messages in XML as tables.

Two ways in, one shape: ``read_elements`` streams XML files element by element, so no
message is ever one value in memory (a file is one task: land large catalogs as
several files); ``parse_elements`` takes messages in a text column.  Both give a column
``element`` that the ``flatten_*`` operators take.  Namespace prefixes are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from statcube.sources import markup
from statcube.sources.nested import unfold

_S = T.StringType()
_TEXTS = T.ArrayType(T.StructType([T.StructField("_lang", _S), T.StructField("_VALUE", _S)]))


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _many(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(_struct(**fields))


_ID_REF = _struct(Ref=_struct(_id=_S))
_ANNOTATIONS = _struct(
    Annotation=_many(
        _id=_S, AnnotationType=_S, AnnotationTitle=_S, AnnotationURL=_S, AnnotationText=_TEXTS
    )
)
_KEY_VALUES = _many(_id=_S, Value=T.ArrayType(_S))


# Element: its type, and where it sits below the root of a message.
ELEMENTS: dict[str, tuple[T.StructType, str]] = {
    "Dataflow": (
        _struct(_id=_S, _agencyID=_S, _version=_S, Name=_TEXTS, Structure=_ID_REF, Annotations=_ANNOTATIONS),
        "Dataflows",
    ),
    "DataStructure": (
        _struct(
            _id=_S,
            DataStructureComponents=_struct(
                DimensionList=_struct(
                    Dimension=_many(
                        _id=_S, _position=_S,
                        ConceptIdentity=_struct(Ref=_struct(_id=_S, _maintainableParentID=_S, _agencyID=_S)),
                        LocalRepresentation=_struct(Enumeration=_ID_REF),
                    )
                )
            ),
        ),
        "DataStructures",
    ),
    "ConceptScheme": (
        _struct(
            _id=_S, _agencyID=_S,
            Concept=_many(_id=_S, CoreRepresentation=_struct(Enumeration=_ID_REF)),
        ),
        "Concepts",
    ),
    "Codelist": (
        _struct(
            _id=_S, Name=_TEXTS,
            Code=_many(_id=_S, Name=_TEXTS, Parent=_ID_REF, Annotations=_ANNOTATIONS),
        ),
        "Codelists",
    ),
    "ContentConstraint": (
        _struct(
            _id=_S, ConstraintAttachment=_struct(Dataflow=_ID_REF),
            CubeRegion=_many(KeyValue=_KEY_VALUES),
        ),
        "Constraints",
    ),
    "Series": (_struct(SeriesKey=_struct(Value=_many(_id=_S, _value=_S))), "DataSet"),
    "Categorisation": (
        _struct(
            Source=_struct(Ref=_struct(_id=_S, _agencyID=_S, **{"_class": _S})),
            Target=_struct(Ref=_struct(_id=_S, _maintainableParentID=_S)),
        ),
        "Categorisations",
    ),
}
_OPTIONS = {"ignoreNamespace": "true", "mode": "FAILFAST"}


# Elements that nest without limit stay texts: no reader schema knows their depth.
TREES = ("CategoryScheme",)


def _whole(tag: str) -> str:
    """Pattern of a whole element, whatever its prefix; such elements do not hold each other."""
    name = rf"(?:[\w.-]+:)?{tag}"
    return rf"(?s)<{name}(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?</{name}\s*>)"


def read_elements(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Elements of XML files, wherever they sit in the message."""
    if tag in TREES:
        # The files are cut behind each end tag, so no file is one value.
        lines = spark.read.option("lineSep", f"{tag}>").text(path).select(F.concat("value", F.lit(f"{tag}>")).alias("_m"))
        return _texts_of(lines, "_m", tag, [])
    kind, _ = ELEMENTS[tag]
    rows = spark.read.format("xml").options(rowTag=tag, **_OPTIONS).schema(kind).load(path)
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("element"))


def parse_elements(df: DataFrame, column: str, tag: str, keep: Sequence[str] = ()) -> DataFrame:
    """Elements of messages held in a text column, with the columns to keep."""
    if tag in TREES:
        return _texts_of(df, column, tag, keep)
    kind, parent = ELEMENTS[tag]
    group = T.StructType([T.StructField(tag, T.ArrayType(kind))])
    root = T.StructType(
        [T.StructField(parent, group), T.StructField("Structures", T.StructType([T.StructField(parent, group)]))]
    )

    if markup.fits(kind):
        df = _read_batches(df, column, kind, [("Structures", parent, tag), (parent, tag)], keep)
    else:
        df = df.select(*keep, F.col(column).alias("_rest"), F.lit(None).cast(T.ArrayType(kind)).alias("_elements"))
    parsed = df.select(*keep, "_elements", F.from_xml("_rest", _ddl(root), _OPTIONS).alias("_m"))
    inner, outer = F.col(f"_m.Structures.{parent}.{tag}"), F.col(f"_m.{parent}.{tag}")
    return parsed.select(*keep, F.explode(F.coalesce("_elements", inner, outer)).alias("element"))


def _read_batches(
    df: DataFrame, column: str, kind: T.StructType, paths: Sequence[Sequence[str]], keep: Sequence[str]
) -> DataFrame:
    """Elements per message, read by Arrow batches, or the message where it is left to ``from_xml``."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("_elements", T.ArrayType(kind)), T.StructField("_rest", _S)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elements, rest = markup.read(batch.column(len(keep)), kind, paths)
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, elements, rest], names=schema.names)

    return df.select(*keep, F.col(column).alias("_message")).mapInArrow(run, schema)


def _texts_of(df: DataFrame, column: str, tag: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.explode(F.regexp_extract_all(column, F.lit(_whole(tag)), F.lit(0))).alias("element"))


def _ddl(kind: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)


# --- texts in several languages ---------------------------------------------


def _in_language(texts: Column, lang: str) -> Column:
    """Text of the language, or the first listed one when the language is missing."""
    same = F.filter(texts, lambda t: t["_lang"] == lang)
    chosen = F.when(F.size(same) > 0, F.get(same, F.lit(0))).otherwise(F.get(texts, F.lit(0)))
    return F.nullif(F.trim(chosen["_VALUE"]), F.lit(""))


def name_of(texts: Column, lang: str) -> Column:
    """Name in the wanted language, else the first; English when that text is empty."""
    return F.coalesce(_in_language(texts, lang), _in_language(texts, "en"))


def _kept(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "element"]


# --- catalog and structures --------------------------------------------------


def flatten_dataflows(elements: DataFrame, lang: str, prefix_agency: bool = False) -> DataFrame:
    """Catalog rows; ids carry their agency when the catalog spans agencies."""
    e = F.col("element")
    plain = F.coalesce(e["_id"], F.lit(""))
    full = F.when(F.coalesce(e["_agencyID"], F.lit("")) != "", F.concat_ws(",", e["_agencyID"], plain))
    return elements.select(
        *_kept(elements), (F.coalesce(full, plain) if prefix_agency else plain).alias("df_id"),
        e["_version"].alias("version"), name_of(e["Name"], lang).alias("df_description"),
        e["Structure"]["Ref"]["_id"].alias("df_structure_id"),
    )


def flatten_dimensions(elements: DataFrame) -> DataFrame:
    """Dimensions of data structures; those without a position are dropped."""
    e = F.col("element")
    dims = elements.select(
        *_kept(elements), e["_id"].alias("structure_id"),
        F.explode(e["DataStructureComponents"]["DimensionList"]["Dimension"]).alias("d"),
    )
    concept = F.col("d")["ConceptIdentity"]["Ref"]
    return dims.select(
        *_kept(elements), "structure_id", F.col("d._id").alias("dimension_id"),
        F.col("d._position").try_cast("int").alias("position"),
        F.col("d")["LocalRepresentation"]["Enumeration"]["Ref"]["_id"].alias("codelist_id"),
        concept["_maintainableParentID"].alias("concept_scheme_id"), concept["_id"].alias("concept_id"),
    ).where("dimension_id <> '' AND position IS NOT NULL")


def flatten_concepts(elements: DataFrame) -> DataFrame:
    """Concepts that name a codelist of their own."""
    e = F.col("element")
    return elements.select(
        *_kept(elements), e["_id"].alias("concept_scheme_id"), F.explode(e["Concept"]).alias("c")
    ).select(
        *_kept(elements), "concept_scheme_id", F.col("c._id").alias("concept_id"),
        F.col("c")["CoreRepresentation"]["Enumeration"]["Ref"]["_id"].alias("concept_codelist_id"),
    ).where("concept_codelist_id IS NOT NULL")


def resolve_concept_codelists(dims: DataFrame, concepts: DataFrame) -> DataFrame:
    """A dimension without a codelist takes the one of its concept."""
    key = ["concept_scheme_id", "concept_id"]
    known = concepts.groupBy(*key).agg(F.min("concept_codelist_id").alias("_codelist"))
    return dims.join(known, key, "left").select(
        *[F.coalesce("codelist_id", "_codelist").alias(c) if c == "codelist_id" else F.col(c) for c in dims.columns]
    )


def _integer(text: Column) -> Column:
    digits = F.trim(text)
    return F.when(digits.rlike("^[+-]?[0-9]+$"), digits.try_cast("bigint"))


def flatten_codelist(elements: DataFrame, lang: str) -> DataFrame:
    """Codes with name, parent and the integer ``ORDER`` annotation."""
    e = F.col("element")
    codes = elements.select(
        *_kept(elements), e["_id"].alias("codelist_id"), F.posexplode(e["Code"]).alias("seq", "c")
    )
    order = F.filter(F.col("c")["Annotations"]["Annotation"], lambda a: a["_id"] == "ORDER")
    texts = F.flatten(F.transform(order, lambda a: F.filter(a["AnnotationText"], lambda t: t["_VALUE"] != "")))
    return codes.select(
        *_kept(elements), "codelist_id", F.lit(lang).alias("lang"), F.col("c._id").alias("id"),
        _in_language(F.col("c.Name"), lang).alias("name"),
        F.nullif(F.col("c")["Parent"]["Ref"]["_id"], F.lit("")).alias("parent"),
        _integer(F.get(texts, F.lit(0))["_VALUE"]).alias("order"), "seq",
    )


# --- availability ------------------------------------------------------------


def _key_values(e: Column) -> Column:
    return F.flatten(F.array_compact(e["CubeRegion"]["KeyValue"]))


def _exploded_codes(rows: DataFrame, keys: Column, columns: Sequence[str]) -> DataFrame:
    pairs = rows.select(*columns, F.explode(keys).alias("_k")).where("_k._id <> ''")
    codes = pairs.select(*columns, F.col("_k._id").alias("dimension_id"), F.explode("_k.Value").alias("_v"))
    return codes.select(*columns, "dimension_id", F.trim("_v").alias("code_id")).where("code_id <> ''")


def flatten_constraints(elements: DataFrame) -> DataFrame:
    """(dimension, code) of a constraint; blanks dropped, a repeated dimension's last list counts."""
    filled = F.filter(_key_values(F.col("element")), lambda k: F.trim(F.array_join(k["Value"], "")) != "")
    rows = elements.select(*_kept(elements), filled.alias("_keys"))
    ids = rows.select(*_kept(elements), "_keys", F.reverse("_keys._id").alias("_ids"))
    last = F.filter("_keys", lambda k, i: F.array_position("_ids", k["_id"]) + i == F.size("_ids"))
    return _exploded_codes(ids, last, _kept(elements)).distinct()


def flatten_series_keys(elements: DataFrame) -> DataFrame:
    """Distinct codes per dimension of series keys."""
    pairs = elements.select(*_kept(elements), F.explode(F.col("element")["SeriesKey"]["Value"]).alias("v"))
    return pairs.select(
        *_kept(elements), F.col("v._id").alias("dimension_id"), F.col("v._value").alias("code_id")
    ).where("dimension_id <> '' AND code_id <> ''").distinct()


def _attached(elements: DataFrame) -> DataFrame:
    long_id = F.col("element")["ConstraintAttachment"]["Dataflow"]["Ref"]["_id"]
    return elements.withColumn("long_id", long_id).where("long_id <> ''")


def bulk_long_ids(elements: DataFrame) -> DataFrame:
    """Untruncated dataflow ids that have a constraint."""
    return _attached(elements).select("long_id").distinct()


def flatten_bulk_constraints(elements: DataFrame) -> DataFrame:
    """(df_id, dimension, code) of many constraints, those of one dataflow united.

    The dataflow id is the text before ``_DF_``.
    """
    rows = _attached(elements).withColumn("df_id", F.substring_index("long_id", "_DF_", 1)).where("df_id <> ''")
    return merge_constraint_sets(_exploded_codes(rows, _key_values(F.col("element")), ["df_id"]))


def merge_constraint_sets(codes: DataFrame) -> DataFrame:
    """Union of the code sets of several constraints of one dataflow."""
    return codes.select("df_id", "dimension_id", "code_id").distinct()


# --- categories --------------------------------------------------------------


_CATEGORY = (
    "scheme_id string, scheme_name string, cat_id string, cat_path string, cat_name string, cat_description string, "
    "parent_path string, depth int"
)


@dataclass
class _Open:
    """An open element; schemes and categories that count have an id."""

    tag: str
    id: str | None = None
    path: str = ""
    parent: str = ""
    depth: int = 0
    lang: str | None = None
    texts: dict[str, list[tuple[str | None, str]]] = field(default_factory=dict)


class _SchemeReader:
    """Categories of the scheme in a text, from its tags: a stack holds the open elements.

    A category without an id is skipped with everything below it, and so is a scheme without one.
    """

    def __init__(self, lang: str):
        self.lang = lang
        self.stack: list[_Open] = [_Open("")]
        self.found: list[tuple[_Open, _Open]] = []
        self.data: list[str] = []

    def start(self, name: str, attributes: dict[str, str]) -> None:
        tag, above = name.rpartition(":")[2], self.stack[-1]
        plain = {key.rpartition(":")[2]: value for key, value in attributes.items()}
        new = _Open(tag, lang=plain.get("lang"))
        if tag == "CategoryScheme":
            new.id = plain.get("id")
        elif tag == "Category" and above.tag in ("Category", "CategoryScheme") and above.id and plain.get("id"):
            new.id, new.parent, new.depth = plain["id"], above.path, above.depth + 1
            new.path = f"{above.path}.{new.id}" if above.path else new.id
            self.found.append((next(o for o in self.stack if o.tag == "CategoryScheme"), new))
        self.stack.append(new)
        self.data = []

    def end(self, name: str) -> None:
        done = self.stack.pop()
        if done.tag in ("Name", "Description"):
            self.stack[-1].texts.setdefault(done.tag, []).append((done.lang, "".join(self.data).strip()))
        self.data = []

    def best(self, texts: list[tuple[str | None, str]]) -> str:
        """Text of the language, or the first listed one when the language is missing."""
        return next((t for lang, t in texts if lang == self.lang), texts[0][1] if texts else "")

    def read(self, element: str) -> Iterator[tuple]:
        parser = expat.ParserCreate("utf-8")
        parser.StartElementHandler, parser.EndElementHandler = self.start, self.end
        parser.CharacterDataHandler = self.data_found
        parser.Parse(element.encode(), True)
        for scheme, c in self.found:
            name, described = (self.best(c.texts.get(t, [])) for t in ("Name", "Description"))
            yield scheme.id, self.best(scheme.texts.get("Name", [])), c.id, c.path, name, described, c.parent, c.depth

    def data_found(self, data: str) -> None:
        self.data.append(data)


def flatten_category_scheme(elements: DataFrame, lang: str) -> DataFrame:
    """Categories with dotted path, parent path and depth (first level is 1), of trees of any depth."""

    def rows_of(element: str | None) -> Iterator[tuple]:
        return _SchemeReader(lang).read(element) if element else iter(())

    return unfold(elements, "element", _kept(elements), rows_of, _CATEGORY)


def flatten_categorisation(elements: DataFrame, prefix_agency: bool = False) -> DataFrame:
    """Links dataflow to category; other sources and incomplete rows are dropped."""
    source, target = F.col("element")["Source"]["Ref"], F.col("element")["Target"]["Ref"]
    agency = F.coalesce(source["_agencyID"], F.lit(""))
    full = F.when((agency != "") & (source["_id"] != ""), F.concat_ws(",", agency, source["_id"]))
    rows = elements.select(
        *_kept(elements), F.coalesce(source["_class"], F.lit("")).alias("_class"),
        (F.coalesce(full, source["_id"]) if prefix_agency else source["_id"]).alias("df_id"),
        target["_maintainableParentID"].alias("scheme_id"), target["_id"].alias("cat_path"),
    )
    complete = "df_id <> '' AND scheme_id <> '' AND cat_path <> ''"
    return rows.where(F.col("_class").isin("", "Dataflow")).where(complete).drop("_class")


# --- annotations -------------------------------------------------------------


def flatten_annotations(elements: DataFrame, lang: str) -> DataFrame:
    """One row per dataflow and annotation type: title, text, URL (each may be null).

    The first annotation of a type counts.  Types are taken literally.
    """
    e = F.col("element")
    typed = F.filter(
        F.transform(
            e["Annotations"]["Annotation"],
            lambda a: F.struct(
                F.trim(a["AnnotationType"]).alias("annotation_type"),
                F.nullif(F.trim(a["AnnotationTitle"]), F.lit("")).alias("title"),
                _any_language(a["AnnotationText"], lang).alias("text"),
                F.nullif(F.trim(a["AnnotationURL"]), F.lit("")).alias("url"),
            ),
        ),
        lambda a: a["annotation_type"] != "",
    )
    rows = elements.select(*_kept(elements), e["_id"].alias("df_id"), typed.alias("_a"))
    first = F.filter(
        F.col("_a"),
        lambda a, i: ~F.exists(
            F.filter(F.col("_a"), lambda _, j: j < i),
            lambda earlier: earlier["annotation_type"] == a["annotation_type"],
        ),
    )
    return rows.select(*_kept(elements), "df_id", F.inline(first))


def _any_language(texts: Column, lang: str) -> Column:
    """Text of the language, else English, else the first; blank texts do not count."""
    filled = F.filter(texts, lambda t: F.trim(t["_VALUE"]) != "")


    def first_in(code: str) -> Column:
        return F.get(F.filter(filled, lambda t: t["_lang"] == code), F.lit(0))

    return F.trim(F.coalesce(first_in(lang), first_in("en"), F.get(filled, F.lit(0)))["_VALUE"])


def annotation_columns(
    annotations: DataFrame, config: Mapping[str, object], keys: Sequence[str] = ("df_id",)
) -> DataFrame:
    """Annotations as catalog columns ``df_<key>``.

    ``config`` says per column which ``type`` it comes from and which ``value`` (text,
    title, url or presence) it takes; a malformed entry gives a null column.
    """
    fields = {"text": F.col("text"), "title": F.col("title"), "url": F.col("url"), "presence": F.lit("true")}
    columns = []
    for key, spec in config.items():
        spec = spec if isinstance(spec, Mapping) else {}
        wanted, value = spec.get("type"), fields.get(spec.get("value", "text"))
        usable = isinstance(wanted, str) and value is not None
        chosen = F.when(F.col("annotation_type") == wanted, value) if usable else F.lit(None).cast("string")
        columns.append(F.max(chosen).alias(f"df_{key}"))
    return annotations.groupBy(*keys).agg(*columns)
