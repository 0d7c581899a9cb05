import json

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statcube.sources import messages_json as js, messages_xml as xml, tabular
from statcube.sources.calendar import flatten_calendar

NS = 'xmlns:m="urn:m" xmlns:s="urn:s" xmlns:c="urn:c"'


def message(spark, body):
    return spark.createDataFrame([(f"<m:Structure {NS}><m:Structures>{body}</m:Structures></m:Structure>",)], "x string")


def test_csv(spark, rows, tmp_path):
    (tmp_path / "o.csv").write_text("FREQ,GEO,TIME_PERIOD,OBS_VALUE\nM,IT,2020-01,7.5\nM,_,2020-04,6.8\nM,FR,2020-05,n/a\n")
    plain = tabular.read_observations(spark, f"{tmp_path}/o.csv")
    assert dict(plain.dtypes) == {"FREQ": "string", "GEO": "string", "TIME_PERIOD": "string", "OBS_VALUE": "double"}
    assert rows(plain, "GEO", "OBS_VALUE") == [("FR", None), ("IT", 7.5), ("_", 6.8)]
    assert rows(tabular.read_suppressed_csv(spark, f"{tmp_path}/o.csv"), "GEO") == [(None,), ("FR",), ("IT",)]
    raw = spark.read.csv(f"{tmp_path}/o.csv", header=True)
    assert tabular.value_failures(raw).first()[0] == 1


@pytest.mark.parametrize("suffix", ["csv", "parquet", "json"])
def test_round_trip(spark, rows, tmp_path, suffix):
    df = spark.createDataFrame([("a,b", 'say "hi"'), ("line\nbreak", None)], "id string, text string")
    path = f"{tmp_path}/out.{suffix}"
    tabular.write_output(df, path)
    back = spark.read.json(path) if suffix == "json" else tabular.read_local(spark, path, multi_line=True)
    assert rows(back, "id", "text") == rows(df)


def test_unknown_suffix(spark, tmp_path):
    with pytest.raises(ValueError):
        tabular.write_output(spark.range(1), f"{tmp_path}/out.xlsx")
    with pytest.raises(ValueError):
        tabular.read_local(spark, f"{tmp_path}/out.xlsx")


def test_archive_partitions_are_replaced_alone(spark, rows, tmp_path):
    schema = "provider string, df_id string, dimension_id string, code_id string"
    path = f"{tmp_path}/archive"
    tabular.write_archive(spark.createDataFrame([("x", "A", "g", "1"), ("y", "B", "g", "2")], schema), path, "provider")
    tabular.write_archive(spark.createDataFrame([("x", "C", "g", "3")], schema), path, "provider")
    assert rows(spark.read.parquet(path), "provider", "df_id") == [("x", "C"), ("y", "B")]


DATAFLOWS = """<s:Dataflows>
 <s:Dataflow id="22_289" agencyID="IT1" version="1.0"><c:Name xml:lang="it">Popolazione</c:Name>
  <c:Name xml:lang="en">Population</c:Name><s:Structure><Ref id="DCIS"/></s:Structure></s:Dataflow>
 <s:Dataflow id="99" version="1.0"><c:Name xml:lang="fr">Premier</c:Name><c:Name xml:lang="en"/></s:Dataflow>
</s:Dataflows>"""


def test_dataflows(spark, rows, tmp_path):
    elements = xml.parse_elements(message(spark, DATAFLOWS), "x", "Dataflow")
    names = "df_id", "df_description", "df_structure_id"
    assert rows(xml.flatten_dataflows(elements, "it"), *names) == [("22_289", "Popolazione", "DCIS"), ("99", "Premier", None)]
    assert rows(xml.flatten_dataflows(elements, "en"), "df_description") == [(None,), ("Population",)]
    assert rows(xml.flatten_dataflows(elements, "it", prefix_agency=True), "df_id") == [("99",), ("IT1,22_289",)]
    (tmp_path / "m.xml").write_text(message(spark, DATAFLOWS).first()[0])
    from_file = xml.read_elements(spark, str(tmp_path / "m.xml"), "Dataflow")
    assert rows(xml.flatten_dataflows(from_file, "it")) == rows(xml.flatten_dataflows(elements, "it"))


def test_codelist(spark, rows):
    body = """<s:Codelists><s:Codelist id="CL_GEO">
      <s:Code id="IT"><c:Annotations><c:Annotation id="ORDER"><c:AnnotationText xml:lang="it">2</c:AnnotationText>
        </c:Annotation></c:Annotations><c:Name xml:lang="it">Italia</c:Name></s:Code>
      <s:Code id="ITC1"><c:Annotations><c:Annotation id="ORDER"><c:AnnotationText>9</c:AnnotationText></c:Annotation>
        </c:Annotations><c:Name xml:lang="it">Piemonte</c:Name><s:Parent><Ref id="IT"/></s:Parent></s:Code>
      <s:Code id="NOORD"><c:Name xml:lang="it">Senza ordine</c:Name><s:Parent><Ref id="ITC1"/></s:Parent></s:Code>
      <s:Code id="BADORD"><c:Annotations><c:Annotation id="ORDER"><c:AnnotationText>x</c:AnnotationText></c:Annotation>
        </c:Annotations><c:Name xml:lang="it">Ordine non numerico</c:Name></s:Code>
    </s:Codelist></s:Codelists>"""
    codes = xml.flatten_codelist(xml.parse_elements(message(spark, body), "x", "Codelist"), "it")
    assert rows(codes, "id", "name", "parent", "order") == [
        ("BADORD", "Ordine non numerico", None, None), ("IT", "Italia", None, 2), ("ITC1", "Piemonte", "IT", 9),
        ("NOORD", "Senza ordine", "ITC1", None)]


def test_constraints(spark, rows):
    one = """<s:ContentConstraint><s:ConstraintAttachment><s:Dataflow><Ref id="{0}"/></s:Dataflow></s:ConstraintAttachment>
      <s:CubeRegion><c:KeyValue id="FREQ"><c:Value>{1}</c:Value><c:Value> </c:Value></c:KeyValue></s:CubeRegion>
      <s:CubeRegion><c:KeyValue id="GEO"><c:Value>IT</c:Value></c:KeyValue><c:KeyValue id="TIME_PERIOD"><c:TimeRange/>
      </c:KeyValue></s:CubeRegion></s:ContentConstraint>"""
    body = "<s:Constraints>" + one.format("22_289_DF_A", "A") + one.format("22_289_DF_B", "M") + one.format("7", "Q") + "</s:Constraints>"
    elements = xml.parse_elements(message(spark, body), "x", "ContentConstraint")
    assert rows(xml.bulk_long_ids(elements)) == [("22_289_DF_A",), ("22_289_DF_B",), ("7",)]
    assert rows(xml.flatten_bulk_constraints(elements)) == [
        ("22_289", "FREQ", "A"), ("22_289", "FREQ", "M"), ("22_289", "GEO", "IT"), ("7", "FREQ", "Q"), ("7", "GEO", "IT")]


def constraint(values, attributes=""):
    return (f"<m:Structure {NS}><m:Structures><s:Constraints><s:ContentConstraint id=\"CC\"{attributes}><s:CubeRegion><c:KeyValue id=\"K\">"
            f"{values}</c:KeyValue></s:CubeRegion></s:ContentConstraint></s:Constraints></m:Structures></m:Structure>")


PLAIN = [
    constraint("<c:Value>a</c:Value><c:Value/><c:Value> b c\n</c:Value><c:Value x='1'>d</c:Value>".replace("'", '"')), constraint(""),
    '<?xml version="1.0"?>\n' + constraint("<Value>dell'anno \"1\" = \"2\"</Value><c:TimeRange><c:Value>t</c:Value></c:TimeRange>"),
    constraint("<c:Value>v</c:Value>", ' x:other="id="'), "<m:Structure/>",
    constraint("").replace("<s:CubeRegion>", '<s:ConstraintAttachment><s:Dataflow><Ref id="1"/></s:Dataflow><s:Dataflow><Ref id="2"/>'
                           '<Ref id=" é "/></s:Dataflow></s:ConstraintAttachment><s:X><s:CubeRegion/></s:X><s:CubeRegion/><s:CubeRegion>'),
]
ODD = [
    constraint("<c:Value>a &amp; b</c:Value>"), constraint("<c:Value><![CDATA[x<y]]></c:Value>"), constraint("<c:Value>a > b</c:Value>"),
    constraint("<!-- <c:Value>no</c:Value> --><c:Value>a<b>c</b></c:Value>"), constraint("<c:Value>x</c:Value>").replace('id="K"', "id = 'K'"),
    constraint("<c:VALUE>x\r\ny</c:VALUE>"), constraint("<c:Value>x</c:Value>") + "<x>", None,
    "<R><Constraints><ContentConstraint x:id='o' id='p'/></Constraints><Structures><Constraints/></Structures></R>",
]


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_batches_of_messages_read_as_from_xml_does(spark, rows, size, monkeypatch):
    """Plain messages are read without ``from_xml``, all others are left to it, and both give the same elements."""
    kind, parent = xml.ELEMENTS["ContentConstraint"]
    paths = [("Structures", parent, "ContentConstraint"), (parent, "ContentConstraint")]
    monkeypatch.setattr(xml.markup, "SLICE", size)
    found, rest = xml.markup.read(pa.array(PLAIN + ODD), kind, paths)
    assert rest.to_pylist() == [None] * len(PLAIN) + ODD
    df = spark.createDataFrame(list(enumerate(PLAIN + ODD)), "k int, x string")
    group = f"{parent} struct<ContentConstraint array<{kind.simpleString()}>>"
    whole = df.select("k", F.from_xml("x", f"{group}, Structures struct<{group}>", {"ignoreNamespace": "true"}).alias("m"))
    inner, outer = (F.col(f"m.{p}{parent}.ContentConstraint") for p in ("Structures.", ""))
    want = whole.select("k", F.explode(F.coalesce(inner, outer)).alias("element"))
    got = xml.parse_elements(df, "x", "ContentConstraint", ["k"])
    assert got.count() == 13 and rows(got) == rows(want)
    assert [e for e in found.to_pylist()[: len(PLAIN)]] == [
        [r["element"].asDict(True) for r in want.where(F.col("k") == k).collect()] for k in range(len(PLAIN))]


def test_broken_constraints_fail(spark):
    for broken in (constraint("<c:Value>x</c:Valu>"), constraint("")[:-1], constraint('<c:Value a="1" a="2"/>'), ""):
        df = spark.createDataFrame([(constraint(""),), (broken,)], "x string")
        with pytest.raises(Exception, match="MALFORMED"):
            xml.parse_elements(df, "x", "ContentConstraint").collect()


def test_last_list_of_a_dimension_counts(spark, rows):
    lists = "<c:KeyValue id='A'><c:Value>1</c:Value></c:KeyValue><c:KeyValue id='A'><c:Value> </c:Value></c:KeyValue>"
    more = "</c:KeyValue></s:CubeRegion><s:CubeRegion/><s:CubeRegion><c:KeyValue id='A'><c:Value>3</c:Value><c:Value>2</c:Value></c:KeyValue>"
    both = f"<c:Value>k</c:Value></c:KeyValue>{lists}<c:KeyValue><c:Value>none</c:Value>"
    df = spark.createDataFrame([(1, constraint(both)), (2, constraint(both + more + "<c:KeyValue id='A'>"))], "k int, x string")
    got = xml.flatten_constraints(xml.parse_elements(df, "x", "ContentConstraint", ["k"]))
    assert rows(got) == [(1, "A", "1"), (1, "K", "k"), (2, "A", "2"), (2, "A", "3"), (2, "K", "k")]


def nested_categories(levels):
    text = ""
    for i in reversed(range(levels)):
        text = f'<s:Category id="L{i}"><c:Name xml:lang="en">n{i}</c:Name>{text}</s:Category>'
    return f'<s:CategorySchemes><s:CategoryScheme id="S">{text}</s:CategoryScheme></s:CategorySchemes>'


@pytest.mark.parametrize("levels", [1, 12, 40, 900])
def test_category_trees_of_any_depth(spark, levels):
    elements = xml.parse_elements(message(spark, nested_categories(levels)), "x", "CategoryScheme")
    got = xml.flatten_category_scheme(elements, "en").orderBy("depth").collect()
    assert len(got) == levels and got[-1]["cat_path"] == ".".join(f"L{i}" for i in range(levels))
    assert [r["depth"] for r in got] == list(range(1, levels + 1)) and got[-1]["cat_name"] == f"n{levels - 1}"
    assert got[-1]["parent_path"] == ".".join(f"L{i}" for i in range(levels - 1))


def test_category_schemes_of_files_and_odd_elements(spark, rows, tmp_path):
    body = """<s:CategorySchemes>
      <s:CategoryScheme agencyID='X > Y' id="S1"><c:Name xml:lang="it"> Uno &amp; due </c:Name><c:Name xml:lang="en">One</c:Name>
        <s:Category id="A"><c:Name xml:lang="de">nur</c:Name><c:Description xml:lang="en">about</c:Description>
          <s:Category><s:Category id="HIDDEN"/></s:Category><s:Category id="B"><c:Annotations><c:Name>no</c:Name></c:Annotations></s:Category>
        </s:Category><s:Category id="007"/></s:CategoryScheme>
      <s:CategoryScheme><s:Category id="lost"/></s:CategoryScheme><s:CategoryScheme id="EMPTY"/></s:CategorySchemes>"""
    want = [("S1", "Uno & due", "007", "007", "", "", "", 1), ("S1", "Uno & due", "A", "A", "nur", "about", "", 1),
            ("S1", "Uno & due", "B", "A.B", "", "", "A", 2)]
    parsed = xml.parse_elements(message(spark, body), "x", "CategoryScheme")
    assert rows(xml.flatten_category_scheme(parsed, "it")) == want
    (tmp_path / "one.xml").write_text(f"<?xml version='1.0'?><m:Structure xmlns:m='m'>{body}</m:Structure>")
    (tmp_path / "two.xml").write_text("<m:Structure/>")
    assert rows(xml.flatten_category_scheme(xml.read_elements(spark, str(tmp_path), "CategoryScheme"), "it")) == want
    broken = xml.parse_elements(message(spark, '<s:CategoryScheme id="S"><s:Category id="A"></s:CategoryScheme>'), "x", "CategoryScheme")
    with pytest.raises(PySparkException, match="mismatched tag"):
        xml.flatten_category_scheme(broken, "en").collect()


def nested_hub(levels):
    category = {"id": f"L{levels - 1}", "label": "leaf", "datasetIdentifiers": ["X,DEEP,1.0"], "childrenCategories": []}
    for i in reversed(range(levels - 1)):
        category = {"id": f"L{i}", "label": f"n{i}", "childrenCategories": [category]}
    return {"categoryGroups": [{"categories": [{"id": "TOP", "label": "Top", "childrenCategories": [category]}]}], "datasetMap": {}}


@pytest.mark.parametrize("levels", [1, 12, 40, 300])
def test_hub_trees_of_any_depth(spark, rows, levels):
    df = spark.createDataFrame([(1, json.dumps(nested_hub(levels)))], "node int, x string")
    path = ".".join(f"L{i}" for i in range(levels))
    assert rows(js.flatten_hub_tree(df, "x", ["node"])) == [(1, "DEEP", "TOP", path)]
    assert js.flatten_hub_categories(df, "x").count() == levels
    assert rows(js.flatten_hub_catalog(df, "x", "node"), "df_id", "df_description") == [("DEEP", "leaf")]


def test_hub_catalog_titles_meet_datasets_by_id(spark, rows):
    """4,000 datasets in one catalog; of two titles of one id the last wins, an empty one gives way to the label."""
    sets = [f"X,D{i},1.{i}" for i in range(4000)]
    titles = {f"X,D{i},1.{i}": {"title": f"title {i}"} for i in range(4000)} | {"Y,D7,9": {"title": "last"}, "Y,D8,9": {"title": ""}, "Y,D9,9": None}
    hub = {"categoryGroups": [{"categories": [{"id": "T", "label": "Label", "datasetIdentifiers": sets}]}], "datasetMap": titles}
    df = spark.createDataFrame([("n", json.dumps(hub)), ("m", "no json"), (None, None)], "node string, x string")
    got = js.flatten_hub_catalog(df, "x", "node")
    assert got.count() == 4000
    assert rows(got.where("df_id IN ('D6', 'D7', 'D8', 'D9')"), "df_id", "version", "df_description") == [
        ("D6", "1.6", "title 6"), ("D7", "1.7", "last"), ("D8", "1.8", "Label"), ("D9", "1.9", "Label")]


def test_broken_message_fails(spark):
    broken = spark.createDataFrame([("<m:Structure><Dataflows><Dataflow id='x'></Dataflows>",)], "x string")
    with pytest.raises(Exception, match="MALFORMED"):
        xml.parse_elements(broken, "x", "Dataflow").collect()


def test_annotations(spark, rows):
    body = """<s:Dataflows><s:Dataflow id="A"><c:Annotations>
      <c:Annotation id="x"><c:AnnotationTitle>2020</c:AnnotationTitle><c:AnnotationType>LAST_UPDATE</c:AnnotationType></c:Annotation>
      <c:Annotation><c:AnnotationTitle>late</c:AnnotationTitle><c:AnnotationType>LAST_UPDATE</c:AnnotationType></c:Annotation>
      <c:Annotation><c:AnnotationType>LINkED</c:AnnotationType><c:AnnotationText xml:lang="fr">f</c:AnnotationText>
        <c:AnnotationText xml:lang="en">e</c:AnnotationText></c:Annotation>
      <c:Annotation><c:AnnotationType>READY</c:AnnotationType></c:Annotation><c:Annotation><c:AnnotationTitle>no type</c:AnnotationTitle>
      </c:Annotation></c:Annotations></s:Dataflow></s:Dataflows>"""
    ann = xml.flatten_annotations(xml.parse_elements(message(spark, body), "x", "Dataflow"), "it")
    assert rows(ann, "annotation_type", "title", "text", "url") == [
        ("LAST_UPDATE", "2020", None, None), ("LINkED", None, "e", None), ("READY", None, None, None)]
    config = {"update": {"type": "LAST_UPDATE", "value": "title"}, "ready": {"type": "READY", "value": "presence"},
              "odd": {"type": "READY", "value": "colour"}, "broken": "READY"}
    assert rows(xml.annotation_columns(ann, config)) == [("A", "2020", "true", None, None)]


def test_json_observations(spark, rows):
    payload = {
        "structure": {"dimensions": {
            "series": [{"id": "A", "keyPosition": 0, "values": [{"id": "a0"}, {"id": "a1"}]},
                       {"id": "B", "keyPosition": 1, "values": [{"id": "b0"}, {"id": "b1"}]}],
            "observation": [{"id": "TIME_PERIOD", "values": [{"id": "2020"}, {"id": "2021"}]}]}},
        "dataSets": [{"series": {"1:0": {"observations": {"0": [5.5], "1": [None]}}}}],
    }
    for text in (json.dumps(payload), json.dumps({"data": payload}), json.dumps(payload).replace("[null", "[,0")):
        df = spark.createDataFrame([(text,)], "x string")
        got = js.flatten_sdmx_json(df, "x", ["A", "B", "TIME_PERIOD"])
        assert rows(got) == [("a0", "b1", "2020", 5.5), ("a0", "b1", "2021", None)]


def test_json_codes_are_worked_out_once_per_series(spark, rows):
    """Keys are split and codes built above no more rows than there are series; equal positions keep their order."""
    ids = lambda *names: [{"id": n} for n in names]
    payload = {"structure": {"dimensions": {
        "series": [{"id": "A", "values": ids("a0", "a1")}, {"id": "B", "keyPosition": 2, "values": ids("b0", "b1")},
                   {"id": "C", "keyPosition": 0, "values": ids("c0", "c1")}],
        "observation": [{"id": "TIME_PERIOD", "values": ids("2020", "2021")}, {"id": "HALF", "values": ids("h1", "h2")}]}},
        "dataSets": [{"series": {"1:0:1": {"observations": {"0": ["5.5"], "1": [], "7": ["[,x"]}}, "0:9": {"observations": {"1": [2]}},
                                 "x": {"observations": {}}, "1:1:1": None}}, {}]}
    df = spark.createDataFrame([(1, json.dumps(payload)), (2, "{"), (3, None)], "k int, x string")
    got = js.flatten_sdmx_json(df, "x", ["C", "A", "B", "HALF", "TIME_PERIOD", "NONE"], ["k"])
    assert rows(got) == [
        (1, None, None, "b0", "h2", "2021", None, 2.0), (1, "c1", "a0", "b1", None, None, None, None),
        (1, "c1", "a0", "b1", "h1", "2020", None, 5.5), (1, "c1", "a0", "b1", "h2", "2021", None, None)]
    steps = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    observations = next(i for i, step in enumerate(steps) if "Generate explode(_observations" in step)
    assert not any("split(" in step or "map_concat" in step for step in steps[:observations])
    assert sum("from_json" in step for step in steps) == 1
    twice = json.dumps(payload).replace('"id": "B"', '"id": "A"')
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        js.flatten_sdmx_json(spark.createDataFrame([(twice,)], "x string"), "x", ["A"]).collect()


HUB = {
    "categoryGroups": [{"categories": [
        {"id": "OS15", "label": "Jobs", "datasetIdentifiers": ["X,DFB_A,1.0"], "childrenCategories": [
            {"id": "C1", "label": "Leaf", "datasetIdentifiers": ["X,DFB_B", "X,DFB_A,1.0"]}]}]}],
    "datasetMap": {"X,DFB_A,1.0": {"title": "Titled"}, "X,DFB_B": {"title": None}},
}


def test_hub(spark, rows):
    df = spark.createDataFrame([(2, json.dumps(HUB)), (1, json.dumps(HUB))], "node int, x string")
    assert rows(js.flatten_hub_catalog(df, "x", "node"), "df_id", "version", "df_description", "node") == [
        ("DFB_A", "1.0", "Titled", 1), ("DFB_B", "1.0", "Leaf", 1)]
    one = df.where("node = 1")
    assert rows(js.flatten_hub_categories(one, "x"), "scheme_id", "cat_path", "depth") == [("OS15", "C1", 1), ("OS15", "OS15", 1)]
    assert rows(js.flatten_hub_tree(one, "x")) == [
        ("DFB_A", "OS15", "C1"), ("DFB_A", "OS15", "OS15"), ("DFB_B", "OS15", "C1")]
    structure = {"timeDimension": "TIME_PERIOD", "criteria": [
        {"id": "TERRITORIO", "label": "Place", "extra": {"DataStructureRef": "X+CL_T+1.0"}}, {"id": "TIME_PERIOD"}, {"id": "IND"}]}
    df = spark.createDataFrame([(json.dumps(structure),)], "x string")
    assert rows(js.flatten_hub_structure(df, "x"), "dimension_id", "position", "codelist_id") == [
        ("IND", 2, None), ("TERRITORIO", 1, "CL_T")]


def test_metadata_report(spark):
    def attr(name, **more):
        return {"id": name, **more}

    tree = [attr("TOP", attributeSet={"reportedAttributes": [
        attr("MID", attributeSet={"reportedAttributes": [attr("DATA_SOURCE", texts={"en": "english", "de": "deutsch"})]})]}),
        attr("DATA_SOURCE", text="later")]
    payload = {"data": {"metadataSets": [{"reports": [{"attributeSet": {"reportedAttributes": tree}}]}]}}
    df = spark.createDataFrame([(json.dumps(payload),)], "x string")
    got = [js.flatten_metadata_report(df, "x", {"a": "DATA_SOURCE", "b": "NONE"}, lang).first() for lang in ("it", "de")]
    assert [tuple(r) for r in got] == [("english", None), ("deutsch", None)]


def test_metadata_reports_of_any_depth(spark, rows):
    node = {"id": "DEEP", "texts": {"fr": "", "en": "found"}}
    for _ in range(200):
        node = {"id": "MID", "attributeSet": {"reportedAttributes": [node]}}
    payload = {"data": {"metadataSets": [{"reports": [{"attributeSet": {"reportedAttributes": [node, {"id": "NUM", "text": 7}]}}]}]}}
    df = spark.createDataFrame([(1, json.dumps(payload)), (2, "[]"), (3, None)], "k int, x string")
    assert rows(js.flatten_metadata_report(df, "x", {"deep": "DEEP", "num": "NUM"}, "fr", ["k"])) == [
        (1, "found", "7"), (2, None, None), (3, None, None)]


def test_calendar(spark, rows):
    text = ("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:1\r\nSUMMARY;LANGUAGE=en: GDP \r\nDTSTART;VALUE=DATE:20260102\r\n"
            "X-THEME:economy\r\nX-CATEGORY:Data release\\, Euro\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nUID:2\r\nEND:VEVENT\r\n")
    df = spark.createDataFrame([(text,)], "x string")
    assert rows(flatten_calendar(df, "x")) == [
        ("1", "GDP", "2026-01-02", "economy", ["Data release", "Euro"]), ("2", "", "", "", [""])]
