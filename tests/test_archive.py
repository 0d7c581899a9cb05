from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import of_provider
from statcube.functions.text import clean_prose, link_id, territorial_level
from statcube.model import AVAILABLE_CODES, PROBE_STATUS
from statcube.operators import archive
from statcube.sources.tabular import write_archive
from statcube.streaming import jobs
from statcube.operators.codes import available_codes


def status_of(spark, entries):
    full = [("P", i, "", s, "", 0, 0, e, "", date.fromisoformat(c)) for i, s, e, c in entries]
    return spark.createDataFrame(full, PROBE_STATUS)


def test_candidates(spark):
    status = status_of(spark, [
        ("E1", "error", 1, "2026-07-19"), ("E3", "error", 3, "2026-07-18"), ("E9", "error", 9, "2026-05-16"),
        ("OK_OLD", "ok", 0, "2026-01-20"), ("OK_EDGE", "ok", 0, "2026-01-21"), ("EMPTY_NEW", "empty", 5, "2026-07-19"),
    ])
    flows = of_provider(spark.createDataFrame(
        [(i,) for i in ("OK_OLD", "OK_EDGE", "EMPTY_NEW", "E9", "E3", "E1", "NEW2", "NEW1")], "df_id string"))
    picked = archive.pick_candidates(flows, status, "2026-07-20", 180, 10)
    assert [r["df_id"] for r in picked.collect()] == ["NEW1", "NEW2", "E9", "E1", "OK_OLD"]
    assert archive.pick_candidates(flows, status, "2026-07-20", 180, 2).count() == 2
    assert {r["df_id"] for r in archive.retry_due(status, "2026-07-20").collect()} == {"E1", "E9"}
    assert "E9" not in {r["df_id"] for r in archive.retry_due(status, "2026-07-18").collect()}


def test_probe_outcome(spark, rows):
    probes = of_provider(spark.createDataFrame(
        [("A", "a", "hub", None), ("B", None, "hub", None), ("C", "c", "hub", "x" * 500)],
        "df_id string, df_description string, source string, error string"))
    codes = of_provider(spark.createDataFrame([("A", "geo", "IT"), ("A", "geo", "FR"), ("A", "sex", "T")],
                                              "df_id string, dimension_id string, code_id string"))
    codes = codes.unionByName(of_provider(spark.createDataFrame([("B", "geo", "IT")], "df_id string, dimension_id string, code_id string"), "Q"))
    previous = status_of(spark, [("A", "error", 4, "2026-01-01"), ("C", "error", 2, "2026-01-01")])
    got = {r["df_id"]: r for r in archive.probe_outcome(probes, codes, previous, "2026-07-20").collect()}
    assert (got["A"]["status"], got["A"]["n_dims"], got["A"]["n_codes"], got["A"]["error_count"]) == ("ok", 2, 3, 0)
    assert (got["B"]["status"], got["B"]["df_description"]) == ("empty", "")
    assert (got["C"]["status"], got["C"]["error_count"], len(got["C"]["last_error"])) == ("error", 3, 500)


def archive_of(spark, triples):
    return spark.createDataFrame([("P", *t, date(2026, 1, 1)) for t in triples], AVAILABLE_CODES)


def test_merge_replaces_probed_only(spark, rows):
    old = archive_of(spark, [("A", "geo", "IT"), ("B", "geo", "FR")])
    new = archive_of(spark, [("A", "geo", "DE")])
    assert rows(archive.merge_archive(old, new, new), "df_id", "code_id") == [("A", "DE"), ("B", "FR")]
    other = new.withColumn("provider", F.lit("Q"))
    both = archive.merge_archive(old, other, other)
    assert rows(both, "provider", "df_id", "code_id") == [("P", "A", "IT"), ("P", "B", "FR"), ("Q", "A", "DE")]
    assert "Sort" not in both._jdf.queryExecution().optimizedPlan().toString()


def test_only_touched_partitions_are_written(spark, rows, tmp_path):
    old = archive_of(spark, [("A", "geo", "IT"), ("B", "geo", "FR")])
    table = old.unionByName(old.withColumn("provider", F.lit("Q")))
    path = f"{tmp_path}/archive"
    write_archive(table, path, "provider")
    before = {p.name for p in (tmp_path / "archive" / "provider=Q").iterdir()}
    new = archive_of(spark, [("A", "geo", "DE")])
    merged = archive.touched_archive(spark.read.schema(table.schema).parquet(path), new, new)
    assert rows(merged, "provider", "df_id", "code_id") == [("P", "A", "DE"), ("P", "B", "FR")]
    write_archive(spark.createDataFrame(merged.collect(), merged.schema), path, "provider")
    assert {p.name for p in (tmp_path / "archive" / "provider=Q").iterdir()} == before
    assert rows(spark.read.schema(table.schema).parquet(path), "provider", "df_id", "code_id") == [
        ("P", "A", "DE"), ("P", "B", "FR"), ("Q", "A", "IT"), ("Q", "B", "FR")]


def test_territorial_view(spark, rows):
    data = archive_of(spark, [
        ("BIRTHS", "RESIDENCE_TERR", "IT"), ("BIRTHS", "RESIDENCE_TERR", "ITC4"), ("BIRTHS", "RESIDENCE_TERR", "015146"),
        ("PRICES", "ECOICOP_2", "011111"), ("MULTI", "REF_AREA", "IT"), ("MULTI", "RESIDENCE_TERR", "015146"),
        ("MULTI", "RESIDENCE_TERR", "015147"), ("MULTI", "RESIDENCE_TERR", "IT108_NC"), ("NONE", "REF_AREA", "XX"),
    ])
    flows = spark.createDataFrame([("BIRTHS", "RESIDENCE_TERR"), ("PRICES", ""), ("X", None)], "df_id string, df_geo_dim string")
    status = status_of(spark, [("BIRTHS", "ok", 0, "2026-01-01")])
    view = archive.territorial_view(data, status, archive.territorial_dims(flows))
    assert rows(view, "df_id", "dimension_id", "max_level", "levels", "n_territories", "checked_at") == [
        ("BIRTHS", "RESIDENCE_TERR", "comune", "nazionale|regione|comune", 3, "2026-01-01"),
        ("MULTI", "REF_AREA", "nazionale", "nazionale", 1, ""), ("MULTI", "RESIDENCE_TERR", "comune", "comune", 3, "")]
    assert rows(archive.dataflows_at_level(data, "comune"), "df_id") == [("BIRTHS",), ("MULTI",), ("PRICES",)]


@pytest.mark.parametrize(
    ("code", "level"),
    [("IT", "nazionale"), ("ITC", "ripartizione"), ("ITC4", "regione"), ("IT108", "provincia"), ("015146", "comune"),
     ("IT108_NC", None), ("FR", None)],
)
def test_levels(spark, code, level):
    assert spark.range(1).select(territorial_level(F.lit(code))).first()[0] == level


def test_prose_and_links(spark, rows):
    raw = "Natalit&agrave; e fecondit&agrave;.<br/> <b>P4</b>&nbsp;  modello"
    df = spark.createDataFrame([(raw,), (None,)], "t string")
    assert [r[0] for r in df.select(clean_prose(F.col("t"))).collect()] == ["Natalità e fecondità. P4 modello", ""]
    assert spark.range(1).select(link_id(F.lit("visualizza.do?x=1&id=0019100"))).first()[0] == "0019100"
    assert spark.range(1).select(link_id(F.lit("visualizza.do"))).first()[0] is None
    urls = spark.createDataFrame([
        ("A", "https://m/?reportId=DCIS_NATI2&metadataSetId=MS%20X&BaseUrlMDA=https%3A%2F%2Fapi"), ("B", "https://m/?reportId=R"),
        ("C", None), ("D", "no url %%% at all")], "df_id string, url string")
    links = archive.metadata_links(of_provider(urls)).drop("provider")
    assert rows(links) == [("A", "DCIS_NATI2", "MS X", "https://api")]


def test_descriptions(spark, rows):
    links = spark.createDataFrame([("A", "R1", "M", "u"), ("B", "R1", "M", "u"), ("C", "R2", "M", "u"), ("D", "R3", "M", "u")],
                                  "df_id string, report_id string, metadata_set_id string, base_url string")
    links = of_provider(links)
    reports = spark.createDataFrame([("R1", "text", "001"), ("R2", "", None)], "report_id string, description string, siqual_id string")
    assert rows(archive.reports_to_fetch(links, reports), "report_id") == [("R3",)]
    described = archive.describe_dataflows(links, reports, "2026-07-20")
    assert rows(described, "df_id", "description") == [("A", "text"), ("B", "text")]
    assert rows(archive.harvest_stats(described, links)) == [(2, 1, 2, 2)]


def test_blacklist(spark, rows):
    listed = of_provider(spark.createDataFrame([("A", "old")], "df_id string, description string")).selectExpr(
        "provider", "df_id", "timestamp'2026-01-01' AS marked_at", "description")
    more = of_provider(spark.createDataFrame([("A", "new"), ("B", "b")], "df_id string, description string"))
    updated = archive.blacklist_upsert(listed, more, "2026-02-01")
    assert rows(updated, "df_id", "description") == [("A", "new"), ("B", "b")]
    left, existed = archive.blacklist_remove(updated, of_provider(spark.createDataFrame([("A",), ("Z",)], "df_id string")))
    assert rows(left, "df_id") == [("B",)] and rows(existed, "df_id", "existed") == [("A", True), ("Z", False)]


def test_feed(spark):
    past = [(f"p{i:02d}", f"2026-01-{i + 1:02d}", ["Data release", "Euro"]) for i in range(12)]
    events = spark.createDataFrame(past + [("f", "2027-01-01", ["Data release"]), ("n", "2026-01-20", ["News"])],
                                   "uid string, date string, categories array<string>").withColumn("theme", F.lit("economy"))
    feed = archive.release_feed(events, "2026-06-30")
    assert [r["uid"] for r in feed.collect()] == [f"p{i:02d}" for i in range(11, 1, -1)]
    assert archive.release_feed(events, "2026-06-30", "science").count() == 0


# --- streams equal batch -----------------------------------------------------


def test_code_stream_equals_batch(spark, rows, tmp_path):
    cube = spark.createDataFrame([("IT", "T"), ("FR", "T"), ("IT", "M")], "geo string, sex string")
    cube.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(cube.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        codes = jobs.stream_available_codes(stream, ["geo", "sex"])
        jobs.start_codes_archive(codes, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    more = spark.createDataFrame([("DE", "T")], cube.schema)
    more.write.mode("append").parquet(f"{tmp_path}/in")
    codes = jobs.stream_available_codes(stream, ["geo", "sex"])
    jobs.start_codes_archive(codes, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(available_codes(cube.unionByName(more), ["geo", "sex"]))


def test_upsert_stream_equals_batch_and_replay(spark, rows, tmp_path):
    data = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("a", 3, 30), ("a", 2, 40), ("c", 5, 50)], "k string, t int, v int")
    data.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    table, keys = f"{tmp_path}/table", ["k"]
    want = rows(archive.upsert(data.limit(0), data, keys, "t"))
    for checkpoint in ("one", "one", "two"):  # continue, then replay everything
        jobs.stream_upsert(stream, keys, table, f"{tmp_path}/{checkpoint}", "t").awaitTermination()
        assert rows(jobs.read_upserted(spark, table, keys, "t")) == want
    jobs.compact_upserted(spark, table, f"{tmp_path}/compact", keys, "t")
    assert rows(jobs.read_upserted(spark, f"{tmp_path}/compact", keys, "t")) == want


def test_stream_goes_on_after_compaction(spark, rows, tmp_path):
    """A stream with a fresh checkpoint adds to the compacted table and replaces nothing of it."""
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, t int, v int")
    new = spark.createDataFrame([("c", 1, 30), ("a", 1, 11)], old.schema)
    keys, table = ["k"], f"{tmp_path}/compact"
    for name, data, target in (("one", old, f"{tmp_path}/table"), ("two", new, table)):
        data.write.parquet(f"{tmp_path}/in-{name}")
        stream = spark.readStream.schema(old.schema).parquet(f"{tmp_path}/in-{name}")
        jobs.stream_upsert(stream, keys, target, f"{tmp_path}/{name}", "t").awaitTermination()
        if name == "one":
            jobs.compact_upserted(spark, target, table, keys, "t")
    assert rows(jobs.read_upserted(spark, table, keys, "t")) == [("a", 1, 11), ("b", 1, 20), ("c", 1, 30)]
