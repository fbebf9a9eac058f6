import datetime as dt

import pytest

from snaplytics.plans.transform import TransformAborted, build_category_dim, clean_fact, load_inputs
from snaplytics.sources.category_json import read_category_items
from snaplytics.sources.manifest import input_manifest, missing
from snaplytics.sources.regional_csv import csv_rejects, file_facts, read_regional_csv, region_glob, scan_files
from tests import fixtures
from tests.conftest import rows


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("raw"))
    fixtures.write_raw(d)
    return d


def test_csv_by_name_encoding_and_region(spark, raw_dir):
    raw = read_regional_csv(spark, raw_dir, ["US", "CA", "GB", "IN", "DE", "FR"])
    assert {"video_id", "views", "title", "region"} <= set(raw.columns)
    fr = raw.where("region = 'FR'").select("video_id", "title", "views").collect()
    assert [tuple(r) for r in fr] == [("z", "café", "20")]      # Latin-1 decoded, columns by name
    n = raw.where("video_id = 'n'").select("title").first()[0]
    assert n == 'quote "x", comma\nnewline'
    assert raw.where("region = 'US'").count() == len(fixtures.us_rows())


def test_missing_region_reported(spark, raw_dir):
    regions = ["US", "CA", "IN", "FR"]
    files = scan_files(spark, region_glob(raw_dir, ["US", "FR"]))
    manifest = input_manifest(spark, raw_dir, regions)
    assert missing(manifest, "csv") == ["CA", "IN"] and missing(manifest, "json") == ["IN"]
    sizes = {(r.region, r.kind): (r.files, r.bytes) for r in manifest.collect()}
    assert sizes["CA", "csv"] == (0, 0) and sizes["US", "csv"][0] == 1 and sizes["US", "csv"][1] > 1000
    assert {utf8 for p, _, utf8, _ in files if p.endswith("FRvideos.csv")} == {False}
    spans = {p.rsplit("/", 1)[-1]: s for p, _, _, s in files}
    assert spans == {"USvideos.csv": True, "FRvideos.csv": False}   # only US has a quoted newline


def test_no_input_is_none(spark, tmp_path):
    assert read_regional_csv(spark, str(tmp_path), ["US"]) is None
    assert read_category_items(spark, str(tmp_path), ["US"]) is None
    assert csv_rejects(spark, str(tmp_path), ["US"]).collect() == []


def test_raw_folder_that_is_not_there_raises(spark, tmp_path):
    """Only missing regions are tolerated: another error is not read as missing input."""
    for read in (read_regional_csv, read_category_items):
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
            read(spark, str(tmp_path / "nowhere"), ["US"])


def test_records_with_surplus_fields(spark, tmp_path):
    d = str(tmp_path)
    with open(f"{d}/USvideos.csv", "w") as fh:
        fh.write('video_id,views,title\na,1,x\nb,2,y,EXTRA\nc,3\nd,4,"q, ""z"""\ne,5,"u,v",6,7\nf,6,"line\nbreak",8\n')
    with open(f"{d}/FRvideos.csv", "w") as fh:
        fh.write("title,video_id\nx,g,\ny,h\n")
    rejected = csv_rejects(spark, d, ["US", "FR", "CA"]).collect()
    assert sorted((r.region, r._source_file.rsplit("/", 1)[-1], r._record.rstrip()) for r in rejected) == [
        ("FR", "FRvideos.csv", "x,g,"), ("US", "USvideos.csv", "b,2,y,EXTRA"),
        ("US", "USvideos.csv", 'e,5,"u,v",6,7'), ("US", "USvideos.csv", 'f,6,"line\nbreak",8')]
    kept = read_regional_csv(spark, d, ["US", "FR"], surplus="drop")
    assert rows(kept, "video_id", "views", "title") == sorted(
        [("a", "1", "x"), ("c", "3", None), ("d", "4", 'q, "z"'), ("h", None, "y")], key=repr)
    with pytest.raises(Exception, match="more fields than the header names: "):
        read_regional_csv(spark, d, ["US"]).collect()


def test_missing_value_texts(spark, tmp_path):
    d = str(tmp_path)
    with open(f"{d}/USvideos.csv", "w") as fh:
        fh.write('video_id,views,title\na,NA,null\nb,"None",""\nc,NaNa,n/a\n')
    assert rows(read_regional_csv(spark, d, ["US"]), "video_id", "views", "title") == [
        ("a", None, None), ("b", None, None), ("c", "NaNa", None)]
    assert rows(read_regional_csv(spark, d, ["US"], missing_texts=()), "video_id", "views", "title") == [
        ("a", "NA", "null"), ("b", "None", None), ("c", "NaNa", "n/a")]


def test_header_scan_sorts_no_text(spark, raw_dir):
    plan = file_facts(spark.read.text(raw_dir))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort " not in plan and "ObjectHashAggregate" in plan


def test_category_json_last_region_wins_and_corrupt_files(spark, raw_dir):
    items = read_category_items(spark, raw_dir, ["US", "CA", "GB", "FR"])
    dim = build_category_dim(items)
    assert rows(dim) == [(10, "Musique"), (12, "Pets"), (22, "People")]
    # order of configuration decides: US last -> US title wins
    dim2 = build_category_dim(read_category_items(spark, raw_dir, ["FR", "US"]))
    assert dict(rows(dim2))[10] == "Music"


def test_abort_without_categories(spark, tmp_path):
    with pytest.raises(TransformAborted):
        load_inputs(spark, str(tmp_path), ["US"])


def test_clean_fact_edge_rows(spark, raw_dir):
    raw, dim = load_inputs(spark, raw_dir, ["US", "CA", "GB", "IN", "DE", "FR"])
    fact = {r["video_id"]: r for r in clean_fact(raw).collect()}
    assert set(fact) == {"a", "b", "c", "d", "i", "j", "k", "l", "m", "n", "z"}
    assert fact["b"]["description"] == "No description provided"
    assert fact["c"]["views"] == 70
    assert fact["d"]["views"] == 10
    assert fact["i"]["category_id"] == 12 and fact["i"]["engagement_rate"] == 0.0012
    assert fact["j"]["engagement_rate"] == 0.0
    k = fact["k"]
    assert (k["views"], k["likes"], k["dislikes"], k["comment_count"]) == (0, 0, 0, 0)
    assert k["engagement_rate"] == 0.0                                # computed before the clamp
    assert fact["l"]["likes"] is None and fact["l"]["engagement_rate"] == 0.2
    assert fact["a"]["trending_date"] == dt.date(2017, 11, 14) and fact["a"]["trending_day"] == "Tuesday"
    assert fact["a"]["publish_hour"] == 17
    assert fact["a"]["tags"] == "a|b" and fact["z"]["title"] == "café"
    assert fact["a"]["comments_disabled"] is False


def test_split_files_keep_header_and_rows(spark, tmp_path):
    """Files larger than a split: the header comes from the first split only, and a file
    without quoted newlines is parsed splittably without losing or duplicating rows."""
    d = str(tmp_path)
    data = [fixtures.row(f"v{i}", "17.14.11", i, title=f"title {i}") for i in range(3000)]
    fixtures.write_csv(f"{d}/USvideos.csv", fixtures.HEADER, data)
    data_fr = data[:1000] + [fixtures.row("nl", "17.14.11", 1, title="a\nb")]
    order = list(reversed(range(len(fixtures.HEADER))))
    fixtures.write_csv(f"{d}/FRvideos.csv", [fixtures.HEADER[i] for i in order],
                       [[r[i] for i in order] for r in data_fr])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        files = scan_files(spark, region_glob(d, ["US", "FR"]))
        assert {p.rsplit("/", 1)[-1]: (h.split(",")[0], s) for p, h, _, s in files} == {
            "USvideos.csv": ("video_id", False), "FRvideos.csv": ("description", True)}
        raw = read_regional_csv(spark, d, ["US", "FR"])
        assert raw.where("region = 'US'").count() == 3000
        assert raw.where("region = 'FR'").count() == 1001
        assert raw.where("region = 'US'").select("video_id").distinct().count() == 3000
        assert raw.where("video_id = 'nl'").first()["title"] == "a\nb"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_header_with_bom_and_quotes(spark, tmp_path):
    from snaplytics.sources.regional_csv import _header_names
    assert _header_names("ï»¿Video_ID,\"Views\",title\r") == ("video_id", "views", "title")
    d = str(tmp_path)
    with open(f"{d}/USvideos.csv", "wb") as fh:
        fh.write(b"\xef\xbb\xbfVideo_ID,views\nx1,5\n")
    raw = read_regional_csv(spark, d, ["US"])
    assert [tuple(r) for r in raw.select("video_id", "views").collect()] == [("x1", "5")]
