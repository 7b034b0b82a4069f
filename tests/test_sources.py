import json

import pytest
from pyspark.sql import functions as F

from varstrata import allocation, strata_stats, stratified_sample, with_total
from varstrata.sources import delimited, nested, records, topics

NAMES = "Year,District.Code,District.Name,Number"


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "one.csv").write_text('Y,C,N,X\n2017,1,"Ciutat, Vella",34\n2017,2,"say ""hi""",\n', encoding="utf-8")
    (tmp_path / "two.csv").write_text("Y,C,N,X\n2018,3,Gràcia,abc\n2018,4,short\n", encoding="utf-8")
    return str(tmp_path)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_read_delimited_drops_each_header_and_keeps_quoted_commas(spark, folder):
    df = delimited.read_delimited(spark, folder, NAMES)
    assert df.columns == NAMES.split(",") and {t for _, t in df.dtypes} == {"string"}
    assert rows(df, "`District.Code`") == [
        ("2017", "1", "Ciutat, Vella", "34"),
        ("2017", "2", 'say "hi"', ""),
        ("2018", "3", "Gràcia", "abc"),
        ("2018", "4", "short", ""),
    ]
    assert delimited.read_delimited(spark, folder, NAMES, header=False).count() == 6


def test_lines_split_as_text_lose_all_quotes(spark, folder):
    lines = delimited.read_lines(spark, folder)
    assert lines.count() == 4 and delimited.read_lines(spark, folder, header=False).count() == 6
    df = delimited.split_lines(lines, NAMES)
    assert rows(df, "`District.Code`")[:2] == [("2017", "1", "Ciutat, Vella", "34"), ("2017", "2", "say hi", "")]
    assert rows(df, "`District.Code`")[3] == ("2018", "4", "short", "")


def test_file_to_sample(spark, folder):
    df = delimited.read_delimited(spark, folder, NAMES)
    stats = strata_stats(df, "year", "number").orderBy("year").collect()
    assert [(r.Year, r.n, r.mean) for r in stats] == [("2017", 2, 17.0), ("2018", 2, 0.0)]
    assert stratified_sample(df, "year", "number", 20, id="District.Code").count() == 2


def test_row_records(spark, edge):
    df = edge(("a", "b", "1.5", "n;m"), (None, "c", "bad", ""))
    out = delimited.transform_rows(df, "k1", "x")
    assert rows(out, "key") == [("", 0.0, "c,bad,"), ("a", 1.5, "b,1.5,n;m")]
    values = records.encode_rows(out)
    assert {r.value for r in values.collect()} == {";0.0;c,bad,", "a;1.5;b,1.5,n;m"}
    # a separator inside a field shifts what follows
    assert rows(records.decode_rows(values), "key") == [("", "c,bad,"), ("a", "b,1.5,n")]


def test_stats_records_carry_the_allocation(edge):
    df = edge(*[(k, "", v) for k in "ab" for v in ("1", "3")], ("c", "", "7"))
    stats = with_total(strata_stats(df, "k1,k2", "x"))
    values = records.encode_stats(stats, "k1,k2")
    assert "a,;2.0;1.0;2.0;0.5;1.0" in {r.value for r in values.collect()}
    direct = {r.k1 + ",": (r.n, r.s) for r in allocation(df, "k1,k2", "x", 5).collect()}
    assert {r.key: (r.n, r.s) for r in records.decode_allocation(values, 5).collect()} == direct


def test_broken_stats_records_become_null(spark):
    df = spark.createDataFrame([('a;1;2;"3;4',), ("b",)], "value string")
    assert all(r.n is None and r.total_gamma is None for r in records.decode_stats(df).collect())


def test_sample_records_and_reports(edge):
    df = edge(("a", "b", "1", "n"), ("a", "b", "3", "m"))
    sample = stratified_sample(df, "k1,k2", "x", 20, id="note")
    assert {r.value for r in records.encode_sample(sample, "k1,k2").collect()} == {"a,b,1,n", "a,b,3,m"}
    assert rows(records.mean_report(strata_stats(df, "k1,k2", "x"), "k1,k2"), "key") == [
        ("a,b", "Mean= 2.0", "Standard deviation= 1.0")
    ]
    assert rows(records.quota_report(allocation(df, "k1,k2", "x", 20), "k1,k2"), "key") == [("a,b", "si= 20")]


DOCUMENT = {
    "results": [
        {
            "location": " 河",
            "city": "T",
            "country": "CN",
            "distance": 5.5,
            "measurements": [
                {"parameter": "so2", "value": 19, "lastUpdated": "2019", "unit": "µg/m³", "sourceName": "S",
                 "averagingPeriod": {"value": 1, "unit": "hours"}},
                {"parameter": "co", "value": -99.5, "lastUpdated": "2019", "unit": "ppm", "sourceName": "S"},
            ],
            "coordinates": {"latitude": 39.2, "longitude": 117.1},
        },
        {"location": "no place", "city": "U", "country": "SE",
         "measurements": [{"parameter": "no2", "value": 3, "lastUpdated": "2018", "unit": "ppm", "sourceName": "R"}]},
        {"location": "nothing measured", "city": "V", "country": "SE", "measurements": []},
    ]
}


def test_nested_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCUMENT, indent=1), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(DOCUMENT), encoding="utf-8")
    flat = nested.flatten_measurements(nested.read_documents(spark, str(tmp_path)))
    assert flat.columns == [
        "location", "city", "country", "utc", "local", "parameter", "value", "unit", "latitude", "longitude",
        "attribution",
    ]
    assert flat.count() == 6
    first = flat.filter("parameter = 'co'").first()
    assert (first.location, first.value, first.latitude, first.attribution) == (" 河", -99.5, 39.2, "S")
    assert flat.filter("parameter = 'no2'").first().latitude is None


def test_bad_documents_are_told(spark, tmp_path):
    text = spark.createDataFrame([(json.dumps(DOCUMENT),), ("not json",), (None,)], "value string")
    with pytest.raises(Exception, match="MALFORMED"):
        nested.flatten_measurements(nested.parse_documents(text)).collect()
    assert nested.flatten_measurements(nested.parse_documents(text, bad="drop")).count() == 3
    kept = nested.parse_documents(text, bad="keep")
    assert [r.bad for r in kept.collect() if r.bad] == ["not json"] and kept.count() == 2
    assert nested.flatten_measurements(kept).count() == 3
    (tmp_path / "a.json").write_text(json.dumps(DOCUMENT), encoding="utf-8")
    (tmp_path / "b.json").write_text("not json", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        nested.read_documents(spark, str(tmp_path)).collect()
    assert nested.flatten_measurements(nested.read_documents(spark, str(tmp_path), bad="drop")).count() == 3
    assert nested.read_documents(spark, str(tmp_path), bad="keep").filter("bad is not null").count() == 1
    with pytest.raises(ValueError):
        nested.read_documents(spark, str(tmp_path), bad="skip")


def test_lines_may_hold_the_separator(spark, tmp_path):
    (tmp_path / "a.txt").write_text("head\x01er\nab\x01cd,e\nplain\n\"q\x01,\"\x01\x01\n\x01\n", encoding="utf-8")
    lines = [r.value for r in delimited.read_lines(spark, str(tmp_path)).collect()]
    assert lines == ["ab\x01cd,e", "plain", "\"q\x01,\"\x01\x01"]


def test_each_text_is_parsed_once(spark):
    text = spark.createDataFrame([("{}",)], "value string")
    flat = nested.flatten_measurements(nested.parse_documents(text))
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_topic_options():
    assert topics.rows_topic("t") == "_t"
    assert topics.source_options("t", "h:1", "g") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "groupIdPrefix": "g",
    }
    assert topics.sink_options("t", "h:1") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_rebalance_evens_out_rows(spark):
    df = spark.range(1000).coalesce(1)
    sizes = topics.rebalanced(df, 8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) <= 130
    assert topics.rebalanced(df, None) is df
