"""Parsers, files, manifest and sinks on hand-written input."""

import gzip
from datetime import date, datetime

from pyspark.sql import functions as F

from hitlens.plans.enrich import enrich
from hitlens.schema import canonical, coerce, resolve_column
from hitlens.sources import files, lines, sinks

PAIRS = (
    'http_host:app.example.gov remote_addr:"100.100.8.44" remote_port:"10305" remote_user:"-" '
    'time:"2025-04-23T00:00:02+08:00" request:"GET /group1/M00/06/B3/a.png HTTP/1.1" code:"200" body:"140332" '
    'http_referer:"-" ar_time:"0.325" RealIp:"100.100.8.45" agent:"zgt-ios/1.4.1 (iPhone; iOS 15.4.1; Scale/3.00)"'
)
COMBINED = (
    '10.0.0.7 - alice [23/Apr/2025:00:00:02 +0800] "GET /api/v1/user/42?x=1 HTTP/1.1" 200 512 '
    '"https://www.baidu.com/s?wd=abc" "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0"'
)
CDN = (
    '[1/Jul/2025:21:47:26 +0800] 203.0.113.9 - 120 "-" "GET https://cdn.example.com/js/a.js?v=3" 200 512 20480 HIT '
    '"Mozilla/5.0 Chrome/120" "application/javascript" 198.51.100.4'
)


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_pair_line(spark):
    row = lines.parse_pairs(text(spark, PAIRS)).first()
    assert row["log_time"] == datetime(2025, 4, 23, 0, 0, 2)
    assert (row["client_ip"], row["remote_addr"]) == ("100.100.8.45", "100.100.8.44")
    assert (row["request_method"], row["request_uri"], row["protocol"]) == ("GET", "/group1/M00/06/B3/a.png", "HTTP/1.1")
    assert (row["status"], row["duration_ms"], row["response_ms"]) == ("200", 325, 325)
    assert (row["body_bytes"], row["sent_bytes"]) == (140332, 140532)
    assert row["referer"] is None and row["server_name"] == "app.example.gov"
    assert row["user_agent"].endswith("Scale/3.00)") and row["parsing_errors"] == []


def test_pair_edges(spark):
    second = 'remote_addr:"1.1.1.1" ar_time:"9" time:"2025-04-23 00:00:02" status:"404" response_time:"1.5" upstream_response_time:"1.2" body_bytes_sent:"3.0" request:"GET"'
    rows = lines.parse_pairs(text(spark, second, "  ", 'remote_addr:"1.1.1.1" time:"x" code:"999"', 'time:"2025-04-23 00:00:02" code:"200"'))
    a, b, c = rows.collect()
    assert a["log_time"] == datetime(2025, 4, 23, 0, 0, 2) and (a["duration_ms"], a["response_ms"]) == (9000, 1200)
    assert (a["status"], a["body_bytes"], a["request_method"], a["request_uri"]) == ("404", 3, "GET", "")
    assert b["parsing_errors"] == ["bad_time", "bad_code"]
    assert c["parsing_errors"] == ["missing_remote_addr"]
    assert lines.accepted(rows).count() == 2 and lines.rejected(rows).count() == 1


def test_json_dialects(spark):
    one = '{"time":"2025-04-23T00:00:02+08:00","client_ip":"1.2.3.4","request_method":"GET","request_uri":"/a","status":"200","request_time":0.29,"body_bytes_sent":"-","bytes_sent":10,"user_agent":"x"}'
    two = '{"log_time":"2025-04-23 00:00:03","remote_addr":"4.3.2.1","method":"POST","uri":"/b","response_status":500,"response_time":"1.001","response_size":7,"http_user_agent":"y"}'
    three = '{"time":"2025-04-23T00:00:04+08:00","http_host":"h","request_uri":"/c","request_args":"x=1","status":"200","upstream_time":"0.1","trace_id":"t","connection_requests":7}'
    rows = lines.parse_json(text(spark, one, two, three, "not json")).orderBy("log_time").collect()
    last = rows.pop()
    assert (last["server_name"], last["request_uri"], last["response_ms"]) == ("h", "/c?x=1", 100)
    assert (last["trace_id"], last["connection_requests"], rows[0]["connection_requests"]) == ("t", 7, 1)
    assert [(r["client_ip"], r["status"], r["duration_ms"], r["body_bytes"], r["user_agent"]) for r in rows] == [
        ("1.2.3.4", "200", 290, 0, "x"), ("4.3.2.1", "500", 1001, 7, "y")]


def test_combined_and_cdn(spark):
    row = lines.parse_combined(text(spark, COMBINED, "junk")).collect()
    assert len(row) == 1 and row[0]["client_ip"] == "10.0.0.7" and row[0]["body_bytes"] == 512
    assert row[0]["request_uri"] == "/api/v1/user/42?x=1" and row[0]["log_time"] == datetime(2025, 4, 23, 0, 0, 2)
    row = lines.parse_cdn(text(spark, CDN, "junk")).collect()
    assert len(row) == 1 and row[0]["log_time"] == datetime(2025, 7, 1, 21, 47, 26)
    assert (row[0]["duration_ms"], row[0]["uri"], row[0]["cache_status"], row[0]["end_ip"]) == (120, "/js/a.js", "HIT", "198.51.100.4")


def test_pairs_map(spark):
    row = text(spark, 'a:"1 2" b:3 a:"4" c:""').select(lines.pairs_map(F.col("value")).alias("m")).first()
    assert row["m"] == {"b": "3", "a": "4", "c": ""}


def test_folder_formats_and_gzip(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.log").write_text("\n\n" + '{"time":"x"}\n' + PAIRS + "\n")
    with gzip.open(tmp_path / "sub" / "b.log.gz", "wt") as f:
        f.write(PAIRS + "\n" + PAIRS + "\n")
    (tmp_path / "c.log").write_text("nothing known\n")
    read = files.read_lines(spark, str(tmp_path), glob="*.log*")
    assert read.count() == 7
    found = lines.file_formats(files.first_lines(read)).select(files.file_name(F.col("source_file")).alias("f"), "format")
    assert {r["f"]: r["format"] for r in found.collect()} == {"a.log": "json", "b.log.gz": "pairs", "c.log": "json"}
    parsed = lines.accepted(lines.parse_pairs(read.filter(F.col("source_file").endswith(".gz"))))
    assert enrich(parsed).select("platform").distinct().collect()[0][0] == "iOS_SDK"


def test_names(spark):
    df = spark.createDataFrame([("20250424093000.zip",), ("x.zip",), ("a_b_20250101.log",), ("log_2025_07_01_210000_220000_x.gz",)], "n string")
    lo, hi = files.name_range(F.col("n"))
    rows = df.select(files.archive_log_date(F.col("n")).alias("d"), files.application_from_file(F.col("n")).alias("app"), lo.alias("lo"), hi.alias("hi")).collect()
    assert [r["d"] for r in rows] == [date(2025, 4, 23), None, None, None]
    assert rows[2]["app"] == "a_b"
    assert (rows[3]["lo"], rows[3]["hi"]) == (datetime(2025, 7, 1, 21), datetime(2025, 7, 1, 22))


def test_manifest(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.log").write_text(f"{name}\n1\n")
    listed = files.list_files(spark, str(tmp_path), glob="*.log")
    assert listed.count() == 3 and set(listed.columns) == {"file", "length", "modificationTime"}
    prints = files.content_fingerprints(files.read_lines(spark, str(tmp_path)))
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    later = F.lit("2025-01-02 00:00:00").cast("timestamp")
    a = prints.filter(F.col("file").endswith("a.log"))
    b = prints.filter(F.col("file").endswith("b.log"))
    manifest = files.manifest_rows(a, "completed", now).unionByName(files.manifest_rows(b, "completed", now)).unionByName(files.manifest_rows(b, "failed", later))
    left = {r["file"][-5:] for r in files.pending(prints.select("file", "hash"), manifest).collect()}
    assert left == {"b.log", "c.log"}
    assert files.reset_failed(manifest, later).count() == 1
    # a manifest is a stored table; a lazy one would read the changed file as well
    manifest.write.parquet(str(tmp_path / "manifest"))
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    (tmp_path / "a.log").write_text("changed\n")
    prints = files.content_fingerprints(files.read_lines(spark, str(tmp_path), glob="*.log"))
    assert files.pending(prints.select("file", "hash"), manifest).count() == 3


def test_new_file_leaves_other_fingerprints(spark, tmp_path):
    def prints():
        return {r["file"][-5:]: r["hash"] for r in files.content_fingerprints(files.read_lines(spark, str(tmp_path))).collect()}

    for name in ("b", "c"):
        (tmp_path / f"{name}.log").write_text(f"{name}\n" * 50)
    before = prints()
    (tmp_path / "a.log").write_text("a\n" * 5000)
    after = prints()
    assert len(after) == 3 and {k: after[k] for k in before} == before


def test_broken_lines_of_every_format(spark):
    good = '{"time":"2025-01-01T00:00:00+08:00","status":"200","client_ip":"1.1.1.1"}'
    df = text(spark, good, "{broken", '{"a": ', "noise", "  ")
    assert lines.parse_json(df).count() == 1
    assert [r["value"] for r in lines.broken(df, "json").collect()] == ["{broken", '{"a": ', "noise"]
    stats = lines.parse_statistics(df, "json").first()
    assert (stats["total"], stats["parsed"], stats["errors"], stats["empty"]) == (5, 1, 3, 1)
    line = '1.1.1.1 - - [01/Jan/2025:00:00:00 +0800] "GET /a HTTP/1.1" 200 5 "-" "x"'
    df = text(spark, line, line + ' "1.1.1.1" 0.5', "1.1.1.1 - -")
    assert [r["user_agent"] for r in lines.parse_combined(df).collect()] == ["x", "x"]
    assert lines.broken(df, "combined").count() == 1 and lines.parse_statistics(df, "combined").first()["errors"] == 1
    assert lines.parse_statistics(df, "cdn").first()["parsed"] == 0


def test_shared_folders_come_from_the_session(spark):
    from hitlens.catalog.base import scratch

    home = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert scratch(spark, "x").startswith(home) and scratch(spark, "x") != scratch(spark, "x")


def test_csv_round_trip_and_coercion(spark, tmp_path):
    df = spark.createDataFrame([("2025-01-01 00:00:00", "1.1.1.1", "200", "7.0"), ("2025-01-01 00:00:01", None, "404", "-")], "raw_time string, client_ip_address string, response_status_code string, body_bytes_sent string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    rows = files.read_staged_csv(spark, str(tmp_path / "csv")).orderBy("log_time").collect()
    assert [(r["client_ip"], r["status"], r["body_bytes"]) for r in rows] == [("1.1.1.1", "200", 7), ("", "404", 0)]
    assert resolve_column(["a", "b"], ["x", "b", "a"]) == "b"
    assert "client_ip" in canonical(df).columns
    assert coerce(df).columns[0] == "log_time"


def test_partitioned_table(spark, tmp_path):
    rows = [(datetime(2025, 1, d, h), "t1" if h else "t2", "prod", h) for d in (1, 2, 3) for h in range(4)]
    df = spark.createDataFrame(rows, "log_time timestamp, tenant string, environment string, v int")
    path = str(tmp_path / "table")
    sinks.write_table(df, path, bloom=["tenant"])
    back = spark.read.parquet(path)
    assert back.count() == 12 and {"date", "tenant", "environment"} <= set(back.columns)
    plan = back.filter("date = '2025-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    sinks.write_table(df.filter("day(log_time) = 2 and v > 1"), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 11  # only (day 2, t1) was replaced
    assert sinks.delete_dates(spark, path, date(2025, 1, 3), date(2025, 1, 5)) == ["2025-01-03"]
    kept = spark.read.parquet(path)
    assert kept.filter("date = '2025-01-03'").count() == 0
    assert sinks.retain(kept, "date", 1, date(2025, 1, 3)).count() == 3


def test_fallbacks(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    out = sinks.with_fallbacks(df, {"x": "?"}).collect()
    assert [(r["x"], r["enrichment_status"]) for r in out] == [("a", "complete"), ("?", "fallback")]
