import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from gridtally.plans.session import staging_path
from gridtally.sources.alerts import ALERT_FIELDS, read_alerts
from gridtally.sources.calls import CALL_COLUMNS, STRING_COLUMNS
from gridtally.sources.scan import (
    day_report, hour_report, missing_days, read_day, scan_days, scan_range,
)
from gridtally.sources.sinks import preview, read_csv, write_csv, write_parquet


def _write_day(root, day, header, rows):
    d = os.path.join(root, f"UTC_date={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_call_columns():
    assert len(CALL_COLUMNS) == 85 and len(set(CALL_COLUMNS)) == 85
    assert "rlc_pdu_dl__retransmitted_bytes_count" in CALL_COLUMNS
    assert "submkt" in STRING_COLUMNS and "submkt" not in CALL_COLUMNS


def test_scan_days_by_header(spark, tmp_path):
    root = str(tmp_path / "trc")
    cols = ["a", "b", "c"]
    _write_day(root, "20240101", cols, [("1", "x", "p"), ("2", "y", "q")])
    _write_day(root, "20240103", cols, [("3", "z", "r")])
    _write_day(root, "20240104", ["b", "a", "c"], [("w", "4", "s")])  # reordered header
    _write_day(root, "20240105", ["a", "c", "extra", "submkt"], [("5", "t", "e", "m")])
    days = ["20240101", "20240102", "20240103"]
    assert missing_days(spark, root, days) == ["20240102"]
    df = scan_days(spark, root, days, columns=cols)
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "x", "p", "20240101"), ("2", "y", "q", "20240101"), ("3", "z", "r", "20240103")]
    assert [d for _, d in df.dtypes] == ["string"] * 4
    mixed = scan_days(spark, root, ["20240101", "20240104", "20240105"], columns=cols + ["submkt"])
    got = [tuple(r) for r in mixed.collect()]
    assert ("4", "w", "s", None, "20240104") in got
    assert ("5", None, "t", "m", "20240105") in got and len(got) == 4
    assert scan_days(spark, root, ["20240102"], columns=cols).count() == 0
    rng = scan_range(spark, root, "20240102", "20240103", columns=cols)
    assert [tuple(r) for r in rng.collect()] == [("3", "z", "r", "20240103")]
    report = day_report(spark, root, ["20240100", *days])
    assert [tuple(r) for r in report.collect()] == [
        ("20240100", False, None), ("20240101", True, "20240101"),
        ("20240102", False, "20240101"), ("20240103", True, "20240103")]


def test_hour_folders_on_some_days_and_swapped_headers_in_a_day(spark, tmp_path):
    root = str(tmp_path / "trc")
    _write_day(root, "20240101", ["a", "b"], [("a0", "b0")])
    _write_day(root, "20240102/UTC_hour=00", ["a", "b"], [("a1", "b1")])
    _write_day(root, "20240102/UTC_hour=01", ["b", "a"], [("b2", "a2")])
    df = scan_days(spark, root, ["20240101", "20240102"], columns=["a", "b"])
    assert df.columns == ["a", "b", "UTC_date"]
    assert sorted(tuple(r) for r in df.collect()) == [
        ("a0", "b0", "20240101"), ("a1", "b1", "20240102"), ("a2", "b2", "20240102")]
    one = read_day(spark, root, "20240102", columns=["b"])
    assert sorted(tuple(r) for r in one.collect()) == [("b1", "20240102"), ("b2", "20240102")]
    _write_day(root, "20240103", ["a", "a"], [("1", "2")])
    with pytest.raises(ValueError, match="named twice"):
        scan_days(spark, root, ["20240103"], columns=["a"])


def _small_files(root, days, per_day, header=lambda day, k: ["a", "b"]):
    for day in days:
        d = os.path.join(root, f"UTC_date={day}")
        os.makedirs(d, exist_ok=True)
        for k in range(per_day):
            names = header(day, k)
            with open(os.path.join(d, f"part-{k:05d}.csv"), "w") as f:
                f.write(",".join(names) + "\n" + ",".join(f"{n}{day}{k}" for n in names) + "\n")


def test_ten_thousand_small_files_with_some_swapped_headers(spark, tmp_path):
    root, days = str(tmp_path / "many"), [f"202401{d:02d}" for d in range(1, 11)]
    # day 4 holds both headers, day 7 the other one only
    _small_files(root, days, 1000, lambda day, k: ["b", "a"] if day == "20240107" or (
        day == "20240104" and k % 10 == 3) else ["a", "b"])
    for same in (False, True):
        if same:
            days = [d for d in days if d != "20240104"]
        df = scan_days(spark, root, days, columns=["a", "b"], same_in_folder=same)
        bad = df.where(~F.expr("a like 'a' || UTC_date || '%' and substr(a, 2) = substr(b, 2)"))
        assert df.count() == 1000 * len(days) == df.distinct().count() and bad.count() == 0


def test_gateway_calls_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    client = spark.sparkContext._gateway._gateway_client
    send, calls = client.send_command, []

    def counted(command, *args, **kwargs):
        if command.startswith("c\n"):  # a method call, not the release of an old object
            calls.append(command)
        return send(command, *args, **kwargs)

    monkeypatch.setattr(client, "send_command", counted)

    def cost(name, per_day, **options):
        root = str(tmp_path / name)
        _small_files(root, ["20240101", "20240102"], per_day,
                     lambda day, k: ["a", "b"] if day == "20240101" or k else ["b", "a"])
        calls.clear()
        days = ["20240101", "20240102"] if not options else ["20240101"]
        scan_days(spark, root, days, columns=["a", "b"], **options)
        return len(calls)

    cost("first", 3)  # class names are looked up once
    assert abs(cost("few", 3) - cost("more", 90)) <= 3
    assert abs(cost("few_same", 3, same_in_folder=True) - cost("more_same", 90, same_in_folder=True)) <= 3


def test_layouts_of_odd_folders(spark, tmp_path):
    root = str(tmp_path / "odd place")  # a blank in the path
    _write_day(root, "20240101", ["a", "b"], [("a1", "b1")])
    _write_day(root, "20240101/UTC_hour=05", ["a", "b"], [("a2", "b2")])  # files beside folders
    day = os.path.join(root, "UTC_date=20240102")
    os.makedirs(day)
    for name, text in (("x{1},[y].csv", "a,b\na3,b3\n"), ("x2.csv", "b,a\nb4,a4\n"),
                       ("_hidden.csv", "z\n1\n"), (".dot.csv", "z\n1\n"), ("empty.csv", ""),
                       ("bom.csv", "\ufeffa,b\na5,b5\n"), ("only_header.csv", "a,b\n")):
        with open(os.path.join(day, name), "w", encoding="utf-8") as f:
            f.write(text)
    with gzip.open(os.path.join(day, "z.csv.gz"), "wt") as f:
        f.write("b,a\nb6,a6\n")
    os.makedirs(os.path.join(root, "UTC_date=20240103"))  # a day without files
    df = scan_days(spark, root, ["20240101", "20240102", "20240103"], columns=["a", "b"])
    assert sorted(map(tuple, df.collect())) == [
        (f"a{k}", f"b{k}", "20240101" if k < 3 else "20240102") for k in range(1, 7)]
    assert scan_days(spark, root, ["20240103"], columns=["a"]).count() == 0
    assert scan_days(spark, root, ["20240103"], columns=["a"], same_in_folder=True).count() == 0


def test_sink_round_trips(spark):
    df = spark.range(100).select(
        F.col("id"), (F.col("id") / 3).alias("x"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("s"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(2), F.lit(3), F.lit(4),
                             F.col("id") / 1000 + 0.000001).alias("t"))
    schema = "id bigint, x double, s string, t timestamp_ntz"
    p = staging_path(spark, "t_parquet")
    write_parquet(df, p, files=3)
    assert spark.read.parquet(p).exceptAll(df).count() == 0
    for gz in (False, True):
        p = staging_path(spark, "t_csv")
        write_csv(df, p, files=2, gzip=gz)
        names = os.listdir(p)
        assert any(n.endswith(".csv.gz") for n in names) == gz
        back = read_csv(spark, p, schema)
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_preview_is_deterministic(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = [r.v for r in preview(df, 20, order_by=["v"]).collect()]
    assert got == list(range(20))


def test_json_alerts_lines_and_array(spark, tmp_path):
    recs = [dict(zip(ALERT_FIELDS, ["080001", "site_a", "region_1", "2023-11-13", "2023-11-08",
                                    "1", "10", "0", "vendor_a"])),
            dict(zip(ALERT_FIELDS, ["080002", "site_b", "region_2", "2023-11-13", "bad-day",
                                    "2", "x", "0", "vendor_b"]))]
    arr = tmp_path / "alerts.json"
    arr.write_text(json.dumps(recs))
    lines = tmp_path / "alerts.jsonl"
    lines.write_text("\n".join(json.dumps(r) for r in recs))
    a = read_alerts(spark, str(arr), multiline=True).orderBy("enodeb").collect()
    b = read_alerts(spark, str(lines)).orderBy("enodeb").collect()
    assert a == b
    assert a[0].abnormal_kpi_count == 1 and a[0].nrb_ticket_counts == 10
    assert str(a[0].alert_day) == "2023-11-13"
    assert a[1].event_day is None and a[1].nrb_ticket_counts is None


def test_broken_alert_lines(spark, tmp_path):
    good = json.dumps(dict(zip(ALERT_FIELDS, ["080001", "s", "r", "2023-11-13", "2023-11-08",
                                              "1", "10", "0", "v"])))
    path = tmp_path / "alerts.jsonl"
    path.write_text(good + "\n{broken\n" + good[:30] + "\n")
    kept = read_alerts(spark, str(path), keep_corrupt=True).collect()
    assert [r.corrupt_record for r in kept] == [None, "{broken", good[:30]]
    assert kept[0].enodeb == "080001" and kept[1].enodeb is None
    with pytest.raises(Exception, match="(?i)malformed"):
        read_alerts(spark, str(path)).collect()


def test_hours_of_a_listing(spark, tmp_path):
    root = str(tmp_path / "hours")
    for day in ("20240101/UTC_hour=00", "20240101/UTC_hour=23", "20240102", "20240103/UTC_hour=7", "20240103"):
        _write_day(root, day, ["a"], [("1",)])
    os.makedirs(os.path.join(root, "UTC_date=20240104", "UTC_hour=05"))
    with open(os.path.join(root, "UTC_date=20240101", "UTC_hour=23", "_SUCCESS"), "w") as f:
        f.write("x")
    rows = hour_report(spark, root, [f"2024010{d}" for d in range(1, 6)]).collect()
    by = {(r.day, r.hour): (r.state, r.n) for r in rows}
    assert len(rows) == len(by) == 24 + 1 + 25 + 1 + 1
    assert by["20240101", 23] == ("present", 4) and by["20240101", 22] == ("missing", 0)
    assert by["20240102", None] == ("no hour folders", 4)
    assert by["20240103", 7][0] == "present" and by["20240103", None][0] == "no hour folders"
    assert by["20240104", None] == by["20240105", None] == ("no data", 0)
    assert hour_report(spark, root, ["20300101"]).collect()[0].state == "no data"
