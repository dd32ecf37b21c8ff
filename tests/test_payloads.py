import datetime
import json
from pathlib import Path

import pytest

from heliovane import session
from heliovane.plans import queries
from heliovane.schema import OBSERVATION_SCHEMA, VARIABLES
from heliovane.sources.payloads import ingest, ingest_with_problems, mapping_of, parse_payloads, payload_status, scan_payloads


def document(**parameters):
    return json.dumps({"properties": {"parameter": parameters}})


def rows(spark, *payloads, **options):
    table = spark.createDataFrame(list(enumerate(payloads)), "point_id BIGINT, payload STRING")
    return parse_payloads(table, **options).orderBy("point_id", "date").collect()


def test_reads_variables_by_date(spark):
    found = rows(
        spark,
        document(
            WS10M={"19991231": 0.5, "20000229": 17.25, "20000301": 3.0},
            ALLSKY_SFC_SW_DWN={"19991231": 311.0, "20000229": 0.0, "20000301": 87.5},
            WS50M={"19991231": 9.0, "20000229": 8.0, "20000301": 7.0},
        ),
    )
    assert [r["date"].isoformat() for r in found] == ["1999-12-31", "2000-02-29", "2000-03-01"]
    assert [(r["sw_dwn"], r["ws_50m"], r["ws_100m"]) for r in found] == [(311.0, 9.0, 0.5), (0.0, 8.0, 17.25), (87.5, 7.0, 3.0)]
    assert {(r["dni"], r["t2m"]) for r in found} == {(None, None)}


def test_schema_holds_all_variables(spark):
    table = spark.createDataFrame([(1, "{}")], "point_id BIGINT, payload STRING")
    parsed = parse_payloads(table)
    assert parsed.columns == ["point_id", "date", *VARIABLES]
    assert [f.dataType for f in parsed.schema] == [f.dataType for f in OBSERVATION_SCHEMA]


def test_unusable_payloads_give_no_rows(spark):
    bad = ["{}", "no json", "", None, '{"properties": null}', '{"properties": {"parameter": {}}}']
    bad.append(document(WS50M={"20200101": 1.0}))
    assert rows(spark, *bad) == []


def test_fill_text_and_missing_values(spark):
    found = rows(
        spark,
        document(
            ALLSKY_SFC_SW_DWN={"20200101": -999, "20200102": -999.0, "20200103": "7.5", "20200104": "n/a"},
            ALLSKY_SFC_SW_DNI={"20200102": 3, "20200104": "-999"},
            WS50M={"20200104": 4, "20200103": 3, "20200102": 2, "20200101": 1},
        ),
    )
    assert [r["sw_dwn"] for r in found] == [None, None, 7.5, None]
    assert [r["dni"] for r in found] == [None, 3.0, None, None]
    assert [r["ws_50m"] for r in found] == [1.0, 2.0, 3.0, 4.0]


def test_date_keys(spark):
    keys = {"20200101": 1, "2020010299": 2, "2020013": 3, "20201301": 4, "2020": 5, "x": 6, "20200230": 7}
    found = rows(spark, document(ALLSKY_SFC_SW_DWN=keys))
    assert [(str(r["date"]), r["sw_dwn"]) for r in found] == [
        ("2020-01-01", 1.0), ("2020-01-02", 2.0), ("2020-01-03", 3.0),
    ]


def test_repeated_date_keeps_the_last_value(spark):
    inner = '{"20200101": 1, "20200102": 2, "20200101": 3}'
    text = '{"properties": {"parameter": {"ALLSKY_SFC_SW_DWN": %s, "WS50M": %s}}}' % (inner, inner)
    found = rows(spark, text)
    want = json.loads(text)["properties"]["parameter"]["WS50M"]
    assert [(r["sw_dwn"], r["ws_50m"]) for r in found] == [(v, v) for v in (want["20200101"], want["20200102"])]


def test_gaps_in_a_long_payload(spark):
    days = [(datetime.date(2000, 1, 1) + datetime.timedelta(i)).strftime("%Y%m%d") for i in range(1000)]
    base = {d: float(i) for i, d in enumerate(days)}
    wind = {d: v for d, v in base.items() if v % 3}
    found = rows(spark, document(ALLSKY_SFC_SW_DWN=base, WS50M=dict(reversed(wind.items())), WS10M={"19991231": 1.0}))
    assert [r["sw_dwn"] for r in found] == list(base.values())
    assert [r["ws_50m"] for r in found] == [wind.get(d) for d in days]
    assert {r["ws_100m"] for r in found} == {None}


def test_dates_of_any_parameter(spark):
    text = document(ALLSKY_SFC_SW_DWN={"20200101": 1}, WS50M={"20200102": 2})
    assert len(rows(spark, text)) == 1
    assert [(r["sw_dwn"], r["ws_50m"]) for r in rows(spark, text, date_source="any")] == [(1.0, None), (None, 2.0)]


def test_one_file_per_point(spark, tmp_path):
    for point in (3, 12):
        (tmp_path / f"point_{point}.json").write_text(
            json.dumps({"properties": {"parameter": {"ALLSKY_SFC_SW_DWN": {"20200101": point}}}}, indent=2)
        )
    (tmp_path / "point_99.json").write_text("<html>busy</html>")
    found = ingest(spark, str(tmp_path), name_pattern=r"(\d+)").orderBy("point_id").collect()
    assert [(r["point_id"], r["sw_dwn"]) for r in found] == [(3, 3.0), (12, 12.0)]


def test_one_line_per_payload_in_point_folders(spark, tmp_path):
    table = spark.createDataFrame(
        [(i % 3, document(ALLSKY_SFC_SW_DWN={f"2020010{i}": i})) for i in range(1, 7)], "point_id BIGINT, payload STRING"
    )
    table.write.partitionBy("point_id").text(str(tmp_path / "landed"))
    found = ingest(spark, str(tmp_path / "landed"), "lines").orderBy("sw_dwn").collect()
    assert [(r["point_id"], r["sw_dwn"]) for r in found] == [(i % 3, float(i)) for i in range(1, 7)]


def test_points_of_text_files(spark, tmp_path):
    text = document(ALLSKY_SFC_SW_DWN={"20100601": 1.0})
    for name in ("v2_point_17.json", "v2_point_18.json"):
        (tmp_path / name).write_text(text)
    found = scan_payloads(spark, str(tmp_path), name_pattern=r"point_(\d+)\.json").collect()
    assert sorted(r["point_id"] for r in found) == [17, 18]
    with pytest.raises(ValueError, match="name_pattern"):
        scan_payloads(spark, str(tmp_path))
    with pytest.raises(Exception, match="no point number"):
        scan_payloads(spark, str(tmp_path), name_pattern=r"place_(\d+)").collect()


def test_only_wanted_parameters_are_parsed(spark):
    table = spark.createDataFrame([(1, document(ALLSKY_SFC_SW_DWN={"20100601": 1.0}, T2M={"20100601": 9.0}))], "point_id BIGINT, payload STRING")
    parsed = parse_payloads(table, columns=mapping_of(["sw_dwn", "ws_50m"]))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "WS50M" in plan and "T2M" not in plan and parsed.columns == ["point_id", "date", "sw_dwn", "ws_50m"]


def reasons(spark, *payloads, **options):
    table = spark.createDataFrame(list(enumerate(payloads)), "point_id BIGINT, payload STRING")
    return [tuple(r)[1:] for r in payload_status(table, **options).orderBy("point_id").collect()]


def test_every_unusable_payload_has_a_reason(spark):
    good = document(ALLSKY_SFC_SW_DWN={"20200101": 1.0})
    cases = {
        good: None,
        document(ALLSKY_SFC_SW_DWN={"20200101": 1.0, "2020xx01": 2.0}): "some invalid dates",
        document(ALLSKY_SFC_SW_DWN={"never": 1.0}): "no valid date",
        document(ALLSKY_SFC_SW_DWN={}): "no dates",
        document(WS50M={"20200101": 1.0}): "no dates",
        "{}": "no parameters",
        '{"properties": null}': "no parameters",
        '{"properties": 5}': "unreadable",
        good[:-3]: "unreadable",
        "[1]": "unreadable",
        "no json": "unreadable",
        "": "empty",
        " \n": "empty",
        None: "empty",
    }
    assert [r[2] for r in reasons(spark, *cases)] == list(cases.values())
    gives_rows = {r["point_id"] for r in rows(spark, *cases)}
    told = list(cases.values())
    assert gives_rows == {i for i, reason in enumerate(told) if reason in (None, "some invalid dates")}


def test_status_counts_dates_of_any_parameter(spark):
    payload = document(ALLSKY_SFC_SW_DWN={"20200101": 1.0, "x": 2.0}, WS50M={"20200102": 1.0, "20200101": 0.0})
    assert reasons(spark, payload) == [(2, 1, "some invalid dates")]
    assert reasons(spark, payload, date_source="any") == [(3, 1, "some invalid dates")]
    with pytest.raises(ValueError):
        reasons(spark, payload, date_source="all")


def test_no_payloads_have_no_status(spark):
    assert reasons(spark) == []


def test_odd_files_do_not_stop_the_others(spark, tmp_path):
    good = document(ALLSKY_SFC_SW_DWN={"20200101": 1.0})
    for name, text in {"point_7.json": good, "point_8.json": "{", "readme.json": good, "point_9.json": " "}.items():
        (tmp_path / name).write_text(text)
    read, problems = ingest_with_problems(spark, str(tmp_path), name_pattern=r"point_(\d+)")
    assert [r["point_id"] for r in read.collect()] == [7]
    found = {(r["point_id"], r["file"], r["reason"]) for r in problems.collect()}
    assert found == {(9, "point_9.json", "empty"), (8, "point_8.json", "unreadable"), (None, "readme.json", "no point")}
    with pytest.raises(Exception, match="no point number in file name"):
        ingest(spark, str(tmp_path), name_pattern=r"point_(\d+)").collect()


def test_a_points_lines_are_landed_as_one_file(spark, conf, tmp_path):
    """A folder's files do not multiply with the tasks that hold the years of its point."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    items = [(i, i % 5, i % 7 + 1, 1.0 + i, 2000.0 + i, 0.01, datetime.datetime(1992 + i % 6, 1 + i % 12, 3)) for i in range(600)]
    kinds = "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ"
    spark.createDataFrame(items, kinds).write.parquet(str(tmp_path / "lineitem.parquet"))
    shared = Path(session.shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("lines-*"))
    found = queries.ingest_lines(spark, str(tmp_path))
    (landed,) = set(shared.glob("lines-*")) - before
    assert {f.name: len(list(f.glob("*.txt"))) for f in landed.glob("point_id=*")} == {f"point_id={i}": 1 for i in range(5)}
    assert {(r["point_id"], r["date"]) for r in found.collect()} == {(i[1], i[6].date()) for i in items}
