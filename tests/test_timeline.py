"""Timeline rows, correlation queries."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import logweave as lw
from logweave.functions.variants import parse_one, with_leaves
from logweave.plans import commits, correlate, rebuild, sinks
from logweave.plans.timeline import ingest_timeline, parse_timeline
from logweave.schemas import NETWORK_EVENTS, TIMELINE_EVENTS

ROOT = "/mnt/case/in"


@pytest.fixture
def rows(lines):
    def run(*texts, **kw):
        parsed = parse_timeline(lines(*texts), ROOT + "/", **kw)
        return [r.asDict() for r in parsed.rows.orderBy("seq").collect()]

    return run


@pytest.mark.parametrize("display, device, path", [
    (f"OS:{ROOT}/PC7/C/Temp/a b.txt", "PC7", "C/Temp/a b.txt"),
    (f"OS:{ROOT}/PC7", "PC7", f"OS:{ROOT}/PC7"),
    (f"OS:{ROOT}/PC7/", "PC7", f"OS:{ROOT}/PC7/"),
    (f"OS:{ROOT}", "unknown", f"OS:{ROOT}"),
    (f"OS:{ROOT}//x", "unknown", f"OS:{ROOT}//x"),
    ("OS:/else/where", "unknown", "OS:/else/where"),
    (f"{ROOT}/A{ROOT}/B/c", "A", f"{ROOT[1:]}/B/c"),
])
def test_device_and_path(rows, display, device, path):
    (row,) = rows(json.dumps({"display_name": display}))
    assert (row["device_name"], row["display_name"]) == (device, path)


def test_event_time(rows):
    got = rows(
        '{"timestamp": 1735787045123456}', '{"timestamp": "1735787045123456"}', '{"timestamp": 1.735787045e15}',
        '{"timestamp": true}', '{}', '{"timestamp": "soon"}', '{"timestamp": null}',
    )
    assert [r["event_timestamp"] for r in got] == [
        datetime(2025, 1, 2, 3, 4, 5, 123456), datetime(2025, 1, 2, 3, 4, 5, 123456), datetime(2025, 1, 2, 3, 4, 5),
        None, None, None, None]
    assert all(r["error"] is None and r["device_name"] == "unknown" for r in got)


def test_identifier(rows):
    got = rows('{"event_identifier": 4624}', '{"event_identifier": "4625"}', '{"event_identifier": 7.9}', "{}",
               '{"event_identifier": null}', '{"event_identifier": "abc"}', '{"event_identifier": true}',
               '{"event_identifier": {"a": 1}}')
    assert [r["event_identifier"] for r in got[:5]] == [4624, 4625, 7, None, None]
    assert [r["error"] is not None for r in got] == [False] * 5 + [True] * 3


def test_whole_numbers_that_a_double_holds_are_read_once(spark):
    frame = spark.createDataFrame(
        [('{"t": 1735787045123456, "u": 0.5}',), ('{"t": -8999999999999999}',), ('{"t": 9007199254740993}',)], "line string"
    ).coalesce(1).select(parse_one(F.col("line")).alias("doc"))
    got = with_leaves(frame, "doc", {"t": "t", "u": "u"}).collect()
    assert [(r["t"], r["t_doubt"]) for r in got] == [
        ("1735787045123456", False), ("-8999999999999999", False), ("9007199254740992", True)]
    assert [r["u"] for r in got] == ["0.5", None, None]


def test_accepted_rows_do_not_put_the_whole_event_together_again(lines):
    """``raw`` is for those who ask for it; to tell an object from other values takes its first letter."""
    plan = parse_timeline(lines('{"message": "m"}'), ROOT).events._jdf.queryExecution().optimizedPlan().toString()
    assert " AS doc#" in plan and " AS raw#" not in plan


def test_integers_as_numbers_and_as_texts(rows):
    got = rows(*[f'{{"event_identifier": {x}, "timestamp": {x}}}' for x in (
        '"007"', '"+7"', "-7", "-0.0", "1e3", '"1e3"', "123456789012345678", '"123456789012345678"', "true", '""', '"[7]"', "[7]")])
    assert [r["event_identifier"] for r in got] == [
        7, 7, -7, 0, 1000, None, 123456789012345680, 123456789012345678, None, None, None, None]
    assert [(r["error"] or "").startswith("event_identifier") for r in got] == [
        False, False, False, False, False, True, False, False, True, True, True, True]
    day = datetime(1970, 1, 1)
    micros = [None if r["event_timestamp"] is None else round((r["event_timestamp"] - day).total_seconds() * 1e6) for r in got[:6]]
    assert micros == [7, 7, -7, 0, 1000, None]


def test_a_number_is_no_path_below_a_root_of_digits(lines):
    parsed = parse_timeline(lines('{"display_name": 5077}', '{"display_name": "5077"}', '  {"display_name": "x"}', ' [1]'), "50")
    got = parsed.rows.orderBy("seq").collect()
    assert [r["device_name"] for r in got] == ["unknown", "77", "unknown", "unknown"]
    assert [r["error"] for r in got] == [None, None, None, "not a JSON object"]


def test_tags_and_bad_rows(rows):
    got = rows('{"tag": ["a", "b"]}', '{"tag": {"labels": []}}', '{"tag": null}', '{"message": {"x": 1}}', "[1]", "{",
               '{"message": "m", "message": "last"}', '{"tag": []}', '{"message": 5}', "   ")
    assert len(got) == 9
    assert got[0]["tag"] == ["a", "b"] and got[6]["message"] == "last" and got[8]["message"] == "5"
    assert [r["error"] for r in got] == [
        None, "tag: not a list of strings", None, "message: not a scalar", "not a JSON object", "invalid JSON",
        None, None, None]


def test_hash_and_size(rows):
    line = '{"message": "x"} '
    got = rows(line + "\r", '{"message": "%s"}' % ("y" * 200), max_line_bytes=100)
    assert got[0]["event_uuid"] == hashlib.sha256(line.encode()).hexdigest()
    assert got[1]["error"] == "line exceeds 100 byte limit"


def test_jsonl_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "raw.jsonl").write_text(
        '{"timestamp": 1735787045000001, "display_name": "OS:/mnt/case/in/PC1/C/x", "extra": {"k": [1, "z"]}, '
        '"event_identifier": 4624}\n\n' + '{"message": "%s"}\n' % ("z" * 11_000_000))
    parsed = ingest_timeline(spark, str(tmp_path / "in"), ROOT)
    out, errors = sinks.write_timeline_jsonl(parsed, str(tmp_path), "c1", "20250102T030405Z")
    assert out.endswith("c1-timeline-20250102T030405Z.jsonl")
    (doc,) = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert doc == {
        "event_timestamp": "2025-01-02T03:04:05.000001Z", "display_name": "C/x", "device_name": "PC1",
        "extra": {"k": [1, "z"]}, "event_identifier": "4624", "event_uuid": doc["event_uuid"]}
    (skipped,) = spark.read.json(errors).collect()
    assert (skipped.line_number, skipped.reason) == (3, "line exceeds 10485760 byte limit")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        ingest_timeline(spark, str(tmp_path / "none"), ROOT)


def timeline(spark, *rows):
    base = dict.fromkeys(TIMELINE_EVENTS.fieldNames())
    return spark.createDataFrame([{**base, "device_name": "D", **r} for r in rows], TIMELINE_EVENTS)


def network(spark, *rows):
    base = dict.fromkeys(NETWORK_EVENTS.fieldNames())
    return spark.createDataFrame([{**base, **r} for r in rows], NETWORK_EVENTS)


AT = datetime(2026, 9, 2, 20, 0)


def test_nexus_events(spark):
    net = network(
        spark, {"event_timestamp": AT, "log_type": "t", "threat_name": "", "action": "deny", "dst_port": 5},
        {"event_timestamp": AT, "threat_name": None, "action": "deny"})
    tl = timeline(spark, {"event_timestamp": AT, "parser": None, "message": None},
                  {"event_timestamp": None, "message": "dropped"}, {"event_timestamp": AT, "parser": "p", "message": "m"})
    got = correlate.nexus_events(net, tl).collect()
    assert sorted(r.summary_detail for r in got) == [": deny", "[p] m", "[unknown] ", "t: "]
    assert {r.local_datetime for r in got} == {datetime(2026, 9, 3, 5, 0)}
    assert {r.log_source for r in got} == {"network", "endpoint"}
    assert dict(correlate.nexus_events(net, tl, "UTC").dtypes)["local_datetime"] == "timestamp_ntz"


def logon(kind, items, **more):
    text = "[x] Strings: [" + ", ".join(f"'{i}'" for i in items) + "] end"
    return {"event_timestamp": AT, "data_type": "windows:evtx:record", "event_identifier": kind, "message": text, **more}


def test_logon_nexus(spark):
    tl = timeline(
        spark, logon(4624, range(27)), logon(4625, range(21)), logon(4624, ["a", "b"]), logon(4634, range(27)),
        logon(4624, ["", "", "", "", "", "u]v"]), logon(4624, range(27), event_timestamp=datetime(2026, 8, 1)),
        logon(4624, range(27), event_timestamp=None), logon(4624, range(27), data_type="other"),
        {**logon(4624, []), "message": "no list"}, {**logon(4624, []), "message": None})
    net = network(spark, {"event_timestamp": AT, "src_ip": "1.1.1.1", "dst_ip": "2.2.2.2", "user_name": ""})
    got = correlate.logon_nexus(net, tl, "2026-09-01 00:00:00").select(
        "src_ip", "src_name", "dst_ip", "dst_name", "user_name").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        ("18", "11", None, "D", "5"), ("19", "13", None, "D", "5"), (None, None, None, "D", None),
        (None, None, None, "D", None), (None, None, None, "D", None), ("1.1.1.1", None, "2.2.2.2", None, "")], key=repr)


def test_logons_come_from_one_scan(spark, tmp_path):
    timeline(spark, logon(4624, range(27))).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = correlate.logon_nexus(network(spark), table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "PushedFilters: [IsNotNull(data_type), EqualTo(data_type,windows:evtx:record)" in plan


def test_times_out_of_range_are_errors(lines):
    parsed = parse_timeline(lines('{"timestamp": 9999999999999999999, "message": "m"}', '{"timestamp": 999999999999999999, "message": "m"}', '{"timestamp": 1, "message": "m"}', '{"message": "m"}'), "/mnt")
    assert [r.error for r in parsed.rows.orderBy("block", "seq").collect()][1:] == ["timestamp: outside years 1 to 9999", None, None]


def test_rebuild_by_days(spark, lines, tmp_path):
    """Only days that commits name are computed; the table equals a full rebuild after each step."""
    net, tl, table = (str(tmp_path / n) for n in ("net", "tl", "logons"))
    mapping = lw.parse_mapping({"log_type": "demo", "format": "kv", "fields": [
        {"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "src_ip", "source": "id"}]})
    flows = lambda *at: lw.parse_network(lines(*[f"t={86400 * d + 5},id={d}" for d in at]), mapping)
    strings = ", ".join(f"'s{i}'" for i in range(27))

    def logons(*at):
        return parse_timeline(lines(*[json.dumps({
            **({} if d is None else {"timestamp": (86400 * d + 7) * 1_000_000}), "data_type": "windows:evtx:record", "event_identifier": 4624,
            "message": f"{d} Strings: [{strings}]"}) for d in at]), ROOT)

    def full(since=None):
        rows = correlate.logon_nexus(sinks.scan_network(spark, net), sinks.scan_timeline(spark, tl), since=since)
        return sorted(map(repr, rows.collect()))

    held = lambda: sorted(map(repr, rebuild.scan_logons(spark, table).collect()))
    sinks.write_parsed(flows(0, 1, 2), net, run="a")
    sinks.write_parsed(logons(1, 3, None), tl, run="a")
    day = lambda *n: [f"1970-01-{1 + x:02d}" for x in n]
    assert rebuild.rebuild_logons(spark, net, tl, table) == day(0, 1, 2, 3) + [commits.NO_DAY]
    assert held() == full() and len(held()) == 6
    assert rebuild.rebuild_logons(spark, net, tl, table) == []
    sinks.write_parsed(flows(2, 9), net, run="b")
    assert rebuild.rebuild_logons(spark, net, tl, table) == day(2, 9) and held() == full()
    # A replaced run changes the days that it had and the days that it has; one of them is empty now.
    sinks.write_parsed(flows(1, 5), net, run="a")
    assert rebuild.rebuild_logons(spark, net, tl, table) == day(0, 1, 2, 5) and held() == full()
    # A moved bound.
    assert rebuild.rebuild_logons(spark, net, tl, table, since="1970-01-03 00:00:00") == sorted(
        {d for p in (net, tl) for r in commits.parts(spark, p).collect() for d in r.days if d == commits.NO_DAY or d <= "1970-01-03"})
    assert held() == full("1970-01-03 00:00:00")
    rebuild.rebuild_logons(spark, net, tl, table, since="1970-01-03 00:00:00", whole=True)
    assert held() == full("1970-01-03 00:00:00")
    plan = sinks.scan_network(spark, net, days=["1970-01-03"])._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
