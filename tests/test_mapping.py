"""Config checks, value rules and transforms."""

import json
import warnings
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import logweave as lw
from logweave import mapping as mapping_module
from logweave import vendors
from logweave.functions import regexes, timestamps

TIME = {"target": "event_timestamp", "source": "t", "transform": "unix"}


def config(*fields, **more):
    return {"log_type": "x", "format": "kv", "fields": [TIME, *fields], **more}


@pytest.mark.parametrize("name", lw.LOG_TYPES)
def test_shipped_mappings_load(name):
    loaded = lw.vendor_mapping(name)
    assert loaded.log_type == name and loaded.fields
    assert lw.parse_mapping(json.dumps(vendors.config(name))) == loaded


@pytest.mark.parametrize("document, text", [
    ("{", "not valid JSON"),
    ("[]", "JSON object"),
    ({"format": "xml", "fields": [TIME]}, "unsupported format"),
    ({"format": "kv", "fields": []}, "no fields"),
    ({"format": "kv", "fields": [{"target": "src_ip", "source": "a"}]}, "no event_timestamp"),
    (config({"source": "a"}), "no target"),
    (config({"target": "event_uuid", "source": "a"}), "unknown target"),
    (config({"target": "src_ip", "source": "", "join": ["a"]}), "exclude"),
    (config({"target": "src_ip", "source": "a", "transform": "uper"}), "unknown transform"),
    (config({"target": "event_timestamp", "source": "a", "transform": "upper"}), "unknown transform"),
    (config({"target": "src_ip", "source": 5}), "list of strings"),
    (config(format="csv", delimiter="semicolon"), "delimiter"),
    (config(format="regex"), "at least one pattern"),
    (config(format="regex", patterns=[{"match": "(?P<a>x)(?P<a>y)"}]), "repeated"),
    (config(format="regex", patterns=[{"match": "a(?=b)"}]), "not supported"),
    (config(format="regex", patterns=[{"match": r"(a)\1"}]), "not supported"),
])
def test_bad_configs(document, text):
    with pytest.raises(lw.MappingError, match=text):
        lw.parse_mapping(document)


def test_bad_regex_is_found_before_reading(spark, tmp_path):
    (tmp_path / "f.log").write_text("x\n")
    bad = lw.parse_mapping(config(format="regex", patterns=[{"match": "(a"}]))
    with pytest.raises(lw.MappingError, match="pattern 0"):
        lw.ingest_network(spark, str(tmp_path), bad)


def test_load_mapping(spark, tmp_path):
    (tmp_path / "config").mkdir()
    (tmp_path / "config" / "x.json").write_text(json.dumps(config(), indent=2))
    assert lw.load_mapping(spark, str(tmp_path), "x") == lw.parse_mapping(config())


def test_template_warning_once(parse):
    mapping_module._warned.discard("x")
    document = config(template_warning="look first")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        parse(document, "t=0")
        parse(document, "t=0")
    assert ["look first" in str(w.message) for w in seen].count(True) == 1


def test_source_rules(parse):
    rows = parse(
        config(
            {"target": "rule_name", "source": ["", "a", "b"], "value_map": {"x": "X", "gone": ""}, "default": "x"},
            {"target": "action", "join": ["a", "none", "b"]},
            {"target": "log_type", "default": "compute/firewall", "transform": "gcp_log_name_id"},
            {"target": "direction", "source": "a"}, {"target": "direction", "source": "b"},
            {"target": "user_name", "source": "a", "transform": "url_decode"},
        ),
        "t=0,a=x,b=y", "t=0,a=,b=y", "t=0", "t=0,a=gone", "t=0,a=p+q%21", "t=0,a=%2", "a=1",
    )
    assert [r["rule_name"] for r in rows[:4]] == ["X", "y", "x", ""]
    assert [r["action"] for r in rows[:3]] == ["x:y", "y", ""]
    assert [r["direction"] for r in rows[:4]] == ["y", "y", "", "gone"]
    assert rows[0]["log_type"] == ""
    assert rows[4]["user_name"] == "p q!"
    assert rows[5]["error"].startswith("user_name: url_decode") and rows[6]["error"] == "event_timestamp: no value"


def test_integers(parse):
    values = {"12": 12, "+5": 5, "-3": -3, "1.5": 0, "0x10": 0, "9223372036854775807": 2**63 - 1,
              "9223372036854775808": 0, "1_000": 0, "": 0, "007": 7}
    rows = parse(config({"target": "src_port", "source": "p"}), *[f"t=0,p={v}" for v in values])
    assert [r["src_port"] for r in rows] == list(values.values())


def one(spark, value, transform):
    column = timestamps.parse(F.col("v"), transform)
    return spark.createDataFrame([(value,)], "v string").select(column.alias("t")).first().t


@pytest.mark.parametrize("transform, value, expected", [
    ("", "2025-01-02T03:04:05Z", datetime(2025, 1, 2, 3, 4, 5)),
    ("rfc3339", "2025-01-02T03:04:05.5-01:30", datetime(2025, 1, 2, 4, 34, 5, 500000)),
    ("rfc3339nano", "2025-01-02T03:04:05,123456789123Z", datetime(2025, 1, 2, 3, 4, 5, 123456)),
    ("rfc3339", "2025-01-02", None),
    ("rfc3339", "2025-01-02 03:04:05Z", None),
    ("rfc3339", "2025-02-30T03:04:05Z", None),
    ("rfc3339", "2025-01-02T24:04:05Z", None),
    ("unix", "1710000000", datetime(2024, 3, 9, 16, 0)),
    ("unix", "-1", datetime(1969, 12, 31, 23, 59, 59)),
    ("unix", " 1", None),
    ("unix", "9223372036854775807", None),
    ("unix_ms", "1710000000123", datetime(2024, 3, 9, 16, 0, 0, 123000)),
    ("unix_ms", "x", None),
    ("aws_suricata", "2025-01-02T03:04:05.000001+0900", datetime(2025, 1, 1, 18, 4, 5, 1)),
    ("aws_suricata", "2025-01-02T03:04:05+0000", datetime(2025, 1, 2, 3, 4, 5)),
    ("aws_suricata", "2025-01-02T03:04:05Z", None),
    ("auto", "60", datetime(1970, 1, 1, 0, 1)),
    ("auto", "2025/01/02  03:04:05.25", datetime(2025, 1, 2, 3, 4, 5, 250000)),
    ("auto", "2025-01-02 3:04:05", datetime(2025, 1, 2, 3, 4, 5)),
    ("auto", "Jan 2 2025", None),
    ("layout:Jan 2 2006 15:04:05", "jul    5 2024 01:02:03", datetime(2024, 7, 5, 1, 2, 3)),
    ("layout:Jan 2 2006 15:04:05", "Jul 32 2024 01:02:03", None),
    ("layout:Jan 2 2006 15:04:05", "July 5 2024 01:02:03", None),
    ("layout:Monday, January _2 06 3:04PM", "Friday, July  5 24 12:07AM", datetime(2024, 7, 5, 0, 7)),
    ("layout:02/01/2006 15:04:05 -07:00", "05/07/2024 01:02:03 +02:00", datetime(2024, 7, 4, 23, 2, 3)),
    ("layout:2006-002T15:04:05.000Z0700", "2024-060T01:02:03.004Z", datetime(2024, 2, 29, 1, 2, 3, 4000)),
    ("layout:2006-002", "2023-366", None),
    ("layout:2006-01-02 15:04:05 MST", "2024-07-05 01:02:03 UTC", datetime(2024, 7, 5, 1, 2, 3)),
])
def test_timestamps(spark, transform, value, expected):
    assert one(spark, value, transform) == expected


@pytest.mark.parametrize("pattern, java", [
    (r"(?P<a_b>\d+)", r"(\d+)"),
    (r"[\s.]\s", r"[\t\n\f\r .][\t\n\f\r ]"),
    (r"[[:alpha:][&&]", r"[\p{Alpha}\[\&\&]"),
    (r"[]a]", r"[\]a]"),
    (r"(?i:x)(?s-i)", r"(?iu:x)(?s-iu)"),
    (r"\Qa.b\E", r"a\.b"),
])
def test_regex_dialect(pattern, java):
    assert regexes.to_java(pattern).text == java
