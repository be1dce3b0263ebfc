"""Vendor formats: one record each, then the rules that are easy to get wrong."""

import gzip
import hashlib
import json
import random
from datetime import datetime

import pytest

import logweave as lw


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def kv(delimiter="comma", *fields):
    return {
        "log_type": "t", "format": "kv", "delimiter": delimiter,
        "fields": [{"target": "event_timestamp", "source": "t", "transform": "unix"}, *fields],
    }


def test_fortigate(parse):
    line = ('itime=1710000000,devname="EDGE-7",type="utm",subtype="virus",action="blocked",policyid="12",'
            'srcip=192.0.2.7,srcport=4242,dstip=198.51.100.9,dstport=25,proto=17,vd="root",dstintf="wan1",'
            'user="",unauthuser="bo",sentbyte=10,rcvdbyte=-1')
    (row,) = parse("fortigate", "  " + line + "\t")
    assert row["error"] is None
    assert row["event_timestamp"] == datetime(2024, 3, 9, 16, 0)
    assert (row["device_name"], row["log_type"], row["protocol"]) == ("EDGE-7", "utm:virus", "UDP")
    assert (row["src_port"], row["dst_port"], row["ing_if"]) == (4242, 25, "root")
    assert (row["user_name"], row["sent_bytes"], row["rcvd_bytes"]) == ("bo", 10, -1)
    assert (row["direction"], row["nat_src_port"]) == ("", 0)
    assert row["event_uuid"] == sha(line)


def test_checkpoint(parse):
    (row,) = parse("checkpoint", 'time=1710000000 product="Gate & Co  1" i/f_dir="outbound" proto="udp" '
                                 'src="192.0.2.1" service="53" rule_uid="{u-1}" bytes="77"')
    assert row["error"] is None and row["device_name"] == "Gate & Co  1"
    assert (row["direction"], row["dst_port"], row["protocol"], row["sent_bytes"]) == ("outbound", 53, "UDP", 77)


def test_paloalto_and_generic_csv(parse):
    rows = parse(
        "paloalto",
        "Receive Time,SOURCE ADDRESS,Source Port,IP Protocol,Bytes Sent,Threat Category",
        "2025/02/03 04:05:06,192.0.2.3,1234,tcp,55,scan",
    )
    assert [(r["src_ip"], r["src_port"], r["protocol"], r["sent_bytes"], r["threat_name"]) for r in rows] == [
        ("192.0.2.3", 1234, "TCP", 55, "scan")]
    assert rows[0]["event_timestamp"] == datetime(2025, 2, 3, 4, 5, 6)
    rows = parse("generic_csv", "datetime,source_ip,traffic_direction", "1710000000,192.0.2.4,In")
    assert (rows[0]["src_ip"], rows[0]["direction"]) == ("192.0.2.4", "In")


def test_vpc_flow(parse):
    (row,) = parse("aws_vpc_flow", "2 1 eni-9 10.0.0.1 10.0.0.2 1000 22 6 3 400 1710000000 1710000060 REJECT OK")
    assert (row["device_name"], row["protocol"], row["sent_bytes"], row["action"]) == ("eni-9", "TCP", 400, "REJECT")


def test_asa(parse):
    rows = parse(
        "cisco_asa",
        "Feb  3 2025 04:05:06 gw %ASA-4-106100: access-list OUT denied udp dmz/192.0.2.5(99) -> lan/10.1.1.1(53) x",
        "Feb 3 2025 04:05:06 gw %ASA-6-302014: Teardown TCP connection 5 for wan:192.0.2.6/443 to lan:10.1.1.2/5000",
        "Feb 3 2025 04:05:06 gw %ASA-6-999999: something else",
    )
    assert (rows[0]["action"], rows[0]["rule_name"], rows[0]["log_type"], rows[0]["protocol"]) == (
        "Deny", "OUT", "access-list", "UDP")
    assert (rows[1]["action"], rows[1]["direction"], rows[1]["log_type"], rows[1]["src_port"]) == (
        "Teardown", "", "connection", 443)
    assert rows[2]["error"].startswith("line matches none")


GOOGLE = {
    "logName": "projects/prj/logs/a%2Fb", "receiveTimestamp": "2025-01-02T03:04:05.678901234Z",
    "jsonPayload": {"connection": {"src_ip": "192.0.2.8", "src_port": 6.0, "protocol": 1},
                    "rule_details": {"action": True, "reference": ["no leaf"]}},
}


def test_google_one_line_and_pretty(parse):
    compact, pretty = json.dumps(GOOGLE), json.dumps(GOOGLE, indent=2)
    (one,) = parse("google", compact)
    (many,) = parse("google", *pretty.split("\n"))
    for row in (one, many):
        assert row["error"] is None
        assert row["event_timestamp"] == datetime(2025, 1, 2, 3, 4, 5, 678901)
        assert (row["device_name"], row["log_type"], row["src_port"]) == ("prj", "a/b", 6)
        assert (row["protocol"], row["action"], row["rule_name"]) == ("ICMP", "true", "")
    assert (one["event_uuid"], many["event_uuid"]) == (sha(compact), sha(pretty))


def test_azure_shapes(parse):
    record = '{"time":"2025-01-02T03:04:05+09:00", "resourceId":"/a/fw1", "properties":{"msg":"Deny"}}'
    rows = parse("azure", '{"records":[%s , %s]}' % (record, record), "[%s]" % record, '{"records":%s}' % record,
                 '{"other":1}', '{"records":null}', "7")
    good = [r for r in rows if r["error"] is None]
    assert len(good) == 4 and {r["event_uuid"] for r in good} == {sha(record)}
    assert good[0]["event_timestamp"] == datetime(2025, 1, 1, 18, 4, 5)
    assert (good[0]["device_name"], good[0]["action"]) == ("fw1", "Deny")
    bad = [r["error"] for r in rows if r["error"]]
    assert len(bad) == 2 and "not found" in bad[0] and bad[1].startswith("event_timestamp")


def test_broken_json_keeps_good_lines(parse):
    good = '{"timestamp":"2025-01-02T03:04:05Z"}'
    rows = parse("google", good, '{"timestamp": {"cut off"', good, good)
    assert [r["error"] is None for r in rows].count(True) == 3
    assert [r["raw_line"] for r in rows if r["error"]] == ['{"timestamp": {"cut off"']
    rows = parse("google", good + good + " " + good, "nonsense", multiline=False)
    assert [r["error"] is None for r in rows].count(True) == 3


def test_failfast(lines):
    good, row_error, broken = '{"timestamp":"2025-01-02T03:04:05Z"}', '{"timestamp":"x"}', '{"timestamp":'
    google = lw.vendor_mapping("google")
    parsed = lw.parse_network(lines(good, row_error), google, lw.Options(multiline=False)).failfast()
    assert (parsed.events.count(), parsed.quarantine().count()) == (1, 1)
    with pytest.raises(Exception, match="invalid JSON"):
        lw.parse_network(lines(good, broken), google, lw.Options(multiline=False)).failfast().events.collect()


def test_one_json_record_per_line(parse):
    rows = parse("google", '{"timestamp":"2025-01-02T03:04:05Z"}', '{"a":', one_per_line=True)
    assert [r["error"] for r in rows] == [None, "invalid JSON"]


def test_json_numbers(parse):
    mapping = {"log_type": "n", "format": "json", "fields": [
        {"target": "event_timestamp", "default": "0", "transform": "unix"}, {"target": "rule_id", "source": "a.n"}]}
    numbers = {"1e3": "1000", "6.0": "6", "1.50": "1.5", "9007199254740993": "9007199254740992", "1e-7": "0.0000001",
               "12345678901234567890": "12345678901234567000", "-0.25": "-0.25", "1.5e21": "1500000000000000000000",
               '"1e3"': "1e3", '"6.0"': "6.0", '"{x"': "{x", "null": "", "{}": "", "[1]": "", "false": "false", '""': ""}
    rows = parse(mapping, *['{"a":{"n":%s}}' % n for n in numbers], one_per_line=True)
    assert [r["rule_id"] for r in rows] == list(numbers.values())
    (row,) = parse(mapping, '{"a":{"n":1},"a":{"n":2}}', one_per_line=True)
    assert row["rule_id"] == "2"


def test_comma_kv_quotes(parse):
    mapping = kv("comma", {"target": "device_name", "source": "name"}, {"target": "action", "source": "act"})
    rows = parse(
        mapping,
        't=0,name="F,G",act=x',           # the quote is not at the field's start: ends at the comma
        '"name=F,G",act=x,t=0',           # it is: the comma is protected
        't=0,name=a,name="b",act',        # last key wins; a field without = is dropped
        ' t = 0 , name =  " b " ,act="y"',
        ',t=0,name=a=b,act=""',
        't=0,name=1,name',
        't=0,"name=say ""hi""",act=x',
        't=0,name=,act=z,name= ',
    )
    assert all(r["error"] is None for r in rows)
    assert [(r["device_name"], r["action"]) for r in rows] == [
        ("F", "x"), ("F,G", "x"), ("b", ""), (" b ", "y"), ("a=b", ""), ("1", ""), ('say "hi', "x"), ("", "z")]


def test_space_kv_quotes(parse):
    mapping = kv("space", {"target": "device_name", "source": "my name"}, {"target": "action", "source": "act"})
    rows = parse(mapping, 't=0 "my name"="a b"  act="x=y z', 't=0 act=a\tb act', "t=0 act=x=y=z")
    assert [(r["device_name"], r["action"]) for r in rows] == [("a b", "x=y z"), ("", ""), ("", "x=y=z")]


def test_long_values_do_not_overflow(parse):
    long = "x" * 300_000
    mapping = kv("space", {"target": "device_name", "source": "n"})
    (row,) = parse(mapping, f't=0 n="{long} {long}"')
    assert len(row["device_name"]) == 600_001
    rows = parse(kv("comma", {"target": "device_name", "source": "n"}), f'"n={long}",t=0', f"t=0,n={long}",
                 "t=0,n=" + "y" * (1 << 20))
    assert [len(r["device_name"]) for r in rows] == [300_000, 300_000, 1 << 20]
    rows = parse(kv("comma", {"target": "device_name", "source": "n"}), "t=0,n=" + "y" * 200, max_line_bytes=100)
    assert rows[0]["error"] == "line exceeds 100 byte limit" and not rows[0]["device_name"]


def test_strict_form_keeps_the_line_limit(lines):
    mapping = lw.parse_mapping(kv("comma", {"target": "device_name", "source": "n"}))
    with pytest.raises(Exception, match="line exceeds 1048576 byte limit"):
        lw.parse_network(lines("t=0,n=" + "y" * (1 << 20)), mapping).failfast().rows.collect()
    assert lw.parse_network(lines("t=0,n=y"), mapping).failfast().rows.count() == 1


def test_csv_rules(parse):
    mapping = {"log_type": "c", "format": "csv", "has_header": True, "fields": [
        {"target": "event_timestamp", "source": "t", "transform": "unix"},
        {"target": "rule_name", "source": "Name"}, {"target": "action", "source": "col:3"},
        {"target": "rule_id", "source": ["col:99", "col:0", "col:x"], "default": "none"}]}
    rows = parse(mapping, "t, NAME ,x,name", '0,a,b,"last, ""wins"""', "0,short", "", '0,a"b,c', '0,"a"b,c', "0,a,b,c\r")
    assert [r["error"] for r in rows] == [None, None, "csv: stray or unclosed quote", "csv: stray or unclosed quote", None]
    assert [(r["rule_name"], r["action"], r["rule_id"]) for r in rows if not r["error"]] == [
        ('last, "wins"', "b", "none"), ("", "", "none"), ("c", "b", "none")]
    assert rows[0]["event_uuid"] == sha('0,a,b,last, "wins"')


def test_csv_multiline(parse):
    mapping = {"log_type": "c", "format": "csv", "has_header": True, "fields": [
        {"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "rule_name", "source": "n"}]}
    rows = parse(mapping, 't,"n', '",z', "0,plain,1", '0,"two', "", '"",lines",1', '0,a"bad,1', '0,"x",1', '0,"never')
    assert [(r["error"] is None) for r in rows] == [True, True, False, True, False]
    # The header spans two lines too; the line end around its name is trimmed.
    assert [r["rule_name"] for r in rows if not r["error"]] == ["plain", 'two\n\n",lines', "x"]
    rows = parse(mapping, "t,n", "0,plain", '0,"two', "", '"",lines"', '0,"x"', '0,"y""', 'z"')
    assert [r["rule_name"] for r in rows] == ["plain", 'two\n\n",lines', "x", 'y"\nz']


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,src_ip\n2025-01-01 00:00:00,1.1.1.1\n")
    (tmp_path / "b.csv").write_text("srcip,time\n2.2.2.2,2025-01-01T00:00:00Z\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "sub").mkdir()
    with gzip.open(tmp_path / "sub" / "c.csv.gz", "wt") as f:
        f.write("datetime,source_ip\n1710000000,3.3.3.3\n")
    parsed = lw.ingest_network(spark, str(tmp_path), lw.vendor_mapping("generic_csv"))
    assert sorted(r.src_ip for r in parsed.events.collect()) == ["2.2.2.2", "3.3.3.3"]
    bad = {r.source_file.rsplit("/", 1)[1]: r for r in parsed.quarantine(line_numbers=True).collect()}
    assert bad["a.csv"].line_number == 2 and bad["a.csv"].error == "event_timestamp: no value"
    assert set(bad) == {"a.csv"}   # an empty file has no rows, good or bad
    shared = lw.Options(multiline=False, header=("t", "src_ip"))
    rows = lw.ingest_network(spark, str(tmp_path / "a.csv"), lw.vendor_mapping("generic_csv"), options=shared)
    assert [r.raw_line for r in rows.rows.collect()] == ["2025-01-01 00:00:00,1.1.1.1"]


def test_line_numbers_across_splits(spark, tmp_path):
    text = "".join(f"t=0,id={n}\n" if n % 1000 else "bad\n" for n in range(1, 20_001))
    (tmp_path / "big.log").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(kv()))
        assert parsed.lines.select("block").distinct().count() > 3
        numbers = sorted(r.line_number for r in parsed.quarantine(line_numbers=True).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert numbers == list(range(1000, 20_001, 1000))


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_multiline_across_splits(spark, tmp_path, kind):
    """Records that straddle file splits come back whole."""
    count = 3000
    if kind == "json":
        mapping = {"log_type": "j", "format": "json", "fields": [
            {"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "rule_id", "source": "id"}]}
        text = "\n".join(json.dumps({"t": 0, "id": n, "pad": {"x": "}{" * 20}}, indent=1) for n in range(count))
    else:
        mapping = {"log_type": "c", "format": "csv", "fields": [
            {"target": "event_timestamp", "source": "col:1", "transform": "unix"}, {"target": "rule_id", "source": "col:2"}]}
        text = "".join(f'0,{n},"a\n""b""\n\n{"c" * 40}"\n' for n in range(count))
    (tmp_path / "f.log").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(mapping))
        rows = parsed.rows.select("rule_id", "error").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.error for r in rows if r.error] == []
    assert sorted(int(r.rule_id) for r in rows) == list(range(count))


@pytest.mark.parametrize("kind", ["json", "csv"])
@pytest.mark.parametrize("most, few_blocks", [(1 << 28, 1 << 20), (1 << 28, 0), (40, 1 << 20)])
def test_records_of_many_blocks_as_by_one_pass(spark, monkeypatch, kind, most, few_blocks):
    """Random lines in random blocks, of several files, against a state carried from line to line."""
    from logweave.sources import multiline

    monkeypatch.setattr(multiline, "MAX_RECORD_BYTES", most)
    monkeypatch.setattr(multiline, "MAX_BROADCAST_BLOCKS", few_blocks)
    r = random.Random(kind)
    pieces = ['{"a": 1}', '{"a": [', "]}", "[", "]", "{}", "", " ", '"x{"'] if kind == "json" else ["a,b", "", '"q', 'z"', '"w"', ' ', '"', 'c,"d""', '"",e"']
    rows, at = [], 0
    for file in ("f", "g", "h"):
        for block in range(0, 60, r.choice((3, 7))):
            for _ in range(r.choice((0, 1, 2, 9))):
                rows.append((file, block, at, r.choice(pieces)))
                at += 1
    frame = spark.createDataFrame(rows, "source_file string, block bigint, seq bigint, value string").coalesce(1)
    flagged = multiline.with_json_flags(frame) if kind == "json" else multiline.with_csv_flags(frame, ",")
    flags = {x.seq: x for x in flagged.collect()}
    got = multiline.records(flagged, multiline.survey(flagged, kind == "csv"), kind == "csv").collect()
    want, file, state, own = [], None, 0, None
    for name, block, seq, value in rows:
        if name != file:
            file, state, own = name, 0, None
        x = flags[seq]
        outside = state <= 0 if kind == "json" else not state
        if outside and x.full:
            own = [(name, block, seq), []]
            want.append(own)
        if own is not None and (x.full or not outside):
            own[1].append((block, seq, value))
        state = state + x.a if kind == "json" else (x.b if state else x.a)
    if most > 1000:
        assert sorted((g.source_file, g.block, g.seq, g.raw) for g in got) == sorted((*p, "\n".join(v for _, _, v in own)) for p, own in want)
    # Beyond the limit records fall apart, but no line is lost or doubled.
    lines = sorted(v for g in got for v in g.raw.split("\n"))
    assert lines == sorted(v for _, own in want for _, _, v in own)


def test_a_record_of_one_block_takes_several_batches(spark, tmp_path):
    """A .gz is one block; its records meet the edges of Arrow batches."""
    mapping = {"log_type": "c", "format": "csv", "has_header": True, "fields": [
        {"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "rule_name", "source": "n"}]}
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('\n\nt,"n\n"\n' + "".join(f'0,"x\n\ny{n}"\n' for n in range(500)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(mapping)).rows.select("rule_name", "error").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.rule_name for r in rows) == sorted(f"x\n\ny{n}" for n in range(500)) and not any(r.error for r in rows)


def test_a_given_header_is_dropped_only_as_first_record(spark, tmp_path):
    mapping = {"log_type": "c", "format": "csv", "has_header": True, "fields": [
        {"target": "event_timestamp", "source": "t", "transform": "unix", }, {"target": "rule_id", "source": "id"}]}
    (tmp_path / "a.csv").write_text("\n T ,id\n1,a\nt,id\n2,b\n")
    (tmp_path / "b.csv").write_text("3,c\nt,id\n")
    rows = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(mapping), options=lw.Options(header=("t", "id"))).rows
    got = sorted((r.source_file.rsplit("/", 1)[1], r.rule_id if not r.error else r.raw_line) for r in rows.select("source_file", "rule_id", "raw_line", "error").collect())
    assert got == [("a.csv", "a"), ("a.csv", "b"), ("a.csv", "t,id"), ("b.csv", "c"), ("b.csv", "t,id")]


def test_oversized_record_falls_apart_into_lines(parse, monkeypatch):
    from logweave.sources import multiline

    monkeypatch.setattr(multiline, "MAX_RECORD_BYTES", 60)
    good = '{"timestamp":"2025-01-02T03:04:05Z"}'
    rows = parse("google", '{"timestamp": {', good, good, good)
    assert [r["error"] is None for r in rows].count(True) == 3
    assert [r["raw_line"] for r in rows if r["error"]] == ['{"timestamp": {']


def test_regex_separator_in_line(parse):
    mapping = {"log_type": "r", "format": "regex", "patterns": [
        {"match": r"(?P<t>\d+) a=(?P<a>.*?) b(?P<b>\d)?$", "consts": {"a": "const", "c": "one", "b": "no"}},
        {"match": r"^(?P<t>[[:digit:]]+)\s(?i)other", "consts": {"c": "two"}}],
        "fields": [{"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "action", "source": "a"},
                   {"target": "rule_id", "source": "b"}, {"target": "log_type", "source": "c"}]}
    rows = parse(mapping, "x 5 a=p b7", "5 a=p\x01q b", "5 OTHER", "5 a= b")
    assert [(r["action"], r["rule_id"], r["log_type"]) for r in rows] == [
        ("p", "7", "one"), ("p\x01q", "", "one"), ("", "", "two"), ("", "", "one")]


def test_custom_reader(parse, lines):
    from pyspark.sql import functions as F

    def reader(frame, mapping, options):
        return (frame.withColumn("raw", F.col("value")).withColumn("error", F.lit(None).cast("string")),
                lambda path: F.lit("9") if path == "t" else F.upper("value"))

    lw.register_format("special", reader)
    mapping = {**kv("", {"target": "action", "source": "any"}), "log_type": "special"}
    assert [r["action"] for r in parse(mapping, "abc")] == ["ABC"]


def test_flags_of_a_batch_are_those_of_its_lines(spark):
    """Flags from all bytes of a batch, against Spark's expressions over each line; in each block as in the whole."""
    from pyspark.sql import functions as F

    from logweave.functions import csvtext
    from logweave.functions.strings import trim_space
    from logweave.sources import multiline

    r = random.Random(7)
    pieces = ["{", "}", "[", "]", '"', '""', "\\", '\\"', "\\\\", "a", ",", " ", "é", " ", " ", "\r", '"a{"', '"]\\"["']
    texts = ["", " ", " ", "\x01", '"\\\r{"', '{"a": "b\\\\", "c": [', *("".join(r.choices(pieces, k=r.randrange(1, 12))) for _ in range(4000))]
    frame = spark.createDataFrame([("f", 0, i, t) for i, t in enumerate(texts)], "source_file string, block bigint, seq bigint, value string").coalesce(1)
    value = F.col("value")
    bare = F.regexp_replace(value, r'"(?:[^"\\]++|\\.)*+"', "")
    count = lambda c, some: F.length(c) - F.length(F.translate(c, some, ""))
    want = frame.select("seq", (count(bare, "[{") - count(bare, "]}")).alias("a"), (trim_space(value) != "").alias("full")).collect()
    got = multiline.with_json_flags(frame).collect()
    assert [(x.seq, x.a, x.b, x.full) for x in got] == [(x.seq, x.a, 0, x.full) for x in want]
    for d in (",", "|", " ", "\t"):
        open_ = lambda c: F.contains(c, F.lit('"')) & c.rlike(csvtext.open_end(d) + r"\z")  # noqa: B023, E731
        want = frame.select("seq", open_(value).cast("int").alias("a"), (F.when(~F.contains(value, F.lit('"')), True).otherwise(
            open_(F.concat(F.lit('"'), value)))).cast("int").alias("b"), (value != "").alias("full")).collect()
        got = multiline.with_csv_flags(frame, d).collect()
        assert [(x.seq, x.a, x.b, x.full) for x in got] == [(x.seq, x.a, x.b, x.full) for x in want]
