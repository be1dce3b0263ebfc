"""Archives, sinks, routing, chunks and streams."""

import gzip
import io
import json
import os
import random
import tarfile
import time
import zipfile
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import logweave as lw
from logweave import schemas
from logweave.operators import routing
from logweave.plans import commits, sinks
from logweave.sources import archives, chunks, ranges
from logweave.sources.archives import archive_entries, archive_lines, archive_lines_of
from logweave.sources.store import list_objects
from logweave.sources.lines import as_line_frame
from logweave.sources.chunks import decrypt_chunks
from logweave.sources.listing import hidden_objects, list_files, list_with_markers
from logweave.streaming.ingest import stream_network, stream_timeline
from logweave.streaming.objects import dead_letters, failures

LINE = "t=0,id={}\n"
MAPPING = {"log_type": "demo", "format": "kv", "fields": [
    {"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "rule_id", "source": "id"}]}


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("folder/", b"")
        for name, data in files.items():
            z.writestr(name.replace("__", "."), data)
    return out.getvalue()


def tarred(mode="w:gz", **files):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        folder = tarfile.TarInfo("dir")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, data in files.items():
            info = tarfile.TarInfo(name.replace("__", "."))
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def line(n):
    return LINE.format(n).encode()


def test_archives(spark, tmp_path):
    (tmp_path / "plain.log").write_bytes(line(1))
    (tmp_path / "one.log.gz").write_bytes(gzip.compress(line(2)))
    (tmp_path / "two.ZIP").write_bytes(zipped(a__log=line(3), b__log=line(4)))
    (tmp_path / "three.tar.gz").write_bytes(tarred(a__log=line(5), inner__zip=zipped(x__log=line(6))))
    (tmp_path / "four.tgz").write_bytes(tarred(a__log__gz=gzip.compress(line(7))))
    (tmp_path / "five.tar").write_bytes(tarred("w", a__log=line(8)))
    (tmp_path / "six.zip.gz").write_bytes(gzip.compress(zipped(a__log=line(9))))
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(MAPPING))
    assert sorted(r.rule_id for r in parsed.events.collect()) == [str(n) for n in range(1, 10)]
    (bad,) = parsed.quarantine().collect()
    assert bad.source_file.endswith("bad.zip") and bad.error.startswith("archive:")
    names = {r.source_file.rsplit("/", 1)[1] for r in archive_lines(spark, str(tmp_path)).collect()}
    assert "three.tar.gz!x.log" in names and "two.ZIP!a.log" in names


@pytest.mark.parametrize("levels, fails", [(5, False), (6, True)])
def test_archive_depth(spark, levels, fails):
    data = line(1)
    for n in range(levels):
        data = zipped(**{"in__zip" if n else "in__log": data})
    files = spark.createDataFrame([("x.zip", bytearray(data))], "path string, content binary")
    (row,) = archive_lines_of(files).collect()
    assert (row.error is not None and "nesting" in row.error) == fails


def test_entries_of_a_zip_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    from logweave.sources import archives

    methods = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as z:
        z.writestr("in.zip", zipped(deep__log=line(900), e0__log=line(901)))
        for n in range(40):
            z.writestr(f"dir/../e{n}.log", line(n) * (1 + 300 * (n % 3)), compress_type=methods[n % 4])
        with pytest.warns(UserWarning):
            z.writestr("dir/../e7.log", line(7))
        z.writestr("in.tar.gz", tarred(x__log=line(902)))
        z.writestr("deep.log", line(903))
    monkeypatch.setattr(archives, "CHUNK_BYTES", 400)
    found = archive_entries(list_objects(spark, str(tmp_path))).collect()
    assert len(found) == 44 and len({r.chunk for r in found}) > 5
    lines = archive_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    got = {}
    for r in lines.collect():
        assert r.error is None
        got.setdefault(r.source_file.split("!", 1)[1], []).append((r.block, r.seq, r.value))
    want = {f"dir/../e{n}.log": 1 + 300 * (n % 3) for n in range(40)} | {
        "dir/../e7.log#2": 1, "in.zip!deep.log": 1, "e0.log": 1, "x.log": 1, "deep.log": 1}
    assert {k: len(v) for k, v in got.items()} == want
    assert all(sorted(v)[i][1] == i for v in got.values() for i in range(len(v)))


def test_a_damaged_entry_leaves_the_others(spark, tmp_path):
    body = bytearray(zipped(a__log=line(1), b__log=line(2), c__log=line(3)))
    at = body.index(b"id=2")
    body[at : at + 4] = b"id=9"
    (tmp_path / "x.zip").write_bytes(body)
    (tmp_path / "cut.zip").write_bytes(zipped(a__log=line(4))[:-5])
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    rows = archive_lines(spark, str(tmp_path)).collect()
    good = {r.value for r in rows if r.error is None}
    assert {"t=0,id=1", "t=0,id=3"} <= good <= {"t=0,id=1", "t=0,id=3", "t=0,id=9"}
    bad = {r.source_file.rsplit("/", 1)[1]: r.error for r in rows if r.error}
    assert set(bad) == {"x.zip!b.log", "cut.zip"} and all(e.startswith("archive:") for e in bad.values())


def test_archive_depth_through_ingestion(spark, tmp_path):
    data = line(1)
    for n in range(3):
        data = zipped(**{"in__zip" if n else "in__log": data})
    (tmp_path / "x.zip").write_bytes(data)
    mapping = lw.parse_mapping(MAPPING)
    assert lw.ingest_network(spark, str(tmp_path), mapping).events.count() == 1
    assert "nesting" in lw.ingest_network(spark, str(tmp_path), mapping, max_depth=2).quarantine().first().error


def test_write_and_scan(spark, lines, tmp_path):
    days = [f"t={86400 * d},id={d}" for d in range(5)] + ["t=x,id=bad", "id=none"]
    parsed = lw.parse_network(lines(*days), lw.parse_mapping(MAPPING))
    path = str(tmp_path / "net")
    assert sinks.write_parsed(parsed, path) == {"events_loaded": 5, "rows_skipped": 2}
    part = sinks.scan_network(spark, path, datetime(1970, 1, 2), "1970-01-04 00:00:00")
    assert sorted(r.rule_id for r in part.collect()) == ["1", "2"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sinks.scan_quarantine(spark, path).count() == 2
    assert part.columns == list(lw.Parsed(parsed.rows, parsed.columns).columns)
    # A repeated run replaces its own rows and leaves the others alone.
    again = str(tmp_path / "runs")
    for run in ("a", "b", "a"):
        sinks.write_parsed(parsed, again, run=run)
    assert sinks.scan_network(spark, again).count() == 10


def test_plain_sinks(spark, lines, tmp_path):
    parsed = lw.parse_network(lines("t=5,id=1", "nothing"), lw.parse_mapping(MAPPING))
    sinks.write_network(parsed.events, str(tmp_path / "n"))
    sinks.write_network(parsed.events, str(tmp_path / "n"))
    assert sinks.scan_network(spark, str(tmp_path / "n")).count() == 2
    sinks.write_quarantine(parsed.quarantine(), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).columns == ["source_file", "line_number", "raw_line", "error"]
    sinks.write_manifest(spark, str(tmp_path / "case"), "c1", "a.c1", 3, 99)
    marker = json.loads((tmp_path / "case" / "_READY").read_text())
    assert (marker["case_id"], marker["entries_written"], marker["bytes_decrypted"]) == ("c1", 3, 99)


def listing(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def test_routing(spark):
    rows = routing.route_logs(
        listing(spark, "log/aws/x/y.json", "log/evil/x", "log/aws", "log//x", "config/aws.json", "xlog/aws/f"), ["aws"])
    assert {r.key: (r.log_type, r.reject) for r in rows.collect()} == {
        "log/aws/x/y.json": ("aws", None), "log/evil/x": ("evil", "log type not allowed"),
        "log/aws": (None, "no log type in the path"), "log//x": (None, "no log type in the path"),
        "config/aws.json": (None, "outside the log/ prefix"), "xlog/aws/f": (None, "outside the log/ prefix")}
    rows = routing.route_timelines(
        listing(spark, "c1-timeline-1.jsonl", "c1-timeline-a-timeline-b.JSONL", "-timeline-1.jsonl", "c1.jsonl", "c1-timeline-1.txt"))
    assert {r.key: (r.case_id, r.reject is None) for r in rows.collect()} == {
        "c1-timeline-1.jsonl": ("c1", True), "c1-timeline-a-timeline-b.JSONL": ("c1", True),
        "-timeline-1.jsonl": (None, False), "c1.jsonl": (None, False), "c1-timeline-1.txt": ("c1", False)}
    rows = routing.ready_only(listing(spark, "a/_READY", "a/x", "b/y", "_READY", "top", "a/b/z"))
    assert sorted(r.key for r in rows.collect()) == ["a/x", "top"]
    rows = routing.route_artifacts(listing(spark, "up/PC1.Case7", "PC.2.case7", ".case7", "PC3.case8"), "CASE7")
    assert {r.key: r.device_name for r in rows.collect()} == {
        "up/PC1.Case7": "PC1", "PC.2.case7": "PC.2", ".case7": "unknown"}
    notices = spark.createDataFrame([("new", "b1"), ("gone", "b1"), ("new", "b2")], "event_type string, bucket string")
    assert routing.accept_events(notices, "new", "b1").count() == 1
    assert routing.accept_events(notices, "new").count() == 2


def test_listing_keys(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "f").write_text("abc")
    (row,) = routing.with_key(list_files(spark, str(tmp_path)), f"file://{tmp_path}").collect()
    assert (row.key, row.length) == ("log/f", 3)


def test_chunks(spark):
    key = b"k" * 32
    rows = spark.createDataFrame([(n, "text %d" % n) for n in range(3)], "n int, text string").select(
        "n", F.aes_encrypt("text", F.lit(key), F.lit("GCM")).alias("payload"))
    damaged = rows.withColumn("payload", F.when(
        F.col("n") == 1, F.concat(F.substr("payload", F.lit(1), F.lit(20)), F.lit(b"\x00"), F.substr("payload", F.lit(22))))
        .when(F.col("n") == 2, F.lit(b"short")).otherwise(F.col("payload")))
    got = decrypt_chunks(damaged, F.lit(key)).orderBy("n").collect()
    assert bytes(got[0].plain) == b"text 0" and got[0].error is None
    assert "damaged" in got[1].error and "too short" in got[2].error


@pytest.mark.parametrize("span", [4096, 5, 1])
def test_chunks_that_are_missing_repeated_or_cut(spark, monkeypatch, span):
    monkeypatch.setattr(chunks, "SPAN", span)
    r = random.Random(span)
    have = {f"p{n}": [x for x in range(r.randrange(1, 40)) if r.random() < 0.7 for _ in range(r.choice((1, 1, 1, 3)))] for n in range(30)}
    rows = [(p, x) for p, own in have.items() for x in own] + [(None, 1), ("odd", None), ("odd", -4), ("far", 100)]
    expected = {p: r.randrange(1, 45) for p in list(have)[:20]} | {"gone": 7}
    frame = spark.createDataFrame(rows, "path string, chunk_no bigint").repartition(3)
    got = {x.path: x for x in chunks.completeness(frame, spark.createDataFrame(list(expected.items()), "path string, n_expected bigint")).collect()}
    have["far"] = [100]
    flat = lambda ranges: [n for x in ranges for n in range(x["first"], x["last"] + 1)]
    for path in {p for p, own in have.items() if own} | set(expected):
        own = have.get(path, [])
        last = max(own, default=-1)
        row = got.pop(path)
        assert row.n_chunks == len(set(own))
        assert flat(row.missing) == [n for n in range(last) if n not in own]
        assert flat(row.repeated) == sorted({n for n in own if own.count(n) > 1})
        assert row.cut == (last + 1 if last + 1 < expected.get(path, 0) else None)
    assert not got
    assert all(x.cut is None for x in chunks.completeness(frame).collect())


def test_stream_network(spark, tmp_path):
    logs = tmp_path / "in" / "log" / "demo"
    logs.mkdir(parents=True)
    (tmp_path / "in" / "config").mkdir()
    (tmp_path / "in" / "config" / "demo.json").write_text(json.dumps(MAPPING))
    table = str(tmp_path / "table")

    def run():
        stream_network(spark, str(tmp_path / "in"), table, str(tmp_path / "cp"), ["demo"]).trigger(
            availableNow=True).start().awaitTermination()
        return sorted(r.rule_id for r in sinks.scan_network(spark, table).collect())

    (logs / "a[1] {x}.log").write_bytes(line(1))
    (logs / "b.zip").write_bytes(zipped(x__log=line(2)))
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    (logs / "c.log").write_bytes(line(3) + b"broken\n")
    assert run() == ["1", "2", "3"]
    assert sinks.scan_quarantine(spark, table).count() == 1
    rejected = spark.read.parquet(table + "_rejected").collect()
    assert [r.reject for r in rejected] == ["outside the log/ prefix"]


def test_stream_timeline(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c1-timeline-1.jsonl").write_text('{"timestamp": 1000000, "message": "m"}\n')
    (tmp_path / "in" / "notes.txt").write_text("x")
    table = str(tmp_path / "table")
    stream_timeline(spark, str(tmp_path / "in"), table, str(tmp_path / "cp"), "/mnt").trigger(
        availableNow=True).start().awaitTermination()
    assert [r.message for r in sinks.scan_timeline(spark, table).collect()] == ["m"]


def test_stream_query_ingests_every_event(spark, tmp_path, monkeypatch):
    import workloads

    rows = [(i, i, "error" if i % 3 == 0 else "click", datetime(2026, 1, 1, 0, 0, i), '{"k": 1}') for i in range(30)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, ts timestamp, props string").write.parquet(str(tmp_path / "events.parquet"))
    base = tmp_path / "scratch"
    base.mkdir()
    monkeypatch.setattr(workloads, "scratch_dir", lambda *_: str(base))
    got = workloads.stream_timeline_ingest(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in got) == [i for i in range(30) if i % 3]
    bad = sinks.scan_quarantine(spark, str(base / "table")).collect()
    assert sorted(int(json.loads(r.raw_line)["message"]) for r in bad) == list(range(0, 30, 3))
    assert {r.error for r in bad} == {"timestamp: outside years 1 to 9999"}


def test_lines_of_archives_leave_in_small_batches():
    """A worker that holds many lines at once grows from batch to batch."""
    body = b"".join(b"line %d\n" % n for n in range(40_000))
    files = pa.RecordBatch.from_pydict({"path": ["x/a.zip", "x/b.zip"], "content": [zipped(a__log=body), zipped(b__log=body)]})
    out = list(archives._unpack(5)(iter([files])))
    assert [x for b in out for x in b.column("value").to_pylist()] == 2 * body.splitlines()
    assert {x for b in out for x in b.column("source_file").to_pylist()} == {"x/a.zip!a.log", "x/b.zip!b.log"}
    assert max(b.num_rows for b in out) <= 20_000


def test_objects_of_hidden_names_are_read(spark, tmp_path):
    (tmp_path / "sub" / "_deep" / ".down").mkdir(parents=True)
    (tmp_path / "sub" / "_temporary").mkdir()
    for name, body in (("a.log", line(1)), ("_b.log", line(2)), (".c.log", line(3)), ("_SUCCESS", b""), ("_READY", b"{}"), ("sub/d.log", line(4)),
                       ("sub/_e.log", line(5)), ("sub/_deep/f.log", line(6)), ("sub/_deep/.down/g.log", line(7)), ("sub/_temporary/x", line(99)),
                       ("_h.zip", zipped(x__log=line(8))), ("_i.log.gz", gzip.compress(line(9))), ("_empty", b""), (".a.log.crc", b"crc\0"), ("sub/.d.log.crc", b"crc\0")):
        (tmp_path / name).write_bytes(body)
    parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(MAPPING))
    assert sorted(r.rule_id for r in parsed.events.collect()) == [str(n) for n in range(1, 10)]
    assert parsed.quarantine().count() == 0
    for odd, count in (("a.log", 1), ("_b.log", 1), ("sub/_*", 4), ("sub/_deep", 2)):
        assert lw.ingest_network(spark, f"{tmp_path}/{odd}", lw.parse_mapping(MAPPING)).events.count() == count, odd


def test_hidden_objects_that_are_packed_otherwise_are_rejected(spark, tmp_path):
    (tmp_path / "_a.log.bz2").write_bytes(b"x")
    (tmp_path / "b.log").write_bytes(line(1))
    parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(MAPPING))
    (bad,) = parsed.quarantine().collect()
    assert bad.source_file.endswith("_a.log.bz2") and bad.error.startswith("not read:")
    with pytest.raises(Exception, match="not read"):
        parsed.failfast().rows.collect()


def test_stores_that_only_spark_opens(spark, tmp_path, monkeypatch):
    from logweave.sources import archives, scan

    for name, body in (("a.log", line(1)), ("_b.log", line(2)), ("c.zip", zipped(x__log=line(3)))):
        (tmp_path / name).write_bytes(body)
    for module in (archives, scan):
        monkeypatch.setattr(module, "reachable", lambda _: False)
    parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(MAPPING))
    assert sorted(r.rule_id for r in parsed.events.collect()) == ["1", "3"]
    (bad,) = parsed.quarantine().collect()
    assert bad.error == "not read: its name begins with _ or ."
    assert hidden_objects(spark, str(tmp_path / "a.log")) == []


@pytest.mark.parametrize("buffer", [1, 2, 3, 7, 50])
def test_ranges_share_lines_out(tmp_path, monkeypatch, buffer):
    monkeypatch.setattr(ranges, "_BUFFER", buffer)
    r = random.Random(buffer)
    for _ in range(60):
        body = b"".join(r.choice([b"a", b"bb", b"\n", b"\n\n", b"ccc\n"]) for _ in range(r.randrange(40)))
        (tmp_path / "x").write_bytes(body)
        want = body.split(b"\n")
        want = want[:-1] if want[-1] == b"" else want
        size = r.randrange(1, 15)
        got = [x for a in range(0, max(len(body), 1), size) for x in ranges.range_lines(str(tmp_path / "x"), a, a + size)]
        assert [x[3] for x in got] == want
        assert len({x[:3] for x in got}) == len(got)


def test_ready_folders_of_a_real_listing(spark, tmp_path):
    for name in ("a/x", "a/b/y", "c/z", "top"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    sinks.write_manifest(spark, str(tmp_path / "a"), "c1", "a.c1", 1, 1)
    found = list_with_markers(spark, str(tmp_path), routing.MARKER)
    assert [r.key for r in routing.ready_only(routing.with_key(found, f"file://{tmp_path}")).collect()] == ["a/x"]


def test_equal_entry_names_keep_their_own_headers(spark, tmp_path):
    one = zipped(log__csv=b"t,src,dst\n0,1.1.1.1,2.2.2.2\n")
    two = zipped(log__csv=b"t,dst,src\n0,4.4.4.4,3.3.3.3\n")
    with tarfile.open(tmp_path / "o.tar", "w") as tar:
        for name, body in (("a.zip", one), ("b.zip", two), ("b.zip", two)):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    mapping = lw.parse_mapping({"log_type": "demo", "format": "csv", "has_header": True, "fields": [
        {"target": "event_timestamp", "source": "t", "transform": "unix"}, {"target": "src_ip", "source": "src"}, {"target": "dst_ip", "source": "dst"}]})
    parsed = lw.ingest_network(spark, str(tmp_path), mapping)
    got = sorted((r.src_ip, r.dst_ip) for r in parsed.events.collect())
    assert got == [("1.1.1.1", "2.2.2.2"), ("3.3.3.3", "4.4.4.4"), ("3.3.3.3", "4.4.4.4")]
    names = {r.source_file.split("!", 1)[1] for r in parsed.rows.collect()}
    assert names == {"log.csv", "b.zip!log.csv", "b.zip!log.csv#2"}


def test_damaged_containers_are_rows(spark, tmp_path):
    packed = bytearray(zipped(x__log=line(1) * 3000))
    for at in range(200, len(packed) - 200, 7):
        packed[at] ^= 0x55
    (tmp_path / "bad.zip").write_bytes(packed)
    (tmp_path / "good.log").write_bytes(line(2))
    parsed = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(MAPPING))
    assert "2" in [r.rule_id for r in parsed.events.collect()]
    assert any(r.error.startswith("archive:") for r in parsed.quarantine().collect())


def test_event_ids_do_not_depend_on_the_container(spark, tmp_path):
    body = b"t=0,id=caf\xe9\n"
    (tmp_path / "plain.log").write_bytes(body)
    (tmp_path / "packed.zip").write_bytes(zipped(x__log=body))
    rows = lw.ingest_network(spark, str(tmp_path), lw.parse_mapping(MAPPING)).events.select("event_uuid").collect()
    assert len(rows) == 2 and len({r.event_uuid for r in rows}) == 1


def test_line_numbers_over_several_tasks(spark):
    rows = spark.createDataFrame([(i, f"t={i},id={i}" if i % 5 else "broken") for i in range(40)], "i int, value string").repartitionByRange(4, "i").sortWithinPartitions("i")
    parsed = lw.parse_network(as_line_frame(rows, "value"), lw.parse_mapping(MAPPING))
    assert sorted(r.line_number for r in parsed.quarantine(line_numbers=True).collect()) == [i + 1 for i in range(0, 40, 5)]


def stream(spark, tmp_path, **options):
    """Run a network stream to its end; returns the ids in its table."""
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")
    mapping = lw.parse_mapping(MAPPING)
    stream_network(spark, str(tmp_path / "in"), table, checkpoint, ["demo"], mapping_for=lambda _: mapping, **options).trigger(
        availableNow=True).start().awaitTermination()
    return sorted(r.rule_id for r in sinks.scan_network(spark, table).collect())


def test_streams_take_old_files_and_outlive_damaged_ones(spark, tmp_path):
    logs = tmp_path / "in" / "log" / "demo"
    logs.mkdir(parents=True)
    (logs / "a.log").write_bytes(line(1))
    assert stream(spark, tmp_path) == ["1"]
    (logs / "b.log").write_bytes(line(2))
    month = time.time() - 30 * 86400
    os.utime(logs / "b.log", (month, month))
    assert stream(spark, tmp_path) == ["1", "2"]
    (logs / "c.log.gz").write_bytes(gzip.compress(b"".join(line(n) for n in range(3000)))[:4000])
    (logs / "d.log").write_bytes(line(4))
    held = len(spark.sparkContext._jsc.getPersistentRDDs())
    assert stream(spark, tmp_path) == ["1", "2", "4"]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held
    (bad,) = failures(spark, str(tmp_path / "cp")).collect()
    assert bad.path.endswith("c.log.gz") and (bad.attempt, bad.dead) == (1, False) and bad.reason and bad.due > time.time()
    # Not due yet, so not tried again.
    assert stream(spark, tmp_path) == ["1", "2", "4"] and failures(spark, str(tmp_path / "cp")).count() == 1


def test_streams_see_objects_of_hidden_names(spark, tmp_path):
    logs = tmp_path / "in" / "log" / "demo"
    (logs / "_deep").mkdir(parents=True)
    for name, body in (("a.log", line(1)), ("_b.log", line(2)), (".c.log", line(3)), ("_deep/d.log", line(4)), ("_READY", b"{}"), ("_z.zip", zipped(x__log=line(5)))):
        (logs / name).write_bytes(body)
    assert stream(spark, tmp_path, max_files=2) == ["1", "2", "3", "4", "5"]
    (logs / "_later.log").write_bytes(line(6))
    assert stream(spark, tmp_path) == ["1", "2", "3", "4", "5", "6"]


def test_failed_objects_come_again_until_they_work_or_are_given_up(spark, tmp_path):
    logs = tmp_path / "in" / "log" / "demo"
    logs.mkdir(parents=True)
    whole = gzip.compress(b"".join(line(n) for n in range(100, 3100)))
    for n in range(5):
        (logs / f"good{n}.log").write_bytes(line(n))
    (logs / "late.log.gz").write_bytes(whole[:4000] + bytes(len(whole) - 4000))
    (logs / "never.log.gz").write_bytes(whole[:4000])
    before = os.stat(logs / "late.log.gz")
    options = {"max_attempts": 3, "backoff": (0, 0)}
    good = [str(n) for n in range(5)]
    assert stream(spark, tmp_path, **options) == good
    assert stream(spark, tmp_path, **options) == good
    (logs / "late.log.gz").write_bytes(whole)   # the same object to a listing, readable now
    os.utime(logs / "late.log.gz", ns=(before.st_atime_ns, before.st_mtime_ns))
    for _ in range(2):
        got = stream(spark, tmp_path, **options)
    assert len(got) == 3005 and len(set(got)) == 3005
    noted = failures(spark, str(tmp_path / "cp")).collect()
    tries = {k: sorted(r.attempt for r in noted if k in r.path) for k in ("late", "never")}
    assert tries == {"late": [1, 2], "never": [1, 2, 3]}
    (dead,) = dead_letters(spark, str(tmp_path / "cp")).collect()
    assert dead.path.endswith("never.log.gz") and dead.attempt == 3 and dead.reason


def test_objects_that_cannot_be_read_are_found_without_parsing(spark, tmp_path, monkeypatch):
    logs = tmp_path / "in" / "log" / "demo"
    logs.mkdir(parents=True)
    whole = gzip.compress(b"".join(line(n) for n in range(100, 3100)))
    for n in range(4):
        (logs / f"good{n}.log").write_bytes(line(n))
        (logs / f"bad{n}.log.gz").write_bytes(whole[:4000])
    tries, add = [], sinks.Run.add
    monkeypatch.setattr(sinks.Run, "add", lambda run, parsed: tries.append(1) or add(run, parsed))
    assert stream(spark, tmp_path) == ["0", "1", "2", "3"]
    assert len(tries) == 1 and failures(spark, str(tmp_path / "cp")).count() == 4


@pytest.mark.parametrize("fault", ["before the commit", "after the commit", "after a failure is noted"])
def test_a_replayed_batch_adds_no_row(spark, tmp_path, monkeypatch, fault):
    """The query dies in a batch that went object by object; the restart meets the damaged file mended."""
    from logweave.streaming import ingest

    logs = tmp_path / "in" / "log" / "demo"
    logs.mkdir(parents=True)
    whole = gzip.compress(b"".join(line(n) for n in range(100, 3100)))
    for n in range(4):
        (logs / f"good{n}.log").write_bytes(line(n))
    (logs / "odd.log.gz").write_bytes(whole[:4000] + bytes(len(whole) - 4000))
    before = os.stat(logs / "odd.log.gz")
    with monkeypatch.context() as patched:
        commit, note = sinks.Run.commit, ingest.note_failure

        def dying(self, *args):
            if fault == "after the commit":
                commit(self, *args)
            if fault != "after a failure is noted":
                raise RuntimeError("lost")
            return commit(self, *args)

        def dying_note(*args):
            note(*args)
            raise RuntimeError("lost")

        patched.setattr(sinks.Run, "commit", dying)
        patched.setattr(ingest, "note_failure", dying_note)
        with pytest.raises(Exception, match="lost"):
            stream(spark, tmp_path, backoff=(0, 0))
    (logs / "odd.log.gz").write_bytes(whole)
    os.utime(logs / "odd.log.gz", ns=(before.st_atime_ns, before.st_mtime_ns))
    for _ in range(1 if fault == "after the commit" else 2):
        got = stream(spark, tmp_path, backoff=(0, 0))
    assert got == sorted([str(n) for n in range(4)] + [str(n) for n in range(100, 3100)])
    gone = commits.vacuum(spark, str(tmp_path / "table"), older_than_hours=-1)
    assert gone and sinks.scan_network(spark, str(tmp_path / "table")).count() == len(got)


def test_a_wrong_mapping_ends_the_stream(spark, tmp_path):
    logs = tmp_path / "in" / "log" / "demo"
    logs.mkdir(parents=True)
    (logs / "a.log").write_bytes(line(1))
    with pytest.raises(Exception, match="demo.json|not exist|PATH_NOT_FOUND"):
        stream_network(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp"), ["demo"]).trigger(availableNow=True).start().awaitTermination()
    assert failures(spark, str(tmp_path / "cp")).count() == 0


def test_a_stream_waits_for_the_marker_of_a_folder(spark, tmp_path):
    """Markers before, after and never, over restarts."""
    base = tmp_path / "in"
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")

    def put(name, n):
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text(f'{{"timestamp": {n}, "message": "{n}"}}\n')

    def run():
        stream_timeline(spark, str(base), table, checkpoint, "/mnt", gate=True).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.message for r in sinks.scan_timeline(spark, table).collect()) if os.path.exists(table) and any(x.startswith("status") for x in os.listdir(table)) else []

    put("early/c-timeline-1.jsonl", 1)
    (base / "early" / "_READY").write_text("{}")
    for n in range(40):
        put(f"late/c-timeline-{n}.jsonl", 100 + n)
    put("never/c-timeline-1.jsonl", 3)
    put("c-timeline-top.jsonl", 4)
    assert run() == ["1"]
    put("early/c-timeline-2.jsonl", 2)
    assert run() == ["1", "2"]
    (base / "late" / "_READY").write_text("{}")
    (base / "late" / "sub").mkdir()
    put("late/sub/c-timeline-1.jsonl", 5)
    assert run() == sorted(["1", "2"] + [str(100 + n) for n in range(40)])
    (base / "_READY").write_text("{}")
    put("late/c-timeline-last.jsonl", 6)
    assert run() == sorted(["1", "2", "4", "6"] + [str(100 + n) for n in range(40)])


def test_a_run_replaces_what_it_had_added_in_other_parts(spark, lines, tmp_path):
    mapping, table = lw.parse_mapping(MAPPING), str(tmp_path / "t")
    parsed = [lw.parse_network(lines(f"t={86400 * n},id={n}", "bad"), mapping) for n in range(4)]
    one = sinks.Run(spark, table, "run/1")
    one.add(parsed[0])
    one.add(parsed[1])
    assert sinks.scan_network(spark, table).count() == 0   # not committed
    assert one.commit() == {"events_loaded": 2, "rows_skipped": 2}
    sinks.write_parsed(parsed[2], table)
    ids = lambda: sorted(r.rule_id for r in sinks.scan_network(spark, table).collect())
    assert ids() == ["0", "1", "2"] and sinks.scan_quarantine(spark, table).count() == 3
    sinks.write_parsed(parsed[3], table, run="run/1")
    assert ids() == ["2", "3"] and sinks.scan_quarantine(spark, table).count() == 2
    sinks.write_parsed(parsed[0], table, mode="overwrite")
    assert ids() == ["0"]
    assert sorted(d for r in commits.parts(spark, table).collect() for d in r.days) == ["1970-01-01"]


def test_look_ups_by_either_address_skip_row_groups(spark, tmp_path):
    """Of the row groups of one day's file, Bloom filters let a look-up read few, by source or by destination."""
    n = 60_000
    rows = spark.range(n).select(
        F.timestamp_seconds(F.lit(5)).alias("event_timestamp"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("2001:db8::"), F.hex(F.pmod(F.xxhash64("id"), F.lit(5000))))).otherwise(
            F.concat(F.lit("10.0."), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).cast("string"), F.lit("."), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(250)).cast("string"))).alias("src_ip"),
        F.concat(F.lit("192.168."), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(40)).cast("string"), F.lit("."), F.pmod(F.xxhash64("id", F.lit(4)), F.lit(250)).cast("string")).alias("dst_ip"),
        F.sha2(F.col("id").cast("string"), 256).alias("event_uuid"))
    for c in schemas.NETWORK_COLUMNS:
        if c not in rows.columns:
            kind = next(f.dataType for f in schemas.NETWORK_EVENTS.fields if f.name == c)
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    with pytest.MonkeyPatch.context() as patched:
        patched.setitem(sinks._LOOKUPS, "parquet.block.size", str(256 << 10))
        sinks.write_network(rows.coalesce(1), str(tmp_path / "n"))
    rows = rows.persist()
    for column, like in (("src_ip", "2001:"), ("src_ip", "10."), ("dst_ip", "192.")):
        some = rows.where(F.col(column).startswith(like)).select(column).first()[0]
        found = sinks.scan_network(spark, str(tmp_path / "n")).where(F.col(column) == some)
        want = rows.where(F.col(column) == some).count()
        got = found.select("event_uuid", column)
        got.collect()
        scan = [x for x in _nodes(got._jdf.queryExecution().executedPlan()) if "FileScan" in x.nodeName() or "Scan parquet" in x.nodeName()][0]
        read = scan.metrics().get("numOutputRows").get().value()
        assert found.count() == want and read < n / 3, (column, read)
    rows.unpersist()


def _nodes(plan):
    """All nodes of an executed plan."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        plan = plan.plan()
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))
