"""Queries over the driver tables, each with the SQL that gives the same rows.

The driver tables hold no vendor logs. Each query therefore renders every row of
a table as a log line (or file, archive, chunk), lets the engine read it back,
and the SQL states the expected columns straight from the table.
"""

from __future__ import annotations

import io
import json
import os
import sys
import tarfile
import uuid
import warnings
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

import logweave as lw
from logweave.operators import routing
from logweave.plans import correlate, rebuild, sinks
from logweave.plans.timeline import ingest_timeline, parse_timeline
from logweave.session import scratch_dir
from logweave.sources.archives import archive_lines_of
from logweave.sources.listing import list_with_markers, put_object
from logweave.sources.chunks import completeness
from logweave.sources.chunks import decrypt_chunks as decrypt
from logweave.sources.lines import as_line_frame
from logweave.sources.store import open_store
from logweave.streaming.ingest import stream_network, stream_timeline
from logweave.streaming.objects import dead_letters, failures

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            lw.configure(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = configured
        if sql is not None:
            ORACLES[run.__name__] = sql
        return configured

    return register


# --- rendering ---------------------------------------------------------------


#: Rows whose log lines one task renders and parses, in some 10 to 20 seconds.
ROWS_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, on as many tasks as its rows ask for and as there are cores.

    A row is a few bytes in its file and much work as a log line. Splits of a file
    say little about that: those without a row group's middle are empty, and the
    others hold whole row groups. How many rows each has comes from the files' footers.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    splits = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    total, most = splits.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // ROWS_PER_TASK))
    return rows if most and most * tasks <= 2 * total else rows.repartition(tasks)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``at`` as a TIMESTAMP, ``k`` out of the props and texts of the numbers."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.col("ts").cast("timestamp").alias("at"),
        F.regexp_extract("props", "[0-9]+", 0).alias("k"),
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user"),
    ).withColumn("epoch", F.unix_seconds("at").cast("string"))


def text(*parts: str | Column) -> Column:
    """Concatenate literals and columns; a plain string is a literal."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def c(name: str) -> Column:
    return F.col(name)


def parse(rows: DataFrame, line: Column, mapping: dict | str, **options) -> DataFrame:
    """Accepted events of one line per row."""
    mapping = lw.vendor_mapping(mapping) if isinstance(mapping, str) else lw.parse_mapping(mapping)
    opts = lw.Options(**{"multiline": False, **options})
    return lw.parse_network(as_line_frame(rows, line), mapping, opts).events


def micros(name: str = "event_timestamp") -> Column:
    return F.unix_micros(name).alias("ts_us")


def kv_mapping(*fields: dict, delimiter: str = "comma", time: str = "unix") -> dict:
    return {
        "log_type": "demo", "format": "kv", "delimiter": delimiter,
        "fields": [{"target": "event_timestamp", "source": "t", "transform": time}, *fields],
    }


# --- key=value ---------------------------------------------------------------


def fortigate_line() -> Column:
    return text(
        "itime=", c("epoch"), ',devname="fw ', c("user"), '",type="traffic",subtype="', c("event_type"),
        '",action="', c("event_type"), '",policyid=', c("id"), ',policyname="Allow ', c("k"),
        '",srcip=10.0.0.', c("user"), ",srcport=", c("k"), ",dstip=10.1.0.", c("k"),
        ",dstport=443,proto=", F.when(c("event_type") == "click", "6").when(
            c("event_type") == "view", "17").otherwise("47"),
        ',srcintf="",interface="port', c("k"), '",user="ann,', c("user"), '",sentbyte=', c("id"),
        ",rcvdbyte=n/a,duration=+", c("k"), ',msg="a = b"',
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id, epoch_us(date_trunc('second', ts)) AS ts_us,
  'fw ' || user_id AS device_name, 'traffic:' || event_type AS log_type, event_type AS action,
  'Allow ' || regexp_extract(props, '[0-9]+') AS rule_name, '10.0.0.' || user_id AS src_ip,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS src_port,
  '10.1.0.' || regexp_extract(props, '[0-9]+') AS dst_ip, CAST(443 AS BIGINT) AS dst_port,
  CASE event_type WHEN 'click' THEN 'TCP' WHEN 'view' THEN 'UDP' ELSE '47' END AS protocol,
  'port' || regexp_extract(props, '[0-9]+') AS ing_if, 'ann' AS user_name,
  event_id AS sent_bytes, CAST(0 AS BIGINT) AS rcvd_bytes,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS duration, 'a = b' AS threat_name
FROM events""")
def kv_comma_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse(events(spark, sf_dir), fortigate_line(), "fortigate")
    return rows.select(
        "rule_id", micros(), "device_name", "log_type", "action", "rule_name", "src_ip", "src_port",
        "dst_ip", "dst_port", "protocol", "ing_if", "user_name", "sent_bytes", "rcvd_bytes",
        "duration", "threat_name",
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id, epoch_us(date_trunc('second', ts)) AS ts_us,
  'VPN-1 & FW ' || user_id AS device_name, event_type AS action, 'Rule  of ' || event_type AS rule_name,
  'inbound' AS direction, '10.0.0.' || user_id AS src_ip, CAST(0 AS BIGINT) AS src_port,
  CASE WHEN event_type = 'error' THEN 443
       ELSE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS dst_port, 'TCP' AS protocol,
  event_id AS sent_bytes
FROM events""")
def kv_space_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = text(
        "time=", c("epoch"), ' action="', c("event_type"), '"  product="VPN-1 & FW ', c("user"),
        '" i/f_dir="inbound" proto="tcp" src="10.0.0.', c("user"), '" s_port="none" dst_port=',
        F.when(c("event_type") == "error", '""').otherwise(c("k")),
        ' service="443" rule_name="Rule  of ', c("event_type"), '" rule_uid=first rule_uid="', c("id"),
        '" bytes="', c("id"), '"',
    )
    return parse(events(spark, sf_dir), line, "checkpoint").select(
        "rule_id", micros(), "device_name", "action", "rule_name", "direction", "src_ip", "src_port",
        "dst_port", "protocol", "sent_bytes",
    )


# --- JSON --------------------------------------------------------------------


def aws_line() -> Column:
    return text(
        '{"firewall_name": "fw', c("user"), '", "event": {"src_ip": "10.0.0.', c("user"),
        '", "src_port": ', c("k"), ', "dest_ip": {"not": "a leaf"}, "dest_port": ', c("k"),
        '.0, "proto": "tcp", "event_type": "', c("event_type"), '", "alert": {"signature_id": ', c("id"),
        ', "category": [1], "signature": true, "action": null}, "netflow": {"bytes": ', c("id"),
        'e3, "age": 1, "age": ', c("k"), '}, "timestamp": "',
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+0000"}}',
    )


AWS_COLUMNS = (
    "device_name", "log_type", "action", "rule_id", "rule_name", "threat_name", "src_ip", "src_port",
    "dst_ip", "dst_port", "protocol", "sent_bytes", "duration",
)
AWS_SQL = """
SELECT epoch_us(ts) AS ts_us, 'fw' || user_id AS device_name, event_type AS log_type, '' AS action,
  CAST(event_id AS VARCHAR) AS rule_id, '' AS rule_name, 'true' AS threat_name,
  '10.0.0.' || user_id AS src_ip, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS src_port,
  '' AS dst_ip, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS dst_port, 'TCP' AS protocol,
  event_id * 1000 AS sent_bytes, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS duration
FROM events"""


@query(AWS_SQL)
def json_ndjson_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse(events(spark, sf_dir), aws_line(), "aws", one_per_line=True)
    return rows.select(micros(), *AWS_COLUMNS)


@query("""
WITH numbered AS (SELECT *, unnest([1, 2]) AS part FROM orders)
SELECT epoch_us(o_orderdate) AS ts_us, 'customer' || o_custkey AS device_name,
  CASE part WHEN 1 THEN 'first' ELSE o_orderpriority END AS log_type,
  CAST(o_orderkey AS VARCHAR) AS rule_id,
  CASE part WHEN 1 THEN 'a/' || o_orderstatus ELSE o_orderstatus END AS rule_name, o_orderkey AS src_port,
  sha256(CASE part WHEN 1 THEN '{"time": "' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
    || '",  "resourceId": "/x/customer' || o_custkey || '", "category": "first", "properties": {"priority": '
    || o_orderkey || ', "ruleCollectionName": "a", "ruleName": "' || o_orderstatus || '", "sourcePort": "'
    || o_orderkey || '"}}'
  ELSE '{"time":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","resourceId":"customer' || o_custkey
    || '","operationName":"' || o_orderpriority || '","properties":{"priority":"' || o_orderkey
    || '","ruleName":"' || o_orderstatus || '","sourcePort":' || o_orderkey || '}}' END) AS event_uuid
FROM numbered""")
def json_envelope_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes and bare arrays of two records; ids hash each record's own bytes."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority",
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_custkey").cast("string").alias("cust"),
    )
    one = text(
        '{"time": "', c("time"), '",  "resourceId": "/x/customer', c("cust"),
        '", "category": "first", "properties": {"priority": ', c("key"),
        ', "ruleCollectionName": "a", "ruleName": "', c("o_orderstatus"), '", "sourcePort": "', c("key"), '"}}',
    )
    two = text(
        '{"time":"', c("time"), '","resourceId":"customer', c("cust"), '","operationName":"',
        c("o_orderpriority"), '","properties":{"priority":"', c("key"), '","ruleName":"',
        c("o_orderstatus"), '","sourcePort":', c("key"), "}}",
    )
    pair = text("[", one, " , ", two, "]")
    line = F.when(c("o_orderstatus") == "O", pair).otherwise(text('{"n": 2, "records": ', pair, "}"))
    return parse(rows, line, "azure").select(
        micros(), "device_name", "log_type", "rule_id", "rule_name", "src_port", "event_uuid"
    )


@query(AWS_SQL)
def json_multiline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records pretty-printed over several lines, in real files."""
    folder = scratch_dir(spark, "json") + "/logs"
    pretty = F.regexp_replace(aws_line(), r"([{,]) *\"", '$1\n  "')
    events(spark, sf_dir).select(pretty.alias("value")).write.text(folder)
    rows = lw.ingest_network(spark, folder, lw.vendor_mapping("aws")).events
    return rows.select(micros(), *AWS_COLUMNS)


# --- CSV ---------------------------------------------------------------------


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *[F.col(n).cast("string").alias(n) for n in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        "l_returnflag", "l_linestatus",
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("shipped"),
    )


CSV_SQL = """
SELECT epoch_us(l_shipdate) AS ts_us, 'dev ' || l_suppkey AS device_name, l_returnflag AS action,
  CAST(l_orderkey AS VARCHAR) AS rule_id, {name} AS rule_name, '10.0.0.' || l_linenumber AS src_ip,
  l_partkey AS src_port, CAST(l_linenumber AS BIGINT) AS dst_port, l_linestatus AS protocol
FROM lineitem"""
CSV_COLUMNS = (
    "device_name", "action", "rule_id", "rule_name", "src_ip", "src_port", "dst_port", "protocol"
)


@query(CSV_SQL.format(name="""'say "' || l_returnflag || '", ok'"""))
def csv_header_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a header row each; names in any case, values with quotes and commas."""
    folder = scratch_dir(spark, "csv") + "/logs"
    lineitem(spark, sf_dir).select(
        c("shipped").alias("DateTime"), text("dev ", c("l_suppkey")).alias(" HostName "),
        c("l_returnflag").alias("action"), c("l_orderkey").alias("policy_id"),
        text('say "', c("l_returnflag"), '", ok').alias("Rule"),
        text("10.0.0.", c("l_linenumber")).alias("source address"), c("l_partkey").alias("srcport"),
        c("l_linenumber").alias("dst_port"), c("l_linestatus").alias("proto"),
    ).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    rows = lw.ingest_network(spark, folder, lw.vendor_mapping("generic_csv")).events
    return rows.select(micros(), *CSV_COLUMNS)


@query(CSV_SQL.format(name="'two' || chr(10) || chr(10) || 'lines, ' || l_orderkey"))
def csv_multiline_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted values that span lines, blank ones included."""
    folder = scratch_dir(spark, "csv") + "/logs"
    lineitem(spark, sf_dir).select(text(
        c("shipped"), "|dev ", c("l_suppkey"), "|", c("l_returnflag"), "|", c("l_orderkey"),
        '|"two\n\nlines, ', c("l_orderkey"), '"|10.0.0.', c("l_linenumber"), "|", c("l_partkey"), "|",
        c("l_linenumber"), "|", c("l_linestatus"),
    ).alias("value")).write.text(folder)
    mapping = {
        "log_type": "piped", "format": "csv", "delimiter": "pipe",
        "fields": [{"target": "event_timestamp", "source": "col:1", "transform": "auto"}] + [
            {"target": target, "source": f"col:{n}"} for n, target in enumerate(CSV_COLUMNS, start=2)
        ],
    }
    rows = lw.ingest_network(spark, folder, lw.parse_mapping(mapping)).events
    return rows.select(micros(), *CSV_COLUMNS)


@query("""
SELECT epoch_us(l_shipdate) AS ts_us, 'eni-' || l_suppkey AS device_name, '10.0.0.' || l_linenumber AS src_ip,
  l_partkey AS src_port, CASE l_linenumber WHEN 1 THEN 'ICMP' WHEN 6 THEN 'TCP' ELSE CAST(l_linenumber AS VARCHAR) END
  AS protocol, l_orderkey AS sent_bytes, l_returnflag AS action,
  sha256('2,1,eni-' || l_suppkey || ',10.0.0.' || l_linenumber || ',10.0.1.1,' || l_partkey || ',443,'
    || l_linenumber || ',10,' || l_orderkey || ',' || CAST(epoch(l_shipdate) AS BIGINT) || ',0,' || l_returnflag
    || ',OK "x"') AS event_uuid
FROM lineitem""")
def csv_positional_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem(spark, sf_dir)
    epoch = F.unix_seconds(F.to_timestamp("shipped")).cast("string")
    line = text(
        "2 1 eni-", c("l_suppkey"), " 10.0.0.", c("l_linenumber"), " 10.0.1.1 ", c("l_partkey"), " 443 ",
        c("l_linenumber"), " 10 ", c("l_orderkey"), " ", epoch, " 0 ", c("l_returnflag"), ' "OK ""x"""\r',
    )
    return parse(rows, line, "aws_vpc_flow").select(
        micros(), "device_name", "src_ip", "src_port", "protocol", "sent_bytes", "action", "event_uuid"
    )


# --- regex -------------------------------------------------------------------


@query("""
SELECT epoch_us(date_trunc('second', ts)) AS ts_us,
  CASE WHEN event_type IN ('click', 'view') THEN 'access-list' ELSE 'connection' END AS log_type,
  CASE event_type WHEN 'click' THEN 'Allow' WHEN 'view' THEN 'Deny' WHEN 'signup' THEN 'Built'
    ELSE 'Teardown' END AS action,
  CASE WHEN event_type IN ('click', 'view') THEN 'acl_' || user_id ELSE '' END AS rule_name,
  CASE event_type WHEN 'signup' THEN 'Outbound' ELSE '' END AS direction,
  '10.0.0.' || user_id AS src_ip, event_id AS src_port, '10.1.0.' || regexp_extract(props, '[0-9]+') AS dst_ip,
  CAST(443 AS BIGINT) AS dst_port, 'TCP' AS protocol, 'inside' AS ing_if, 'outside' AS egr_if
FROM events WHERE event_type <> 'error'""")
def regex_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sentence shapes; lines of any other shape are quarantined."""
    kind = c("event_type")
    head = text(
        F.date_format("at", "MMM"), F.format_string("%3d", F.dayofmonth("at")),
        F.date_format("at", " yyyy HH:mm:ss"), " fw1 %ASA-6-",
    )
    hit = text(
        head, "106100: access-list acl_", c("user"), " ", F.when(kind == "click", "permitted").otherwise("denied"),
        " tcp inside/10.0.0.", c("user"), "(", c("id"), ") -> outside/10.1.0.", c("k"), "(443) hit-cnt 1",
    )
    flow = text(
        head, F.when(kind == "signup", "302013: Built outbound").otherwise("302014: Teardown"),
        " TCP connection ", c("id"), " for inside:10.0.0.", c("user"), "/", c("id"), " (10.9.9.9/1) to outside:10.1.0.",
        c("k"), "/443 (10.1.0.1/443)",
    )
    line = F.when(kind.isin("click", "view"), hit).when(kind == "error", text("no such ", head)).otherwise(flow)
    return parse(events(spark, sf_dir), line, "cisco_asa").select(
        micros(), "log_type", "action", "rule_name", "direction", "src_ip", "src_port", "dst_ip", "dst_port",
        "protocol", "ing_if", "egr_if",
    )


# --- mapping operators -------------------------------------------------------


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id,
  CASE event_type WHEN 'click' THEN 'a' || user_id WHEN 'view' THEN 'b' || user_id ELSE 'c' || user_id END AS device_name,
  CASE event_type WHEN 'click' THEN 'last' ELSE event_type END AS action
FROM events""")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-empty source wins; of two fields with one target the later one."""
    kind = c("event_type")
    line = text(
        "t=0,id=", c("id"), ",a=", F.when(kind == "click", text("a", c("user"))).otherwise('""'),
        F.when(kind == "view", text(",b=b", c("user"))).otherwise(""), ",c=c", c("user"), ",act=", kind,
        ",late=", F.when(kind == "click", "last").otherwise(""),
    )
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"}, {"target": "device_name", "source": ["a", "", "b", "c"]},
        {"target": "action", "source": "act"}, {"target": "action", "source": "late"},
    )
    return parse(events(spark, sf_dir), line, mapping).select("rule_id", "device_name", "action")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS rule_id, c_mktsegment || ':' || c_nationkey AS log_type,
  CASE WHEN c_nationkey < 10 THEN c_name ELSE c_name || ' / ' || c_nationkey END AS rule_name,
  'none' AS app_name
FROM customer""")
def join_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey").cast("string")
    line = text(
        "t=0 id=", F.col("c_custkey").cast("string"), ' name="', c("c_name"), '" segment=', c("c_mktsegment"),
        " nation=", nation, " big=", F.when(c("c_nationkey") < 10, "").otherwise(nation),
    )
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"}, {"target": "log_type", "join": ["segment", "nation"]},
        {"target": "rule_name", "join": ["name", "nowhere", "big"], "separator": " / "},
        {"target": "app_name", "join": ["nowhere", "nothing"], "default": "none"}, delimiter="space",
    )
    return parse(table(spark, sf_dir, "customer"), line, mapping).select(
        "rule_id", "log_type", "rule_name", "app_name"
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id,
  CASE event_type WHEN 'click' THEN 'Allow' WHEN 'view' THEN 'Deny' WHEN 'error' THEN 'click' ELSE event_type END AS action
FROM events""")
def value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches are replaced, others kept; the default is not looked up."""
    line = text("t=0,id=", c("id"), ",act=", F.when(c("event_type") == "error", "").otherwise(c("event_type")))
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"},
        {"target": "action", "source": "act", "value_map": {"click": "Allow", "view": "Deny"}, "default": "click"},
    )
    return parse(events(spark, sf_dir), line, mapping).select("rule_id", "action")


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id,
  CASE event_type WHEN 'error' THEN 'FALLBACK' ELSE upper(event_type) END AS action, '' AS log_type
FROM events""")
def default_then_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A default passes through the transform, so a log id without /logs/ gives ''."""
    line = text("t=0,id=", c("id"), ",act=", F.when(c("event_type") == "error", "").otherwise(c("event_type")))
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"},
        {"target": "action", "source": "act", "transform": "upper", "default": "fallback"},
        {"target": "log_type", "default": "plain/firewall", "transform": "gcp_log_name_id"},
    )
    return parse(events(spark, sf_dir), line, mapping).select("rule_id", "action", "log_type")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS rule_id, n_chars AS src_port, -n_chars AS dst_port, CAST(0 AS BIGINT) AS nat_src_port,
  CAST(0 AS BIGINT) AS nat_dst_port, CAST(0 AS BIGINT) AS sent_bytes, CAST(9223372036854775807 AS BIGINT) AS rcvd_bytes
FROM documents""")
def int_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars").cast("string")
    line = text(
        "t=0,id=", F.col("doc_id").cast("string"), ",a=+", n, ",b=-", n, ",c=", n, ".5,d=", n,
        "x,e=9223372036854775808,f=9223372036854775807",
    )
    targets = ("src_port", "dst_port", "nat_src_port", "nat_dst_port", "sent_bytes", "rcvd_bytes")
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"}, *[{"target": t, "source": s} for t, s in zip(targets, "abcdef")]
    )
    return parse(table(spark, sf_dir, "documents"), line, mapping).select("rule_id", *targets)


# --- timestamps --------------------------------------------------------------


def _times(spark: SparkSession, sf_dir: str, printed: Column, transform: str) -> DataFrame:
    line = text('t="', printed, '" id=', c("id"))
    mapping = kv_mapping({"target": "rule_id", "source": "id"}, delimiter="space", time=transform)
    return parse(events(spark, sf_dir), line, mapping).select("rule_id", micros())


def _times_sql(printed: str) -> str:
    return f"SELECT CAST(event_id AS VARCHAR) AS rule_id, {printed} AS ts_us FROM events"


SECONDS = _times_sql("epoch_us(date_trunc('second', ts))")
MILLIS = _times_sql("epoch_us(date_trunc('millisecond', ts))")
EXACT = _times_sql("epoch_us(ts)")


@query(SECONDS)
def ts_unix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir, c("epoch"), "unix")


@query(MILLIS)
def ts_unix_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir, F.unix_millis("at").cast("string"), "unix_ms")


@query(EXACT)
def ts_rfc3339(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine-hour offset and nine fraction digits, cut to microseconds."""
    local = F.date_format(F.from_utc_timestamp("at", "Asia/Tokyo"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return _times(spark, sf_dir, text(local, "789+09:00"), "rfc3339nano")


@query(EXACT)
def ts_suricata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(
        spark, sf_dir, text(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "+0000"), "aws_suricata"
    )


@query(_times_sql("CASE WHEN event_type = 'view' THEN epoch_us(ts) ELSE epoch_us(date_trunc('second', ts)) END"))
def ts_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = c("event_type")
    printed = (
        F.when(kind == "click", c("epoch"))
        .when(kind == "view", text(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "Z"))
        .when(kind == "error", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("at", "yyyy/MM/dd  HH:mm:ss"))
    )
    return _times(spark, sf_dir, printed, "auto")


@query(_times_sql("CASE WHEN event_type = 'view' THEN epoch_us(ts) ELSE epoch_us(date_trunc('second', ts)) END"))
def ts_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month names in any case, padded days, afternoon hours, unasked fractions."""
    printed = text(
        F.upper(F.date_format("at", "MMM")), F.format_string("%3d", F.dayofmonth("at")),
        F.date_format("at", " yyyy hh:mm:ss"),
        F.when(c("event_type") == "view", F.date_format("at", ",SSSSSS")).otherwise(""),
        F.date_format("at", " a"), " +0000",
    )
    return _times(spark, sf_dir, printed, "layout:Jan 2 2006 03:04:05 PM -0700")


# --- value transforms --------------------------------------------------------


def _transformed(rows: DataFrame, key: str, value: Column, transform: str) -> DataFrame:
    line = text('t=0 id=', F.col(key).cast("string"), ' v="', value, '"')
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"}, {"target": "rule_name", "source": "v", "transform": transform},
        delimiter="space",
    )
    return parse(rows, line, mapping).select("rule_id", "rule_name")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS rule_id, CASE l_linenumber WHEN 1 THEN 'ICMP' WHEN 6 THEN 'TCP'
  ELSE CAST(l_linenumber AS VARCHAR) END AS rule_name FROM lineitem""")
def proto_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return _transformed(rows, "l_orderkey", F.col("l_linenumber").cast("string"), "proto_num")


@query("SELECT CAST(page_id AS VARCHAR) AS rule_id, string_split(url, '/')[-1] AS rule_name FROM pages")
def basename_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transformed(table(spark, sf_dir, "pages"), "page_id", c("url"), "basename")


@query("""
SELECT CAST(page_id AS VARCHAR) AS rule_id, url || ' é' AS rule_name FROM pages
WHERE url NOT LIKE '%#top'""")
def url_decode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken escapes (here: of the #top pages) are row errors."""
    encoded = text(F.url_encode("url"), "+%C3%a9")
    broken = F.when(F.col("url").endswith("#top"), text(encoded, "%zz")).otherwise(encoded)
    return _transformed(table(spark, sf_dir, "pages"), "page_id", broken, "url_decode")


@query("""
SELECT CAST(page_id AS VARCHAR) AS rule_id, 'p-' || page_id AS device_name, url AS log_type FROM pages""")
def gcp_log_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = text(
        't=0 id=', F.col("page_id").cast("string"), ' n="projects/p-', F.col("page_id").cast("string"),
        "/logs/", F.url_encode("url"), '"',
    )
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"},
        {"target": "device_name", "source": "n", "transform": "gcp_log_name_project"},
        {"target": "log_type", "source": "n", "transform": "gcp_log_name_id"}, delimiter="space",
    )
    return parse(table(spark, sf_dir, "pages"), line, mapping).select("rule_id", "device_name", "log_type")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS rule_id,
  sha256('t=0 id=' || doc_id || ' note="' || replace(replace(text, chr(10), ' '), '"', '') || '"') AS event_uuid
FROM documents""")
def event_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 over whole documents as lines, blanks around the line not counted."""
    body = F.replace(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit('"'), F.lit(""))
    line = text("  \tt=0 id=", F.col("doc_id").cast("string"), ' note="', body, '" \r')
    mapping = kv_mapping({"target": "rule_id", "source": "id"}, delimiter="space")
    return parse(table(spark, sf_dir, "documents"), line, mapping).select("rule_id", "event_uuid")


# --- timeline ----------------------------------------------------------------

ROOT = "/mnt/input"


def timeline_line() -> Column:
    """Raw timeline JSON: numbers and numeric texts, paths with and without the root."""
    kind = c("event_type")
    us = F.unix_micros("at").cast("string")
    return text(
        '{"timestamp": ', F.when(kind == "view", text('"', us, '"')).otherwise(us),
        ', "timestamp_desc": "Creation Time", "data_type": "', kind, '", "display_name": "OS:',
        F.when(kind == "click", text("/elsewhere/", c("user")))
        .when(kind == "signup", text(ROOT, "/host", c("user")))
        .otherwise(text(ROOT, "/host", c("user"), "/C/Users/", c("id"))),
        '", "message": "m ', c("id"), '", "event_identifier": ',
        F.when(kind == "error", "null").when(kind == "view", text('"', c("id"), '"')).otherwise(text(c("id"), ".0")),
        ', "parser": "p', c("k"), '", "username": "u', c("user"), '", "tag": ["a", "', kind, '"], "extra": {"x": 1}}',
    )


TIMELINE_SQL = """
SELECT epoch_us(ts) AS ts_us, 'Creation Time' AS timestamp_desc,
  CASE event_type WHEN 'click' THEN 'unknown' ELSE 'host' || user_id END AS device_name,
  'p' || regexp_extract(props, '[0-9]+') AS parser,
  CASE event_type WHEN 'click' THEN 'OS:/elsewhere/' || user_id
    WHEN 'signup' THEN 'OS:/mnt/input/host' || user_id ELSE 'C/Users/' || event_id END AS display_name,
  'm ' || event_id AS message, event_type AS data_type,
  CASE event_type WHEN 'error' THEN NULL ELSE event_id END AS event_identifier,
  'u' || user_id AS username, 'a,' || event_type AS tags
FROM events"""


@query(TIMELINE_SQL)
def timeline_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = as_line_frame(events(spark, sf_dir), timeline_line())
    return parse_timeline(lines, ROOT + "/").events.select(
        micros(), "timestamp_desc", "device_name", "parser", "display_name", "message", "data_type",
        "event_identifier", "username", F.array_join("tag", ",").alias("tags"),
    )


@query("""
SELECT event_type AS data_type, user_id, 'm ' || event_id AS message, epoch_us(ts) AS ts_us, 1 AS x
FROM events""")
def timeline_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written JSON lines keep the keys the table does not have."""
    folder = scratch_dir(spark, "jsonl")
    parsed = parse_timeline(as_line_frame(events(spark, sf_dir), timeline_line()), ROOT)
    out, _ = sinks.write_timeline_jsonl(parsed, folder, "case1")
    back = spark.read.schema(
        "data_type string, username string, message string, event_timestamp timestamp, extra struct<x:int>"
    ).json(out)
    return back.select(
        "data_type", F.substr("username", F.lit(2)).cast("bigint").alias("user_id"), "message", micros(),
        F.col("extra.x").alias("x"),
    )


@query("""
SELECT CASE WHEN octet_length(encode(text)) + 15 >= 2000 THEN 'line exceeds 2000 byte limit' ELSE '' END AS error,
  count(*) AS n, CAST(sum(octet_length(encode(text)) + 15) AS BIGINT) AS bytes
FROM (SELECT replace(replace(replace(text, '\\', ''), chr(10), ' '), '"', '') AS text FROM documents)
GROUP BY 1""")
def oversize_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines past the limit are set aside with the reason, the others go on."""
    body = F.translate("text", '\n"\\', " ")
    lines = as_line_frame(table(spark, sf_dir, "documents"), text('{"message": "', body, '"}'))
    rows = parse_timeline(lines, ROOT, max_line_bytes=2000).rows
    return rows.groupBy(F.coalesce("error", F.lit("")).alias("error")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("raw_line")).alias("bytes")
    )


# --- errors and sinks --------------------------------------------------------


@query("""
SELECT CASE event_type WHEN 'click' THEN 'event_timestamp: no value'
    WHEN 'view' THEN 'event_timestamp: not a unix time: soon' ELSE '' END AS error,
  count(*) AS n, min(event_id) AS first_id
FROM events GROUP BY 1""")
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = c("event_type")
    line = text(
        "id=", c("id"), ",t=", F.when(kind == "click", "").when(kind == "view", "soon").otherwise(c("epoch"))
    )
    mapping = lw.parse_mapping(kv_mapping({"target": "src_port", "source": "id"}))
    rows = lw.parse_network(as_line_frame(events(spark, sf_dir), line), mapping).rows
    return rows.groupBy(F.coalesce("error", F.lit("")).alias("error")).agg(
        F.count("*").alias("n"), F.min("src_port").alias("first_id")
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id, epoch_us(date_trunc('second', ts)) AS ts_us FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""")
def table_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by day, read ten days back: only their partitions are read."""
    folder = scratch_dir(spark, "table") + "/network_events"
    parsed = lw.parse_network(
        as_line_frame(events(spark, sf_dir), fortigate_line()), lw.vendor_mapping("fortigate")
    )
    sinks.write_parsed(parsed, folder)
    return sinks.scan_network(spark, folder, "2024-01-10", "2024-01-20").select("rule_id", micros())


# --- correlation -------------------------------------------------------------


def demo_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(events(spark, sf_dir), fortigate_line(), "fortigate")


def demo_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_timeline(as_line_frame(events(spark, sf_dir), timeline_line()), ROOT).events


@query("""
SELECT epoch_us(date_trunc('second', ts)) AS utc_us, epoch_us(date_trunc('second', ts) + INTERVAL 9 HOUR) AS local_us,
  'network' AS log_source, 'fw ' || user_id AS device_name, 'ann' AS username, '10.0.0.' || user_id AS src_ip,
  '10.1.0.' || regexp_extract(props, '[0-9]+') AS dst_ip, CAST(443 AS BIGINT) AS dst_port, event_type AS action,
  'traffic:' || event_type || ': a = b' AS summary_detail
FROM events
UNION ALL
SELECT epoch_us(ts), epoch_us(ts + INTERVAL 9 HOUR), 'endpoint',
  CASE event_type WHEN 'click' THEN 'unknown' ELSE 'host' || user_id END, 'u' || user_id, NULL, NULL, NULL, NULL,
  '[p' || regexp_extract(props, '[0-9]+') || '] m ' || event_id
FROM events""")
def nexus_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = correlate.nexus_events(demo_network(spark, sf_dir), demo_timeline(spark, sf_dir))
    return rows.select(
        F.unix_micros("utc_timestamp").alias("utc_us"),
        F.unix_micros(F.col("local_datetime").cast("timestamp")).alias("local_us"),
        "log_source", "device_name", "username", "src_ip", "dst_ip", "dst_port", "action", "summary_detail",
    )


def logon_line() -> Column:
    """Clicks are successful logons, views failed ones, purchases have a list cut short."""
    kind = c("event_type")
    success = [f"'s{i}'" for i in range(27)]
    failure = [f"'f{i}'" for i in range(21)]

    def listed(items: list[str], workstation: int, address: int) -> Column:
        parts: list[str | Column] = []
        for i, item in enumerate(items):
            parts.append(", " if i else "")
            if i == 5:
                parts += ["'user ", c("k"), "'"]
            elif i == workstation:
                parts += ["'ws", c("id"), "'"]
            elif i == address:
                parts += ["'ip", c("user"), "'"]
            else:
                parts.append(item)
        return text(*parts)

    strings = (
        F.when(kind == "view", listed(failure, 13, 19))
        .when(kind == "purchase", text("'a', 'b', 'c', 'd', '', 'user ", c("k"), "', 'cut]', 'off'"))
        .otherwise(listed(success, 11, 18))
    )
    return text(
        '{"timestamp": ', F.unix_micros("at").cast("string"), ', "data_type": "',
        F.when(kind == "error", "other").otherwise("windows:evtx:record"),
        '", "event_identifier": ', F.when(kind == "view", "4625").when(kind == "signup", "4634").otherwise("4624"),
        ', "display_name": "', ROOT, "/host", c("user"), '/x", "message": "[4624] Strings:  [', strings, '] Computer"}',
    )


@query("""
SELECT epoch_us(ts) AS ts_us, CASE WHEN event_type = 'purchase' THEN NULL ELSE 'ip' || user_id END AS src_ip,
  CASE WHEN event_type = 'purchase' THEN NULL ELSE 'ws' || event_id END AS src_name,
  CAST(NULL AS VARCHAR) AS dst_ip, 'host' || user_id AS dst_name,
  'user ' || regexp_extract(props, '[0-9]+') AS user_name
FROM events WHERE event_type IN ('click', 'view', 'purchase') AND ts >= TIMESTAMP '2024-01-05'
UNION ALL
SELECT epoch_us(date_trunc('second', ts)), '10.0.0.' || user_id, NULL, '10.1.0.' || regexp_extract(props, '[0-9]+'),
  NULL, 'ann' FROM events""")
def logon_nexus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logons, successful and failed, beside the network's rows."""
    timeline = parse_timeline(as_line_frame(events(spark, sf_dir), logon_line()), ROOT).events
    rows = correlate.logon_nexus(demo_network(spark, sf_dir), timeline, since="2024-01-05 00:00:00")
    return rows.select(micros(), "src_ip", "src_name", "dst_ip", "dst_name", "user_name")


# --- routing -----------------------------------------------------------------


def _objects(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", key.alias("key"))


@query("""
SELECT doc_id, CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN NULL ELSE source END AS log_type,
  CASE WHEN lang = 'fr' THEN 'outside the log/ prefix' WHEN lang = 'de' THEN 'no log type in the path'
    WHEN source NOT IN ('src1', 'src2', 'src3') THEN 'log type not allowed' END AS reject
FROM documents""")
def route_log_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = text(c("source"), "/f", F.col("doc_id").cast("string"), ".log")
    key = F.when(c("lang") == "fr", text("config/", name)).when(
        c("lang") == "de", text("log/", c("source"))).otherwise(text("log/", name))
    routed = routing.route_logs(_objects(spark, sf_dir, key), ("src1", "src2", "src3"))
    return routed.select("doc_id", "log_type", "reject")


@query("""
SELECT doc_id, CASE WHEN lang = 'es' THEN NULL ELSE 'case-' || source END AS case_id,
  CASE WHEN lang = 'fr' THEN 'not a timeline file' WHEN lang = 'es' THEN 'no case id in the name' END AS reject
FROM documents""")
def route_timeline_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = text(
        F.when(c("lang") == "es", "").otherwise(text("case-", c("source"))), "-timeline-2024-timeline-",
        F.when(c("lang") == "fr", "x.txt").otherwise("x.JSONL"),
    )
    return routing.route_timelines(_objects(spark, sf_dir, key)).select("doc_id", "case_id", "reject")


@query("""
SELECT d.doc_id FROM documents d
WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)
  AND EXISTS (SELECT 1 FROM documents m JOIN labels l USING (doc_id) WHERE m.source = d.source AND m.lang = d.lang)""")
def ready_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents stand for the completion markers of their folder."""
    labelled = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("is_marker")).distinct()
    name = F.when(c("is_marker"), "_READY").otherwise(text("f", F.col("doc_id").cast("string")))
    listing = table(spark, sf_dir, "documents").join(labelled, "doc_id", "left").select(
        "doc_id", text("case/", c("source"), "/", c("lang"), "/", name).alias("key")
    )
    return routing.ready_only(listing).select("doc_id")


@query("""
SELECT doc_id, CASE lang WHEN 'fr' THEN 'unknown' ELSE source || '.v1' END AS device_name
FROM documents WHERE lang <> 'de'""")
def route_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = text(
        "up/", F.when(c("lang") == "fr", "").otherwise(text(c("source"), ".v1")), ".",
        F.when(c("lang") == "de", "case8").otherwise("Case7"),
    )
    return routing.route_artifacts(_objects(spark, sf_dir, key), "CASE7").select("doc_id", "device_name")


# --- archives, chunks, streams -----------------------------------------------


def _renamed(spark: SparkSession, old: str, new: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(new).getParent())
    if not system.rename(path(old), path(new)):
        raise RuntimeError(f"cannot rename {old}")


def _written(spark: SparkSession, rows: DataFrame, folder: str) -> list[str]:
    """Write lines (``value``) as text; returns the paths of the parts."""
    rows.write.text(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().toString() for x in system.globStatus(path(f"{folder}/part-*")))


def _one_file(spark: SparkSession, rows: DataFrame, order: str, folder: str) -> None:
    """Lines (``value``) by ``order`` as the one file of a folder: sorted by many tasks, their parts copied one after the other by one."""
    parts = _written(spark, rows.orderBy(order).select("value"), f"{folder}-parts")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for paths in batch["paths"]:
                store, path = open_store(folder)
                store.create_dir(path, recursive=True)
                with store.open_output_stream(f"{path}/all.log", compression=None) as out:
                    for part in paths:
                        own, at = open_store(part)
                        with own.open_input_stream(at, compression=None) as file:
                            while piece := file.read(8 << 20):
                                out.write(piece)
                yield pd.DataFrame({"n": [len(paths)]})

    spark.createDataFrame([(parts,)], "paths array<string>").coalesce(1).mapInPandas(joined, "n bigint").collect()


@F.pandas_udf(BinaryType())
def _packed(name: pd.Series, body: pd.Series) -> pd.Series:
    """A zip or a tar.gz of one log file, the zip inside a tar for some."""

    def pack(archive: str, text_: str) -> bytes:
        data = text_.encode()
        out = io.BytesIO()
        if archive.endswith(".zip"):
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("dir/app.log", data)
            return out.getvalue()
        with tarfile.open(fileobj=out, mode="w:gz") as tar:
            entry, inner = "app.log", data
            if archive.startswith("nested"):
                entry, inner = "in.zip", pack("x.zip", text_)
            info = tarfile.TarInfo(entry)
            info.size = len(inner)
            tar.addfile(info, io.BytesIO(inner))
        return out.getvalue()

    return pd.Series([pack(n, b) for n, b in zip(name, body)])


@query("""
SELECT source, count(*) AS n_ready FROM documents
WHERE source IN (SELECT source FROM documents GROUP BY source HAVING min(doc_id) % 2 = 0) GROUP BY source""")
def ready_gate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real folder for each source; only those with a completion marker are let through."""
    base = scratch_dir(spark, "ready")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    docs.withColumn("folder", F.col("source")).select(F.col("doc_id").cast("string").alias("value"), "folder").write.partitionBy("folder").text(base)
    ready = docs.groupBy("source").agg(F.min("doc_id").alias("least")).where("least % 2 = 0")
    for row in ready.select("source").toLocalIterator():   # a marker for each source
        sinks.write_manifest(spark, f"{base}/folder={row.source}", row.source, row.source, 1, 1)
    found = routing.with_key(list_with_markers(spark, base, routing.MARKER), f"file:{base}")
    open_files = routing.ready_only(found).select("path")
    lines = spark.read.option("recursiveFileLookup", True).text(base).select(F.col("_metadata.file_path").alias("path"), "value")
    source = F.regexp_extract("path", "folder=([^/]+)/", 1).alias("source")
    return lines.join(open_files, "path", "left_semi").groupBy(source).agg(F.count("*").alias("n_ready"))


@query("SELECT event_type AS action, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY event_type")
def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each kind of event, two of them under names that Spark's scans leave out: all are read."""
    base = scratch_dir(spark, "prefix")
    rows = events(spark, sf_dir)
    rows.select(text("t=0,id=", c("id"), ",act=", c("event_type")).alias("value"), c("event_type").alias("kind")).write.partitionBy("kind").text(f"{base}/logs")
    _renamed(spark, f"{base}/logs/kind=error", f"{base}/logs/_error")
    _renamed(spark, f"{base}/logs/kind=view", f"{base}/logs/.view")
    mapping = lw.parse_mapping(kv_mapping({"target": "src_port", "source": "id"}, {"target": "action", "source": "act"}))
    found = lw.ingest_network(spark, f"{base}/logs", mapping).events
    return found.groupBy("action").agg(F.count("*").alias("n"), F.min("src_port").alias("first_id"), F.max("src_port").alias("last_id"))


@query("SELECT CAST(event_id AS VARCHAR) AS rule_id, event_type AS action FROM events")
def lower_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-case actions come back in lower case."""
    line = text("t=0,id=", c("id"), ",act=", F.upper(c("event_type")))
    mapping = kv_mapping(
        {"target": "rule_id", "source": "id"}, {"target": "action", "source": "act", "transform": "lower"})
    return parse(events(spark, sf_dir), line, mapping).select("rule_id", "action")


@query("""
SELECT event_id AS id, epoch_us(ts) AS ts_us FROM events WHERE event_type <> 'error'""")
def stream_timeline_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline objects ingested by a stream, read back from the table; error events have a time the stream must reject."""
    base = scratch_dir(spark, "timeline")
    rows = events(spark, sf_dir)
    beyond = F.lit(10**18)   # microseconds past year 9999
    line = F.to_json(F.struct(F.when(c("event_type") == "error", beyond).otherwise(F.unix_micros("at")).alias("timestamp"), c("id").alias("message")))
    rows.select(line.alias("value")).write.text(f"{base}/parts")
    folder = f"{base}/in"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    system = path(base).getFileSystem(conf)
    system.mkdirs(path(folder))
    for n, part in enumerate(system.globStatus(path(f"{base}/parts/part-*"))):   # written parts get the names of timelines
        system.rename(part.getPath(), path(f"{folder}/case{n}-timeline-1.jsonl"))
    stream_timeline(spark, folder, f"{base}/table", f"{base}/checkpoint", "/mnt").trigger(
        availableNow=True).start().awaitTermination()
    n_rejected, n_errors = sinks.scan_quarantine(spark, f"{base}/table").count(), rows.where("event_type = 'error'").count()
    if n_rejected != n_errors:
        raise RuntimeError(f"{n_errors} events must be rejected, {n_rejected} were")
    return sinks.scan_timeline(spark, f"{base}/table").select(
        F.col("message").cast("bigint").alias("id"), F.unix_micros("event_timestamp").alias("ts_us"))


@query("""
SELECT conv_id || '/' || CASE role WHEN 'user' THEN 'a' || turn || '.zip!dir/app.log'
  ELSE 'nested' || turn || '.tgz!dir/app.log' END AS source_file, count(*) AS n_lines,
  CAST(sum(octet_length(encode(line))) AS BIGINT) AS n_bytes
FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line FROM conversations
      WHERE role = 'user' OR role <> 'user')
WHERE line <> '' GROUP BY 1""")
def archive_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn packed on its own; lines come back with archive and entry name."""
    rows = table(spark, sf_dir, "conversations")
    turn = F.col("turn").cast("string")
    name = F.when(c("role") == "user", text("a", turn, ".zip")).otherwise(text("nested", turn, ".tgz"))
    files = rows.select(
        text(F.col("conv_id").cast("string"), "/", name).alias("path"), _packed(name, c("text")).alias("content")
    )
    return archive_lines_of(files).where(F.col("value") != "").groupBy("source_file").agg(
        F.count("*").alias("n_lines"), F.sum(F.octet_length("value")).alias("n_bytes")
    )


@query("SELECT CAST(event_id AS VARCHAR) AS rule_id, event_type AS action, user_id AS src_port FROM events")
def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives in a folder, one of them of a hidden name: zips of many entries, tars with zips in them."""
    base = scratch_dir(spark, "packed")
    rows = events(spark, sf_dir)
    line = text("t=0,id=", c("id"), ",act=", c("event_type"), ",port=", c("user"))
    rows.select(line.alias("value"), F.pmod("event_id", F.lit(6)).alias("archive")).groupBy("archive").applyInPandas(
        _archive_of(f"{base}/in"), "path string").write.parquet(f"{base}/done")
    mapping = lw.parse_mapping(kv_mapping(
        {"target": "rule_id", "source": "id"}, {"target": "action", "source": "act"}, {"target": "src_port", "source": "port"}))
    return lw.ingest_network(spark, f"{base}/in", mapping).events.select("rule_id", "action", "src_port")


def _archive_of(folder: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Write the lines of a group as one archive into the shared folder."""

    def write(group: pd.DataFrame) -> pd.DataFrame:
        n, lines = int(group["archive"].iloc[0]), group["value"].tolist()
        pieces = [("\n".join(lines[i::7]) + "\n").encode() for i in range(min(7, len(lines)))]
        out = io.BytesIO()
        if n % 2:
            name = f"{'_' if n == 5 else ''}a{n}.zip"
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for i, piece in enumerate(pieces):
                    z.writestr(f"dir/{i}.log", piece)
        else:
            name = f"a{n}.tar.gz"
            with tarfile.open(fileobj=out, mode="w:gz") as tar:
                for i, piece in enumerate(pieces):
                    entry, body = f"{i}.log", piece
                    if i % 2:
                        inner = io.BytesIO()
                        with zipfile.ZipFile(inner, "w") as z:
                            z.writestr("in.log", piece)
                        entry, body = f"{i}.zip", inner.getvalue()
                    info = tarfile.TarInfo(entry)
                    info.size = len(body)
                    tar.addfile(info, io.BytesIO(body))
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{name}", compression=None) as file:
            file.write(out.getvalue())
        return pd.DataFrame({"path": [f"{folder}/{name}"]})

    return write


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN sha256(text) END AS digest,
  CASE WHEN lang = 'en' THEN NULL WHEN lang = 'fr' THEN 'chunk too short for its nonce'
    ELSE 'chunk does not decrypt: wrong key or damaged' END AS error
FROM documents""")
def decrypt_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents encrypted; French ones cut short, others with another key."""
    keys = F.when(c("lang") == "en", F.lit("0123456789abcdef0123456789abcdef")).otherwise(
        F.lit("another-key-another-key-another-"))
    sealed = F.aes_encrypt(F.encode("text", "utf-8"), keys.cast("binary"), F.lit("GCM"))
    chunks = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(c("lang") == "fr", F.substr(sealed, F.lit(1), F.lit(7))).otherwise(sealed).alias("payload")
    )
    plain = decrypt(chunks, F.lit(b"0123456789abcdef0123456789abcdef"))
    return plain.select(
        "doc_id", F.when(F.col("plain").isNotNull(), F.sha2("plain", 256)).alias("digest"), "error"
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id, 'fw ' || user_id AS device_name, event_id AS sent_bytes
FROM events""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New objects under log/ ingested by a stream; the rest is set aside."""
    base = scratch_dir(spark, "stream")
    events(spark, sf_dir).select(fortigate_line().alias("value")).write.text(f"{base}/in/log/fortigate/day1")
    running = stream_network(
        spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", ["fortigate"],
        mapping_for=lw.vendor_mapping,
    ).trigger(availableNow=True).start()
    running.awaitTermination()
    return sinks.scan_network(spark, f"{base}/table").select("rule_id", "device_name", "sent_bytes")


@query("SELECT event_type AS action, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def stream_hidden_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream takes objects of hidden names, and in hidden folders, as any other."""
    base = scratch_dir(spark, "hidden")
    line = text("t=0,id=", c("id"), ",act=", c("event_type"))
    names = ("log/demo/a{}.log", "log/demo/_a{}.log", "log/demo/_deep/a{}.log", "log/demo/.a{}.log")
    for n, part in enumerate(_written(spark, events(spark, sf_dir).select(line.alias("value")), f"{base}/parts")):
        _renamed(spark, part, f"{base}/in/" + names[n % 4].format(n))
    mapping = lw.parse_mapping(kv_mapping({"target": "src_port", "source": "id"}, {"target": "action", "source": "act"}))
    stream_network(spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", ["demo"], mapping_for=lambda _: mapping).trigger(
        availableNow=True).start().awaitTermination()
    return sinks.scan_network(spark, f"{base}/table").groupBy("action").agg(F.count("*").alias("n"), F.sum("src_port").alias("ids"))


@query("""
SELECT event_id AS id, event_type AS folder FROM events WHERE event_type NOT IN ('error', 'purchase')""")
def stream_ready_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each kind of event: markers before, with and after the objects, in a later start, or never."""
    base = scratch_dir(spark, "gate")
    line = F.to_json(F.struct(F.unix_micros("at").alias("timestamp"), c("id").alias("message"), c("event_type").alias("parser")))
    rows = events(spark, sf_dir).select(line.alias("value"), c("event_type").alias("kind")).persist()
    kinds = [r.kind for r in rows.select("kind").distinct().orderBy("kind").collect()]   # a handful of types

    def put(kind: str) -> None:
        own = rows.where(c("kind") == kind).select("value")
        for n, part in enumerate(_written(spark, own, f"{base}/parts/{kind}")):
            _renamed(spark, part, f"{base}/in/{kind}/case-timeline-{n}.jsonl")

    def mark(kind: str) -> None:
        sinks.write_manifest(spark, f"{base}/in/{kind}", "case", kind, 1, 1)

    def run() -> None:
        stream_timeline(spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", "/mnt", gate=True).trigger(
            availableNow=True).start().awaitTermination()

    for kind in kinds:
        if kind == "click":
            mark(kind)          # before its objects
        else:
            put(kind)
    run()
    if "click" in kinds:
        put("click")
    for kind in kinds:
        if kind not in ("click", "error", "purchase"):
            mark(kind)          # after its objects
    run()
    rows.unpersist()
    return sinks.scan_timeline(spark, f"{base}/table").select(c("message").cast("bigint").alias("id"), c("parser").alias("folder"))


@query("""
SELECT 'loaded' AS outcome, event_id AS id, 0 AS attempts FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'dead', count(*) * 0, 3 FROM events WHERE event_type = 'error' HAVING count(*) > 0""")
def stream_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views fail twice and are loaded once then; errors fail for good and end as a dead letter."""
    base = scratch_dir(spark, "retries")
    folder = f"{base}/in/log/demo"
    rows = events(spark, sf_dir).select(text("t=0,id=", c("id")).alias("value"), c("event_type").alias("kind")).persist()
    rows.where("kind NOT IN ('view', 'error')").select("value").write.text(folder)
    whole = {}
    for kind in ("view", "error"):
        rows.where(c("kind") == kind).select("value").coalesce(1).write.option("compression", "gzip").text(f"{base}/{kind}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        system = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        (part,) = [x.getPath().toString() for x in system.globStatus(path(f"{base}/{kind}/part-*"))]
        whole[kind] = part
        _damaged(part, f"{folder}/{kind}.log.gz")
    mapping = lw.parse_mapping(kv_mapping({"target": "src_port", "source": "id"}))

    def run() -> None:
        stream_network(
            spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", ["demo"], mapping_for=lambda _: mapping, max_attempts=3, backoff=(0, 0),
        ).trigger(availableNow=True).start().awaitTermination()

    run()
    run()
    _mended(whole["view"], f"{folder}/view.log.gz")
    run()
    run()
    rows.unpersist()
    noted = failures(spark, f"{base}/checkpoint").where(c("path").contains("view.log")).count()
    if noted != 2:
        raise RuntimeError(f"the views were to fail twice, not {noted} times")
    loaded = sinks.scan_network(spark, f"{base}/table").select(F.lit("loaded").alias("outcome"), c("src_port").alias("id"), F.lit(0).alias("attempts"))
    dead = dead_letters(spark, f"{base}/checkpoint").select(F.lit("dead").alias("outcome"), F.lit(0).cast("bigint").alias("id"), c("attempt").alias("attempts"))
    return loaded.unionAll(dead)


def _damaged(source: str, target: str) -> None:
    """The object with zeros for its second half: of the same length, but no whole .gz."""
    _copied(source, target, lambda body: body[: len(body) // 2] + bytes(len(body) - len(body) // 2))


def _mended(source: str, target: str) -> None:
    """The whole object in place of the damaged one; its time stays, so that a listing sees the same object."""
    store, path = open_store(target)
    before = store.get_file_info(path).mtime_ns
    _copied(source, target, lambda body: body)
    os.utime(path, ns=(before, before))


def _copied(source: str, target: str, change: Callable[[bytes], bytes]) -> None:
    store, path = open_store(source)
    with store.open_input_stream(path, compression=None) as file:
        body = file.read()
    store, path = open_store(target)
    with store.open_output_stream(path, compression=None) as file:
        file.write(change(body))


@query(ORACLES["logon_nexus"])
def logon_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logon table brought up to date by days: first with early events, then with all, one run replaced."""
    base = scratch_dir(spark, "logons")
    net, tl, table = f"{base}/network", f"{base}/timeline", f"{base}/logons"
    early = c("at") < F.lit("2024-01-20").cast("timestamp")

    def write(rows: DataFrame, run: str) -> None:
        network = lw.parse_network(as_line_frame(rows, fortigate_line()), lw.vendor_mapping("fortigate"), lw.Options(multiline=False))
        sinks.write_parsed(network, net, run=run)
        sinks.write_parsed(parse_timeline(as_line_frame(rows, logon_line()), ROOT), tl, run=run)

    rows = events(spark, sf_dir)
    since = "2024-01-05 00:00:00"
    write(rows.where(early & (c("event_type") != "view")), "one")   # incomplete: replaced below
    rebuild.rebuild_logons(spark, net, tl, table, since=since)
    write(rows.where(early), "one")
    write(rows.where(~early), "two")
    rebuild.rebuild_logons(spark, net, tl, table, since=since)
    return rebuild.scan_logons(spark, table).select(micros(), "src_ip", "src_name", "dst_ip", "dst_name", "user_name")


# --- mappings, counters, views and the rest ----------------------------------


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id, upper(event_type) AS action, CASE WHEN event_type = 'error' THEN 'ERR' ELSE event_type END AS threat_name, 'none' AS user_name
FROM events""")
def mapping_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping read from its config document in the case's folder."""
    base = scratch_dir(spark, "config")
    document = kv_mapping(
        {"target": "rule_id", "source": "id"}, {"target": "action", "source": ["none", "act"], "transform": "upper"},
        {"target": "threat_name", "source": "act", "value_map": {"error": "ERR"}}, {"target": "user_name", "source": "who", "default": "none"})
    put_object(spark, f"{base}/config/demo.json", json.dumps(document).encode())
    rows = events(spark, sf_dir)
    line = text("t=", c("epoch"), ",id=", c("id"), ",act=", c("event_type"))
    return lw.parse_network(as_line_frame(rows, line), lw.load_mapping(spark, base, "demo")).events.select("rule_id", "action", "threat_name", "user_name")


@query("""
SELECT epoch_us(ts) AS ts_us, 'prj' || user_id AS device_name, 'log/' || event_type AS log_type,
  CASE event_type WHEN 'error' THEN '' ELSE 'DENIED' END AS action, '10.0.0.' || user_id AS src_ip, event_id AS src_port,
  CASE event_type WHEN 'click' THEN 'TCP' WHEN 'signup' THEN 'ICMP' ELSE '47' END AS protocol
FROM events""")
def google_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = c("event_type")
    name = text("projects/prj", c("user"), "/logs/log%2F", kind)
    line = text(
        '{"logName": "', name, '", "receiveTimestamp": "', F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        '", "jsonPayload": {"connection": {"src_ip": "10.0.0.', c("user"), '", "src_port": ', c("id"), ', "protocol": ',
        F.when(kind == "click", "6").when(kind == "signup", "1").otherwise("47"), "}",
        F.when(kind == "error", "").otherwise(', "rule_details": {"action": "DENIED"}'), "}}")
    return parse(events(spark, sf_dir), line, "google", one_per_line=True).select(
        micros(), "device_name", "log_type", "action", "src_ip", "src_port", "protocol")


@query("""
SELECT epoch_us(date_trunc('second', ts)) AS ts_us, 'pa' || user_id AS device_name, event_type AS action, '10.0.0.' || user_id AS src_ip, event_id AS src_port,
  CASE event_type WHEN 'click' THEN 'TCP' ELSE 'UDP' END AS protocol, 'say "' || event_type || '", twice' AS rule_name
FROM events""")
def paloalto_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a header of spaced names; every partition is a file of its own header."""
    folder = scratch_dir(spark, "pa") + "/logs"
    events(spark, sf_dir).select(
        F.date_format("at", "yyyy/MM/dd HH:mm:ss").alias("Generate Time"), text("pa", c("user")).alias("Device Name"), c("event_type").alias("ACTION"),
        text('say "', c("event_type"), '", twice').alias("Rule"), text("10.0.0.", c("user")).alias("Source address"), c("id").alias("Source Port"),
        F.when(c("event_type") == "click", "tcp").otherwise("udp").alias("IP Protocol"),
    ).write.option("header", True).option("escape", '"').csv(folder)
    rows = lw.ingest_network(spark, folder, lw.vendor_mapping("paloalto"), options=lw.Options(multiline=False)).events
    return rows.select(micros(), "device_name", "action", "src_ip", "src_port", "protocol", "rule_name")


@query("""
SELECT count(*) AS events_loaded, 0 AS rows_skipped FROM events WHERE event_type <> 'error'
UNION ALL SELECT 0, count(*) FROM events WHERE event_type = 'error'""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of two runs: one whose lines are all good, one whose lines are all bad."""
    base = scratch_dir(spark, "counters")
    mapping = lw.parse_mapping(kv_mapping({"target": "rule_id", "source": "id"}))
    line = text("t=", F.when(c("event_type") == "error", "soon").otherwise("0"), ",id=", c("id"))
    rows = events(spark, sf_dir)
    counted = [sinks.write_parsed(lw.parse_network(as_line_frame(rows.where(some), line), mapping), f"{base}/table")
               for some in ("event_type <> 'error'", "event_type = 'error'")]
    return spark.createDataFrame([(x["events_loaded"], x["rows_skipped"]) for x in counted], "events_loaded bigint, rows_skipped bigint")


@query("""
SELECT log_source, count(*) AS n FROM (
  SELECT 'network' AS log_source FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_type = 'click'
  UNION ALL SELECT 'endpoint' FROM events WHERE ts >= TIMESTAMP '2024-01-10') GROUP BY 1""")
def nexus_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over both tables, asked by its name in SQL."""
    sinks.create_nexus_view(demo_network(spark, sf_dir), demo_timeline(spark, sf_dir), "all_events")
    return spark.sql("""
        SELECT log_source, count(*) AS n FROM all_events
        WHERE utc_timestamp >= date_trunc('SECOND', TIMESTAMP '2024-01-10') AND (log_source = 'endpoint' OR action = 'click') GROUP BY log_source""")


@query("""
SELECT event_id, user_id % 3 AS bucket FROM events WHERE event_type = 'click' AND user_id % 3 = 1""")
def accept_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of one kind and one bucket out of all events."""
    notices = events(spark, sf_dir).withColumn("bucket", text("b", F.pmod("user_id", F.lit(3)).cast("string")))
    found = routing.accept_events(notices, "click", "b1")
    return found.select("event_id", F.substr("bucket", F.lit(2)).cast("bigint").alias("bucket"))


@query("""
SELECT DISTINCT event_type AS name, true AS refused_value, true AS refused_time, false AS refused_known FROM events""")
def refused_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of event as the name of a transform: none is known, neither for values nor for times."""
    def refused(*fields: dict) -> bool:
        try:
            lw.parse_mapping({"log_type": "demo", "format": "kv", "fields": list(fields)})
        except lw.MappingError:
            return True
        return False

    at = {"target": "event_timestamp", "source": "t", "transform": "unix"}
    names = [r.event_type for r in events(spark, sf_dir).select("event_type").distinct().collect()]   # a handful
    return spark.createDataFrame([
        (n, refused(at, {"target": "action", "source": "a", "transform": n}), refused({**at, "transform": n}), refused(at, {"target": "action", "source": "a", "transform": "upper"}))
        for n in names], "name string, refused_value boolean, refused_time boolean, refused_known boolean")


@query("""
SELECT event_type AS log_type, count(*) AS n, 1 AS warnings FROM events GROUP BY event_type""")
def template_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping marked as an unchecked template says so once for its log type, however often it parses."""
    rows = events(spark, sf_dir)
    kinds = [r.event_type for r in rows.select("event_type").distinct().collect()]   # a handful
    out = []
    for kind in kinds:
        document = kv_mapping({"target": "rule_id", "source": "id"}) | {"log_type": f"{kind} {uuid.uuid4().hex}", "template_warning": "try it first"}
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            for _ in range(2):
                own = rows.where(c("event_type") == kind)
                n = lw.parse_network(as_line_frame(own, text("t=0,id=", c("id"))), lw.parse_mapping(document)).events.count()
        out.append((kind, n, sum("try it first" in str(w.message) for w in caught)))
    return spark.createDataFrame(out, "log_type string, n bigint, warnings int")


@query("""
SELECT sha256('{"message": "m ' || event_id || '", "username": "ü' || user_id || '"}') AS event_uuid, 'm ' || event_id AS message FROM events""")
def timeline_event_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of a timeline event is the hash of its line's bytes."""
    line = text('{"message": "m ', c("id"), '", "username": "ü', c("user"), '"}')
    return parse_timeline(as_line_frame(events(spark, sf_dir), line), ROOT).events.select("event_uuid", "message")


@query("""
SELECT 'm ' || event_id AS message, epoch_us(ts) AS ts_us FROM events WHERE ts >= TIMESTAMP '2024-01-15'""")
def timeline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted timeline rows appended to a plain table, read back from a time on."""
    folder = scratch_dir(spark, "timeline") + "/table"
    sinks.write_timeline(demo_timeline(spark, sf_dir), folder)
    return sinks.scan_timeline(spark, folder, since="2024-01-15").select("message", micros())


@query("SELECT strftime(max(ts), '%Y%m%dT%H%M%SZ') AS stamp, count(*) AS n FROM events")
def run_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp of a run that ended with the last event names its output."""
    folder = scratch_dir(spark, "stamped")
    rows = events(spark, sf_dir)
    (last,) = rows.agg(F.unix_micros(F.max("at"))).first()
    stamp = sinks.run_stamp(datetime.fromtimestamp(last // 1_000_000, timezone.utc))
    out, _ = sinks.write_timeline_jsonl(parse_timeline(as_line_frame(rows, timeline_line()), ROOT), folder, "case", stamp)
    name = F.regexp_extract(F.col("_metadata.file_path"), "case-timeline-([^/]*)[.]jsonl/", 1)
    return spark.read.text(out).select(name.alias("stamp")).groupBy("stamp").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS rule_id, 'from ' || event_type AS action FROM events""")
def custom_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader of one's own for a format that no mapping describes."""
    def fixed_width(frame: DataFrame, mapping: lw.Mapping, options: lw.Options):
        rows = frame.withColumn("raw", c("value")).withColumn("error", F.lit(None).cast("string"))
        return rows, lambda path: F.lit("0") if path == "t" else F.btrim(F.substring("value", 1 + 20 * int(path), 20))

    lw.register_format("fixed width", fixed_width)
    mapping = kv_mapping({"target": "rule_id", "source": "0"}, {"target": "action", "join": ["2", "1"], "separator": " "}) | {"log_type": "fixed width"}
    line = text(F.rpad("id", 20, " "), F.rpad("event_type", 20, " "), "from")
    return parse(events(spark, sf_dir), line, mapping).select("rule_id", "action")


@query("""
SELECT line_number, 'event_timestamp: not a unix time: soon' AS error, event_id AS id
FROM (SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) * 2 AS line_number FROM events) WHERE event_type = 'error'""")
def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with a blank line before each event: bad rows know the number of their line."""
    folder = scratch_dir(spark, "numbered") + "/logs"
    line = text("\nt=", F.when(c("event_type") == "error", "soon").otherwise("0"), ",id=", c("id"))
    _one_file(spark, events(spark, sf_dir).select("event_id", line.alias("value")), "event_id", folder)
    bad = lw.ingest_network(spark, folder, lw.parse_mapping(kv_mapping())).quarantine(line_numbers=True)
    return bad.select("line_number", "error", F.regexp_extract("raw_line", "id=([0-9]+)", 1).cast("bigint").alias("id"))


@query("""
SELECT line_number, 'line exceeds 40 byte limit' AS reason
FROM (SELECT event_type, row_number() OVER (ORDER BY event_id) AS line_number FROM events) WHERE event_type = 'error'""")
def timeline_error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines past the limit end in the error file, by number and reason."""
    base = scratch_dir(spark, "errors")
    line = text('{"message": "', c("id"), '"', F.when(c("event_type") == "error", F.lit(', "username": "a very long name"')).otherwise(""), "}")
    _one_file(spark, events(spark, sf_dir).select("event_id", line.alias("value")), "event_id", f"{base}/in")
    _, errors = sinks.write_timeline_jsonl(ingest_timeline(spark, f"{base}/in", ROOT, max_line_bytes=40), base, "case", "s")
    return spark.read.schema("line_number bigint, reason string").json(errors)


@query("""
SELECT epoch_us(l_shipdate) AS ts_us, 'dev' || l_suppkey AS device_name, CAST(l_orderkey AS VARCHAR) AS rule_id, l_returnflag || chr(9) || 'x' AS rule_name FROM lineitem""")
def csv_tab_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tabs between fields, and one inside quotes."""
    mapping = {"log_type": "tabbed", "format": "csv", "delimiter": "tab", "fields": [{"target": "event_timestamp", "source": "col:1", "transform": "auto"}] + [
        {"target": t, "source": f"col:{n}"} for n, t in enumerate(("device_name", "rule_id", "rule_name"), start=2)]}
    line = text(c("shipped"), "\tdev", c("l_suppkey"), "\t", c("l_orderkey"), '\t"', c("l_returnflag"), '\tx"')
    return parse(lineitem(spark, sf_dir), line, mapping).select(micros(), "device_name", "rule_id", "rule_name")


@query("""
SELECT path, n_chunks, array_to_string(list_filter(range(0, last), lambda x: NOT list_contains(ks, x)), ',') AS missing, repeated, top > last AS cut
FROM (
  SELECT 'up/' || (doc_id // 50) AS path, count(*) FILTER (WHERE doc_id % 7 <> 3) AS n_chunks, max(doc_id % 50) AS top,
    coalesce(list(doc_id % 50) FILTER (WHERE doc_id % 7 <> 3), []) AS ks, coalesce(max(doc_id % 50) FILTER (WHERE doc_id % 7 <> 3), -1) AS last,
    coalesce(string_agg(CAST(doc_id % 50 AS VARCHAR), ',' ORDER BY doc_id % 50) FILTER (WHERE doc_id % 11 = 5 AND doc_id % 7 <> 3), '') AS repeated
  FROM documents GROUP BY 1)""")
def chunk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks of artifacts: some lost, some sent twice, some tails cut off."""
    path = text("up/", F.floor(c("doc_id") / 50).cast("string")).alias("path")
    rows = table(spark, sf_dir, "documents").select("doc_id", path, (c("doc_id") % 50).alias("chunk_no"))
    whole = rows.groupBy("path").agg((F.max("chunk_no") + 1).alias("n_expected"))
    twice = F.when(c("doc_id") % 11 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = rows.where("doc_id % 7 <> 3").select("path", "chunk_no", F.explode(twice))
    found = completeness(kept, whole)
    spans = lambda name: F.array_join(F.flatten(F.transform(name, lambda x: F.sequence(x["first"], x["last"]))).cast("array<string>"), ",")
    return found.select("path", "n_chunks", spans("missing").alias("missing"), spans("repeated").alias("repeated"), c("cut").isNotNull().alias("cut"))
