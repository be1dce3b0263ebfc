"""Raw endpoint-timeline JSON lines -> rows of the timeline table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timestamps
from ..functions.strings import event_uuid, pinned, to_int64, trim_space
from ..functions.variants import ROOT, parse_one, path_of, with_leaves

PLACE = ["source_file", "block", "seq"]

# Fixed value: longer lines are skipped and reported.
MAX_LINE_BYTES = 10 * 1024 * 1024

_TEXTS = ("timestamp_desc", "parser", "message", "data_type", "username")
_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")
# Integers that are the same read as a double's text and as they stand.
_PLAIN_INTEGER = r"\A-?[0-9]{1,18}\z"


def _kind(doc: Column, key: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(doc, path_of(key), "variant"))


def _is_number(kind: Column) -> Column:
    return F.substring_index(kind, "(", 1).isin(*_NUMBERS)


def split_device(display: Column, root: str) -> tuple[Column, Column]:
    """Device and remaining path of ``…<root>/<device>/<path>``.

    Device is NULL where the root does not occur or nothing follows it; the
    remaining path is '' where the device is the last part.
    """
    at = F.instr(display, F.lit(root))
    rest = F.substr(display, at + len(root))
    rest = F.when(rest.startswith("/"), F.substr(rest, F.lit(2))).otherwise(rest)
    device = F.substring_index(rest, "/", 1)
    found = (at > 0) & (device != "")
    return F.when(found, device), F.when(found, F.substr(rest, F.length(device) + 2))


def normalise(lines: DataFrame, root: str, default_device: str, max_line_bytes: int) -> DataFrame:
    """Line frame -> timeline columns, ``raw`` (VARIANT), ``raw_line``, ``error``."""
    root = root.removesuffix("/")
    text = F.regexp_replace("value", r"\r\z", "")
    too_long = F.octet_length("value") >= max_line_bytes
    rows = (
        lines.select(
            *PLACE, pinned(text).alias("raw_line"),
            F.when(too_long, F.lit(f"line exceeds {max_line_bytes} byte limit")).alias("error"),
        )
        .where(trim_space(F.col("raw_line")) != "")
        .withColumn("doc", F.when(F.col("error").isNull(), parse_one(F.col("raw_line"))))
    )
    doc = F.col("doc")
    leaves = (*_TEXTS, "timestamp", "event_timestamp", "display_name", "event_identifier")
    rows = rows.select(
        "*", F.try_variant_get(doc, ROOT, "variant").alias("raw"),
        F.try_variant_get(doc, path_of("tag"), "array<string>").alias("_tag"),
    )
    rows = with_leaves(rows, "doc", {f"_{k}": k for k in leaves})

    # A value's kind is dear to ask for; most texts tell what they are without it.
    def number(key: str) -> Column:
        """A number cut to an integer; also a text of digits, which is the same."""
        leaf = F.col(f"_{key}")
        return F.when(leaf.rlike(_PLAIN_INTEGER), leaf.try_cast("bigint")).when(
            leaf.isNotNull() & _is_number(_kind(doc, key)), leaf.try_cast("double").try_cast("bigint"))

    # Epoch microseconds, as a number (cut to an integer) or as a numeric text.
    stamp, identifier = F.col("_timestamp"), F.col("_event_identifier")
    rows = rows.select(
        "*", F.coalesce(number("timestamp"), to_int64(stamp)).alias("_micros"),
        F.coalesce(number("event_identifier"), F.when(
            identifier.isNotNull() & (_kind(doc, "event_identifier") == "STRING"), to_int64(identifier)))
        .alias("_identifier"),
    )
    whole, identifier_number = F.col("_micros"), F.col("_identifier")
    event_time = F.coalesce(timestamps.micros(whole), F.col("_event_timestamp").try_cast("timestamp"))
    # Nothing but a missing value, or null, has neither a text nor a doubt.
    identifier_wrong = identifier_number.isNull() & (identifier.isNotNull() | F.coalesce("_event_identifier_doubt", F.lit(False)))

    display = F.col("_display_name")
    if "/" not in root:   # a number is no path, but may hold such a root
        display = F.when(_kind(doc, "display_name") == "STRING", display)
    if root:
        device, path = split_device(display, root)
    else:
        device, path = F.lit(None).cast("string"), F.lit(None).cast("string")
    rows = rows.select("*", device.alias("_device"), path.alias("_path"))

    nested = [
        F.when(F.col(f"_{k}_doubt") & F.col(f"_{k}").isNull(), F.lit(f"{k}: not a scalar"))
        for k in (*_TEXTS, "display_name")
    ]
    tag_wrong = ~F.coalesce(_kind(doc, "tag"), F.lit("VOID")).rlike(r"^(?:VOID|ARRAY<(?!OBJECT|ARRAY))")
    # One JSON value that starts with a brace is an object; after blanks it may be one.
    no_object = ~F.col("raw_line").startswith("{") & ~F.schema_of_variant(F.try_variant_get(doc, ROOT, "variant")).startswith("OBJECT")
    error = F.coalesce(
        F.col("error"),
        F.when(doc.isNull(), F.lit("invalid JSON")),
        F.when(no_object, F.lit("not a JSON object")),
        *nested,
        F.when(identifier_wrong, F.lit("event_identifier: not an integer")),
        F.when(tag_wrong, F.lit("tag: not a list of strings")),
        F.when(whole.isNotNull() & event_time.isNull(), F.lit("timestamp: outside years 1 to 9999")),
        F.when(F.coalesce("_device", F.lit(default_device)) == "", F.lit("device_name: missing")),
    )
    return rows.select(
        event_time.alias("event_timestamp"),
        F.col("_timestamp_desc").alias("timestamp_desc"),
        F.coalesce("_device", F.lit(default_device)).alias("device_name"),
        F.col("_parser").alias("parser"),
        F.when(F.col("_path") != "", F.col("_path")).otherwise(F.col("_display_name")).alias("display_name"),
        F.col("_message").alias("message"),
        F.col("_data_type").alias("data_type"),
        identifier_number.alias("event_identifier"),
        F.col("_username").alias("username"),
        F.col("_tag").alias("tag"),
        event_uuid(F.col("raw_line")).alias("event_uuid"),
        *PLACE, "raw", "raw_line", pinned(error).alias("error"),
    )


def to_json_line(raw: Column) -> Column:
    """A normalised row as JSON text: the table's columns over all other keys of
    the raw event, which the table itself does not keep."""
    own = {
        "event_timestamp": F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "device_name": F.col("device_name"),
        "display_name": F.col("display_name"),
        "event_identifier": F.col("event_identifier").cast("string"),
        "event_uuid": F.col("event_uuid"),
    }
    replaced = [*own, "timestamp"]
    rest = F.map_filter(raw.cast("map<string,variant>"), lambda k, v: ~k.isin(*replaced))
    pairs = [x for k, v in own.items() for x in (F.lit(k), v.cast("variant"))]
    mine = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return F.to_json(F.map_concat(rest, mine))
