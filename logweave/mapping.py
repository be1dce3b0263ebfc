"""Mapping configs: a declarative description of one vendor's log format.

A config is data. It is checked here, when it is loaded, and then compiled to
Spark columns; nothing in it is ever evaluated as an expression.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

from .functions import timestamps
from .functions.csvtext import DELIMITERS
from .functions.regexes import JavaPattern, to_java
from .functions.transforms import TRANSFORMS
from .schemas import NETWORK_TARGETS


class MappingError(ValueError):
    """The config itself is wrong; no row was read."""


@dataclass(frozen=True)
class Pattern:
    match: str
    java: JavaPattern
    consts: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Field:
    target: str
    source: tuple[str, ...] = ()
    join: tuple[str, ...] = ()
    separator: str = ":"
    value_map: dict[str, str] = field(default_factory=dict)
    transform: str = ""
    default: str = ""


@dataclass(frozen=True)
class Mapping:
    log_type: str
    format: str
    fields: tuple[Field, ...]
    record_path: str = ""
    delimiter: str = ""
    has_header: bool = False
    patterns: tuple[Pattern, ...] = ()
    template_warning: str = ""

    @property
    def paths(self) -> tuple[str, ...]:
        """Every source path the fields name, each once, in order."""
        named = (p for f in self.fields for p in (*f.source, *f.join) if p)
        return tuple(dict.fromkeys(named))


def _get(doc: dict, key: str, kind: type, default: Any) -> Any:
    value = doc.get(key)
    if value is None:
        return default
    if not isinstance(value, kind):
        raise MappingError(f"{key!r} must be {kind.__name__}, got {value!r}")
    return value


def _texts(doc: dict, key: str, also_single: bool = False) -> tuple[str, ...]:
    value = doc.get(key)
    if value is None:
        return ()
    if also_single and isinstance(value, str):
        return (value,)
    if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
        raise MappingError(f"{key!r} must be a list of strings")
    return tuple(value)


def _text_map(doc: dict, key: str) -> dict[str, str]:
    value = _get(doc, key, dict, {})
    if not all(isinstance(v, str) for v in value.values()):
        raise MappingError(f"{key!r} must map strings to strings")
    return dict(value)


def _field(doc: dict) -> Field:
    target = _get(doc, "target", str, "")
    if not target:
        raise MappingError("field mapping has no target")
    if target not in NETWORK_TARGETS:
        raise MappingError(f"unknown target {target!r}")
    source, join = _texts(doc, "source", also_single=True), _texts(doc, "join")
    if source and join:
        raise MappingError(f"{target}: source and join exclude each other")
    transform = _get(doc, "transform", str, "")
    known = (
        timestamps.is_timestamp_transform(transform)
        if target == "event_timestamp" else transform in TRANSFORMS
    )
    if not known:
        raise MappingError(f"{target}: unknown transform {transform!r}")
    return Field(
        target, source, join, _get(doc, "separator", str, "") or ":",
        _text_map(doc, "value_map"), transform, _get(doc, "default", str, ""),
    )


def _pattern(number: int, doc: dict) -> Pattern:
    match = _get(doc, "match", str, "")
    try:
        return Pattern(match, to_java(match), _text_map(doc, "consts"))
    except ValueError as problem:
        raise MappingError(f"pattern {number}: {problem}") from problem


def parse_mapping(config: str | bytes | dict) -> Mapping:
    """Check a config document (JSON text or a dict) and return it typed."""
    if not isinstance(config, dict):
        try:
            config = json.loads(config)
        except ValueError as problem:
            raise MappingError(f"mapping is not valid JSON: {problem}") from problem
        if not isinstance(config, dict):
            raise MappingError("mapping must be a JSON object")
    fmt = _get(config, "format", str, "")
    if fmt not in ("json", "kv", "csv", "regex"):
        raise MappingError(f"unsupported format {fmt!r}: use json, kv, csv or regex")
    fields = tuple(_field(f) for f in _get(config, "fields", list, []))
    if not fields:
        raise MappingError("mapping has no fields")
    if not any(f.target == "event_timestamp" for f in fields):
        raise MappingError("mapping has no event_timestamp field")
    delimiter = _get(config, "delimiter", str, "")
    if fmt == "csv" and delimiter not in DELIMITERS:
        raise MappingError(f"unsupported csv delimiter {delimiter!r}")
    patterns = tuple(
        _pattern(n, p) for n, p in enumerate(_get(config, "patterns", list, []))
    ) if fmt == "regex" else ()
    if fmt == "regex" and not patterns:
        raise MappingError("regex format needs at least one pattern")
    return Mapping(
        _get(config, "log_type", str, ""), fmt, fields,
        _get(config, "record_path", str, ""), delimiter,
        _get(config, "has_header", bool, False), patterns,
        _get(config, "template_warning", str, ""),
    )


def load_mapping(spark: SparkSession, root: str, log_type: str, path: str | None = None) -> Mapping:
    """Read ``<root>/config/<log_type>.json`` (or ``path``) from any file system Spark knows."""
    path = path or f"{root.rstrip('/')}/config/{log_type}.json"
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows:
        raise MappingError(f"mapping {path} is empty")
    return parse_mapping(rows[0].value)


def check_patterns(spark: SparkSession, mapping: Mapping) -> None:
    """Let Java compile each pattern now, on the driver, before any file is read."""
    for number, pattern in enumerate(mapping.patterns):
        try:
            spark.sql("SELECT '' RLIKE :p", args={"p": pattern.java.text}).collect()
        except Exception as problem:
            raise MappingError(f"pattern {number}: invalid regex {pattern.match!r}") from problem


_warned: set[str] = set()


def warn_if_template(mapping: Mapping) -> None:
    """Pass on a config's own warning, once per log type."""
    if mapping.template_warning and mapping.log_type not in _warned:
        _warned.add(mapping.log_type)
        warnings.warn(
            f"mapping {mapping.log_type!r} is an unchecked template: {mapping.template_warning}",
            stacklevel=2,
        )
