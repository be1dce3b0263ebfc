"""logweave: incident-response logs, timelines and their correlation on Spark."""

from .mapping import Mapping, MappingError, load_mapping, parse_mapping
from .operators.formats import Options, register_format
from .plans.network import Parsed, ingest_network, parse_network
from .session import configure
from .vendors import LOG_TYPES, vendor_mapping

__all__ = [
    "LOG_TYPES", "Mapping", "MappingError", "Options", "Parsed", "configure",
    "ingest_network", "load_mapping", "parse_mapping", "parse_network",
    "register_format", "vendor_mapping",
]
