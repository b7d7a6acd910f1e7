from strata.sources.imports import Imported, exact_amount, read_with_rejects, wide_to_long
from strata.sources.layout import LAYOUTS, write_layout, write_tables
from strata.sources.scratch import shared_path
from strata.sources.sinks import append_report, read_report, read_xml, write_xml
from strata.sources.tables import SCHEMAS, Tables

__all__ = [
    "Imported",
    "LAYOUTS",
    "SCHEMAS",
    "Tables",
    "append_report",
    "exact_amount",
    "read_report",
    "read_with_rejects",
    "read_xml",
    "shared_path",
    "wide_to_long",
    "write_layout",
    "write_tables",
    "write_xml",
]
