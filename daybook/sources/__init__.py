"""Reading exports and storing tables."""

from daybook.sources.csv_files import parse_failures, read_export
from daybook.sources.headers import HeaderMatch, canonical_columns, match_header, normal_header
from daybook.sources.report_csv import report_frame, write_report
from daybook.sources.tables import TableStore

__all__ = [
    "HeaderMatch",
    "TableStore",
    "canonical_columns",
    "match_header",
    "normal_header",
    "parse_failures",
    "read_export",
    "report_frame",
    "write_report",
]
