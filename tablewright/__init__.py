"""Table intake, relationship discovery and SQL answers as Spark DataFrame jobs."""

from tablewright.operators.catalog import column_catalog, database_catalog, schema_document
from tablewright.operators.normalize import Normalized, infer_types, normalize
from tablewright.operators.questions import Answer, answer, digest
from tablewright.operators.relations import (
    key_relationships,
    location_relationships,
    relationships,
    typed_relationships,
    viewable,
    with_row_counts,
)
from tablewright.operators.views import create_views, relationship_view
from tablewright.plans.ingest import analyze, ingest, normalize_and_load, normalize_all, normalize_sheets, write_sheets
from tablewright.sinks.csv_files import csv_lines, write_csv
from tablewright.sinks.metadata import relationship_document, relationship_lines, write_relationships
from tablewright.sinks.tables import load_folder, load_table, load_tables, refresh_database
from tablewright.sources.csv_files import scan_csv
from tablewright.sources.files import file_manifest, not_landed
from tablewright.sources.tables import read_table, scan_tables

__all__ = [
    "Answer", "Normalized", "analyze", "answer", "column_catalog", "create_views", "csv_lines",
    "database_catalog", "digest", "file_manifest", "infer_types", "ingest", "key_relationships",
    "load_folder", "load_table", "load_tables", "location_relationships", "normalize",
    "normalize_all", "normalize_and_load", "normalize_sheets", "not_landed", "read_table",
    "refresh_database", "relationship_document", "relationship_lines", "relationship_view", "relationships", "scan_csv",
    "scan_tables", "schema_document", "typed_relationships", "viewable", "with_row_counts",
    "write_csv", "write_relationships", "write_sheets",
]
