from farelens.sources.tables import (
    NoInputFiles, SchemaMismatch, TRIP_SCHEMA, canonical_trips, load_table, read_paths, read_trips)
from farelens.sources.views import bills, documents_labels, line_charges, trips

__all__ = [
    "NoInputFiles", "SchemaMismatch", "TRIP_SCHEMA", "canonical_trips", "load_table",
    "read_paths", "read_trips", "bills", "documents_labels", "line_charges", "trips"]
