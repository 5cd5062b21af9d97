"""Column names and types of the corpus tables (fixed values, never inferred)."""

from __future__ import annotations

# The per-cell metric columns, in output order.
METRICS = (
    "LOC", "BLC", "S", "P", "UDF", "NBD", "OPRND", "OPRAT", "UOPRND", "UOPRAT", "ID", "I",
    "PO", "LCO", "CO", "TCO", "LCI", "CI", "TCI", "V", "MSC", "TC",
)

# Metrics whose notebook value is the largest cell value; all others add up.
PEAK_METRICS = ("NBD", "UOPRND", "UOPRAT", "LCO", "LCI")

# Table schemas as DDL.
CELLS = "notebook_hash string, cell_id string, cell_pos int, source string"
OP_COUNTS = "category string, function string, count long"
