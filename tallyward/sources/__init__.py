"""Reading landed record exports and writing the derived tables."""

from tallyward.sources.records import load_inputs, normalize_names, read_records
from tallyward.sources.sinks import read_product, write_product

__all__ = ["load_inputs", "normalize_names", "read_product", "read_records", "write_product"]
