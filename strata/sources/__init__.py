"""Sources and sinks: landing reads, bronze ingest, table writes."""

from .bronze import card_number, rekey_tenant, scrub_null_text, split_name, tag_union, with_sales_amounts
from .landing import (ENTITIES, LAYERS, infer_landing_schema, landing_names, layer_path,
                      read_landing, read_table, with_row_id, write_landing)
from .sinks import write_incremental, write_table

__all__ = [n for n in dir() if not n.startswith("_")]
