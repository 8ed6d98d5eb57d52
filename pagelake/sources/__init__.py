"""Readers: landed pages and seed files."""

from pagelake.sources.pages import read_pages
from pagelake.sources.seeds import (
    read_id_list, read_lines, read_seed_set, read_status_seeds, with_line_order, zip_lists,
)

__all__ = ["read_pages", "read_id_list", "read_lines", "read_seed_set", "read_status_seeds",
           "with_line_order", "zip_lists"]
