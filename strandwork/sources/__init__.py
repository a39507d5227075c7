"""Readers that give typed tables, with the place of each record kept for rules that depend on order."""

from .landed import cached_copy, code_list, fetch, land, read_code_lists, read_pages, read_panels, xml_records
from .obo import read_nested_classes, read_obo
from .sequences import read_fasta, read_fasta_sources
from .tables import read_json_lines, read_landed, read_padded, read_quoted, read_ragged_classes, read_raw, save_landed, write_export, write_table

__all__ = [
    "cached_copy", "code_list", "fetch", "land", "read_code_lists", "read_fasta", "read_fasta_sources", "read_json_lines", "read_landed",
    "read_nested_classes", "read_obo", "read_padded", "read_pages", "read_panels", "read_quoted", "read_ragged_classes", "read_raw", "save_landed",
    "write_export", "write_table", "xml_records",
]
