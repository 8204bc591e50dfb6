"""Readers and writers of checklist and authority files."""

from rankmatch.sources.files import read_backbone, read_backbone_checked, read_records, write_csv

__all__ = ["read_backbone", "read_backbone_checked", "read_records", "write_csv"]
