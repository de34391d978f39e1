"""Field mappings of the scholarly-API entities (C1 + C2 + C3 together).

A landed record (JSON text, one per row) becomes the entity's target row:
the listed fields in order, each taken from the top-level key of the same
name unless a mapping names another (possibly nested) source path. Nested
paths follow objects only -- an array or a null on the way gives null --
and a missing key gives null. Values stay text (the raw layer); C5
conforms them afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.jsonpath import nested_path

# Target field list of each entity table.
ENTITY_FIELDS = {
    "openalex_works": ["id", "title", "doi", "publication_year", "host_venue", "type"],
    "openalex_authors": ["id", "display_name", "orcid", "works_count", "citation_count", "last_known_institution"],
    "openalex_sources": ["id", "display_name", "issn", "is_oa", "host_organization", "works_count"],
    "openalex_institutions": ["id", "display_name", "country_code", "type", "ror", "works_count"],
}

# Target field <- source path where they differ. The sources
# table stores ``issn`` (its DDL column) from the record's ``issn_l``.
SOURCE_PATHS = {
    "host_venue": "primary_location.source.display_name",
    "citation_count": "cited_by_count",
    "last_known_institution": "last_known_institutions.display_name",
    "issn": "issn_l",
}


def project_entity(records: DataFrame, entity: str, record_col: str = "record") -> DataFrame:
    """Map JSON text records to the target fields of ``entity``."""
    fields = ENTITY_FIELDS[entity]
    rec = F.col(record_col)
    return records.select([nested_path(rec, SOURCE_PATHS.get(f, f)).alias(f) for f in fields])
