"""The registered queries: importing this package fills the registry."""

from . import assembly_queries, audit_queries, check_queries, document_queries, lookup_queries, metadata_queries, package_queries, queue_queries, record_queries, scalar_queries, storage_queries, volume_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
