"""Table stores, partitioned export, scratch tables and the BI catalog."""

from derrick.sources.catalog import register, tables_present
from derrick.sources.export import export_all, export_table
from derrick.sources.scratch import materialize, scratch_root, scratch_scope
from derrick.sources.fingerprint import Fingerprint, fingerprint
from derrick.sources.stores import CatalogStore, JdbcStore, ParquetStore, reconcile, reconcile_content, replace_verified
from derrick.sources.versioned import CommitConflict, VersionedStore

__all__ = [
    "CatalogStore",
    "CommitConflict",
    "Fingerprint",
    "JdbcStore",
    "ParquetStore",
    "VersionedStore",
    "export_all",
    "export_table",
    "fingerprint",
    "materialize",
    "reconcile",
    "reconcile_content",
    "replace_verified",
    "register",
    "scratch_root",
    "scratch_scope",
    "tables_present",
]
