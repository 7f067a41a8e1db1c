"""Writers."""

from .tables import new_run_id, observed, run_manifest, write_manifest, write_strata, write_table

__all__ = ["new_run_id", "observed", "run_manifest", "write_manifest", "write_strata", "write_table"]
