"""shiftkit: master-data migration jobs as Spark plans.

Every public function takes and returns ``DataFrame``s (or ``Column``s).
Nothing here calls ``collect`` on data; the only driver-side logic works on
schemas (column names) and on small, bounded configuration frames.
"""

from shiftkit.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
