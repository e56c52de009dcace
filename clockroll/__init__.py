"""clockroll: per-object event-time window rollups of sensor measures on Spark.

Batch path: DataFrame expressions (parse -> filter -> per-object clock ->
window statistics -> emissions -> upsert).  Stream path: Structured
Streaming with keyed state (``transformWithStateInPandas``) feeding the same
upsert through ``foreachBatch``.
"""

from clockroll.config import RollupConfig
from clockroll.session import build_session, ensure_utc, scratch_dir

__all__ = ["RollupConfig", "build_session", "ensure_utc", "scratch_dir"]
