"""auric — medallion (Bronze → Silver → Gold) analytics on Spark DataFrames.

Every operator is a function that takes and returns ``DataFrame`` / ``Column``
objects; nothing is collected to the driver except one-row gate results.
"""

from auric.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
