"""heldout: classifier preparation, fitting and held-out measurement on Spark.

Everything runs as DataFrame / Spark SQL / Spark ML jobs.  Fitted models are
small parameter tables (one row per class and feature); scoring applies them
as column expressions, so scoring never shuffles.
"""

from heldout.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
