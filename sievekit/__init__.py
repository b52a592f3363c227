"""sievekit: DataFrame operators for screening large tables of described
items (quality checks, profiles, rule scores, fingerprints, similarity,
training and evaluation), built on PySpark."""

from .session import build_session, clear_scratch, cut_lineage, ensure_checkpoint_dir, scratch_path

__all__ = ["build_session", "clear_scratch", "cut_lineage", "ensure_checkpoint_dir", "scratch_path"]
__version__ = "0.1.0"
