"""Table operators: each takes DataFrames and column names and returns a
DataFrame (models aside)."""

from . import evaluate, fingerprints, frames, profile, quality, rules, runs, similarity, train

__all__ = ["evaluate", "fingerprints", "frames", "profile", "quality", "rules", "runs",
           "similarity", "train"]
