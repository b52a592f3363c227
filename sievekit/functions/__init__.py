"""Column-level functions (expressions); no actions, no shuffles."""

from .fingerprint import (dense_fingerprint, dice, explode_bits, hashed_fingerprint,
                          pattern_keys, sign_bits, similarity, tanimoto,
                          token_matches, with_fingerprint)
from .tokens import char_count, tokens

__all__ = [
    "char_count", "dense_fingerprint", "dice", "explode_bits", "hashed_fingerprint",
    "pattern_keys", "sign_bits", "similarity", "tanimoto", "token_matches",
    "tokens", "with_fingerprint",
]
