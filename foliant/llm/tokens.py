"""Sizes of texts in tokens, as the training-data operators use them."""

from __future__ import annotations

from foliant.functions.tokens import VOCABULARY, count_tokens, encoding, n_tokens

__all__ = ["VOCABULARY", "count_tokens", "encoding", "n_tokens"]
