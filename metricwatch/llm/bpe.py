"""Byte-level BPE encoding with a public vocabulary; ids equal those of the ``tokenizers`` library (tested)."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str | None], np.ndarray]:
    """text -> ids as little-endian unsigned 16-bit numbers (the vocabulary has under 65,536 entries); null as empty.

    Kept once per Python worker and vocabulary file. Strings of special tokens are ordinary text.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(plain.encode_ordinary(text) if text else [], dtype="<u2")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")
