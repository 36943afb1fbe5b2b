"""Encoders of the public vocabularies; their files are parameters and are read by each task."""

from __future__ import annotations

import base64
from collections.abc import Callable

import public_tokenizers

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def rank_encoding(path: str):
    """tiktoken encoding of a rank file."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text by a vocabulary file of ``tokenizers``, without special tokens added."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
