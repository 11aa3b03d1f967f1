"""Digest columns of token ids, for results that must stay small."""

from __future__ import annotations

from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame

from telmart.llm.byte_bpe import CHUNK_CHARS, OVERLAP_CHARS, Codec, Outcome, encode

RANK_FILE = "byte_bpe_50k.tiktoken"


def codec() -> Codec:
    """The 50k byte-level vocabulary; read once, on the driver."""
    return Codec.from_file(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


def _digests(codec: Codec, ids: list[int]) -> tuple[int, str, str]:
    named = " ".join(map(str, ids)).encode()
    return len(ids), sha256(named).hexdigest(), sha256(codec.decode(ids)).hexdigest()


DIGESTS = Outcome("n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def token_digests(docs: DataFrame, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs``."""
    return encode(docs, codec(), chunk_chars=chunk_chars, overlap_chars=overlap_chars, outcome=DIGESTS)
