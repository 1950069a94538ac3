"""Token ids of whole texts inside tasks.

The ids are those of ``tokenizers`` with ``byte_bpe_50k.json`` and
add_special_tokens=False.  The same vocabulary as ranks, run by ``tiktoken``, gives the
same ids at about five times the speed; a test compares both on all texts of a table.
Texts with a stretch of LONG_RUN characters without a blank go to ``tokenizers``,
whose merge loop stays fast on them.
"""

from __future__ import annotations

import base64
import functools
import json
import re

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
LONG_RUN = re.compile(r"\S{4096}")


@functools.cache
def slow_encoder(vocabulary: str = VOCABULARY):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


@functools.cache
def fast_encoder(vocabulary: str = VOCABULARY):
    """Once per Python worker, like the slow one, which most workers never need."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    with open(public_tokenizers.path(vocabulary.replace(".json", ".tiktoken")), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    if len(text) >= 4096 and LONG_RUN.search(text):
        return np.array(slow_encoder(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.asarray(fast_encoder(vocabulary).encode_to_numpy(text, allowed_special="all"), np.uint32)
