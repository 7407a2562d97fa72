"""The public byte-level BPE vocabulary, loaded once per Python process.

The vocabulary is published twice: as a `tokenizers` file and as ranks for `tiktoken`.  Both give the same ids
for every text; `tests/llm/test_tokens.py` compares them over Unicode code points, special strings and
random texts.  The ranks are used here because that library encodes about five times as many bytes a second.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}

#: A place between an ASCII letter or digit and a space or line break: no pre-token spans it, and what follows is
#: cut into the same pre-tokens with or without the text before it.  Special strings hold no white space.
_SAFE = re.compile(r"(?<=[A-Za-z0-9])[ \n]")


@lru_cache(maxsize=2)
def encoder(ranks: str | None = None):
    """The encoder of a rank file (by default the public 50k vocabulary)."""
    import public_tokenizers
    import tiktoken

    with open(ranks or public_tokenizers.path(RANKS), "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=SPECIAL
    )


def safe_pieces(text: str, at_least: int) -> list[str]:
    """The text cut at safe places, each piece but the last at least so long; uncut where there is no safe place."""
    if len(text) <= at_least:
        return [text]
    pieces, start = [], 0
    while len(text) - start > at_least and (gap := _SAFE.search(text, start + at_least)):
        pieces.append(text[start : gap.start()])
        start = gap.start()
    pieces.append(text[start:])
    return pieces
