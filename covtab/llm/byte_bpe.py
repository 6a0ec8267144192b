"""Byte-level BPE ids from a public vocabulary file, inside tasks."""

from __future__ import annotations

import base64
import re
from functools import cached_property

import numpy as np

#: The one special token of the 50k vocabulary, its id, and the
#: pattern that splits text before merges.
SPECIAL = {"<|endoftext|>": 50256}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The pattern's search keeps a state for each blank of a run, 1,000,000 at
#: most, so runs from this length on are cut out before it. The class is the
#: pattern's \s, which is not quite Python's.
LONG_RUN = 1 << 16
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG = re.compile(f"(?<!{_SPACE}){_SPACE}{{{LONG_RUN},}}")
_SPECIAL_NEXT = re.compile("|".join(map(re.escape, SPECIAL)))


def default_ranks() -> str:
    """Place of the rank file; any other file in that format can be given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Text to ids. The rank file and ``byte_bpe_50k.json`` are the same
    vocabulary, and ids are those that the ``tokenizers`` library gives for
    the latter with ``add_special_tokens=False``. Null counts as empty."""

    def __init__(self, ranks: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self._table = table
        self._bpe = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=table, special_tokens=SPECIAL)

    @cached_property
    def _piece(self):
        """The same merges over a text that is one pre-token."""
        import tiktoken

        return tiktoken.Encoding("byte_bpe_piece", pat_str=r"[\s\S]+", mergeable_ranks=self._table, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if len(text) < LONG_RUN:
            return self._searched(text)
        parts, at = [], 0
        for run in _LONG.finditer(text):
            # All but the last blank are one pre-token; at the end, and before a special token, all are.
            whole = run.end() == len(text) or _SPECIAL_NEXT.match(text, run.end())
            end = run.end() if whole else run.end() - 1
            parts += [self._searched(text[at:run.start()]), self._piece.encode_to_numpy(text[run.start():end])]
            at = end
        return np.concatenate([*parts, self._searched(text[at:])])

    def _searched(self, text: str) -> np.ndarray:
        special = {s for s in SPECIAL if s in text}
        return self._bpe.encode_to_numpy(text, allowed_special=special, disallowed_special=())
