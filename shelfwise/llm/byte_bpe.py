"""Whole texts to the ids of a byte-level vocabulary.

The ids are those the tokenizers library gives for the ``.json`` file without
added special tokens; special strings inside a text become their ids, which is
that library's default.  Where the same vocabulary also lies beside it as ranks
(``.tiktoken``), the merges run on those, which is several times cheaper and
keeps no table of seen words.  That both agree is checked three times: when an
encoder is made (same tokens, same numbers), in the tests (every code point in
every position of a pre-token), and while it runs (one text in ``AUDIT`` is
encoded both ways; a difference stops the job).
"""

from __future__ import annotations

import base64
import os

import numpy as np

AUDIT = 512
_MADE: dict[str, RankEncoder] = {}


def _shown() -> dict[int, str]:
    """Byte -> the character byte-level vocabularies write for it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class RankEncoder:
    """Ids of whole texts by merge ranks, audited against the tokenizers library."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        with open(public_tokenizers.path(vocabulary.removesuffix(".json") + ".tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        names = self.library.get_vocab(with_added_tokens=True)
        self.special = {a.content: number for number, a in self.library.get_added_tokens_decoder().items()}
        shown = _shown()
        if {"".join(map(shown.__getitem__, token)): rank for token, rank in ranks.items()} | self.special != names:
            raise ValueError(f"{vocabulary} and its ranks are two vocabularies")
        self.merges = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.type = np.dtype("<u2") if max(names.values()) < 1 << 16 else np.dtype("<u4")
        self.seen = 0

    def ids(self, text: str) -> bytes:
        """The ids of a text, little-endian."""
        found = self.merges.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        if self.seen % AUDIT == 0 and found.tolist() != self.library.encode(text, add_special_tokens=False).ids:
            raise ValueError("the two encodings of a text differ")
        self.seen += 1
        return found.astype(self.type).tobytes()


def has_ranks(vocabulary: str) -> bool:
    import public_tokenizers

    return vocabulary.endswith(".json") and os.path.exists(public_tokenizers.path(vocabulary).removesuffix(".json") + ".tiktoken")


def encoder(vocabulary: str) -> RankEncoder:
    """One encoder per worker and vocabulary."""
    if vocabulary not in _MADE:
        _MADE[vocabulary] = RankEncoder(vocabulary)
    return _MADE[vocabulary]
