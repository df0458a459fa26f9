"""Byte-level BPE of whole texts, alike in every worker."""

from __future__ import annotations

import base64
import re

from tallyline.llm import words as wd

VOCABULARY = "byte_bpe_50k.tiktoken"
FULL_VOCABULARY = "byte_bpe_50k.json"
# The pattern's look-ahead is tried at every place of a run of white space, on a stack that ends
# somewhere over 500,000. Texts with longer runs than this go to the other library.
LONGEST_RUN = 100_000
_WHITE = re.compile(r"\s+")


def has_long_run(text: str) -> bool:
    """Whether the text has a run of white space over ``LONGEST_RUN``."""
    return len(text) > LONGEST_RUN and any(
        m.end() - m.start() > LONGEST_RUN for m in _WHITE.finditer(text))


class ByteBPE:
    """The vocabulary's ids of a text, by ranks; both libraries give the same ones."""

    def __init__(self, ranks_path: str | None, special: dict[str, int], full_path: str | None = None):
        import public_tokenizers
        import tiktoken

        self.special, self.full_path, self._slow = special, full_path, None
        with open(ranks_path or public_tokenizers.path(VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def slow(self):
        if self._slow is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            path = self.full_path or public_tokenizers.path(FULL_VOCABULARY)
            self._slow = Tokenizer.from_file(path)
            self._slow.encode_special_tokens = not self.special
        return self._slow

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of ``special`` become theirs, without any they are text."""
        if has_long_run(text):
            return self.slow().encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")

    def decode(self, ids) -> str:
        return self.fast.decode(ids)


def loaded(ranks_path: str | None = None, special: dict[str, int] | None = None) -> ByteBPE:
    """Loaded once per Python worker."""
    special = special or {}
    key = ("byte-bpe", ranks_path, tuple(special.items()))
    return wd.per_worker(key, lambda: ByteBPE(ranks_path, special))
