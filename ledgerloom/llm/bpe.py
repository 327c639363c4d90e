"""Token ids of a public byte-level BPE vocabulary, inside tasks.

The rank file and the tokenizer file hold one vocabulary. Plain text goes through the ranks, which is several times
faster; text with a special token or with characters outside Latin script goes through the tokenizer file itself, so
ids are always those of the tokenizer. Tests compare both.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

#: Vocabulary files, found beside the public_tokenizers package unless a full path is given.
TOKENIZER_FILE, RANK_FILE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

#: Whitespace runs need the look-ahead of the vocabulary's own pattern; single blanks do not.
_RUN = re.compile(r"\s\s")
_UNUSUAL = re.compile(r"[^\t\n\r -~\u00a0-\u024f\u2010-\u2027]|<\|endoftext\|>")
_WITHOUT_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


class ByteBpe:
    def __init__(self, tokenizer_file: str, rank_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(vocabulary_path(rank_file), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        build = functools.partial(tiktoken.Encoding, mergeable_ranks=ranks, special_tokens={})
        self._general = build("general", pat_str=public_tokenizers.PATTERN).encode_ordinary
        self._simple = build("simple", pat_str=_WITHOUT_RUNS).encode_ordinary
        self._exact = Tokenizer.from_file(vocabulary_path(tokenizer_file))

    def ids(self, text: str) -> list[int]:
        if _UNUSUAL.search(text):
            return self._exact.encode(text, add_special_tokens=False).ids
        return self._general(text) if _RUN.search(text) else self._simple(text)

    def id_bytes(self, text: str) -> bytes:
        """The ids as unsigned 32-bit numbers (little-endian on every machine Spark supports here)."""
        return array("I", self.ids(text)).tobytes()


@functools.cache
def byte_bpe(tokenizer_file: str = TOKENIZER_FILE, rank_file: str = RANK_FILE) -> ByteBpe:
    """One encoder per Python worker."""
    return ByteBpe(tokenizer_file, rank_file)
