"""Token ids of the public byte-level vocabulary, and the bytes each id stands for."""

from __future__ import annotations

import base64
import re

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
_LOADED: dict[str, tuple] = {}
_TWO_SPACES = re.compile(r"\s\s")
#: The only alternative of the split pattern that looks ahead; it acts on runs of white space.
_LOOK_AHEAD = r"|\s+(?!\S)"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids of a text as ``tokenizers`` gives them for the JSON file, special strings as text.

    The same vocabulary is at hand as ranks, which ``tiktoken`` encodes several times
    faster to the same ids. A text without two white-space characters in a row never
    reaches the look-ahead of the split pattern, so a pattern without it cuts it alike.
    A text that tiktoken refuses goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.full, self.plain = (
            tiktoken.Encoding(n, pat_str=p, mergeable_ranks=ranks, special_tokens={})
            for n, p in (("full", public_tokenizers.PATTERN),
                         ("plain", public_tokenizers.PATTERN.replace(_LOOK_AHEAD, ""))))
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.token_bytes[i] = token

    def ids(self, text: str) -> list[int]:
        try:
            return (self.full if _TWO_SPACES.search(text) else self.plain).encode_ordinary(text)
        except (ValueError, RuntimeError, UnicodeError):
            return self.slow.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
