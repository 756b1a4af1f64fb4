"""Token ids of texts, by a public tokenizer's file."""

import json
from array import array

# How byte-level vocabularies write the bytes that are no printing characters, and cut a text.
_PRINTING = [*range(33, 127), *range(161, 173), *range(174, 256)]
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE by the bytes its entries stand for."""
    letters = {chr(b): b for b in _PRINTING}
    others = [b for b in range(256) if b not in set(_PRINTING)]
    letters.update({chr(256 + k): b for k, b in enumerate(others)})
    return {bytes(letters[c] for c in entry): n for entry, n in vocabulary.items()}


class ByteTokens:
    """Ids of a byte-level BPE (a file of the `tokenizers` library), as little-endian uint32 bytes.

    Ordinary texts are merged by `tiktoken` over the same vocabulary, which gives the same ids in less time. A text
    that holds a special token's string goes through `tokenizers` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = byte_ranks({entry: n for entry, n in vocabulary.items() if entry not in self._special})
        self._ranks = ranks
        self._fast = tiktoken.Encoding("file", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return self._fast.encode_to_numpy(text, disallowed_special=()).tobytes()

    def plain(self, text: str):
        """Ids as a uint32 array, where a special token's string is ordinary text."""
        return self._fast.encode_to_numpy(text, disallowed_special=())

    def entries(self) -> list[bytes]:
        """The bytes that each id stands for; none for special tokens."""
        found = [b""] * (max(self._ranks.values()) + 1)
        for entry, n in self._ranks.items():
            found[n] = entry
        return found
