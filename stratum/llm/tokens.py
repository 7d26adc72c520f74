"""Word-cached tokenizing with a public word-level BPE vocabulary.

The vocabulary's pre-tokenizer drops white space and never joins characters
across it, so the ids of a text are the ids of its white-space separated
chunks in order.  Natural text repeats its words, so each worker keeps a
bounded cache chunk -> packed ids and only sends unseen chunks to the
tokenizer.  ``tests/llm/test_operators.py`` compares the result with
encoding whole texts.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np

#: Fixed values of the vocabulary file: ids below 49,408 fit two bytes; special strings start with these characters.
ID_DTYPE = np.dtype("<u2")
SPECIAL_START = "<|"

#: Two-byte ids of "." and "," are cached apart, so that a word before them needs one entry.
_MARKS = b".,"

#: Byte-level form, by its rule: printable Latin-1 stands for itself, the other bytes for 256 and on, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_FORM = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class WordTokenizer(dict):
    """A cache chunk -> packed ids that fills itself.

    ``max_cache``: most chunks kept; the cache starts anew beyond it (ids do not depend on it).
    """

    def __init__(self, path: str, max_cache: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.max_cache = max_cache

    def whole(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        stem = chunk.rstrip(_MARKS)
        if len(stem) < len(chunk) and stem[-1:].isalpha():
            # the tokenizer cuts between a letter and the marks after it
            ids = self[stem] + self[chunk[len(stem):]]
        elif chunk.isalpha() or (word := chunk.decode("utf-8")).isalpha() and word == word.lower() and is_normalized("NFC", word):
            # lower-case, composed words of letters alone: the model's merges on their byte-level form
            ids = array("H", [t.id for t in self.merge(chunk.decode("latin-1").translate(BYTE_FORM))]).tobytes()
        else:
            ids = self.whole(word)
        if len(self) >= self.max_cache:
            self.clear()
        self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, two bytes each."""
        if SPECIAL_START in text:  # lower-casing could make a special string here
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").lower().split()))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer, and so one cache, for each worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
