"""Token ids of whole texts with the tokenizers library, fast enough for whole corpora.

A byte-level BPE file splits a text into pre-tokens before merging, and no pre-token crosses the
start of a " word". A text whose words are parted by single spaces or line feeds therefore has
the ids of its chunks (" word", or a line feed and its word) one after another. Each distinct
chunk is encoded once and remembered; a text with any other white space, or with the string of a token
that the file adds to its vocabulary, is encoded whole. Ids are those of the library's own encode() of the
whole text, whatever its length.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

#: Chunks remembered by a Python worker (a hundred thousand take about 20 MB). Beyond it the memory is emptied:
#: results do not change, chunks met again are worked out again.
MEMORY_ENTRIES = 300_000
_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Byte-level files write each byte as a visible character: printable Latin-1 as itself, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def load_tokenizer(path: str, special_as_text: bool = False):
    """The tokenizer in the file at path. The library takes the string of a special token in a text for that token;
    special_as_text makes it ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


class _Chunks(dict):
    """Ids of chunks, worked out at the first use."""

    def __init__(self, tokenizer):
        self._tokenizer, self._tokenize, self._marks = tokenizer, tokenizer.model.tokenize, {}
        self.line_feed = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def letters(self, core: str) -> bytes:
        """Ids of one pre-token, written in byte-level characters, straight from the file's merge model."""
        ids = array("I", [t.id for t in self._tokenize(core)])
        return ids.tobytes() if _LITTLE else np.asarray(ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        first = chunk[0]
        bare = first == "\n" or first == "\r"
        word = chunk[1:] if bare else chunk
        core = word.rstrip(_PUNCTUATION)
        if core.isalpha():  # letters make one pre-token, the marks after them another
            ids = None if bare else self.get(core)
            if ids is None:
                raw = core if core.isascii() else core.encode().decode("latin-1").translate(_BYTE_LEVEL)
                ids = self.letters(raw if bare else "\u0120" + raw)
            if core != word:
                marks = word[len(core) :]
                ids += self._marks.get(marks) or self._marks.setdefault(marks, self.whole(marks))
        else:
            ids = self.whole(word if bare else " " + word)
        if first == "\n":
            ids = self.line_feed + ids
        self[chunk] = ids
        return ids


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, entries: int | None = None, special_as_text: bool = False):
        self._tokenizer, self._entries = load_tokenizer(path, special_as_text), entries or MEMORY_ENTRIES
        self._added = tuple(t.content for t in self._tokenizer.get_added_tokens_decoder().values())
        self._known = known = _Chunks(self._tokenizer)
        # Chunk by chunk encoding needs a line feed that is a token of its own, and byte-level letters.
        parts = (known.whole("a"), known.line_feed, known.letters("\u00c3\u00a9"), known.letters("\u0120b"))
        self._chunked = len(known.line_feed) == 4 and known.whole("a\n\u00e9 b") == b"".join(parts)

    @staticmethod
    def _chunks(text: str) -> list[str] | None:
        """The text's chunks: "word" stands for " word", "\\nword" for itself, "\\rword" for the text's
        first word; None if words aren't parted by single spaces and line feeds."""
        words = text.split()
        if not words or sum(map(len, words)) + len(words) - 1 != len(text) or text.count(" ") + text.count("\n") != len(words) - 1:
            return None
        if "\n" in text:
            words = text.replace("\n", " \n").split(" ")
        words[0] = "\r" + words[0]
        return words

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text (None: no ids)."""
        known = self._known
        get = known.__getitem__
        out = []
        for text in texts:
            chunks = self._chunks(text) if text and self._chunked and not any(a in text for a in self._added) else None
            if chunks:
                out.append(b"".join(map(get, chunks)))
            else:
                out.append(known.whole(text) if text else b"")
            if len(known) > self._entries:
                self._known = known = _Chunks(self._tokenizer)
                get = known.__getitem__
        return out


@lru_cache(maxsize=None)
def encoder(path: str, entries: int | None = None) -> ChunkEncoder:
    """One encoder for each Python worker, file and size of memory."""
    return ChunkEncoder(path, entries)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
