"""Ids of whole texts from a public tokenizer file; the library merges each distinct word once.

A text is cut only where the tokenizer's own pre-tokenizer must cut, so the ids of its chunks in a row are
the ids of the text:

* byte-level pattern (`byte_bpe_*`): before a space that a non-space follows. The pattern takes such a
  space with what follows it, whatever stands before.
* word-end pattern (`word_bpe_*`): at spaces and line feeds, which this tokenizer drops. No character
  composes or changes case across them.

Chunks and words already seen are looked up in bounded caches. A chunk of plain Latin letters, digits and
ASCII signs is split into words by the tokenizer's pattern here, and the library's model merges each word; any
other chunk, and any text that holds the start of a special string, goes through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import public_tokenizers

from dailybars.llm.common import holds, release_others

#: A space before a character that no Unicode version calls white space.
CUT = re.compile("[ ](?=[^\\s᠎])")
#: White space next to white space: only then does splitting at every space differ from CUT.
RUN = re.compile("[ ][\\s᠎]")
SPECIAL = "<|"
#: Here Python's classes agree with the library's, and case and composition are plain.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-ÿ]*")
BYTE_LEVEL = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
WORD_END = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
CHUNKS = 500_000

_encoders: dict[str, Encoder] = {}
holds("tokenizing", _encoders.clear)


def encoder(name: str, chunks: int = CHUNKS) -> Encoder:
    """One encoder per worker process; its caches, of `chunks` and four fifths as many words, outlive a task."""
    release_others("tokenizing")
    if name not in _encoders or _encoders[name].chunks.limit != chunks:
        _encoders[name] = Encoder(public_tokenizers.path(name), chunks, chunks * 4 // 5)
    return _encoders[name]


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Cache(dict):
    """Looks up; makes what is missing. At most twice `limit` entries: the older half goes first."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    def __init__(self, path: str, chunks: int = CHUNKS, words: int = CHUNKS * 4 // 5):
        self.library = load(path)
        self.model = self.library.model
        self.alphabet = byte_alphabet()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not spec.get("normalizer"):
            self.split, self.lead, self.pattern, self.lower = self.before_spaces, " ", BYTE_LEVEL, False
        elif spec["model"].get("end_of_word_suffix"):
            self.split, self.lead, self.pattern, self.lower = self.at_spaces, "", WORD_END, True
        else:
            self.split, self.lead, self.pattern, self.lower = None, "", None, False
        self.words = Cache(self._merge, words)
        self.chunks = Cache(self._chunk, chunks)

    @staticmethod
    def before_spaces(text: str) -> tuple[str, list[str]]:
        head, *rest = CUT.split(text) if RUN.search(text) or text.endswith(" ") else text.split(" ")
        return head, rest

    @staticmethod
    def at_spaces(text: str) -> tuple[str, list[str]]:
        return "", text.replace("\n", " ").split(" ")

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _merge(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        chunk = self.lead + chunk
        return self._plain(chunk) if PLAIN.fullmatch(chunk) else self._whole(chunk)

    def _plain(self, text: str) -> bytes:
        words = self.pattern.findall(text.lower() if self.lower else text)
        return b"".join([self.words[word] for word in words])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers, without special tokens added."""
        if self.split is None or SPECIAL in text:
            return self._whole(text)
        head, rest = self.split(text)
        ids = b"".join(map(self.chunks.__getitem__, rest))
        return (self._plain(head) if PLAIN.fullmatch(head) else self._whole(head)) + ids if head else ids
