"""Operator 6: number of tokens of each document, by whole tokens where that is proven.

Offline, each vocabulary string is given to the tokenizer alone; those that come back as one id are whole
tokens. A text is cut by the tokenizer's own pattern. A piece that is a whole token counts one; only the other
pieces are merged by the library, each distinct one once while it stays in a bounded cache. Texts with special
strings go to the library whole, and so do words outside plain Latin script.

Nulls: a null text is empty and has no tokens. Repeated rows are counted each. An empty table gives
no rows. Very long texts are counted whole; `limit` tokens are not over the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.llm import tokenizing
from dailybars.llm.common import texts_of

ROWS = "doc_id long, n_bytes long, n_tokens long"
CACHED = 400_000
_counters: dict[str, "Counter"] = {}


def whole_tokens(library, pattern, alphabet: dict[int, str]) -> set[str]:
    """The strings that are one piece of the pattern and encode alone as one token."""
    back = {c: b for b, c in alphabet.items()}
    found = []
    for spelled in library.get_vocab(with_added_tokens=False):
        if all(c in back for c in spelled):
            try:
                found.append(bytes(back[c] for c in spelled).decode())
            except UnicodeDecodeError:
                continue
    found = [x for x in found if pattern.fullmatch(x) and tokenizing.PLAIN.fullmatch(x)]
    ids = library.encode_batch_fast(found, add_special_tokens=False)
    return {x for x, y in zip(found, ids) if len(y.ids) == 1}


class Counter:
    def __init__(self, path: str):
        self.library = tokenizing.load(path)
        self.model = self.library.model
        self.alphabet = tokenizing.byte_alphabet()
        self.pattern = tokenizing.BYTE_LEVEL
        self.cuts = tokenizing.Encoder.before_spaces
        self.whole = whole_tokens(self.library, self.pattern, self.alphabet)
        self.ones = dict.fromkeys(self.whole, 1)
        self.merged = tokenizing.Cache(self._merge, CACHED)
        self.chunks = tokenizing.Cache(self._chunk, CACHED)

    def _merge(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.alphabet)))

    def _pieces(self, text: str) -> int:
        ones, merged = self.ones, self.merged
        return sum([1 if piece in ones else merged[piece] for piece in self.pattern.findall(text)])

    def _any(self, text: str) -> int:
        if tokenizing.PLAIN.fullmatch(text):
            return self._pieces(text)
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> int:
        return self._any(" " + chunk)

    def count(self, text: str) -> int:
        if tokenizing.SPECIAL in text:
            return len(self.library.encode(text, add_special_tokens=False).ids)
        head, rest = self.cuts(text)
        return self._any(head) + sum(map(self.chunks.__getitem__, rest))


def counter(name: str) -> Counter:
    if name not in _counters:
        _counters[name] = Counter(public_tokenizers.path(name))
    return _counters[name]


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens). No shuffle."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array([count(x) for x in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return texts_of(docs).mapInArrow(tasks, ROWS).withColumn("over_limit", F.col("n_tokens") > limit)
