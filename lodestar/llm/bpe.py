"""Byte-level BPE encoding and decoding of whole texts by overlapping chunks."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame

from .tables import id_and_text

RANKS = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP = 1 << 16, 1 << 9
# A match that ends this far before the end of a chunk cannot change with the text behind it:
# the pattern looks at most at the two characters behind the start of a contraction.
MARGIN = 4
# Distinct pre-tokens remembered by a worker before it starts afresh; bounds its memory only.
REMEMBERED = 400_000


class ByteBpe:
    """Encodes text by the ranks of a vocabulary file, pre-token by pre-token."""

    def __init__(self, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = tiktoken.Encoding(
            os.path.basename(vocabulary), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.raw = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.raw[rank] = token
        self.decimal = [str(i) for i in range(len(self.raw))]
        self.chunk, self.overlap = chunk, overlap
        self.known: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[str]:
        """The matches of the pattern over the whole text."""
        return [piece for part in self.parts(text) for piece in part]

    def parts(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern over the whole text, found chunk by chunk and given out as they are settled.

        Every chunk is scanned on its own from ``overlap`` characters before its start. The
        pattern never looks back, so where a boundary of a chunk is also one of the chunk before
        it, both go on alike. Without a common boundary the overlap is widened, at last to the
        place up to which the text is already settled. The matches of two chunks are held at a time.
        """
        if len(text) <= self.chunk:
            yield self.pattern.findall(text)
            return
        done, open_part = 0, []
        for start in range(0, len(text), self.chunk):
            end = min(start + self.chunk, len(text))
            reach = self.overlap
            while True:
                begin = max(done, start - reach)
                found = self.pattern.findall(text[begin:end])
                if begin == done:  # a settled boundary: nothing of the part before is needed
                    open_part = found
                    break
                at = self._meeting(open_part, done, found, begin, start - MARGIN)
                if at:
                    yield open_part[:at[0]]
                    done, open_part = at[2], found[at[1]:]
                    break
                reach *= 4
        yield open_part

    @staticmethod
    def _meeting(left: list[str], left_at: int, right: list[str], right_at: int, last: int):
        """The first boundary of both scans up to ``last``: indexes into both, and the place."""
        i = j = 0
        while max(left_at, right_at) <= last:
            if left_at == right_at:
                return i, j, left_at
            if left_at < right_at:
                left_at, i = left_at + len(left[i]), i + 1
            else:
                right_at, j = right_at + len(right[j]), j + 1
        return None

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as little-endian 32-bit numbers."""
        return np.concatenate([np.zeros(0, "<u4"), *map(self._ids, self.parts(text))])

    def encoded(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text part by part."""
        return map(self._ids, self.parts(text))

    def _ids(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u4")
        except KeyError:
            for piece in pieces:
                if piece not in known:
                    known[piece] = np.array(self.library.encode_ordinary(piece), "<u4").tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u4")

    def decode(self, ids) -> bytes:
        """The bytes of a list of ids: those of its tokens, one after the other."""
        return b"".join(map(self.raw.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(vocabulary: str) -> ByteBpe:
    return ByteBpe(vocabulary)


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every whole text.

    A missing or empty text has no ids. Repeated rows give repeated rows, an empty table none;
    extra columns are ignored. A text is encoded by the task that reads its row, in chunks.
    """
    path = vocabulary or public_tokenizers.path(RANKS)

    def work(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            ids = [bpe.encode(text) for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([i.astype("i4") for i in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = id_and_text(docs)
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, bytes)``: the raw bytes of ``(doc_id, ids)`` rows; missing ids are none."""
    path = vocabulary or public_tokenizers.path(RANKS)

    def work(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            raw = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary")


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Encode every text, decode its ids, and return the count and both digests.

    The two steps of ``encode`` and ``decode`` in one task, so that ids of whole corpora are
    not moved: ``doc_id, n_tokens, ids_sha256, decoded_sha256``. Ids go into the digests part by
    part and are forgotten, so memory follows the chunk and the text itself. Edge cases as in ``encode``;
    an empty text has the digests of no bytes.
    """
    path = vocabulary or public_tokenizers.path(RANKS)

    def work(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                count, names, raw = 0, hashlib.sha256(), hashlib.sha256()
                for part in bpe.encoded(text):
                    ids = part.tolist()
                    if ids:
                        names.update(b" " * bool(count) + " ".join(map(bpe.decimal.__getitem__, ids)).encode())
                        raw.update(bpe.decode(ids))
                        count += len(ids)
                counts.append(count)
                coded.append(names.hexdigest())
                decoded.append(raw.hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
