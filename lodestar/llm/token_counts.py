"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F

from .tables import id_and_text

VOCABULARY = "byte_bpe_50k.json"
CHUNK, OVERLAP = 1 << 16, 1 << 9
# Nearer than this to the end of a chunk a boundary may still depend on the text behind it:
# no contraction is longer than 3 characters, and special tokens are added to it.
MARGIN = 4
REMEMBERED = 400_000


class TokenCounter:
    """Counts tokens as the library does for the whole text."""

    def __init__(self, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as text:
            self.special = [t["content"] for t in json.load(text)["added_tokens"]]
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.margin = MARGIN + max(map(len, self.special), default=0)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.chunk, self.overlap = chunk, max(overlap, 2 * self.margin)
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        return self._spliced(text) if len(text) > self.chunk else self._short(text)

    def _short(self, text: str) -> int:
        """Special strings apart, the library merges within pre-tokens: sum their counts."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        total, parts = 0, [text]
        if self.cut_special and self.cut_special.search(text):
            parts = self.cut_special.split(text)
            total = len(parts) - 1
        for part in parts:
            pieces = self.pattern.findall(part)
            try:
                total += sum(map(self.known.__getitem__, pieces))
            except KeyError:
                new = [p for p in set(pieces) if p not in self.known]
                encoded = self.library.encode_batch_fast(new, add_special_tokens=False)
                self.known.update(zip(new, map(len, encoded)))
                total += sum(map(self.known.__getitem__, pieces))
        return total

    def _spliced(self, text: str) -> int:
        """Encode overlapping chunks with offsets and join them at boundaries both share.

        A place where two chunks both start a pre-token is proven stable when the left chunk
        goes on for ``margin`` more characters: the right one is then the library's own scan
        from there. If the overlap has no such place it is widened, at last back to the place
        up to which the text is settled, from where the right chunk is exact by itself. The
        encodings of two chunks are held at a time.
        """
        encoded = self.library.encode(text[:self.chunk], add_special_tokens=False)
        total, done, left, held = 0, 0, self._boundaries(encoded, 0), len(encoded)
        for start in range(self.chunk, len(text), self.chunk):
            reach, end = self.overlap, start + self.chunk
            begin = max(done, start - reach)
            while True:
                encoded = self.library.encode(text[begin:end], add_special_tokens=False)
                right = self._boundaries(encoded, begin)
                shared = [p for p in right.keys() & left.keys() if p <= start - self.margin] if begin > done else [done]
                if shared:
                    break
                reach *= 4
                begin = max(done, start - reach)
            meet = min(shared)
            total += left[meet] - left[done]
            done, left, held = meet, right, len(encoded)
        return total + held - left[done]

    @staticmethod
    def _boundaries(encoded, begin: int) -> dict[int, int]:
        """Place of each pre-token's start in the text -> tokens of the chunk before it."""
        found, before = {begin: 0}, None
        for at, (word, (place, _)) in enumerate(zip(encoded.word_ids, encoded.offsets)):
            if word != before:
                found[begin + place], before = at, word
        return found


@lru_cache(maxsize=2)
def counter(vocabulary: str) -> TokenCounter:
    return TokenCounter(vocabulary)


def count_tokens(docs: DataFrame, limit: int = 512, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    A missing or empty text counts 0. Special strings in a text are special tokens, as the
    library has it by default. Repeated rows give repeated rows, an empty table none; extra
    columns are ignored.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def work(batches):
        tokens = counter(path)
        for batch in batches:
            counts = [tokens.count(text) for text in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = id_and_text(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(work, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
