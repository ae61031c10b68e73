"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import zlib

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import numbered
from ..session import materialise
from .bpe import RANKS, byte_bpe
from .tables import id_and_text, in_intervals

CAPACITY = 2048
SPECIAL = {"<|endoftext|>": 50256}
# Longer texts are encoded chunk by chunk, so that no single scan grows with the text.
WHOLE = 1 << 18


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False,
                 vocabulary: str | None = None, special: dict[str, int] | None = None) -> DataFrame:
    """Encode every document, append ``end_id``, and cut what is longer than ``capacity``.

    Returns ``doc_id, piece, start, length, ids_crc32`` and, if asked for, the little-endian
    32-bit ``ids`` of each piece. The first piece takes the remainder, the others are full. A
    missing or empty text is the end id alone; repeated rows are documents of their own.
    """
    path, special = vocabulary or public_tokenizers.path(RANKS), SPECIAL if special is None else special

    def work(batches):
        import tiktoken

        bpe = byte_bpe(path)
        known = bpe.library
        library = tiktoken.Encoding("with-special", pat_str=known._pat_str, mergeable_ranks=known._mergeable_ranks, special_tokens=special)
        end = end_id.to_bytes(4, "little")

        def encoded(text: str) -> bytes:
            if len(text) <= WHOLE:
                return library.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            for word, number in special.items():
                if word in text:
                    return number.to_bytes(4, "little").join(map(encoded, text.split(word)))
            return bpe.encode(text).tobytes()

        for batch in batches:
            for part in range(0, batch.num_rows, 2000):
                owner, piece, start, length, check, kept = [], [], [], [], [], []
                for at, text in enumerate(batch.column(1)[part:part + 2000].to_pylist(), part):
                    ids = encoded(text) + end
                    total = len(ids) // 4
                    first = total % capacity or capacity
                    cuts = [0, *range(first, total + 1, capacity)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        own = ids[4 * a:4 * b]
                        owner.append(at)
                        piece.append(n)
                        start.append(a)
                        length.append(b - a)
                        check.append(zlib.crc32(own))
                        kept.append(own if keep_ids else b"")
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(check, pa.int64()), pa.array(kept, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    cut = rows.mapInArrow(work, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary")
    return cut if keep_ids else cut.drop("ids")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``.

    Subset sums are bits of one integer. Lengths join from the longest down, each in powers of
    two of its count, until the room is filled exactly; going back takes the fewest short ones.
    """
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left and not sums >> room:
            take = min(part, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            left, part = left - take, part * 2
        if sums >> room:
            break
    target, chosen = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + take
            target -= length * take
    return chosen


def minimum_slack(counts: dict[int, int], capacity: int):
    """Bins by minimum bin slack over a histogram of lengths.

    Each bin starts with the longest length left and takes the fullest feasible combination for
    the rest, which is removed. The combination stays the fullest one while its lengths last, so
    it is used as often as they do. Yields ``(times, [(length, how many)])`` per combination.
    """
    counts = {length: n for length, n in counts.items() if n}
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = fullest(counts, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
        yield times, sorted(chosen.items(), reverse=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``doc_id, piece, length``.

    The driver sees the histogram of lengths alone (at most ``capacity`` entries) and returns
    runs of ranks; every piece finds its run by its rank in descending order of length, ties by
    ``doc_id`` and ``piece``. Lengths must lie in 1..capacity. An empty table gives no rows.
    """
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece")]
    placed = numbered(pieces, order, "pack-order")
    counts = {r[0]: r[1] for r in placed.groupBy("length").count().collect()}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    next_rank, at = {}, 0
    for length in sorted(counts, reverse=True):
        next_rank[length], at = at, at + counts[length]
    runs, sequence = [], 0
    for times, chosen in minimum_slack(counts, capacity):
        offset = 0
        for length, n in chosen:
            first = next_rank[length]
            next_rank[length] = last = first + times * n
            runs.append((first, last, n, sequence, offset))
            offset += length * n
        sequence += times
    spans = pieces.sparkSession.createDataFrame(runs, "first bigint, last bigint, each bigint, base bigint, begin bigint")
    found = in_intervals(placed, "rank", spans)
    nth = F.col("rank") - F.col("first")
    return found.withColumns({
        "sequence_id": F.col("base") + F.floor(nth / F.col("each")).cast("long"),
        "offset": F.col("begin") + F.pmod(nth, F.col("each")) * F.col("length"),
    }).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack documents; the pieces are written once, then only their lengths move."""
    return pack(materialise(token_pieces(docs, capacity, end_id, keep_ids), "pack-pieces"), capacity)
