import hashlib
import random
import tracemalloc
import zlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lodestar.llm import bpe, packing, token_counts

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(1)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "'re", "don't", "é", "中", "1", "²", "!!", "<|endoftext|>", "<|endof", "text|>", " the", " word",
                "\t", " ", "😀", "é", "\x1c", "\x85"]
    made = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 900))) for _ in range(120)]
    return made + ["a" * 3000, " " * 3000 + "x", "", "\n" * 2000 + "b", "x" * 700 + " y" * 900, "'" * 900]


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (300, 20), (1 << 16, 1 << 9)])
def test_chunks_equal_whole(mixed, chunk, overlap):
    counter = token_counts.TokenCounter(public_tokenizers.path(token_counts.VOCABULARY), chunk, overlap)
    coder = bpe.ByteBpe(public_tokenizers.path(bpe.RANKS), chunk, overlap)
    for text in mixed:
        assert counter.count(text) == len(reference(text))
        ids = coder.encode(text).tolist()
        assert ids == coder.library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_counts(odd, texts, nothing, given):
    for docs, rows in ((odd, texts), given):
        got = sorted(map(tuple, token_counts.count_tokens(docs).collect()), key=repr)
        want = [(d, len(t.encode()), len(reference(t)), len(reference(t)) > 512) for d, t in rows]
        assert got == sorted(want, key=repr)
    assert token_counts.count_tokens(nothing).collect() == []


def test_round_trip(odd, texts, nothing, given):
    coder = bpe.ByteBpe(public_tokenizers.path(bpe.RANKS))
    for docs, rows in ((odd, texts), given):
        got = sorted(map(tuple, bpe.digests(docs).collect()), key=repr)
        want = []
        for d, t in rows:
            ids = coder.library.encode_ordinary(t)
            want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
        assert got == sorted(want, key=repr)
    assert bpe.digests(nothing).collect() == []
    back = bpe.decode(bpe.encode(odd)).collect()
    assert sorted(((r.doc_id, bytes(r.bytes)) for r in back), key=repr) == sorted(((d, t.encode()) for d, t in texts), key=repr)


def pieces_of(text, capacity=2048):
    ids = reference(text) + [0]
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(n, a, ids[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def check_packing(rows, texts, capacity=2048):
    want = []
    for d, t in texts:
        want += [(d, n, a, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))) for n, a, ids in pieces_of(t, capacity)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_packing(odd, texts, nothing, given):
    used, bound = check_packing(packing.pack_documents(given[0]).collect(), given[1])
    assert used <= bound * 1.02 + 1
    check_packing(packing.pack_documents(odd).collect(), texts)
    check_packing(packing.pack_documents(odd, capacity=7).collect(), texts, 7)
    assert packing.pack_documents(nothing).collect() == []


def test_kept_ids(odd, texts):
    rows = packing.pack_documents(odd, keep_ids=True).collect()
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.start), []).append(bytes(r.ids))
    for d, t in texts:
        for _, a, ids in pieces_of(t):
            assert b"".join(i.to_bytes(4, "little") for i in ids) in got[d, a]


def test_fullest_combination():
    draw = random.Random(4)
    for _ in range(200):
        counts = {draw.randint(1, 20): draw.randint(1, 3) for _ in range(draw.randint(1, 5))}
        room = draw.randint(0, 40)
        sums = {0}
        for length, n in counts.items():
            for _ in range(n):
                sums |= {s + length for s in sums}
        chosen = packing.fullest(counts, room)
        assert all(n <= counts[length] for length, n in chosen.items())
        assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)


def test_rank_file_is_the_same_vocabulary():
    coder = bpe.ByteBpe(public_tokenizers.path(bpe.RANKS))
    assert isinstance(coder.library, tiktoken.Encoding)
    assert reference("Is the vocabulary the same? é") == coder.library.encode_ordinary("Is the vocabulary the same? é")


def test_a_long_text_is_forgotten_chunk_by_chunk():
    draw = random.Random(6)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9))) for _ in range(3000)]
    text = " ".join(draw.choice(words) for _ in range(400_000))
    coder = bpe.ByteBpe(public_tokenizers.path(bpe.RANKS))
    longest, parts = max(sum(map(len, p)) for p in coder.parts(text)), list(coder.encoded(text))
    assert longest <= 2 * coder.chunk and len(parts) >= len(text) // coder.chunk
    ids = coder.encode(text)
    assert ids.tolist() == [i for p in parts for i in p.tolist()] == coder.library.encode_ordinary(text)

    tracemalloc.start()
    for _ in coder.encoded(text):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(text)
    counter = token_counts.TokenCounter(public_tokenizers.path(token_counts.VOCABULARY))
    tracemalloc.start()
    assert counter.count(text) == len(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20 and peak < 8 * len(text)
