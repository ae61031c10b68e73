import random
import zlib
from collections import Counter, defaultdict

from lodestar.llm import sharding


def plain_best_fit(sizes, capacity):
    rooms, placed = [], []
    for size in sorted(sizes, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fitting:
            room, i = min(fitting)
            rooms[i] -= size
        else:
            i = len(rooms)
            rooms.append(max(capacity, size) - size)
        placed.append((size, i))
    return len(rooms), placed


def test_runs_equal_one_group_at_a_time():
    draw = random.Random(1)
    for _ in range(60):
        sizes = [draw.randint(1, draw.choice([5, 60])) for _ in range(draw.randint(0, 80))]
        capacity = draw.randint(20, 80)
        bins, runs = sharding.best_fit_decreasing(list(Counter(sizes).items()), capacity)
        ordered = sorted(sizes, reverse=True)
        by_bin = [Counter() for _ in range(bins)]
        for first, last, which in runs:
            by_bin[which].update(ordered[first:last])
        expected_bins, placed = plain_best_fit(sizes, capacity)
        expected = [Counter() for _ in range(expected_bins)]
        for size, which in placed:
            expected[which][size] += 1
        assert bins == expected_bins
        assert sorted(map(repr, map(sorted, (b.items() for b in by_bin)))) == sorted(map(repr, map(sorted, (b.items() for b in expected))))


def check(rows, texts, shards):
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    assert Counter((r.size, r.text_crc32) for r in rows) == Counter((len(t.encode()) + 1, zlib.crc32(t.encode())) for _, t in texts)
    slots, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        by_text[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_text.values())
    assert set(slots) <= set(range(shards))


def test_near_equal_and_whole(given):
    docs, texts = given
    rows = sharding.shard(docs, shards=8).collect()
    check(rows, texts, 8)
    filled = Counter()
    for r in rows:
        filled[r.shard] += r.size
    assert max(filled.values()) - min(filled.values()) <= 0.01 * max(filled.values())


def test_odd_and_empty(odd, texts, nothing):
    check(sharding.shard(odd, shards=8).collect(), texts, 8)
    assert sharding.shard(nothing, shards=8).collect() == []


def test_fixed_capacity(odd, texts):
    rows = sharding.shard(odd, capacity=500).collect()
    filled = Counter()
    for r in rows:
        filled[r.shard] += r.size
    largest = max(len(t.encode()) + 1 for _, t in texts)
    assert sorted(filled.values())[-1] == largest and sorted(filled.values())[-2] <= 500
