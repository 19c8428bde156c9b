"""The trie against rebuilt texts."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from shelfwise.llm import prefix_trie

from conftest import SF01

SCHEMA = "conv_id long, turn long, role string, text string"


def _brute(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            talks[c].append(((turn is not None, turn or 0), role, key, text))
    own = {c: [(role, text) for _, role, _, text in sorted(t)] for c, t in talks.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved, out = defaultdict(int), defaultdict(int), []
    for path, m in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(m) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += not children[path]
    for path, m in members.items():
        ended = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(path))
        up = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), up, len(m), len(children[path]), leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def _trie(spark, rows):
    talks = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, depth int, member string").repartition(5)
    return sorted(map(tuple, prefix_trie.conversation_trie(talks).collect()), key=str)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    ids, numbers = [*range(60)] * 3 + [None, -3, -7, 10**12 + 1], [None, *range(10)]
    rows = [(rng.choice(ids), rng.choice(numbers), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "a", "b", "été", "a"])) for _ in range(500)]
    return rows + [(c, k, "u", f"x{k}") for c in range(100, 125) for k in range(12)] + [(75, 1, "user", "a")] * 3


def test_nulls_ties_repeats_and_copies(spark, odd):
    assert _trie(spark, odd) == _brute(odd)


def test_one_conversation_over_many_tasks(spark, odd, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rng = random.Random(4)
    rows = odd[:100] + [(c, k, "user", rng.choice("ab") if k > 20 else "a") for c in (75, 77, 78) for k in range(250)]
    assert _trie(spark, rows) == _brute(rows)


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 6, 7, 8, 9, 11, 12, 13, 14)]  # no base exists
    got = _trie(spark, rows)
    assert got == _brute(rows) and got[0][1] == 0
    assert _trie(spark, []) == []


def test_given_conversations(spark):
    talks = spark.read.parquet(f"{SF01}/conversations.parquet")
    got = sorted(map(tuple, prefix_trie.conversation_trie(talks).collect()), key=str)
    assert got == _brute([tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()])


def test_equal_fingerprints_of_unequal_prefixes_are_found(spark, odd, monkeypatch):
    """With a base of 1 a fingerprint is a plain sum, so turned-round prefixes collide."""
    seeds, real = [], prefix_trie.bases

    def poor(seed):
        seeds.append(seed)
        return [1] * prefix_trie.LANES if len(seeds) == 1 else real(seed)

    monkeypatch.setattr(prefix_trie, "bases", poor)
    rows = [(1000 + 5 * c, k, "user", t) for c, talk in enumerate(("ab", "ba", "abc")) for k, t in enumerate(talk)]
    assert _trie(spark, rows) == _brute(rows) and seeds == [1, 2]
