"""Conversation prefix trie against a trie of plain tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from larkspur.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, place long, key string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, role, mark, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn, role, text))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}


def brute(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(conversations):
        turns = conversations[c]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        weight = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += weight
            leaves[node[:d]] += node not in children
    return [
        (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest())
        for node, own in members.items()
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def nodes(places, **how):
    return sorted(map(tuple, prefixes.trie(places, **how).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    out = []
    for conv in range(120):
        if conv % 17 == 3:
            continue
        opening = rnd.choice(["Hello", "Hi there", "Grüß dich"])
        for turn in range(rnd.randrange(1, 12)):
            text = opening if turn == 0 else rnd.choice(["yes", "no", "a longer answer with ü"])
            out.append((conv, turn, ["user", "assistant"][turn % 2], text))
    out += [(200 + k, t, "user", f"copy {t}") for k in range(40) for t in range(3)]
    out += [(300 + k, t, "user", f"line {t}" if t < 50 + k % 3 else f"{k} {t}") for k in range(8) for t in range(60 + k)]
    out += [(400, None, None, None), (400, None, "user", "b"), (400, 1, "user", None), (401, 5, "a", "tie"), (401, 5, "a", "eit"), (401, 5, "a", "tie")]
    out += [(None, 1, "user", "of nobody"), (406, 0, "", ""), (5_000_000_000, 1, "user", "large id"), (407, 0, "user", "x" * 300_000)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("width, conversations", [(256, 1024), (4, 1024), (7, 5), (1, 3)])
def test_rebuilt_trie_matches_plain_tuples(spark, rows, width, conversations):
    got = nodes(prefixes.rebuilt(frame(spark, rows)), width=width, conversations=conversations)
    assert got == sorted(brute(rebuilt(rows)), key=str)


def test_some_rebuilt_conversation_has_no_turns(rows):
    assert any(not turns for turns in rebuilt(rows).values())


def test_trie_of_the_conversations_as_they_are(spark, rows):
    own = [r for r in rows if None not in r and r[0] < 400]
    assert nodes(prefixes.plain(frame(spark, own)), width=16) == sorted(brute(plain(own)), key=str)


def test_many_ranges_give_the_same(spark, rows):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = nodes(prefixes.rebuilt(frame(spark, rows)), width=16)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted(brute(rebuilt(rows)), key=str)


def test_no_conversations(spark, rows):
    assert nodes(prefixes.rebuilt(frame(spark, rows).limit(0))) == []
