import hashlib
import random
import re
import zlib

import pytest

from tallywharf.llm import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
LAYOUT = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Each conversation's turns by the rule, in plain Python."""
    def name(role, text):
        return hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", name(role, text), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]

        def childless(p):
            return not any(len(q) == len(p) + 1 and q[:-1] == p for q in members)

        def words(p):
            return len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        out.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids),
            sum(len(q) == len(path) + 1 for q in below), sum(childless(p) for p in below),
            sum((len(members[p]) - 1) * words(p) for p in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def run(frame):
    found = prefix_trie.nodes(prefix_trie.rebuilt(frame))
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=repr)


def made(seed, convs, deepest):
    rnd = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rnd.randrange(1, deepest + 1)):
            # Few texts, so that conversations share prefixes; some are prefixes of others.
            rows.append((c, t, rnd.choice(["user", None]), rnd.choice(["a b", "c", "", None, "d  e\nf"][: 2 + t % 4])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, shard", [(256, 1 << 17), (2, 1 << 17), (3, 9), (1, 5)])
def test_nodes_against_all_prefixes(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 3)
    rows = made(segment + shard, [*range(-30, 70), 205, 207], 7)
    assert run(spark.createDataFrame(rows, LAYOUT).repartition(4)) == brute(rows)


def test_a_hot_conversation_and_hot_first_turn(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 40)
    rows = [(20, t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(c, t, "user", "the same words") for c in range(100, 160) for t in range(3)]
    rows += [(c, t, "user", "the same words" if not t else f"own {c}") for c in range(160, 180) for t in range(3)]
    assert run(spark.createDataFrame(rows, LAYOUT).repartition(3)) == brute(rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (0, None, "user", "first"), (0, 0, "user", "second"), (0, 0, "assistant", "before it"), (0, 0, "user", "second"),
        (1, 5, None, None), (2, None, None, None), (2, None, None, None), (None, 0, "user", "no one's"), (40, 1, "", ""),
        (41, 1, "a", "bc"), (42, 1, "ab", "c"),
    ]
    frame = spark.createDataFrame(
        [(*r, "x", 1, None) for r in rows], LAYOUT + ", path string, place long, words string"
    )
    assert run(frame) == brute(rows)


def test_an_empty_table(spark):
    assert run(spark.createDataFrame([], LAYOUT)) == []


def test_double_arrays_hold_exactly_their_paths():
    rnd = random.Random(2)
    paths = sorted({tuple(rnd.randrange(30) for _ in range(rnd.randrange(1, 6))) for _ in range(400)})
    trie = prefix_trie.DoubleArray([list(p) for p in paths])
    prefixes = {p[:k] for p in paths for k in range(len(p) + 1)}
    places = {}
    for p in sorted(prefixes, key=len):
        node = places[p[:-1]] if p else trie.ROOT
        places[p] = trie.base[node] + p[-1] if p else trie.ROOT
        if p:
            assert trie.check[places[p]] == node
    assert len(set(places.values())) == len(prefixes)
    assert (trie.check >= 0).sum() == len(prefixes) - 1
