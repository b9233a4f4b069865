"""The prefix trie against one that lists the members of every prefix."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lawtrace.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, part string, key string, depth int"


def brute(convs):
    """convs: id -> tuple of (role, text)."""
    members, kids, leaves, saved = {}, {}, {}, {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = sum(saved[x] for x in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in members[p] if convs[c] == p))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], ends(p)) for p, m in members.items()), key=str)


def ordered(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: tuple(x[2:] for x in sorted(v)) for c, v in by.items()}


def forked(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))  # the remainder has the sign of c
        out[c] = convs.get(base, ())[:h] + own[h:]
    return out


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert result(queries.op11_prefix_trie(spark, small)) == brute(forked(ordered(map(tuple, rows.collect()))))


@pytest.mark.parametrize("per_part", [1, 7, 10_000])
def test_nulls_ties_copies_and_clashing_columns(spark, per_part):
    rows = [(c, t, "user", f"{'é' * (c % 3)}{t % 4}") for c in range(-6, 30) for t in range(c % 7)]
    rows += [(100, None, None, None), (100, None, None, None), (100, 3, "user", ""), (100, 3, "assistant", "b"), (None, 1, "user", "x"), (101, 0, None, "x"), (102, 0, "", "x")]
    rows += [(200 + i * 5000, t, "user", "same") for i in range(40) for t in range(3)]  # copies, in many ranges of ids
    rows += [(900_000, t, "user", "w" * 3000) for t in range(300)] + [(900_001, t, "user", "w" * 3000) for t in range(299)]
    frame = spark.createDataFrame([(*r, "p", "k", 1) for r in rows], SCHEMA)
    strings = prefix_trie.turn_strings(frame)
    assert result(prefix_trie.trie(strings, per_part)) == brute(ordered(rows))
    if per_part == 7:
        assert result(prefix_trie.trie(queries.rebuilt(strings), per_part)) == brute(forked(ordered(rows)))


def test_empty_table_has_no_node(spark):
    assert result(prefix_trie.trie(prefix_trie.turn_strings(spark.createDataFrame([], SCHEMA)))) == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.lists(st.integers(0, 2), max_size=6).map(tuple), min_size=1, max_size=30), st.integers(0, 5))
def test_forests_merge_over_any_borders(strings, cuts):
    """Forests of any cut into parts, merged by hand, are the trie of all."""
    convs = {i: tuple((str(x), "y" * x) for x in s) for i, s in enumerate(sorted(strings))}
    digest = lambda t: hashlib.sha256(repr(t).encode()).digest()[: prefix_trie.WIDTH]
    rows = sorted((b"".join(map(digest, t)), [len(x[1]) for x in t], 1, c, hashlib.sha256(str(c).encode()).hexdigest()) for c, t in convs.items())
    size = max(1, -(-len(rows) // (cuts + 1)))
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    merged, closed, names = {}, [], {}
    for i, p in enumerate(parts):
        left = prefix_trie.common_turns(parts[i - 1][-1][0], p[0][0]) if i else -1
        right = prefix_trie.common_turns(p[-1][0], parts[i + 1][0][0]) if i + 1 < len(parts) else -1
        seqs, sizes, counts, ids, ends = (list(c) for c in zip(*p))
        for _, key, over, d, first, parent, n, kids, leaves, saved, end in prefix_trie.Forest(seqs, sizes, counts, ids, left, right).rows(i, ends):
            if key is None:
                closed.append((first, d, parent, over, n, kids, leaves, saved, end))
            else:
                was = merged.get(key, (first, d, over, 0, 0, 0, 0, None))
                merged[key] = (min(was[0], first), d, over, was[3] + n, was[4] + kids, was[5] + leaves, was[6] + saved, end or was[7])
    names = {k: v[0] for k, v in merged.items()}
    got = [(f, d, names[over] if over else parent, n, k, leaf, s, e or prefix_trie.NOTHING) for f, d, parent, over, n, k, leaf, s, e in closed]
    got += [(f, d, names[over] if over else None, n, k, leaf, s, e or prefix_trie.NOTHING) for f, d, over, n, k, leaf, s, e in merged.values()]
    assert sorted(got, key=str) == brute(convs)
