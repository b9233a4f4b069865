"""Repeated strings against a table of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lawtrace.llm import queries, suffix_arrays

SCHEMA = "doc_id long, text string, key long, start string, n int"


def brute(rows, length):
    """rows: (id, text). Per row: id, bytes, removed bytes, runs, hash of what is left."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(raw[p : p + length] for _, raw in raws for p in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        runs = sum(1 for p in range(len(raw)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def digest(frame):
    return sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"]) for r in frame.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=80).map(lambda b: bytes(x % 3 for x in b)), st.sampled_from([1, 3, 128]), st.integers(1, 12))
def test_suffix_array_and_common_prefixes(raw, lane, most):
    data = np.frombuffer(raw, np.uint8)
    sa = suffix_arrays.suffix_array(data)
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    assert sa.tolist() == want

    def shared(a, b):
        k = 0
        while k < min(len(a), len(b), most) and a[k] == b[k]:
            k += 1
        return k

    assert suffix_arrays.common_prefixes(data, sa, most, lane).tolist() == [shared(raw[want[k - 1] :], raw[want[k] :]) if k else 0 for k in range(len(raw))]


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=80).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 40))
def test_ranks_up_to_a_length_are_equal_where_the_bytes_are(raw, most):
    sa, rank = suffix_arrays.ranked(np.frombuffer(raw, np.uint8), most)
    heads = [raw[i : i + most] for i in range(len(raw))]
    assert [heads[i] for i in sa] == sorted(heads) and sorted(sa.tolist()) == list(range(len(raw)))
    assert all((rank[i] < rank[j]) == (heads[i] < heads[j]) for i in range(len(raw)) for j in range(len(raw)))


def test_a_shard_is_sorted_no_further_than_strings_reach(monkeypatch):
    """Copies of 5,000 bytes took ten rounds and a walk over common prefixes."""
    rounds = []
    monkeypatch.setattr(suffix_arrays.np, "sort", lambda x, f=np.sort: rounds.append(len(x)) or f(x))
    monkeypatch.setattr(suffix_arrays, "common_prefixes", None)
    text = bytes(random.Random(3).choices(b"abcd", k=5000))
    assert suffix_arrays.Shard([text, text], np.array([1, 1]), 200).total.tolist().count(2.0) == 4801
    assert len(rounds) <= 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 2 for x in b)), max_size=5), st.integers(1, 20))
def test_every_string_has_one_segment_and_equal_strings_one_anchor(texts, length):
    raw, bounds = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    seen, offset = Counter(), {}
    for text, first, count, anchor in suffix_arrays.segments(raw, bounds, length):
        for t, f, c, a in zip(text.tolist(), first.tolist(), count.tolist(), anchor.tolist()):
            for p in range(f, f + c):
                assert bounds[t] <= p and p + length <= bounds[t + 1] and 0 <= a - p < suffix_arrays._span(length)
                seen[p] += 1
                assert offset.setdefault(raw[p : p + length].tobytes(), a - p) == a - p
    want = {int(b) + p for b, t in zip(bounds, texts) for p in range(len(t) - length + 1)}
    assert set(seen) == want and set(seen.values()) <= {1}


def test_pairs_of_shards_agree_with_one():
    """Strings of one set of segments, cut in two shards that meet by binary search."""
    rng = random.Random(5)
    for length in (5, 8, 21):
        texts = list({bytes(rng.choice(b"ab") for _ in range(rng.randrange(length, length + 30))) for _ in range(24)})
        weights = np.array([rng.choice([1, 1, 2]) for _ in texts])

        def marked(found):
            return {(s, int(a) + k) for s, at, n in found for a, m in zip(at, n) for k in range(m)}

        whole = marked(suffix_arrays.Shard(texts, weights, length).repeated())
        a, b = (suffix_arrays.Shard(texts[i::2], weights[i::2], length) for i in (0, 1))
        mine, theirs = a.shared(b)
        got = {(2 * s, p) for s, p in marked(a.repeated()) | marked(a.repeated(mine))} | {(2 * s + 1, p) for s, p in marked(b.repeated()) | marked(b.repeated(theirs))}
        assert got == whole


def test_shards_are_cut_between_keys_and_bounded():
    key, sizes = np.array([5, 3, 5, 9, 3, 7]), np.array([40, 30, 40, 10, 30, 200])
    groups = suffix_arrays._by_key(key, sizes, 100)
    assert sorted(i for g in groups for i in g) == list(range(6))
    assert [sorted(set(key[g].tolist())) for g in groups] == [[3], [5], [7], [9]] and len(suffix_arrays._by_key(key, sizes, 140)) == 3
    with pytest.raises(ValueError):
        suffix_arrays.suffix_array(np.zeros(1 << suffix_arrays.INDEX, np.uint8))


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in queries.op13_suffix_array_dedup(spark, small).collect()), key=str)
    want = brute([tuple(r) for r in rows], 200)
    assert got == want and sum(r[2] for r in want) > 0


@pytest.mark.parametrize(("length", "shard"), [(20, 300), (20, 1 << 19), (7, 100)])
def test_nulls_copies_hot_passages_and_clashing_columns(spark, length, shard):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abc é") for _ in range(rng.randrange(1, 60)))
    passage = "a passage that a third of all rows hold, é and more"
    rows = [(i, word() + (passage if i % 3 == 0 else "") + word()) for i in range(150)]
    rows += [(None, None), (None, ""), (5, rows[5][1]), (None, rows[7][1]), (300, "x" * 500), (301, "ab" * 300), (302, passage[:-1]), (303, None), (304, "short")]
    frame = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA)
    found = suffix_arrays.repeats(frame, length, with_kept=True, shard=shard)
    assert digest(found) == brute(rows, length)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found.select("kept", "kept_sha256").collect())


def test_long_text_and_buffers(spark, monkeypatch):
    monkeypatch.setattr(suffix_arrays, "BUFFER", 1000)
    rng = random.Random(2)
    long = "".join(rng.choice("abcd") for _ in range(20_000))
    rows = [(1, long), (2, "x" + long[5000:9000] + "y"), (3, long[9990:10_100]), (4, "z" * 200), (5, "z" * 199)]
    assert digest(suffix_arrays.repeats(spark.createDataFrame(rows, "doc_id long, text string"), 200)) == brute(rows, 200)


def test_empty_table(spark):
    assert suffix_arrays.repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
