"""Near-duplicate documents and lines against brute force over all pairs."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lawtrace.llm import line_dedup, linking, minhash, queries, storage


def grouped(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def word_bags(text, n=5):
    words = (text or "").lower().encode().split()
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else Counter()


def brute_groups(texts, similarity=0.8):
    """Groups by weighted Jaccard similarity of all pairs."""
    bags = {k: word_bags(t) for k, t in texts}
    links = [(a, b) for a, b in combinations(bags, 2) if bags[a] and (bags[a] & bags[b]).total() >= similarity * (bags[a] | bags[b]).total()]
    return grouped(list(bags), links)


def families(n_base=12, copies=6, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(n_base):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 200))]
        for c in range(copies):
            own = list(words)
            for _ in range(c if c < 4 else 0):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    return out


def test_near_groups_of_the_table(spark, small):
    texts = [(r.doc_id, r.text) for r in queries.table(spark, small, "documents").collect()]
    assert {r.doc_id: r.class_id for r in queries.op7_minhash_near_dedup(spark, small).collect()} == brute_groups(texts)


def test_near_groups_of_odd_rows(spark):
    texts = list(enumerate([*families(), None, "", " \n", "one two", "One  two", "one two three", "x " * 30_000]))
    table = spark.createDataFrame([(k, t, 0) for k, t in texts], "doc_id long, text string, class_id int")
    assert {r.doc_id: r.class_id for r in minhash.near_groups(table).collect()} == brute_groups(texts)
    assert minhash.near_groups(table.limit(0)).count() == 0
    ties = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "p q r s t u"), (None, "a b c d e f"), (4, "p q r s t u")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.class_id) for r in minhash.near_groups(ties).collect()) == [(-1, 1), (1, 1), (1, 1), (1, 1), (4, 1)]


def test_sketches_never_rule_out_links_of_small_bags(spark):
    rng = np.random.default_rng(2)
    rows = []
    for n in (1, 4, 20, 146, 700, 3000):
        for _ in range(40):
            e = rng.integers(0, 2**63, n, dtype=np.uint64)
            times = rng.integers(1, 3, n).astype(float)
            other = times.copy()
            total = int(times.sum())
            for i in rng.permutation(n):  # take elements away while the similarity stays at 0.8 or more
                if other.sum() - 1 >= 0.8 * total:
                    other[i] -= 1
            held = other > 0
            rows.append((total, int(other.sum()), minhash.sketch(e, times), minhash.sketch(e[held], other[held])))
    table = spark.createDataFrame(rows, "a_n long, b_n long, a array<long>, b array<long>")
    table = table.select("a_n", "b_n", *[F.col(s)[i].alias(f"{s}_k{i}") for s in "ab" for i in range(minhash.BINS // 16)])
    assert table.where(minhash._sketches_allow("a_", "b_", 0.8)).count() == len(rows)
    assert table.where(minhash._sketches_allow("a_", "b_", 0.99)).count() < 0.5 * len(rows)


def test_one_of_each_with_equal_and_null_ids(spark):
    a, b, c = families(n_base=3, copies=1, seed=9)
    near = a + " and more"
    rows = [(1, a), (2, near), (2, b), (None, near), (None, c), (None, c), (3, None), (3, None), (4, ""), (None, None)]
    table = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, text string, class_id string, text_key int")
    kept = minhash.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (2, b), (None, c), (3, None), (4, ""), (None, None)], key=str)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    for low, high in ((1, 2), (1, 9)):
        off = []
        for _ in range(30):
            e = rng.integers(0, 2**63, 150, dtype=np.uint64)
            wa, wb = rng.integers(low, high, 150).astype(float), rng.integers(low, high, 150).astype(float)
            wa[:30] = 0.0
            keep = wa > 0
            a, b = minhash.signature(e[keep], wa[keep], 252), minhash.signature(e, wb, 252)
            off.append((a == b).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
        assert abs(np.mean(off)) < 0.02


def test_linking_keeps_all_connections_of_a_bucket(spark):
    # in one bucket, 1-2-3 is a chain off the pivot 0, and 4 is alone
    nodes = spark.createDataFrame([(n, [7, 8] if n == 4 else [8] if n == 9 else [7]) for n in (*range(5), 9)], "node long, keys array<long>")
    traits = lambda shared: shared.withColumn("n", F.lit(1))
    true = {(1, 2), (2, 3)}
    table = spark.createDataFrame(sorted(true), "a long, b long")
    scratch = storage.Scratch(spark)
    links, labels = linking.linked(nodes, traits, lambda pairs: pairs.join(table, ["a", "b"]), lambda a, b: f"{a}n = {b}n", scratch)
    assert {tuple(r) for r in links.collect()} == true
    assert {r.node: r.label for r in labels.collect()} == {1: 1, 2: 1, 3: 1}
    assert linking.linked(nodes, traits, lambda pairs: pairs.where("false"), lambda a, b: "true", scratch)[1] is None
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    assert {r.label for r in linking.components(chain, scratch).collect()} == {0}


def words_of(line):
    return re.sub(r"[.,;:!?\"'()]", "", line.lower()).split()


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _step(row, i, x, b)
    return row[-1]


def _step(before, i, x, b):
    row = [i]
    for j, y in enumerate(b, 1):
        row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row


def test_line_groups(spark):
    rng = random.Random(8)
    base = families(n_base=10, copies=4, seed=3)
    docs = []
    for d in range(30):
        docs.append((d, "\n".join([rng.choice(base), f"alone {d} " + " ".join(str(rng.random()) for _ in range(9)), "short one", "", "The Very Same line, here!" if d % 2 else "the very same LINE here"])))
    docs += [(30, None), (31, ""), (32, "\n\n"), (33, "word " * 20_000), (34, "word " * 20_000)]
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, kept string")
    rows = line_dedup.line_groups(table).collect()
    text = {(d, i): words_of(x) for d, t in docs if t for i, x in enumerate(t.split("\n")) if len(words_of(x)) >= 5}
    assert {(r.doc_id, r.line) for r in rows} == set(text)
    got = {(r.doc_id, r.line): (r.class_doc, r.class_line) for r in rows}
    assert {k for k, v in got.items() if k == v} == {(r.doc_id, r.line) for r in rows if r.kept}
    keys = [k for k in text if k[0] < 33]
    near = {(a, b): edit(text[a], text[b]) <= 0.2 * max(len(text[a]), len(text[b])) for a, b in combinations(keys, 2) if abs(len(text[a]) - len(text[b])) <= 40}
    want = grouped(keys, [p for p, ok in near.items() if ok])
    assert all(want[a] == want[b] for a, b in combinations(keys, 2) if got[a] == got[b])  # no false class
    equal = [(a, b) for a, b in combinations(keys, 2) if text[a] == text[b]]
    assert equal and all(got[a] == got[b] for a, b in equal)
    pairs = [p for p, ok in near.items() if ok and text[p[0]] != text[p[1]]]
    assert np.mean([got[a] == got[b] for a, b in pairs]) > 0.6  # what blocks of fingerprints reach
    assert got[34, 0] == (33, 0)
    left = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(table).collect()}
    assert 34 not in left and left[30] is None and left[31] == "" and left[32] == "\n\n"
    assert left[0].split("\n")[2] == "short one"
    assert line_dedup.line_groups(table.limit(0)).count() == 0


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    n, columns, counts = docs.count(), docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, small)
        assert docs.columns == columns
        counts.append(docs.count())
    assert n > counts[0] >= counts[1] >= counts[2] > 0.4 * n and counts[3] > 0
    rows = corpus_pipeline.run(spark, small).collect()
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
