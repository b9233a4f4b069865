"""Links of lines at the threshold, one pair at a time, so that no chain can stand in for a lost link."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from lawtrace.llm import line_dedup, linking, queries, storage

CASES = ((5, 1), (7, 1), (10, 2), (15, 3), (20, 4), (24, 4), (25, 5), (30, 6), (50, 10))


def changed(rng, words, edits):
    """``edits`` substitutions, so that the similarity is 1 - edits / len(words)."""
    out = list(words)
    for k in rng.sample(range(len(words)), edits):
        out[k] = f"n{rng.getrandbits(40):x}"
    return out


def repeated(rng, words):
    """Few different words."""
    return [words[rng.randrange(2)] for _ in words]


def test_recall_at_the_threshold(spark):
    rng = random.Random(11)
    docs, cases = [], {}
    for n, edits in CASES:
        for kind in ("mixed",) * 40 + ("repeated",) * 5:
            # words of 3 to 9 letters, so that short words are as rare as long ones and edits hit both
            words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n)]
            words = repeated(rng, words) if kind == "repeated" else words
            key = len(docs)
            docs.append((key, " ".join(words) + "\n" + " ".join(changed(rng, words, edits))))
            cases.setdefault((n, kind), []).append(key)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    same = {r.doc_id for r in line_dedup.line_groups(table).collect() if r.line == 1 and not r.kept}
    recall = {k: sum(d in same for d in v) / len(v) for k, v in cases.items()}
    print(recall)
    total = len(same) / len(docs)
    assert total >= 0.99, recall
    assert all(v == 1 for (n, _), v in recall.items() if n <= line_dedup.SHORT), recall


def test_edits_that_shift_words_and_lengths_on_both_sides_of_the_cut(spark):
    rng = random.Random(12)
    docs = []
    for n in (5, 6, 8, 12, 19, 20, 21, 22, 23, 24, 27):
        for _ in range(8):
            words = [f"w{rng.getrandbits(40):x}" for _ in range(n)]
            more = list(words)
            while len(words) >= 0.8 * (len(more) + 1):
                more.insert(rng.randrange(len(more) + 1), f"n{rng.getrandbits(40):x}")
            docs.append((len(docs), " ".join(words) + "\n" + " ".join(more)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [r.doc_id for r in line_dedup.line_groups(table).collect() if r.line == 1 and r.kept]
    assert len(kept) <= 0.01 * len(docs), kept


def test_lines_of_a_repeated_phrase_meet_only_if_they_share_runs(spark):
    """Their single words, frequent ones too, were all keys, so that all such lines of a table met."""
    rng = random.Random(13)
    common = [f"c{i}" for i in range(30)]
    phrases = [[rng.choice(common) if rng.random() < 0.5 else f"w{rng.getrandbits(40):x}" for _ in range(30)] for _ in range(12)]
    lines = [p * 5 for p in phrases]
    rows = [(i, " ".join(w)) for i, w in enumerate(lines)] + [(100 + i, " ".join(changed(rng, w, 30))) for i, w in enumerate(lines)]
    f = spark.createDataFrame(rows, "i long, norm string").select("i", "norm", line_dedup.features(F.col("norm"), 0.8).alias("f")).select("i", "norm", "f.*")
    keys = line_dedup.rare_keys(F.col("n"), F.col("d"), F.col("rare"), F.col("places"), F.col("norm"), 0.8)
    of = {r.i: set(r["keys"]) for r in f.select("i", keys.alias("keys")).collect()}
    assert all(of[i] & of[100 + i] for i in range(12))
    assert sum(bool(of[i] & of[j]) for i in range(12) for j in range(i)) <= 6


def test_short_lines_and_other_white_space(spark, tmp_path):
    long = "one two three four five six"
    docs = [(0, f"All rights reserved.\n{long}\nLes.\n...\n \t\n"), (1, "all  rights\treserved\none\ttwo three four five　six\nles\n...\nAll rights kept."), (2, "没有空格的一行\nLES\r"), (3, "没有空格的一行")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.line): (r.class_doc, r.class_line, r.kept) for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {
        (0, 0): (0, 0, True), (0, 1): (0, 1, True), (0, 2): (0, 2, True),
        (1, 0): (0, 0, False), (1, 1): (0, 1, False), (1, 2): (0, 2, False), (1, 4): (1, 4, True),
        (2, 0): (2, 0, True), (2, 1): (0, 2, False), (3, 0): (2, 0, False),
    }
    left = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, table, str(tmp_path)).collect()}
    assert left == {0: docs[0][1], 1: "...\nAll rights kept.", 2: "没有空格的一行"}


def featured(spark, lines):
    f = spark.createDataFrame(list(enumerate(lines)), "i long, norm string").select("i", "norm", line_dedup.features(F.col("norm"), 0.8).alias("f"))
    return f.select("i", "norm", "f.*")


def test_lines_that_repeat_frequent_words_do_not_meet_by_them(spark):
    """Runs of a frequent word alone, three in a row, were keys, so that all such lines of a table met."""
    rng = random.Random(14)
    lines = [["a"] * 20 + ["the"] * 20 + [f"w{rng.getrandbits(40):x}"] * 25 + [f"w{rng.getrandbits(40):x}"] * 15 for _ in range(10)]
    f = featured(spark, [" ".join(w) for w in lines] + [" ".join(changed(rng, w, 16)) for w in lines])
    keys = line_dedup.rare_keys(F.col("n"), F.col("d"), F.col("rare"), F.col("places"), F.col("norm"), 0.8)
    # anchors are keys with their neighbours, which such lines may share at one place
    of = {r.i: set(r["keys"]) for r in f.select("i", keys.alias("keys")).collect()}
    assert all(of[i] & of[10 + i] for i in range(10))
    few = line_dedup.repeated_keys(F.col("n"), F.col("norm"), F.array().cast("array<bigint>"), 0.8)
    of = {r.i: set(r["keys"]) for r in f.select("i", few.alias("keys")).collect()}
    assert all(of[i] & of[10 + i] for i in range(10))
    assert not any(of[i] & of[j] for i in range(10) for j in range(i))


def test_parities_of_long_lines_tell_unlinked_ones_apart(spark):
    """128 bits could not: of 150 words each, two lines without a common word differ in about 58 bits, and 60 are allowed."""
    rng = random.Random(15)
    sizes = (47, 48, 59, 60, 100, 150, 159, 160, 200)
    lines = [[f"w{rng.getrandbits(40):x}" for _ in range(n)] for n in sizes]
    other = [[f"w{rng.getrandbits(40):x}" for _ in range(n)] for n in sizes]
    near = [changed(rng, w, len(w) // 5) for w in lines]
    longer = [w + [f"w{rng.getrandbits(40):x}" for _ in range(len(w) // 4)] for w in lines]  # over a step of PARITIES
    f = featured(spark, [" ".join(w) for w in lines + near + longer + other]).select("i", "n", *line_dedup.bit_classes())
    a, b = (f.withColumnsRenamed({c: f"{s}{c}" for c in f.columns}) for s in ("a_", "b_"))
    passed = {(r.a_i, r.b_i) for r in a.crossJoin(b).where(line_dedup.plausible_pair("a_", "b_", 0.8)).select("a_i", "b_i").collect()}
    k = len(sizes)
    assert all((i, k + i) in passed and (i, 2 * k + i) in passed and (2 * k + i, i) in passed for i in range(k))
    assert not any((i, 3 * k + i) in passed for i in range(k))


def test_edges_between_groups_join_the_groups(spark, monkeypatch):
    """All edges were walked anew, those within and between groups alike."""
    rng = random.Random(16)
    first = [(a, a + 1) for a in range(0, 60, 3)] + [(a, a + 2) for a in range(0, 60, 3)]
    more = [(rng.randrange(30), rng.randrange(30)) for _ in range(40)] + [(0, 100), (100, 101), (200, 201)]
    more = [(min(p), max(p)) for p in more if p[0] != p[1]]
    seen, real = [], linking.components
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    labels = linking.components(frame(first), storage.Scratch(spark))
    monkeypatch.setattr(linking, "components", lambda edges, scratch: seen.append(edges.count()) or real(edges, scratch))
    got = dict(tuple(r) for r in linking.joined_groups(labels, frame(more), storage.Scratch(spark)).select("node", "label").collect())
    want = dict(tuple(r) for r in real(frame(first + more), storage.Scratch(spark)).select("node", "label").collect())
    assert got == want and seen[0] < len(set(more))
