"""Stages of the pipeline on tables whose columns are named like ours, and the pipeline on odd tables."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lawtrace.llm import line_dedup, minhash, mixing

NAMES = ("size", "uses", "use", "use_id", "use_key", "own_key", "own_id", "left_text", "gone_lines", "kept_own", "kept_id", "kept_key", "row", "whole", "cut_text", "text_key", "class_id", "label", "node")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words):
    return " ".join(rng.choice(["river", "stone", "cloud", "garden", "winter", "letter", "music", "valley", "engine", "paper"]) + str(rng.randrange(30)) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    shared = prose(rng, 9)
    rows = [(i, prose(rng, 40) + "\n" + (shared if i % 3 == 0 else prose(rng, 8)) + "\n" + prose(rng, 30), "en", "ab"[i % 2]) for i in range(24)]
    rows += [(100, rows[4][1], "en", "a"), (101, rows[4][1] + " end", "en", "b")]
    return spark.createDataFrame([(*r, *[f"{n}-{r[0]}" for n in NAMES]) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in NAMES))


@pytest.mark.parametrize("stage", [mixing.mixed_documents, line_dedup.without_repeated_lines, minhash.one_of_each])
def test_columns_of_our_names_pass_through(docs, stage):
    plain = stage(docs.select("doc_id", "text", "lang", "source"))
    own = stage(docs)
    assert own.columns == docs.columns
    rows = own.collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in plain.collect()) and rows
    assert all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in NAMES)


def test_long_text_of_repeated_lines(spark):
    line = "one line of more than five words that repeats"
    rows = [(1, "\n".join([line] * 20_000)), (2, "\n".join(f"line {i} has words of its own here" for i in range(2000)) + "\n" + line)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), similarity=1.0).collect()}
    # words are compared by short codes, so a few pairs of these two million may count as equal
    assert out[1] == line and line not in out[2] and out[2].count("\n") >= 1990


def run(spark, folder, rows):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_pipeline_on_empty_and_rejected_tables(spark, tmp_path):
    assert run(spark, tmp_path / "none", []) == []
    assert run(spark, tmp_path / "bad", [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "too short", "en", "a", 9), (None, "# $ % & " * 40, None, "a", 1)]) == []


def test_pipeline_on_nulls_ties_and_repeated_rows(spark, tmp_path):
    rng = random.Random(8)
    own = [(i, prose(rng, 120), None if i % 5 == 0 else "en", None if i % 7 == 0 else "a", 1) for i in range(12)]
    rows = [*own, own[3], own[3], (3, prose(rng, 120), "en", "b", 1), (None, prose(rng, 120), "en", "b", 1), (50, None, None, None, None)]
    got = run(spark, tmp_path, rows)
    ids = {r["doc_id"] for r in got}
    assert ids <= {r[0] for r in rows} and 50 not in ids and len(ids) >= 10  # the mix may leave some of a small source out
    pieces = {}
    for r in got:
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in pieces.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
