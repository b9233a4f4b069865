"""Token counts, token files and packing against the tokenizers library itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lawtrace.llm import encoding, packing, queries, token_counts, token_files
from lawtrace.llm.encoding import ChunkEncoder, slices

LIBRARIES = {}


def library(path):
    return LIBRARIES.setdefault(path, None) or LIBRARIES.update({path: Tokenizer.from_file(path)}) or LIBRARIES[path]


BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "a  b", "<|endoftext|> x<|endoftext|>y", " lead", "tail ", "a\n\nb", "it's don't 12 34", "x \n y", "é́ ́a", "A b", "\tq", "İstanbul ΣΑΣ", "nul\x00in it", "x\x1cy z", "日本語 テキスト", "🙂 🙂🙂", "word " * 3000]


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "src", i, "clash") for i, t in enumerate(texts)], "doc_id long, text string, source string, length int, n_tokens string")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunks_give_the_library_ids():
    for path, spaced in ((BYTES, True), (WORDS, False)):
        lib = library(path)
        want = [lib.encode(t, add_special_tokens=False).ids if t else [] for t in ODD * 2]
        for memo in (1 << 10, 32 << 20):  # what is remembered changes no result
            own = ChunkEncoder(path, spaced, memo)
            assert [x.tolist() for part in slices(pa.array(ODD * 2), rows=5, size=200) for x in own.encode(part)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet=st.sampled_from("abrstzKÉéßÿµªº×đ'"), max_size=8), st.text(alphabet=st.sampled_from(encoding.SIGNS + "'<|>2"), max_size=4)), max_size=8))
def test_words_with_signs_give_the_library_ids(parts):
    text = " ".join(word + signs for word, signs in parts)
    for path, spaced in ((BYTES, True), (WORDS, False)):
        assert encoding.encoder(path, spaced).encode(pa.array([text]))[0].tolist() == library(path).encode(text, add_special_tokens=False).ids


def test_plain_words_go_straight_to_the_model():
    for path, spaced in ((BYTES, True), (WORDS, False)):
        own = ChunkEncoder(path, spaced)
        whole, asked = own.tokenizer, []
        own.tokenizer = type("Counted", (), {"encode_batch_fast": lambda _, texts, **more: asked.extend(texts) or whole.encode_batch_fast(texts, **more)})()
        text = "Étés, plain words. And (more\") plain$$$ words***"
        assert own.encode(pa.array([text]))[0].tolist() == library(path).encode(text, add_special_tokens=False).ids
        assert [t.strip() for t in asked] == ['(more")']


def test_very_long_texts_stay_whole_and_are_not_remembered():
    texts = ["x" * 1_000_000, "word and " * 120_000, "\t" * 1000 + "y " * 400_000]
    for path, spaced in ((BYTES, True), (WORDS, False)):
        own, lib = ChunkEncoder(path, spaced, 1 << 20), library(path)
        for t in texts:
            assert own.encode(pa.array([t]))[0].tolist() == lib.encode(t, add_special_tokens=False).ids
        assert max(map(len, (*own.memo.young, *own.memo.old))) <= encoding.LONG


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab' \n\té.1,<|>　Z"), max_size=40))
def test_any_white_space_gives_the_library_ids(text):
    lib = library(BYTES)
    assert encoding.encoder(BYTES, True).encode(pa.array([text]))[0].tolist() == lib.encode(text, add_special_tokens=False).ids
    assert token_counts.counter(BYTES).counts(pa.array([text, "", text])).tolist() == [n := len(lib.encode(text, add_special_tokens=False).ids), 0, n]


def test_counts(spark):
    lib = library(BYTES)
    rows = {r.doc_id: r for r in token_counts.token_counts(docs(spark, ODD), BYTES, limit=100).collect()}
    for i, t in enumerate(ODD):
        n = len(lib.encode(t or "").ids)
        assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit) == (n, len((t or "").encode()), n > 100)
    assert token_counts.token_counts(docs(spark, []), BYTES, limit=1).count() == 0


def test_counts_of_the_table(spark, small):
    lib = library(BYTES)
    text = {r.doc_id: r.text for r in queries.table(spark, small, "documents").collect()}
    for r in queries.op6_token_counts(spark, small).collect():
        assert r.n_tokens == len(lib.encode(text[r.doc_id]).ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=60))
def test_elias_fano_selects(steps):
    values = np.cumsum(steps)
    ef = token_files.EliasFano.of(values, int(values[-1]) + 1)
    assert ef.select(np.arange(len(values))).tolist() == values.tolist()
    for v in (0, int(values[-1]), int(values[-1]) + 1):
        assert ef.first_not_below(v) == int(np.searchsorted(values, v))
    assert 8 * (len(ef.low) + len(ef.high)) <= len(values) * (3 + max(0, np.log2(values[-1] / len(values) + 1))) + 32


def test_token_files_round_trip(spark, tmp_path):
    lib, ids = library(BYTES), list(range(5, 5 + len(ODD)))
    random.Random(3).shuffle(ids)
    out = str(tmp_path / "files")
    token_files.write_token_files(docs(spark, ODD, ids), out, BYTES, end_id=2, block_ids=50, partitions=3)
    rows, start = {r.doc_id: r for r in token_files.read_token_files(spark, out).collect()}, 0
    for key, text in sorted(zip(ids, ODD)):
        own = (lib.encode(text, add_special_tokens=False).ids if text else []) + [2]
        assert (rows[key].start, rows[key].n_tokens, rows[key].ids_crc32) == (start, len(own), crc(own))
        assert [(r.start, r.ids) for r in token_files.token_ids(spark, out, key).collect()] == [(start, own)]
        start += len(own)
    assert token_files.token_ids(spark, out, 999).count() == 0


def test_token_files_of_ties_nulls_and_nothing(spark, tmp_path):
    table = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "n"), (-4, "x")], "doc_id long, text string")
    token_files.write_token_files(table, str(tmp_path / "ties"), BYTES, end_id=2)
    rows = token_files.read_token_files(spark, str(tmp_path / "ties")).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in rows] == [(None, 0), (-4, 2), (1, 4), (1, 6), (1, 8)]
    assert sorted(r.start for r in token_files.token_ids(spark, str(tmp_path / "ties"), 1).collect()) == [4, 6, 8]
    token_files.write_token_files(table.limit(0), str(tmp_path / "none"), BYTES, end_id=2)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def check_packed(rows, capacity, lengths):
    assert Counter(r.length for r in rows) == Counter(lengths)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_plan_is_a_packing_no_worse_than_plain_best_fit(lengths):
    counts, capacity = Counter(lengths), 30
    s = packing.plan(dict(counts), capacity)
    seen, bins = Counter(), defaultdict(list)
    for length in sorted(lengths):
        r = seen[length]
        seen[length] += 1
        i = max(j for j in range(len(s["key"] if "key" in s else s["length"])) if s["length"][j] == length and s["first"][j] <= r)
        r -= s["first"][i]
        bins[int(s["sequence"][i] + r // s["copies"][i])].append((int(s["offset"][i] + r % s["copies"][i] * length), length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = []
    for a in sorted(lengths, reverse=True):
        fit = min((x for x in rooms if x >= a), default=None)
        if fit is not None:
            rooms.remove(fit)
        rooms.append((capacity if fit is None else fit) - a)
    assert len(bins) <= len(rooms)
    assert len(bins) >= -(-sum(lengths) // capacity)


def fewest(pieces, capacity):
    """Bins of an optimal packing, by trying every place of each piece."""
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= pieces[i] and room not in rooms[:j]:
                place(i + 1, [*rooms[:j], room - pieces[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - pieces[i]])

    pieces = sorted(pieces, reverse=True)
    place(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(3, 20), min_size=1, max_size=9))
def test_reduction_leaves_an_optimal_packing(lengths):
    left = Counter(lengths)
    fixed = packing.reduced(left, 20)
    used = Counter()
    for many, pattern in fixed:
        assert sum(x * k for x, k in pattern) <= 20
        used.update({x: many * k for x, k in pattern})
    assert used + left == Counter(lengths)
    assert sum(many for many, _ in fixed) + fewest(list(left.elements()), 20) == fewest(lengths, 20)


def test_reduction_fixes_sets_of_three():
    assert packing.beside(Counter([10, 6, 4, 4]), [4, 6, 10], 10, 10) == [6, 4]
    assert packing.beside(Counter([10, 7, 5, 5, 4]), [4, 5, 7, 10], 10, 10) is None


def test_packing_pieces(spark):
    lib = library(WORDS)
    texts = [*ODD, *["word " * n for n in range(1, 120)]]
    pieces = packing.token_pieces(docs(spark, texts), WORDS, end_id=1, capacity=64)
    rows = packing.pack(pieces, 64).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = (lib.encode(t, add_special_tokens=False).ids if t else []) + [1]
        want |= {(i, k): (at, len(ids[at : at + 64]), crc(ids[at : at + 64])) for k, at in enumerate(range(0, len(ids), 64))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    n = check_packed(rows, 64, [x[1] for x in want.values()])
    assert n <= -(-sum(x[1] for x in want.values()) // 64) + 2
    assert packing.pack(packing.token_pieces(docs(spark, []), WORDS, 1, 64), 64).count() == 0


def test_packing_the_table(spark, small):
    rows = queries.op3_best_fit_packing(spark, small).collect()
    n = check_packed(rows, 4096, [r.length for r in rows])
    assert n <= -(-sum(r.length for r in rows) // 4096) + 2
