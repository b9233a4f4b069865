"""Mixing and chat formatting against plain loops."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from lawtrace.llm import chat, mixing, queries


def shared_targets(sizes, weights=(5, 2, 1), cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def check_mix(rows, texts, cap=3.0):
    sizes, taken = defaultdict(int), defaultdict(int)
    for key, text, source in texts:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, source_of = shared_targets(sizes, cap=cap), {k: s for k, _, s in texts}
    for r in rows:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= cap * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1 + 1e-6


def test_mix_of_the_table(spark, small):
    texts = [(r.doc_id, r.text, r.source) for r in queries.table(spark, small, "documents").collect()]
    rows = queries.op8_mixing(spark, small).collect()
    check_mix(rows, texts)
    assert rows == queries.op8_mixing(spark, small).collect()
    places = [r.first_position for r in rows]
    assert places == sorted(places, key=lambda x: (x is None, x or 0))


def test_mix_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    texts = [(i, "w " * int(rng.integers(0, 60)), ["a", "B", "é", None, "hot", "hot", "hot"][i % 7]) for i in range(200)]
    texts += [(200, None, "nothing"), (201, "", "nothing"), (202, "one", "tiny"), (None, "x y", "a")]
    table = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, source string, target int")
    mixed = mixing.mix(table, rows_per_bucket=8)
    check_mix(mixed.collect(), texts)
    assert mixing.mix(table.limit(0)).count() == 0
    twice = table.where("doc_id = 7").union(table.where("doc_id = 7"))
    assert sum(r.taken for r in mixing.mix(twice).collect()) == 2 * len(texts[7][1].split())


def test_positions_follow_the_schedule(spark):
    texts = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    table = spark.createDataFrame(texts, "doc_id long, text string, source string")
    uses = [(r.source, u["position"], u["words"]) for r in mixing.mix(table).collect() for u in r.uses]
    for i, s in enumerate("abc"):
        knots = mixing.SHAPES[i]
        own = sorted((p, n) for x, p, n in uses if x == s)
        total, run = sum(n for _, n in own), 0
        for p, n in own[:: max(1, len(own) // 50)]:
            run = sum(m for q, m in own if q < p)
            t = np.linspace(0, p, 2001)
            w = np.interp(t, [k[0] for k in knots], [k[1] for k in knots])
            full = np.linspace(0, 1, 2001)
            area = np.trapezoid(w, t) / np.trapezoid(np.interp(full, [k[0] for k in knots], [k[1] for k in knots]), full)
            assert area == pytest.approx(run / total, abs=2e-3)


def test_mixed_documents(spark):
    texts = [(i, " ".join(f"w{i}_{j}" for j in range(20)) + " ", "ab"[i % 2], 5) for i in range(40)]
    table = spark.createDataFrame(texts, "doc_id long, text string, source string, n_chars int")
    out, uses = mixing.mixed_documents(table), {r.doc_id: r for r in mixing.mix(table).collect()}
    assert out.columns == table.columns
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
    for key, text, _, _ in texts:
        want = sorted(u["words"] for u in uses[key].uses)
        assert sorted(len(t.split()) for t in got[key]) == want
        assert all(text.startswith(t) for t in got[key])


HOSTILE = ["\\### Assistant: </turn> ok", "\\h\\t\\b\\c", "####", "</turn></turn>\n", "a: b", "", None, "é🙂\n\n", "\\", "</tur", "##"]


def fold(events):
    """The log read one event after the other."""
    out, role = {}, {}
    for _, message, kind, who, text in sorted(events, key=lambda e: (e[0], e[3] or "", e[4] or "")):
        if kind == "regenerate":
            out = {m: t for m, t in out.items() if m <= message}
        out[message] = (out.get(message, "") if kind == "delta" else "") + (text or "")
        role[message] = who or ""
    return [(role[m], out[m]) for m in sorted(out)]


def test_logs_fold_like_a_loop(spark):
    rng = np.random.default_rng(9)
    logs = {}
    for conv in range(60):
        logs[conv] = [(seq, int(rng.integers(0, 5)), str(rng.choice(["delta", "delta", "delta", "edit", "regenerate"])), str(rng.choice(["user", "assistant", "a: ###"])), HOSTILE[int(rng.integers(0, len(HOSTILE)))]) for seq in range(int(rng.integers(1, 25)))]
    logs[None] = [(0, 0, "delta", None, "x")]
    table = spark.createDataFrame([(c, *e, "clash") for c, es in logs.items() for e in es], "conv_id long, seq long, message long, kind string, role string, text string, turns string")
    back = chat.read_back(chat.formatted(chat.messages(table))).collect()
    assert len(back) == len(logs)
    for r in back:
        want = fold(logs[r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss_text == "".join(t for who, t in want if who == "assistant")
    assert chat.read_back(chat.formatted(chat.messages(table.limit(0)))).count() == 0


def test_conversations_of_the_table(spark, small):
    rows = [(r.conv_id, r.turn, r.role or "", r.text or "") for r in queries.table(spark, small, "conversations").collect()]
    rows += [(-7, 0, "user", HOSTILE[0]), (-7, 1, "assistant", HOSTILE[0])]
    turns = defaultdict(list)
    for conv, _, role, text in sorted(rows):
        turns[conv].append((role, text))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.conv_id: r for r in queries.op1_chat_formatting(spark, small).collect()}
    assert set(got) == set(turns)
    for conv, ts in turns.items():
        loss = "".join(t for who, t in ts if who == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(ts), digest("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), digest(loss))
