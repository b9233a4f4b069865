"""Quality rules by distribution divergence.

Every language's reference is learned from all its documents: the mean distribution over character classes, and the
mean share of its most frequent short words with one share for all other words. A document is rejected if the
Jensen-Shannon distance of its own histogram from the reference is above a bound that shrinks with its length; below a
minimum length a histogram says nothing and only the base rules count.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: FIXED VALUES: ordinary punctuation, symbols of the base rule, and white space as the base rules know it.
PUNCTUATION, SYMBOLS, SPACE = b".,;:'\"!?()-", b"#*$%&|<>", b" \t\n\v\f\r"
UNIT = 1_000_000  # shares are summed as whole millionths, so sums do not depend on the order of rows
VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double"


def _class_table() -> np.ndarray:
    """One-hot classes of bytes: lower, upper, outside ASCII, digit, space, punctuation, other."""
    of = lambda b: 2 if b > 127 else 0 if chr(b).islower() else 1 if chr(b).isupper() else 3 if chr(b).isdigit() else 4 if b in SPACE else 5 if b in PUNCTUATION else 6
    return np.eye(7)[[of(b) for b in range(256)]]


CLASSES = _class_table()
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def short_words(raw: bytes, longest: int) -> list[bytes]:
    return [w for w in raw.lower().translate(None, PUNCTUATION).split() if len(w) <= longest]


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows that stand twice or more in the list, the first standing included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = sum(h[i : i + n] * _ODD[i] for i in range(window))
    ranked = np.sort(keys)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))  # equal windows have equal keys; equal keys are compared word by word
    found = Counter(tuple(words[i : i + window]) for i in at)
    covered = np.zeros(len(words), bool)
    for i in at:
        if found[tuple(words[i : i + window])] > 1:
            covered[i : i + window] = True
    return int(covered.sum())


def base_counts(raw: bytes) -> tuple[int, int, int, int, int, bool, np.ndarray]:
    words = raw.split()  # bytes split at exactly [\x20\x09-\x0D]
    held = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = int(held.sum() - held[0x80:0xC0].sum())
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    n, again = len(words), repeated_words(words)
    return n, points - int(held[list(SPACE)].sum()), int(held[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), again, n < 10 or 100 * again > 20 * n, held


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance in bits, 0..1, of rows of ``p`` from ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = np.where(p > 0, p * np.log2(p / m), 0).sum(-1) + np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.clip(bits / 2, 0, 1))


def references(docs: DataFrame, words: int = 60, longest: int = 6, least_words: int = 30, text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """For each language its class shares, its ``words`` most frequent words of at most ``longest`` bytes, their shares.

    Every document of ``least_words`` words or more counts alike. Tasks emit partial sums, never rows of documents; the
    result is ``words + 7`` numbers for each language.
    """

    def partial(batches):
        sums: Counter = Counter()

        def flushed():
            keys = list(sums)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.int32()), pa.array([sums[k] for k in keys], pa.int64())], ["lang", "word", "class", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode("utf-8")
                n = len(raw.split())
                if n < least_words:
                    continue
                held = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES
                for i, share in enumerate(held / held.sum()):
                    sums[lang, None, i] += round(UNIT * share)
                sums[lang, None, -1] += 1
                for w, c in Counter(short_words(raw, longest)).items():
                    sums[lang, w, -2] += round(UNIT * c / n)
            if len(sums) > 200_000:
                yield flushed()
                sums.clear()
        yield flushed()

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    summed = rows.mapInArrow(partial, "lang string, word binary, class int, n long").groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))
    # words have a branch of their own: a plain limit on their place lets each task keep its ``words`` best before the shuffle
    ranked = summed.where("word is not null").selectExpr("*", "row_number() over (partition by lang order by n desc, word) as place").where(f"place <= {words}")
    top = ranked.unionByName(summed.where("word is null").selectExpr("*", "0 as place"))
    found: dict[str, tuple] = {}
    for r in top.orderBy("lang", "place").collect():  # words + 8 rows for each language
        classes, total, names, shares = found.setdefault(r["lang"], (np.zeros(7), [0], [], []))
        if r["word"] is not None:
            names.append(bytes(r["word"]))
            shares.append(r["n"])
        elif r["class"] >= 0:
            classes[r["class"]] = r["n"]
        else:
            total[0] = r["n"]
    out = {}
    for lang, (classes, total, names, shares) in found.items():
        known = np.array(shares) / (UNIT * total[0])
        out[lang] = (classes / classes.sum(), {w: i for i, w in enumerate(names)}, np.append(known, max(0.0, 1 - known.sum())))
    return out


def judged(docs: DataFrame, char_bound: tuple[float, float] = (0.15, 0.82), word_bound: tuple[float, float] = (0.25, 1.2), least_words: int = 30, longest: int = 6, words: int = 60, text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = ("doc_id",), passing: bool = False) -> DataFrame:
    """Columns ``keep`` of every row with ``VERDICT``; if ``passing``, only kept rows and only those columns.

    A bound (a, b) is ``a + b / sqrt(n_words)``. Two maps over the rows and one small aggregation between them. Null
    and empty texts have no words and fail the base rules; a null language counts as the empty one; a language with no
    document of ``least_words`` words has no reference, and its documents are held to the base rules alone. Rows are
    judged each by itself, so repeated rows get equal verdicts.
    """
    refs = docs.sparkSession.sparkContext.broadcast(references(docs, words, longest, least_words, text_col, lang_col))

    def judge(batches):
        known = refs.value
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for lang, text in zip(langs, texts):
                raw = (text or "").encode("utf-8")
                n, chars, symbols, lines, again, failed, held = base_counts(raw)
                d_char = d_word = None
                if n >= least_words and lang in known:
                    classes, index, shares = known[lang]
                    d_char = float(distance(held @ CLASSES / held.sum(), classes))
                    own = [index[w] for w in raw.lower().translate(None, PUNCTUATION).split() if w in index]
                    counts = np.bincount(own, minlength=len(shares)).astype(float)
                    counts[-1] = n - len(own)
                    d_word = float(distance(counts / n, shares))
                good = not failed and (d_char is None or d_char <= char_bound[0] + char_bound[1] / n**0.5 and d_word <= word_bound[0] + word_bound[1] / n**0.5)
                rows.append((n, chars, symbols, lines, again, failed, good, d_char, d_word))
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            out = pa.RecordBatch.from_arrays([*batch.columns[2:], *(pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 9, types))], [*[f"c{i}" for i in range(batch.num_columns - 2)], *names])
            yield out.filter(out.column(out.num_columns - 3)) if passing else out

    names = [x.split(" ")[0] for x in VERDICT.split(", ")]
    kept = [F.col(c) for c in keep]
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"), *[c.alias(f"c{i}") for i, c in enumerate(kept)])
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.select(*kept).schema)], VERDICT])
    out = rows.mapInArrow(judge, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *([] if passing else names))
