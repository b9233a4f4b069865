"""MinHash near-duplicate groups with DartMinHash signatures.

Every shingle of a document owns regions of weight by rank; each region of area one gets a Poisson(1) number of darts
whose weight, rank and coordinate are hashes of the shingle and the region, so documents that share a shingle share
its darts. A dart counts if its weight is within the shingle's; each of the k coordinates keeps its earliest dart. Two
signatures agree in a coordinate with the probability of the weighted Jaccard similarity, and a document needs about
k ln k darts however many shingles it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.encoding import sliced
from lawtrace.llm.linking import linked
from lawtrace.llm.storage import Scratch, row_of, with_row

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
BINS = 512  # of the sketch that candidate pairs are held to
#: Cumulative Poisson(1) probabilities: darts of a region by one uniform number.
_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size`` consecutive lower-case words, and how often each stands in the text.

    A text of fewer words is one shingle; one without words has none.
    """
    words = (text or "").lower().encode("utf-8").split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, len(h) if len(h) < size else 0, np.uint64)
    for i in range(min(size, len(h))):
        out = mixed(out * _STEP + h[i : i + n])
    found, times = np.unique(out, return_counts=True)
    return found, times.astype(float)


def darts(elements: np.ndarray, weights: np.ndarray, top_rank: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks, coordinate hashes and names of all counting darts below ``top_rank``.

    The weight axis of an element is cut at 1, 2, 4, ...; a strip of width w has rank cells of height 1 / w.
    """
    ranks, where, names = [], [], []
    low, width, strip = 0.0, 1.0, 0
    while len(elements) and (inside := weights > low).any():
        e, w = elements[inside], weights[inside]
        cells = int(np.ceil(top_rank * width))
        base = mixed(e + np.uint64((int(_STEP) * (strip + 1)) % (1 << 64)))
        cell = np.arange(cells, dtype=np.uint64)
        region = mixed(base[:, None] + _STEP * (cell[None, :] + np.uint64(1)))
        count = np.searchsorted(_POISSON, (region >> np.uint64(11)).ravel() / float(1 << 53), side="right")
        at = np.repeat(np.arange(count.size), count)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        dart = mixed(region.ravel()[at] + _STEP * (nth.astype(np.uint64) + np.uint64(1)))
        own = mixed(dart ^ _M1)
        weight = low + width * ((own >> np.uint64(40)) / float(1 << 24))
        rank = (at % cells + ((own & np.uint64(0xFFFFFFFFFF)) / float(1 << 40))) / width
        ok = (weight < w[at // cells]) & (rank < top_rank)
        ranks.append(rank[ok])
        names.append(dart[ok])
        where.append(mixed(dart[ok] + _M2))
        low, width, strip = low + width, max(1.0, low + width), strip + 1
    if not ranks:
        return np.zeros(0), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(ranks), np.concatenate(where), np.concatenate(names)


def signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart's name in each of k coordinates; ``elements`` must not be empty."""
    top = (k * np.log(k) + 2 * k) / weights.sum()
    while True:
        rank, where, name = darts(elements, weights, top)
        late_first = np.argsort(-rank)
        slot = (where % np.uint64(k)).astype(np.int64)[late_first]
        out, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[slot] = name[late_first]  # of equal coordinates the last written, the earliest dart, stays
        filled[slot] = True
        if filled.all():
            return out
        top *= 2


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """A key for each band of ``rows`` coordinates; bands of different places have different keys."""
    out = np.arange(1, len(sig) // rows + 1, dtype=np.uint64)
    for i in range(rows):
        out = mixed(out * _STEP + sig[i::rows][: len(out)])
    return out.view(np.int64)


def sketch(elements: np.ndarray, times: np.ndarray) -> list[int]:
    """Of all elements, an element of weight w being w elements, the least hash in each of ``BINS`` bins: four bits of
    it, zero for an empty bin, sixteen bins to a long. For bags of fewer elements than bins this is nearly the whole bag."""
    times = times.astype(np.int64)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    h = np.sort(mixed(np.repeat(elements, times) + _STEP * (nth.astype(np.uint64) + np.uint64(1))))
    at = (h // np.uint64((1 << 64) // BINS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    own = np.zeros(BINS, np.uint8)
    own[at[first]] = mixed(h[first]) % np.uint64(15) + np.uint64(1)
    return (own[::2] | own[1::2] << 4).view(np.int64).tolist()


def _sketches_allow(a: str, b: str, similarity: float, deviations: float = 5) -> str:
    """SQL that holds unless the share of equal bins lies ``deviations`` below what it is at the similarity.

    N of the U elements of both bags stand in a bin, as a sample without repetition, so the variance of the share is
    s (1 - s) / N (1 - N / U).
    """
    held = lambda x: f"bit_count(({x} | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3)) & {0x1111111111111111}L)"
    longs = range(BINS // 16)
    unequal = " + ".join(held(f"({a}k{i} ^ {b}k{i})") for i in longs)
    filled = " + ".join(held(f"({a}k{i} | {b}k{i})") for i in longs)
    u = f"(({a}n + {b}n) / {1 + similarity}D)"
    n = f"({BINS}D * (1D - exp(-{u} / {BINS}D)))"
    low = f"({similarity - 0.002}D - {deviations}D * sqrt(greatest({similarity * (1 - similarity)}D / {n} * (1D - {n} / {u}), 0D)))"
    return f"({unequal}) <= ({filled}) * (1D - {low})"


def near_groups(docs: DataFrame, similarity: float = 0.8, words: int = 5, n_bands: int = 36, rows: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, class_id)`` for every row: the smallest id of its near-duplicate group.

    Two texts are linked if the weighted Jaccard similarity of their bags of ``words``-word shingles (lower case; a shingle weighs
    as often as it stands in the text) is at least ``similarity``, tested exactly on candidate pairs; groups are connected.
    Candidates share a band: at similarity s a pair is missed with probability (1 - s ** rows) ** n_bands, 0.0002 for 0.8 by
    default. Of those, pairs whose sketches of ``BINS`` bins agree five deviations less than at the threshold are left
    out (one in 10 ** 6 there). Equal bags of shingles are one node, so
    copies are never paired; see ``linking.linked`` for near copies.

    Texts of fewer words are one shingle and match only equal ones; null, empty and wordless texts are each a class
    of their own id; a null id is compared like others and stays null as a row's id, and never names a class that has
    another id; rows with equal ids keep their own text's class. Rows of an empty table have none.
    """
    return _classed(docs, similarity, words, n_bands, rows, id_col, text_col).select("doc_id", "class_id")


def _classed(docs: DataFrame, similarity: float, words: int, n_bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``near_groups`` with ``text_key``, a hash of the row's text, and ``class_key``, that of the class's first text."""
    spark = docs.sparkSession
    own, lasting = Scratch(spark), Scratch(spark)

    def printed(batches):
        for batch in batches:
            for part in sliced(batch, 1):
                out: list[tuple] = []
                for key, text, text_key in zip(*(c.to_pylist() for c in part.columns)):
                    found, times = shingles(text, words)
                    if len(found):
                        h = mixed(found * _M1 + times.astype(np.uint64))
                        sig = signature(found, times, n_bands * rows)
                        out.append((key, text_key, int(h.sum().view(np.int64)), int(mixed(h ^ _M2).sum().view(np.int64)), int(times.sum()), bands(sig, rows).tolist(), sketch(found, times)))
                    else:
                        out.append((key, text_key, None, None, 0, None, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 5, *[pa.list_(pa.int64())] * 2))], ["doc_id", "text_key", "f1", "f2", "n", "keys", "bits"])

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))
    prints = lasting.written(rows_in.mapInArrow(printed, "doc_id long, text_key long, f1 long, f2 long, n long, keys array<long>, bits array<long>"), "prints")
    # of the rows of one bag the first by id and text stands for all; max_by and min_by order by one plain value each
    texts = prints.where("f1 is not null").groupBy("f1", "f2", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("first"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    texts = own.written(texts.withColumn("node", F.monotonically_increasing_id()), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = texts.join(ends.hint("merge"), "node").select(F.col("first.doc_id").alias("w_id"), F.col("first.text_key").alias("w_key"), "node")
        # ids grow with the input: never a broadcast side, however small here; the hash keeps rows of one id or none apart
        sources = rows_in.join(wanted.hint("merge"), F.expr("text_key = w_key and doc_id <=> w_id")).select("node", "text")
        sets = own.written(sources.mapInArrow(shingled, "node long, held binary, times binary").dropDuplicates(["node"]), "sets")
        both = pairs.join(sets.selectExpr("node as a", "held as ha", "times as ta").hint("merge"), "a").join(sets.selectExpr("node as b", "held as hb", "times as tb").hint("merge"), "b")
        return both.mapInArrow(compared, "a long, b long")

    def shingled(batches):
        for batch in batches:
            for part in sliced(batch, 1):
                out = [(node, *shingles(text, words)) for node, text in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1].tobytes() for o in out], pa.binary()), pa.array([o[2].astype(np.uint32).tobytes() for o in out], pa.binary())], ["node", "held", "times"])

    def compared(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                ha, ta, hb, tb = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("ha", np.uint64), ("ta", np.uint32), ("hb", np.uint64), ("tb", np.uint32)))
                _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
                both, every = int(np.minimum(ta[ia], tb[ib]).sum(dtype=np.int64)), int(ta.sum(dtype=np.int64) + tb.sum(dtype=np.int64))
                if both >= similarity * (every - both) - 1e-9:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, pa.int64())), batch.column("b").take(pa.array(keep, pa.int64()))], ["a", "b"])

    def traits_of(shared: DataFrame) -> DataFrame:
        return texts.join(shared.hint("merge"), "node").select("node", "n", *[F.col("bits")[i].alias(f"k{i}") for i in range(BINS // 16)])

    def plausible(a: str, b: str) -> str:
        return f"least({a}n, {b}n) >= {similarity - 1e-9}D * greatest({a}n, {b}n) and {_sketches_allow(a, b, similarity)}"

    _, labels = linked(texts.select("node", "keys"), traits_of, verified, plausible, own)
    grouped = texts.select("f1", "f2", "n", "first", "node")
    grouped = grouped.withColumn("label", F.col("node")) if labels is None else grouped.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    grouped = own.written(grouped, "grouped")
    named = grouped.groupBy("label").agg(F.min("first").alias("winner"))
    classes = lasting.written(grouped.join(named, "label").selectExpr("f1 as c1", "f2 as c2", "n as cn", "winner.doc_id as class_id", "winner.text_key as class_key"), "classes")
    own.drop()
    out = prints.select("doc_id", "text_key", "f1", "f2", "n").join(classes, F.expr("f1 = c1 and f2 = c2 and n = cn"), "left")
    return out.select("doc_id", "text_key", F.expr("if(f1 is null, doc_id, class_id)").alias("class_id"), F.expr("if(f1 is null, text_key, class_key)").alias("class_key"))


def one_of_each(docs: DataFrame, similarity: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class: the row with the smallest id, and of rows with one id that with the smallest text
    hash; null ids come last. Rows that agree in id and text are one, and which of them stays is open; documents
    without words all stay but for such repetitions.
    """
    classed = _classed(docs, similarity, words, 36, 7, id_col, text_col)
    keep = Scratch(docs.sparkSession).written(classed.where("doc_id <=> class_id and text_key = class_key").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct(), "kept")
    keyed = with_row(docs, F.col(id_col).alias("own_id"), F.xxhash64(F.col(text_col)).alias("own_key"))
    left = keyed.join(keep.hint("merge"), F.col("own_id").cast("long").eqNullSafe(F.col("kept_id")) & (F.col("own_key") == F.col("kept_key")), "left_semi")
    return left.dropDuplicates(["own_id", "own_key"]).select(*row_of(docs))
