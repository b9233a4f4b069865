"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its adjacent character classes and how often its words, word triples and lines come back in it; damped counts,
weighted by inverse document frequency, are projected on the leading singular directions of a bounded labelled sample.
Every text gets the exact cosines to all labelled vectors, in blocks, and the labels of the nearest vote with their
similarity. Labels, language, source and id are no terms.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = 44


def _folded() -> np.ndarray:
    """A class for each byte: letters each their own, then upper case, digits, blank, other space, outside ASCII, and
    13 classes of the other signs in the order of their codes."""
    out, other = np.zeros(256, np.int64), 0
    for b in range(256):
        c = chr(b)
        if b > 127:
            out[b] = 30
        elif c.islower():
            out[b] = b - ord("a")
        elif c.isupper():
            out[b] = 26
        elif c.isdigit():
            out[b] = 27
        elif c == " ":
            out[b] = 28
        elif b < 32 or b == 127:
            out[b] = 29
        else:
            out[b], other = 31 + other % 13, other + 1
    return out


FOLD = _folded()
PAIRS, STEPS = SYMBOLS * SYMBOLS, 8
TERMS = PAIRS + 4 * STEPS + 2
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def terms(text: str | None) -> np.ndarray:
    """Counts of all terms of one whole text."""
    raw = (text or "").encode("utf-8")
    out = np.zeros(TERMS, np.float32)
    kinds = FOLD[np.frombuffer(raw, np.uint8)]
    if len(kinds) > 1:
        out[:PAIRS] = np.bincount(kinds[:-1] * SYMBOLS + kinds[1:], minlength=PAIRS)
    words = raw.split()
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    triples = hashed[:-2] * _ODD[0] + hashed[1:-1] * _ODD[1] + hashed[2:] * _ODD[2]
    for i, items in enumerate((hashed, triples)):
        times = np.unique(items, return_counts=True)[1]
        out[PAIRS + i * STEPS : PAIRS + (i + 1) * STEPS] = np.bincount(np.minimum(STEPS - 1, np.log2(times).astype(int)), times, STEPS)
    for n in Counter(raw.split(b"\n")).values():
        out[PAIRS + 2 * STEPS + min(STEPS - 1, n.bit_length())] += n
    again = int((hashed[1:] == hashed[:-1]).sum())
    out[PAIRS + 3 * STEPS + min(STEPS - 1, len(words).bit_length() // 2)] = 1
    out[-2:] = again, len(words) - again
    return out


class LatentVoter:
    """Projection and labelled vectors; a few megabytes for the documented sample."""

    def __init__(self, counts: np.ndarray, votes: np.ndarray, dims: int, neighbours: int, power: float):
        self.votes, self.neighbours, self.power = votes, min(neighbours, len(votes)), power
        self.prior = float(votes.mean()) if len(votes) else 0.5
        if not len(votes):
            return
        self.idf = (np.log((1 + len(votes)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
        z = self._weighted(counts)
        self.mean = z.mean(0)
        z -= self.mean
        basis = np.random.default_rng(1).standard_normal((z.shape[1], min(dims + 16, *z.shape))).astype(np.float32)
        for _ in range(6):  # subspace iteration towards the leading right singular vectors
            basis = np.linalg.qr(z.T @ (z @ basis))[0]
        turn = np.linalg.svd(z @ basis, full_matrices=False)[2]
        self.axes = basis @ turn[:dims].T
        self.known = self._unit(z @ self.axes)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        return self._unit(np.log1p(counts) * self.idf)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.votes) or not len(counts):
            return np.full(len(counts), self.prior)
        cosines = self._unit((self._weighted(counts) - self.mean) @ self.axes) @ self.known.T
        near = np.argpartition(-cosines, self.neighbours - 1, axis=1)[:, : self.neighbours]
        weight = np.clip(np.take_along_axis(cosines, near, 1).astype(float), 0, None) ** self.power
        total = weight.sum(1)
        return np.clip(np.where(total > 0, (weight * self.votes[near]).sum(1) / np.where(total > 0, total, 1), self.prior), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, dims: int = 48, neighbours: int = 10, power: float = 4.0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LatentVoter:
    """Learn from at most ``sample`` labelled ids, the first in the order of md5(id).

    Null labels are left out; several labels of one id count as their mean; ids without a document give nothing. The
    sample's ids are broadcast and its sparse term counts collected, about 2 KB each, so both are bounded by ``sample``.
    """
    voted = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("doc_id is not null and label is not null")
    chosen = voted.groupBy("doc_id").agg(F.avg("label").alias("vote")).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id").select("vote", "text")

    def sparse(batches):
        for batch in batches:
            found = [terms(t) for t in batch.column(1).to_pylist()]
            at = [np.flatnonzero(x) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()), pa.array([x[a].astype("<f4").tobytes() for x, a in zip(found, at)], pa.binary())], ["vote", "at", "n"])

    rows = sorted((r["vote"], bytes(r["at"]), bytes(r["n"])) for r in texts.mapInArrow(sparse, "vote double, at binary, n binary").collect())
    counts = np.zeros((len(rows), TERMS), np.float32)
    for x, (_, at, n) in zip(counts, rows):
        x[np.frombuffer(at, "<u2")] = np.frombuffer(n, "<f4")
    return LatentVoter(counts, np.array([r[0] for r in rows]), dims, neighbours, power)


def score(docs: DataFrame, model: LatentVoter, threshold: float = 0.3, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row with ``score`` (0..1) and ``predicted`` (1 if score >= threshold).

    A map over rows with the broadcast model; cosines are computed for 256 documents at a time against all labelled
    vectors. Null counts as the empty text, which votes like any other; repeated rows and
    null ids are scored like others, each by its own text; without any label every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        voter = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = voter.scores(np.array([terms(t) for t in part.column(0).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found), pa.array((found >= threshold).astype(np.int32))], [*[f"c{i}" for i in range(part.num_columns - 1)], "score", "predicted"])

    kept = docs.select(*[F.col(c) for c in keep])
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema)], "score double, predicted int"])
    rows = docs.select(F.col(text_col).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    return rows.mapInArrow(scored, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "score", "predicted")
