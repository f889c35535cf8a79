"""Toxic passages by maximum-scoring segments.

Tokens are runs of letters. A token's log-odds are those of toxic against clean documents under a chain of Dirichlet
priors: the counts of its first 4 bytes refine the base rate, those of 5 to 8 bytes refine that, and the whole word's
counts come last, so rare and unseen words fall back on their beginnings. Scores near zero count as a constant drift
below zero; a linear-time scan then finds every maximal scoring segment of a document. Segment scores are calibrated by the
extreme-value law of clean documents' best segments (E = K n exp(-lambda s)), joined over a document's segments by the
sum statistic, and turned into a probability by a logistic on the training documents.

Counts come from a bounded sample of labelled documents. Rows: null and empty texts have no segment and get the
score of no evidence; a null id counts as empty text in the remainder; repeated rows get equal scores; without labelled
training rows every score is 0.5; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, pieces, remainder

FIT_ROWS = 20_000  #: labelled documents that the model is fitted on, at most: those whose ids hash lowest
SUPPORT = 3  #: documents of the sample that a feature must be in
STRENGTH = 4.0  #: weight of a prior, in documents
LEVELS = (4, 5, 6, 7, 8)  #: bytes of the beginnings
NEUTRAL = 1.0  #: log-odds between minus this and this count as the drift
DRIFT = 0.25

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _features(w: Words, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level: (which of the words numbered `at` have it, its hash); the last level is the whole word."""
    length = w.lengths()[at]
    out = []
    for i, size in enumerate(LEVELS):
        have = np.flatnonzero(length > size)
        out.append((have, w.prefixes(at[have], size) ^ np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
    out.append((np.arange(len(at)), w.hashes[at]))
    return out


def maximal_segments(x: list[float], steps: list[int] | None = None) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of the scores, in linear time; steps: gets the number of entries looked at.

    An entry of the stack keeps the place of the nearest entry below it whose total before is lower. A new segment follows
    these links only, and what it has passed over is never on the links of a later one."""
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, total before, total at its end, link
    total, looked = 0.0, 0
    for i, v in enumerate(x):
        before, total = total, total + v
        if v <= 0:
            continue
        first, low, j = i, before, len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
                looked += 1
            if j < 0 or stack[j][3] >= total:
                break
            first, low, link = stack[j][0], stack[j][2], stack[j][4]
            looked += len(stack) - j
            del stack[j:]
            j = link
        stack.append((first, i, low, total, j))
    if steps is not None:
        steps.append(looked)
    return [(a, b, high - low) for a, b, low, high, _ in stack]


class Model:
    """Fitted log-odds and calibration; small enough to travel with tasks (bounded by the sample)."""

    def __init__(self, hashes: np.ndarray, toxic: np.ndarray, clean: np.ndarray, rate: float):
        order = np.argsort(hashes)
        self.hashes, self.toxic, self.clean, self.rate = hashes[order], toxic[order].astype(np.float32), clean[order].astype(np.float32), rate
        self.lam, self.k, self.a, self.b = 1.0, 1.0, np.array([1.0, 0.0]), 0.0

    def log_odds(self, w: Words) -> np.ndarray:
        """Of every token."""
        distinct, first, local = np.unique(w.hashes, return_index=True, return_inverse=True)
        p = np.full(len(first), self.rate)
        for have, h in _features(w, first):
            if len(self.hashes):
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                hit = self.hashes[at] == h
                t, c = self.toxic[at[hit]], self.clean[at[hit]]
                p[have[hit]] = (t + STRENGTH * p[have[hit]]) / (t + c + STRENGTH)
        return (np.log(p / (1 - p)) - math.log(self.rate / (1 - self.rate)))[local]

    def segments(self, texts: pa.Array) -> list[list[tuple[int, int, float]]]:
        """Per text: (first token, last token, score) of the segments."""
        w = Words(texts, _NOT_LETTER)
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(texts))]
        self.sizes = w.counts
        if not len(w.hashes):
            return out
        s = self.log_odds(w)
        x = np.where(np.abs(s) < NEUTRAL, -DRIFT, s - DRIFT)
        ends = np.cumsum(w.counts)
        again = np.concatenate(([False], w.hashes[1:] == w.hashes[:-1]))
        again[ends[ends < len(again)]] = False  # the first word of a text repeats none of the text before
        x[again] = -DRIFT  # a word said over and over is said once
        total = np.concatenate(([0.0], np.cumsum(x)))
        ups = np.flatnonzero(x > 0)
        doc = np.searchsorted(ends, ups, side="right")
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for part in np.split(ups, cuts):
            if len(part):
                d = int(np.searchsorted(ends, part[0], side="right"))
                base = int(ends[d] - w.counts[d])
                gaps = total[part[1:]] - total[part[:-1] + 1]  # what lies between two positive tokens
                seq = np.empty(2 * len(part) - 1)
                seq[::2], seq[1::2] = x[part], gaps
                out[d] = [(int(part[a // 2]) - base, int(part[b // 2]) - base, v) for a, b, v in maximal_segments(seq.tolist())]
        return out

    def evidence(self, scores: list[float], n: int) -> tuple[float, float]:
        """(best over r of -log P that the r best segments sum so high by chance, share of it by the best alone)."""
        space = math.log(max(self.k * max(n, 1), 1e-9))
        best, total, out = 0.0, 0.0, 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            total += self.lam * s - space
            if total <= 0:
                break
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            out = max(out, -log_p)
            if r == 1:
                best = total
        return out, best

    def significant(self, s: float, n: int) -> bool:
        return self.k * max(n, 1) * math.exp(-self.lam * s) < 0.05

    def calibrate(self, found: list[tuple[list[float], int]], labels: np.ndarray) -> None:
        """Extreme-value law from clean documents, then the logistic, by Newton steps."""
        clean = [(max(s, default=0.0), max(n, 1)) for (s, n), y in zip(found, labels) if not y]
        if clean:
            m, n = np.array([c[0] for c in clean]), np.array([c[1] for c in clean], np.float64)
            best = -np.inf
            for lam in np.linspace(0.2, 3, 57):
                k = len(m) / (n * np.exp(-lam * m)).sum()
                ll = (np.log(lam * k * n) - lam * m - k * n * np.exp(-lam * m)).sum()
                if ll > best:
                    best, self.lam, self.k = ll, float(lam), float(k)
        x = np.array([(*self.evidence(s, n), 1.0) for s, n in found])
        x[:, 0], x[:, 1] = np.log1p(x[:, 0]), np.log1p(x[:, 1])
        beta = np.zeros(3)
        for _ in range(40):
            q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            grad = x.T @ (labels - q) - 0.01 * beta
            hess = (x * (q * (1 - q) + 1e-9)[:, None]).T @ x + 0.01 * np.eye(3)
            beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
        self.a, self.b = beta[:2], float(beta[2])

    def probability(self, scores: list[float], n: int) -> float:
        t, b = self.evidence(scores, n)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.a[0] * math.log1p(t) + self.a[1] * math.log1p(b) + self.b))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", k: int = 3, held: int = 1, rows: int = FIT_ROWS) -> Model | None:
    """The model, from labelled documents whose remainder is not the held-out one; None without any of one kind."""
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), k) != held)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most `rows` ids; rows that share one are all counted, where they are
    sample = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold"))

    def count(batches):
        for batch in pieces(batches):
            w = Words(batch.column("text"), _NOT_LETTER)
            y = batch.column("label").to_numpy()
            _, first, local = np.unique(w.hashes, return_index=True, return_inverse=True)
            doc = np.repeat(np.arange(len(w.counts)), w.counts)
            hs, ds = [], []
            for have, h in _features(w, first) if len(first) else ():
                of = np.full(len(first), -1)
                of[have] = np.arange(len(have))
                each = of[local]
                keep = each >= 0
                values, code = np.unique(h, return_inverse=True)
                pairs = np.unique(code[each[keep]].astype(np.int64) * len(w.counts) + doc[keep])
                hs.append(values[pairs // len(w.counts)])
                ds.append(y[pairs % len(w.counts)])
            if hs:
                h, code = np.unique(np.concatenate(hs), return_inverse=True)
                t = np.bincount(code, weights=np.concatenate(ds), minlength=len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(t), pa.array(np.bincount(code, minlength=len(h)) - t)], names=["h", "t", "c"])

    def counted(rows_: DataFrame):
        found = rows_.drop("fold").mapInArrow(count, "h long, t long, c long").groupBy("h").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") + F.col("c") >= SUPPORT)
        return [x.to_numpy() for x in found.toArrow().columns]  # bounded by the sample

    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return None
    rate = sizes[1] / (sizes[0] + sizes[1])
    made = lambda rows_: Model(*(x.view(np.uint64) if i == 0 else x for i, x in enumerate(counted(rows_))), rate)
    # the calibration sees every document through counts that its own fold has no part in
    folds = [made(sample.where(F.col("fold") != f)) for f in (0, 1)]

    def scan(batches):
        for batch in pieces(batches):
            fold = batch.column("fold")[0].as_py()
            model = folds[fold]
            segments = model.segments(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(model.sizes.astype(np.int64)), pa.array([[s for _, _, s in x] for x in segments], pa.list_(pa.float64()))], names=["doc_id", "label", "n", "scores"])

    scanned = [sample.where(F.col("fold") == f).mapInArrow(scan, "doc_id long, label int, n long, scores array<double>") for f in (0, 1)]
    model = made(sample)
    rows_ = sorted(scanned[0].union(scanned[1]).collect(), key=lambda r: (r.doc_id, r.n, r.scores))
    model.calibrate([(r.scores, r.n) for r in rows_], np.array([r.label for r in rows_], np.float64))
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", k: int = 3, held: int = 1, least: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted, passages): passages are the significant segments, as letter-run numbers and score."""
    passages = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for batch in pieces(batches):
            if model is None:
                p, found = np.full(batch.num_rows, 0.5), [[] for _ in range(batch.num_rows)]
            else:
                segments = model.segments(batch.column("text"))
                sizes = model.sizes.tolist()
                p = np.array([model.probability([s for _, _, s in x], n) for x, n in zip(segments, sizes)])
                found = [[{"first": a, "last": b, "score": s} for a, b, s in x if model.significant(s, n)] for x, n in zip(segments, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(p), pa.array((p >= least).astype(np.int32)), pa.array(found, passages)], names=[id_col, "held_out", "score", "predicted", "passages"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), (remainder(F.col(id_col), k) == held).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} long, held_out boolean, score double, predicted int, passages array<struct<first:long,last:long,score:double>>")


def keep(docs: DataFrame, model: Model | None, text_col: str = "text", least: float = 0.7) -> DataFrame:
    """The rows, with all their columns, that are not predicted toxic; all of them without a model."""
    schema = docs.schema

    def run(batches):
        for batch in pieces(batches, column=text_col):
            segments = model.segments(batch.column(text_col))
            p = [model.probability([s for _, _, s in x], n) for x, n in zip(segments, model.sizes.tolist())]
            yield batch.filter(pa.array(np.array(p) < least))

    return docs if model is None else docs.mapInArrow(run, schema)


def op3_segments(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))
