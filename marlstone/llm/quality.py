"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its bytes and words, and those of its neighbours; a two-state chain (bad, good) with
learned transitions labels all lines at once. Training maximises the conditional likelihood of the lines' labels, by
full-batch gradient steps with forward-backward in numpy, on all lines of a bounded sample of labelled documents. Only
documents are labelled: a first chain takes their label for every line, a second one is trained on what the first finds
in each line. A document's score is the length-weighted mean of its lines' forward-backward marginals, calibrated by a
logistic on documents of the sample that the chain behind their means was not trained on.

Rows: null and empty texts are one empty line; a null id counts as empty text in the remainder; repeated rows get equal
scores; without labelled training rows every score is 0.5; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, pieces, remainder

FIT_ROWS = 3000  #: labelled documents that the model is fitted on, at most: those whose ids hash lowest
STEPS = 150
OWN = 14  #: features of a line by itself


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features, bytes of each line, lines of each text). A text has one line more than line feeds."""
    w = Words(texts)
    data, offsets = w.data, w.offsets
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    per = np.searchsorted(breaks, offsets)
    counts = np.diff(per) + 1
    # where lines begin: at each text's start and after each line feed, in order
    begin = np.empty(int(counts.sum()), np.int64)
    first = np.cumsum(counts) - counts
    rest = np.ones(len(begin), bool)
    rest[first] = False
    begin[first], begin[rest] = offsets[:-1], breaks + 1
    stop = np.empty_like(begin)
    stop[:-1], stop[-1:] = begin[1:] - 1, len(data)
    stop[first[1:] - 1] = offsets[1:-1]
    size = stop - begin
    kinds = _KIND[data]

    def share(bit: int) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum((kinds >> bit) & 1, dtype=np.int64)))
        return total[stop] - total[begin]

    letters, upper, digits, marks, stops, bars = (share(b) for b in range(6))
    at = np.searchsorted(w.starts, begin)
    till = np.searchsorted(w.starts, stop)
    words = till - at
    line_of = np.repeat(np.arange(len(begin)), words)
    same = np.zeros(len(w.hashes), bool)
    if len(same):
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (line_of[1:] == line_of[:-1])
    order = np.lexsort((w.hashes, line_of))
    h, line = w.hashes[order], line_of[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    distinct = np.bincount(line[fresh], minlength=len(begin))
    repeats = np.bincount(line_of[same], minlength=len(begin))
    many = np.maximum(words, 1)
    length = np.maximum(size, 1)
    mean = size / many
    own = np.stack([
        np.log1p(words) / 4, np.log1p(size) / 6, letters / length, upper / np.maximum(letters, 1), digits / length, marks / length, marks / many, stops / many, bars / many,
        distinct / many, repeats / many, np.minimum(mean, 30) / 10, (words == 0), (upper > 0.6 * letters) & (letters > 3),
    ], 1).astype(np.float64)
    both = np.zeros((len(begin), 2 * OWN + 3))
    both[:, :OWN] = own
    # neighbours within the text: mean of the line before and the line after
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    last = first + counts - 1
    before[first], after[last] = 0, 0
    near = np.full(len(begin), 2.0)
    near[first] -= 1
    near[last] -= 1
    both[:, OWN : 2 * OWN] = (before + after) / np.maximum(near, 1)[:, None]
    both[:, 2 * OWN] = 1
    both[first, 2 * OWN + 1] = 1
    both[last, 2 * OWN + 2] = 1
    return both, np.maximum(size, 1), counts


_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] |= 1
_KIND[65:91] |= 2
_KIND[48:58] |= 4
_KIND[[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) not in ".,'-"]] |= 8
_KIND[[ord("."), ord(",")]] |= 16
_KIND[[ord("|"), ord("<"), ord("{")]] |= 32


def forward_backward(scores: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of state 1 per line, expected moves (2 x 2) and the sum of log partition functions; scores: lines x 2."""
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")  # longest first: at step t the first live[t] chains go on
    first, length = first[order], counts[order]
    most = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(1, most + 1), side="right")
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    for t in range(most):
        at = first[: live[t]] + t
        alpha[at] = scores[at] if not t else scores[at] + np.logaddexp(alpha[at - 1, :1] + moves[0], alpha[at - 1, 1:] + moves[1])
    for t in range(most - 2, -1, -1):
        at = first[: live[t + 1]] + t
        up = scores[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(moves[:, 0] + up[:, :1], moves[:, 1] + up[:, 1:])
    z = np.logaddexp(*alpha[first + length - 1].T)
    of = np.empty(len(counts))
    of[order] = z
    z_line = np.repeat(of, counts)
    p = np.exp(np.clip(alpha[:, 1] + beta[:, 1] - z_line, -700, 0))
    inner = np.ones(len(scores), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    pair = np.exp(alpha[at - 1][:, :, None] + moves + (scores[at] + beta[at])[:, None, :] - z_line[at][:, None, None])
    return p, pair.sum(0), float(z.sum())


def chain(x: np.ndarray, counts: np.ndarray, lines: np.ndarray, line_weight: np.ndarray, steps: int) -> dict:
    """Weights of state 1 against state 0, moves, and scaling, that make the lines' labels likeliest."""
    mean, sd = x.mean(0), x.std(0)
    mean[2 * OWN], sd[sd < 1e-9] = 0, 1
    z = (x - mean) / sd
    inside = np.ones(len(lines), bool)
    inside[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (lines[at - 1].astype(int), lines[at].astype(int)), 1.0)
    params, m, v = np.zeros(x.shape[1] + 4), 0.0, 0.0
    for t in range(1, steps + 1):
        w, moves = params[:-4], params[-4:].reshape(2, 2)
        p, pairs, _ = forward_backward(np.stack((np.zeros(len(z)), z @ w), 1), moves, counts)
        grad = np.concatenate((z.T @ ((lines - p) * line_weight) - 1e-3 * w, ((seen - pairs) / max(len(lines), 1) - 1e-1 * moves).ravel()))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params = params + 0.08 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return {"mean": mean, "sd": sd, "w": params[:-4], "moves": params[-4:].reshape(2, 2)}


def line_labels(p: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels of lines from marginals of a first model: all lines of good documents are good; of bad ones, the lines that look
    good (0.5 or more) are good too, but those that look worst, up to half of the bytes, stay bad."""
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((p, doc))
    total = np.cumsum(size[order])
    before = total - size[order] - np.repeat((total - size[order])[first], counts)
    worst = np.zeros(len(p), bool)
    worst[order] = before < np.repeat(np.add.reduceat(size, first), counts) / 2
    return np.where(labels[doc] == 1, 1.0, ((p >= 0.5) & ~worst).astype(np.float64))


def fit_chain(x: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> dict:
    """A first model takes a document's label for all its lines; the second one takes what the first says of each line, and so learns how good and bad lines follow one another."""
    # rare labels count as much as frequent ones, documents as much as one another
    doc_weight = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    weight = np.repeat(doc_weight / counts, counts)
    model = chain(x, counts, np.repeat(labels, counts).astype(np.float64), weight, steps // 2)
    return chain(x, counts, line_labels(_marginals(model, x, counts), size, counts, labels), weight, steps)


def fit(x: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> dict:
    """The chain, and a logistic on the documents' means; size: bytes per line, labels per document.

    The logistic is fitted on means that come from a chain which has not seen the document: documents are cut in two
    halves in turn, each judged by the chain of the other."""
    model = fit_chain(x, size, counts, labels, steps)
    half = np.zeros(len(labels), np.int64)
    for y in (0, 1):
        own = np.flatnonzero(labels == y)
        half[own] = np.arange(len(own)) % 2
    raw = np.zeros(len(labels))
    for h in (0, 1):
        mine = half == h
        if len(set(labels[~mine].tolist())) == 2 and mine.any():
            lines = np.repeat(mine, counts)
            other = fit_chain(x[~lines], size[~lines], counts[~mine], labels[~mine], steps)
            raw[mine] = _raw(other, x[lines], size[lines], counts[mine])
        else:  # too few documents to keep some apart
            raw = _raw(model, x, size, counts)
            break
    # logistic calibration of the documents' means, by Newton steps
    a, b = 1.0, 0.0
    share = labels.mean()
    for _ in range(30):
        q = 1 / (1 + np.exp(-(a * raw + b)))
        g = np.array([((labels - q) * raw).sum() - 0.01 * a, (labels - q).sum()])
        h = q * (1 - q) + 1e-9
        hess = np.array([[(h * raw * raw).sum() + 0.01, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-6]])
        a, b = np.array([a, b]) + np.clip(np.linalg.solve(hess, g), -2, 2)
    return model | ({"a": float(a), "b": float(b)} if 0 < share < 1 else {"a": 0.0, "b": 9.0 if share else -9.0})


def _marginals(model: dict, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    scores = np.stack((np.zeros(len(x)), np.einsum("ij,j->i", x - model["mean"], model["w"] / model["sd"])), 1)
    return forward_backward(scores, model["moves"], counts)[0]


def _raw(model: dict, x: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: the logit of the length-weighted mean of marginals."""
    p = _marginals(model, x, counts)
    first = np.cumsum(counts) - counts
    mean = np.add.reduceat(p * size, first) / np.add.reduceat(size, first)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", k: int = 5, held: int = 0, rows: int = FIT_ROWS) -> dict | None:
    """The model, from labelled documents whose remainder is not the held-out one; None without any."""
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), k) != held)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # at most `rows` ids

    def run(batches):
        for batch in pieces(batches):
            x, size, counts = line_features(batch.column("text"))
            first = np.cumsum(counts) - counts
            both = [(x[a : a + c].astype(np.float32).tobytes(), size[a : a + c].astype(np.int64).tobytes()) for a, c in zip(first.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([b[0] for b in both], pa.binary()), pa.array([b[1] for b in both], pa.binary())], names=["doc_id", "label", "x", "size"])

    found = sample.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x binary, size binary").distinct()
    # and at most `rows` rows, however many rows share an id
    got = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("x", "size"), "x", "size").limit(rows).toArrow()
    if not got.num_rows:
        return None
    each = sorted(zip(*(got.column(c).to_pylist() for c in ("doc_id", "label", "x", "size"))))
    x = [np.frombuffer(e[2], np.float32).reshape(-1, 2 * OWN + 3) for e in each]
    size = np.concatenate([np.frombuffer(e[3], np.int64) for e in each])
    return fit(np.concatenate(x).astype(np.float64), size, np.array([len(v) for v in x]), np.array([e[1] for e in each]))


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", k: int = 5, held: int = 0, least: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted, n_lines) for every document."""

    def run(batches):
        for batch in pieces(batches):
            x, size, counts = line_features(batch.column("text"))
            if model is None:
                s = np.full(batch.num_rows, 0.5)
            else:
                s = 1 / (1 + np.exp(-(model["a"] * _raw(model, x, size, counts) + model["b"])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(s), pa.array((s >= least).astype(np.int32)), pa.array(counts.astype(np.int64))], names=[id_col, "held_out", "score", "predicted", "n_lines"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), (remainder(F.col(id_col), k) == held).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} long, held_out boolean, score double, predicted int, n_lines long")


def keep(docs: DataFrame, model: dict | None, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows, with all their columns, that are predicted good; all of them without a model."""
    schema = docs.schema

    def run(batches):
        for batch in pieces(batches, column=text_col):
            x, size, counts = line_features(batch.column(text_col))
            yield batch.filter(pa.array(1 / (1 + np.exp(-(model["a"] * _raw(model, x, size, counts) + model["b"]))) >= least))

    return docs if model is None else docs.mapInArrow(run, schema)


def op7_crf(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
