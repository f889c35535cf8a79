"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(group | class, history) * P(word | class, group). A word's class and its group
within the class are digits of its 64-bit hash; the end of a text is a word of its own. The first two factors are
maximum-entropy models over hashed features: a bias, the previous word (n-gram) and the word before it (skip) for the
class; the class itself, and the class with either of the two words, for the group. Both are trained by
gradient updates: in every round, tasks send the gradients of the rows of weights that their share of the training texts
touches, summed by blocks of rows, and every training text is used in one round. The rows of the hashed tables double
with the training tokens, from 2 ** LEAST_BITS to 2 ** MOST_BITS; that bound is what a task holds (2 tables of 2 ** MOST_BITS
rows of CLASSES floats: 32 MB). The last factor tells apart the words that share a class and group, by their relative
frequency in all training texts, with a Good-Turing share for an unseen word, which is one outcome of its cell.

Words are met as 64-bit hashes. The words of all pieces of documents are sorted by hash; their counts are summed on the
way and go back to the pieces that hold them: no vocabulary is ever held in one place. Texts are scored in numpy batches, of which each looks
up only the weight rows of its own features.

Rows: null or empty texts have the end token alone; a null id counts as empty text in the remainder; repeated rows are
scored and counted as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_batches, mix64, pieces, remainder, written

DIGIT = 5  #: bits of the hash that make the class, and as many after them the group
CLASSES = 1 << DIGIT  #: and as many groups in a class
END = np.uint64(0x51A3C96D0E47B82F)  #: the hash of the end token
START = np.uint64(0x0D6B3F8E2C914A75)  #: what stands before the first word
LEAST_BITS, MOST_BITS = 11, 17
TOKENS_PER_ROW = 1 << 13
ROUNDS = 8  #: gradient updates; every training text takes part in one
RATE = 0.3  #: of a step
BLOCK = 256  #: weight rows whose gradients travel together
BATCH = 1 << 14  #: tokens scored at a time
PIECE = 4 << 20  #: bytes of text that share a local vocabulary
HASHED = 1 << 20  #: bytes of text that are hashed at a time


def _pack(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True) + len(raw).to_bytes(8, "little")


def _unpack(b: bytes, kind) -> np.ndarray:
    n = int.from_bytes(b[-8:], "little")
    return np.frombuffer(pa.decompress(b[:-8], decompressed_size=n, codec="zstd", asbytes=True) if n else b"", kind)


TOKENS = "piece long, ids binary, missing binary, train binary, counts binary, tokens binary, hashes binary"


def _tokenised(docs: DataFrame, id_col: str, text_col: str, held: int, k: int) -> DataFrame:
    """One row per piece of documents: their ids, words per document, the words as numbers in the piece's own list of hashes."""

    def run(batches):
        base, n = (TaskContext.get().partitionId() + 1) << 32, 0
        for batch in pieces(batches, PIECE):
            hashed, counts = [], []
            for part in pieces([batch], HASHED):
                w = Words(part.column("text"))
                hashed.append(w.hashes)
                counts.append(w.counts.astype(np.int32))
            hashes, local = np.unique(np.concatenate(hashed), return_inverse=True)
            ids = batch.column("id")
            row = {
                "piece": base + n, "ids": _pack(ids.fill_null(0).to_numpy()), "missing": _pack(ids.is_null().to_numpy(zero_copy_only=False)), "train": _pack(batch.column("train").to_numpy(zero_copy_only=False)),
                "counts": _pack(np.concatenate(counts)), "tokens": _pack(local.astype(np.int32)), "hashes": hashes.tobytes(),
            }
            n += 1
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("piece", pa.int64()), *((c, pa.binary()) for c in ("ids", "missing", "train", "counts", "tokens", "hashes"))])
    held_out = remainder(F.col(id_col), k) == held
    return written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (~held_out).alias("train")).mapInArrow(run, TOKENS), "tokens")


def _rows_of(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


ANSWERS = "piece long, ats binary, totals binary, cell int, n long, v long, ones long"
TOGETHER = 1 << 20  #: words whose counts are given out together


def _answers(tokens: DataFrame) -> DataFrame:
    """For the pieces: numbers of words (ats) with their counts in all training texts (totals). With piece null, parts of what each cell has: tokens, distinct words, words seen once. A written table.

    All pieces' words meet in the order of their hashes; what a task holds is TOGETHER of them, or one word's pieces."""

    def asked(batches):
        for r in _rows_of(batches):
            hashes = np.frombuffer(r["hashes"], np.int64)
            train = np.repeat(_unpack(r["train"], bool), _unpack(r["counts"], np.int32))
            n = np.bincount(_unpack(r["tokens"], np.int32)[train], minlength=len(hashes)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.full(len(hashes), r["piece"])), pa.array(np.arange(len(hashes), dtype=np.int32)), pa.array(n)], names=["hash", "piece", "at", "n"])

    def answered(batches):
        schema = pa.schema([("piece", pa.int64()), ("ats", pa.binary()), ("totals", pa.binary()), *((c, pa.int32() if c == "cell" else pa.int64()) for c in ("cell", "n", "v", "ones"))])
        each = np.zeros((3, CLASSES * CLASSES), np.int64)

        def given(rows):
            hashes, piece, at, n = rows
            starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            sums = np.add.reduceat(n.astype(np.int64), starts)
            cell = cells(hashes[starts].view(np.uint64))
            for k, x in enumerate((sums, sums > 0, sums == 1)):
                each[k] += np.bincount(cell, weights=x, minlength=each.shape[1]).astype(np.int64)
            total = np.repeat(sums, np.diff(np.append(starts, len(hashes))))
            order = np.argsort(piece, kind="stable")
            piece, at, total = piece[order], at[order], total[order]
            cuts = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1], [True]))).tolist()
            parts = list(zip(cuts, cuts[1:]))
            nulls = pa.nulls(len(parts), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(piece[cuts[:-1]]), pa.array([_pack(at[a:b]) for a, b in parts], pa.binary()), pa.array([_pack(total[a:b]) for a, b in parts], pa.binary()), nulls.cast(pa.int32()), nulls, nulls, nulls], schema=schema)

        waiting, size = [], 0
        for batch in batches:
            waiting.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size >= TOGETHER:
                rows = [np.concatenate(x) for x in zip(*waiting)]
                last = int(np.searchsorted(rows[0], rows[0][-1]))  # the last word may go on
                if last:
                    yield given([x[:last] for x in rows])
                waiting, size = [[x[last:] for x in rows]], size - last
        if size:
            yield given([np.concatenate(x) for x in zip(*waiting)])
        some = np.flatnonzero(each[1])
        nulls = pa.nulls(len(some), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), nulls, nulls, pa.array(some.astype(np.int32)), *(pa.array(x[some]) for x in each)], schema=schema)

    words = tokens.select("piece", "train", "counts", "tokens", "hashes").mapInArrow(asked, "hash long, piece long, at int, n int")
    return written(words.repartition("hash").sortWithinPartitions("hash").mapInArrow(answered, ANSWERS), "answers")


def cells(hashes: np.ndarray) -> np.ndarray:
    """Class * CLASSES + group."""
    return (hashes >> np.uint64(64 - 2 * DIGIT)).astype(np.int64)


def sequence(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, each text closed by END; the token before each, the one before that, and where texts end."""
    ends = np.cumsum(counts.astype(np.int64) + 1) - 1
    seq = np.full(int(ends[-1]) + 1 if len(ends) else 0, END)
    inner = np.ones(len(seq), bool)
    inner[ends] = False
    seq[inner] = hashes
    one, two = np.full(len(seq), START), np.full(len(seq), START)
    one[1:], two[2:] = seq[:-1], seq[:-2]
    begin = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    one[begin] = two[begin] = START
    two[begin[counts > 0] + 1] = START
    return seq, one, two, ends


def _row(kind: int, x: np.ndarray, least: int, rows: int) -> np.ndarray:
    return (least + mix64(x + np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(rows - least)).astype(np.int64)


def class_rows(one: np.ndarray, two: np.ndarray, rows: int) -> list[np.ndarray]:
    """Weight rows of the class features: bias, n-gram, skip."""
    with np.errstate(over="ignore"):
        return [np.zeros(len(one), np.int64), _row(1, one, 1, rows), _row(2, two, 1, rows)]


def group_rows(kinds: np.ndarray, one: np.ndarray, two: np.ndarray, rows: int) -> list[np.ndarray]:
    """Weight rows of the group features: class, class and n-gram, class and skip."""
    with np.errstate(over="ignore"):
        own = kinds.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return [kinds, _row(4, one + own, CLASSES, rows), _row(5, two + own, CLASSES, rows)]


def softmax(weights: np.ndarray, features: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log probability of each target, exponentials of all outcomes, their sums). Weights are steps of bounded number and size: no exponential overflows."""
    z = weights[features[-1]]
    for f in features[-2::-1]:
        z += weights[f] if f.any() else weights[0]
    own = z[np.arange(len(target)), target]
    e = np.exp(z, out=z)
    total = e.sum(1)  # no matrix product: its threads would spin beside one another
    return own - np.log(total), e, total


def add_rows(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """table[rows] += values, repeated rows included."""
    if len(rows):
        order = np.argsort(rows.astype(np.uint16) if len(table) <= 1 << 16 else rows, kind="stable")  # short keys sort by their digits
        rows = rows[order]
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        table[rows[starts]] += np.add.reduceat(values[order], starts, axis=0)


def _batches(seq, one, two, rows):
    """Per batch of tokens: its place, and (level, features, targets) of both factors."""
    for a in range(0, len(seq), BATCH):
        s = slice(a, a + BATCH)
        cell = cells(seq[s])
        kind, group = cell // CLASSES, cell % CLASSES
        yield s, ((0, class_rows(one[s], two[s], rows), kind), (1, group_rows(kind, one[s], two[s], rows), group))


def log_probability(weights: np.ndarray, seq: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Of class and group of every token; weights: 2 x rows x CLASSES."""
    out = np.zeros(len(seq))
    for s, levels in _batches(seq, one, two, weights.shape[1]):
        for level, features, target in levels:
            out[s] += softmax(weights[level], features, target)[0]
    return out


def gradient(weights: np.ndarray, seq: np.ndarray, one: np.ndarray, two: np.ndarray, more: np.ndarray, seen: np.ndarray) -> None:
    """Adds to seen (2 levels x rows x CLASSES) the observed outcomes of each weight row, and to more the observed minus the expected ones."""
    cells_seen: tuple[list, list] = ([], [])
    for _, levels in _batches(seq, one, two, weights.shape[1]):
        for level, features, target in levels:
            _, e, total = softmax(weights[level], features, target)
            e *= (-1 / total)[:, None]
            e[np.arange(len(target)), target] += 1
            for f in features:
                if f.any():
                    add_rows(more[level], f, e)
                else:
                    more[level, 0] += e.sum(0)
                cells_seen[level].append(f * CLASSES + target)
    for level, found in enumerate(cells_seen):
        if found:
            seen[level] += np.bincount(np.concatenate(found), minlength=seen[level].size).reshape(seen[level].shape)


def train(tokens: DataFrame, rows: int, n_cell: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (2 x rows x CLASSES). The biases begin at the relative frequencies of classes and groups, n_cell."""
    weights = np.zeros((2, rows, CLASSES), np.float32)
    share = lambda n: np.log((n + 0.5) / (n + 0.5).sum(-1, keepdims=True))
    weights[0, 0], weights[1, :CLASSES] = share(n_cell.reshape(CLASSES, -1).sum(1)), share(n_cell.reshape(CLASSES, -1))
    schema = "level int, block int, n binary, more binary, seen binary"
    width = min(BLOCK, rows)

    def update(w: np.ndarray, round_: int):
        def run(batches):
            more, seen = np.zeros((2, rows, CLASSES), np.float32), np.zeros((2, rows, CLASSES))
            for r in _rows_of(batches):
                counts = _unpack(r["counts"], np.int32).astype(np.int64)
                mine = _unpack(r["train"], bool) & ((np.arange(len(counts)) + r["piece"] % 1_000_003) % rounds == round_)
                if mine.any():
                    at = _unpack(r["tokens"], np.int32)[np.repeat(mine, counts)]
                    seq, one, two, _ = sequence(np.frombuffer(r["hashes"], np.uint64)[at], counts[mine])
                    gradient(w, seq, one, two, more, seen)
            for level in (0, 1):
                for b in range(0, rows, width):
                    s = slice(b, b + width)
                    if seen[level, s].any():
                        n = np.maximum(seen[level, s].sum(1), 1)  # tokens of each row; what goes with it are shares of them
                        shares = [_pack((x[level, s] / n[:, None]).astype(np.float16)) for x in (more, seen)]
                        yield pa.RecordBatch.from_pydict({"level": pa.array([level], pa.int32()), "block": pa.array([b], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in zip(("n", "more", "seen"), (_pack(n.astype(np.float32)), *shares))}})

        return run

    def total(t: pa.Table) -> pa.Table:
        sums = np.zeros((2, width, CLASSES))
        for n, *both in zip(*(t.column(c) for c in ("n", "more", "seen"))):
            n = _unpack(n.as_py(), np.float32)
            for k, x in enumerate(both):
                sums[k] += _unpack(x.as_py(), np.float16).reshape(width, -1) * n[:, None]
        return pa.table({"level": t.column("level")[:1], "block": t.column("block")[:1], "n": pa.nulls(1, pa.binary()), "more": pa.array([sums[0].astype(np.float32).tobytes()], pa.binary()), "seen": pa.array([sums[1].astype(np.float32).tobytes()], pa.binary())})

    pieces_ = tokens.select("piece", "train", "counts", "tokens", "hashes").coalesce(tokens.sparkSession.sparkContext.defaultParallelism)
    for k in range(rounds):
        sent = pieces_.mapInArrow(update(weights, k), schema).groupBy("level", "block").applyInArrow(total, schema)
        step = np.zeros_like(weights)
        for r in sent.toLocalIterator():  # a block of weight rows each
            more, seen = (np.frombuffer(r[c], np.float32).reshape(width, CLASSES) for c in ("more", "seen"))
            step[r["level"], r["block"] : r["block"] + width] = np.clip(more / (np.maximum(seen - more, 0) + 2.0), -1.5, 1.5)
        weights = weights + np.float32(RATE) * step
    return weights


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 10, held: int = 0) -> DataFrame:
    """Per document: doc id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams), score (this model), both log10."""
    with arrow_batches(docs.sparkSession, 2 * PIECE):
        tokens = _tokenised(docs, id_col, text_col, held, k)
        answers = _answers(tokens)
    each = answers.where("piece is null").groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("n", "v", "ones"))).collect()  # CLASSES ** 2 rows
    n_cell, v_cell, ones = np.zeros((3, CLASSES * CLASSES))
    for r in each:
        n_cell[r.cell], v_cell[r.cell], ones[r.cell] = r.n, r.v, r.ones
    ends = lambda batches: (pa.RecordBatch.from_pydict({"n": [int(_unpack(r["train"], bool).sum())]}) for r in _rows_of(batches))
    n_end = tokens.select("train").mapInArrow(ends, "n long").agg(F.sum("n")).first()[0] or 0
    n_all, v_all = int(n_cell.sum()) + n_end, int(v_cell.sum()) + (n_end > 0)
    floor = np.log10(n_all + 0.1 * (v_all + 1))
    end_cell = int(cells(np.array([END]))[0])
    n_cell[end_cell] += n_end
    unseen = (ones + 0.5) / (n_cell + 1.0)
    unseen[n_cell == 0] = 1.0
    bits = int(np.clip(np.ceil(np.log2(max(n_all, 1) / TOKENS_PER_ROW)), LEAST_BITS, MOST_BITS))
    with arrow_batches(docs.sparkSession, 2 * PIECE):
        weights = train(tokens, 1 << bits, n_cell)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        r = left.to_pylist()[0]
        hashes, sizes, at = np.frombuffer(r["hashes"], np.uint64), _unpack(r["counts"], np.int32).astype(np.int64), _unpack(r["tokens"], np.int32)
        count = np.zeros(len(hashes), np.int64)
        for ats, totals in zip(right.column("ats"), right.column("totals")):
            count[_unpack(ats.as_py(), np.int32)] = _unpack(totals.as_py(), np.int64)
        inside = lambda c, cell: np.log(np.where(c > 0, (1 - unseen[cell]) * c / np.maximum(n_cell[cell], 1), unseen[cell]))
        seq, one, two, ends = sequence(hashes[at], sizes)
        last = np.zeros(len(seq), bool)
        last[ends] = True
        score, base, known = log_probability(weights, seq, one, two), np.zeros(len(seq)), np.zeros(len(seq), np.int64)
        for where, c, cell in ((~last, count, cells(hashes)), (last, np.array([n_end]), np.array([end_cell]))):
            number = at if c is count else np.zeros(len(ends), np.int64)
            score[where] += inside(c, cell)[number]
            base[where] = (np.log10(c + 0.1) - floor)[number]
            known[where] = (c > 0)[number]
        begin = np.concatenate(([0], ends[:-1] + 1))
        return pa.table({
            id_col: pa.array(_unpack(r["ids"], np.int64), pa.int64(), mask=_unpack(r["missing"], bool)), "held_out": pa.array(~_unpack(r["train"], bool)), "n_tokens": pa.array(sizes + 1), "n_known": pa.array(np.add.reduceat(known, begin)),
            "train_tokens": pa.array(np.full(len(sizes), n_all)), "base_score": pa.array(np.add.reduceat(base, begin)), "score": pa.array(np.add.reduceat(score, begin) / np.log(10)),
        })

    schema = f"{id_col} long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return tokens.groupBy("piece").cogroup(answers.where("piece is not null").select("piece", "ats", "totals").groupBy("piece")).applyInArrow(run, schema)


def op6_maxent(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return score_corpus(table(spark, sf_dir, "documents"))
