"""Subword lattice language model: the pieces of an existing vocabulary weight all segmentations of a word.

A text is its words, A-Z lowered, each with a word start before it, then one end. All ways to write a word
in pieces (single bytes among them, so every word has one) are the paths of a lattice over its bytes; their
probabilities are summed by a forward recursion in log space. The lattice of a word that occurs in training
has one path more: the word itself. That path has the discounted share of the word among the training
tokens, and what the discount takes from all words is what the other paths share, so that the probabilities
of all words and the end sum to one. A text's probability is the product over its words and the end, so
each different word is worked out once.

Weights of the pieces begin as the vocabulary's own scores: log probabilities as they stand, or, where
scores are merge ranks, one over the rank. They are then learnt from all different training words by expected
counts (forward-backward over the same lattice), starting from these weights and smoothed with them.

Words are counted where the texts are: a block of texts travels as its different words, each with the rows
and numbers of its occurrences, so a word's count and probability meet its occurrences in one join, and the
block's sums are taken where the block meets again. Every row gives one result row: null and empty texts
have only the end, equal rows equal results, null ids are learnt from and not held out. Without any
training text the pieces alone and the vocabulary's weights hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.llm.common import slices, utf8
from repoquarry.session import materialize, ship_package

ROUNDS = 2  # of expected counts
DISCOUNT = 0.75  # taken from each training word's count for the paths through pieces
PRIOR = 500.0  # pieces' worth of the vocabulary's weights in the learnt probabilities
_CELLS = 60_000  # byte positions of words taken together
_ROWS, _BYTES = 50_000, 16 << 20  # texts of a block, and their bytes, at most
_HEAD = np.dtype([("id", "<i8"), ("known", "u1"), ("held", "u1"), ("words", "<i8")])
_BLOCK = "block bigint, word binary, trained bigint, rows binary, times binary"


@lru_cache(maxsize=64)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_SPREAD = np.uint64(0xD1B54A32D192ED03)


@dataclass
class Pieces:
    """Byte strings (a blank is the word start), bytes' and end's places, and log probabilities of all."""

    strings: list[bytes]
    byte: np.ndarray  # place of each byte's piece
    end: int
    weight: np.ndarray


def read_pieces(path: str) -> Pieces:
    """The pieces of a sentencepiece model with byte pieces. Pieces of unused kinds take no part."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    strings, score = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            raw = piece.replace("▁", " ").encode()
            if b" " not in raw[1:]:  # a word has its start once
                strings.append(raw)
                score.append(model.get_score(i))
    score = np.array(score)
    ranks = len(score) > 0 and (score == np.round(score)).all()
    log = -np.log(2.0 - np.clip(score, -1e9, 0)) if ranks else score
    # bytes and the end weigh as the lightest piece does
    rest = np.full(257, log[log > -15].min() if len(log) else 0.0)
    log = np.concatenate([log, rest])
    log -= np.log(np.exp(log - log.max()).sum()) + log.max()
    n = len(strings)
    return Pieces(strings, np.arange(n, n + 256), n + 256, log)


class Lattice:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        lengths = np.array([len(s) for s in pieces.strings], np.int64)
        self._by_length = {}
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            data = np.frombuffer(b"".join(pieces.strings[i] for i in at.tolist()), np.uint8).reshape(len(at), n)
            hashes = self._sums(data)[:, n] * _SPREAD
            order = np.argsort(hashes)
            hashes, at = hashes[order], at[order].astype(np.int32)
            # a table of four times the size by the top bits says where to begin to look
            bits = max(4, int(len(at)).bit_length() + 2)
            first = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
            deepest = int(np.diff(first).max())
            self._by_length[n] = np.append(hashes, np.zeros(deepest + 1, np.uint64)), np.append(at, np.full(deepest + 1, -1, np.int32)), first, np.uint64(64 - bits), deepest

    @staticmethod
    def _sums(data: np.ndarray) -> np.ndarray:
        """(rows, width + 1): running sums from each row's start, comparable from the same start only."""
        rows, width = data.shape
        out = np.zeros((rows, width + 1), np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, width), axis=1, out=out[:, 1:])
        return out

    def _find(self, n: int, hashes: np.ndarray) -> np.ndarray:
        """Place of the piece of n bytes with this hash, or -1."""
        known, place, first, shift, deepest = self._by_length[n]
        top = (hashes >> shift).astype(np.int64)
        at, end = first[top], first[top + 1]
        found = np.full(hashes.shape, -1, np.int32)
        for _ in range(deepest):
            hit = np.flatnonzero((at < end) & (known[at] == hashes))
            found[hit] = place[at[hit]]
            at = at + 1
        return found

    def _blocks(self, words: list[bytes]):
        """Places of words of like length, and their padded bytes."""
        size = np.array([len(w) + 1 for w in words], np.int64)
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            stop = at + 1
            step = 1 << 14
            while step:
                if stop + step <= len(order) and (stop + step - at) * int(size[order[stop + step - 1]]) <= _CELLS:
                    stop += step
                step >>= 1
            part = order[at:stop]
            at = stop
            width = int(size[part[-1]])
            raw = b"".join((b" " + words[i]).ljust(width, b"\0") for i in part.tolist())
            yield part, size[part], np.frombuffer(raw, np.uint8).reshape(len(part), width)

    def _edges(self, data: np.ndarray) -> dict[int, np.ndarray]:
        """For each piece length: place of the piece that starts at each position, or -1."""
        rows, width = data.shape
        sums, out = self._sums(data), {}
        for n in self._by_length:
            if n <= width:
                starts = width - n + 1
                hashes = (sums[:, n:] - sums[:, :starts]) * (_powers(_UNDO, starts) * _SPREAD)
                out[n] = self._find(n, hashes.reshape(-1)).reshape(rows, starts)
        return out

    def _forward(self, size, data, edges, weight):
        rows, width = data.shape
        padded = np.append(weight, -np.inf)  # place -1
        alpha = np.full((rows, width + 1), -np.inf)
        alpha[:, 0] = 0
        byte = weight[self.pieces.byte]
        for j in range(1, width + 1):
            top = int(np.searchsorted(size, j))
            terms = [alpha[top:, j - 1] + byte[data[top:, j - 1]]]
            for n, ids in edges.items():
                if n <= j:
                    terms.append(alpha[top:, j - n] + padded[ids[top:, j - n]])
            terms = np.stack(terms)
            most = terms.max(0)
            alpha[top:, j] = most + np.log(np.exp(terms - most).sum(0))
        return alpha

    def log_probability(self, words: list[bytes], weight: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        weight = self.pieces.weight if weight is None else weight
        out = np.zeros(len(words))
        for part, size, data in self._blocks(words):
            alpha = self._forward(size, data, self._edges(data), weight)
            out[part] = alpha[np.arange(len(part)), size]
        return out

    def expected_counts(self, words: list[bytes], times: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used in the words, over all segmentations."""
        out = np.zeros(len(weight))
        padded = np.append(weight, -np.inf)
        byte = weight[self.pieces.byte]
        for part, size, data in self._blocks(words):
            edges = self._edges(data)
            alpha = self._forward(size, data, edges, weight)
            rows, width = data.shape
            beta = np.full((rows, width + 1), -np.inf)
            beta[np.arange(rows), size] = 0
            total, often = alpha[np.arange(rows), size], times[part]
            for j in range(width - 1, -1, -1):
                top = int(np.searchsorted(size, j + 1))
                ends, places, lots = [], [], []
                places.append(self.pieces.byte[data[top:, j]])
                lots.append(byte[data[top:, j]])
                ends.append(beta[top:, j + 1])
                for n, ids in edges.items():
                    if j + n <= width:
                        places.append(ids[top:, j])
                        lots.append(padded[ids[top:, j]])
                        ends.append(beta[top:, j + n])
                terms = np.stack(lots) + np.stack(ends)
                most = terms.max(0)
                beta[top:, j] = most + np.log(np.exp(terms - most).sum(0))
                share = np.exp(terms + (alpha[top:, j] - total[top:])) * often[top:]
                place = np.stack(places)
                used = place >= 0
                out += np.bincount(place[used], share[used], minlength=len(out))
        return out


def word_blocks(docs: DataFrame, doc_id: str, text: str, held: str) -> DataFrame:
    """Rows of _BLOCK: each block's different words with their occurrences, and a head without a word."""
    ship_package(docs.sparkSession)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for piece in slices(whole, text, _BYTES):
                for at in range(0, piece.num_rows, _ROWS):
                    number += 1
                    yield _block(piece.slice(at, _ROWS), doc_id, text, held, number)

    return docs.select(doc_id, text, held).mapInArrow(run, _BLOCK)


def _block(batch: pa.RecordBatch, doc_id: str, text: str, held: str, number: int) -> pa.RecordBatch:
    data, at = utf8(batch.column(text))
    raw = data.tobytes().lower()
    index: dict[bytes, int] = {}
    ids, sizes = [], np.zeros(batch.num_rows, np.int64)
    for i, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist(), strict=False)):
        words = raw[a:b].split()
        sizes[i] = len(words)
        ids += [index.setdefault(w, len(index)) for w in words]
    head = np.zeros(batch.num_rows, _HEAD)
    id_column = batch.column(doc_id).cast(pa.int64())
    head["id"], head["known"] = np.asarray(id_column.fill_null(0)), np.asarray(id_column.is_valid())
    head["held"], head["words"] = np.asarray(batch.column(held)), sizes
    rows = np.repeat(np.arange(batch.num_rows, dtype=np.int64), sizes)
    pair, times = np.unique(np.array(ids, np.int64) * batch.num_rows + rows, return_counts=True)
    word, row = np.divmod(pair, batch.num_rows)
    trained = np.bincount(word, times * (head["held"][row] == 0), minlength=len(index)).astype(np.int64)
    first = np.searchsorted(word, np.arange(len(index) + 1))
    words = [*index, None]

    def lists(values: np.ndarray, kind: str, last: bytes) -> pa.Array:
        body = values.astype(kind)
        offsets = np.append(first * body.itemsize, len(body) * body.itemsize + len(last)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(body.tobytes() + last)])

    columns = [
        pa.array(np.full(len(words), number)),
        pa.array(words, pa.binary()),
        pa.array(np.append(trained, 0)),
        lists(row, "<u2", head.tobytes()),
        lists(times, "<u4", b""),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "word", "trained", "rows", "times"])


def learn(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces from the training words in (word, trained): one pass over the different
    words in tasks for each round; a task sends one number for each piece it met."""
    weight, prior = pieces.weight, np.exp(pieces.weight)
    trained = words.where("trained > 0").select("word")

    for _ in range(rounds):

        def expect(batches, weight=weight):
            lattice, total = Lattice(pieces), np.zeros(len(weight))
            for batch in batches:
                total += lattice.expected_counts(batch.column("word").to_pylist(), np.ones(batch.num_rows), weight)
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["piece", "amount"])

        amount = PRIOR * prior
        summed = trained.mapInArrow(expect, "piece bigint, amount double").groupBy("piece").agg(F.sum("amount").alias("amount"))
        for piece, n in summed.collect():
            amount[piece] += n
        weight = np.log(amount / amount.sum())
    return weight


def score_texts(docs: DataFrame, model: str, held: str, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    held: a boolean column, true for rows that nothing is learnt from. model: path of the vocabulary.
    """
    spark = docs.sparkSession
    pieces = read_pieces(model)
    # read twice: blocks take more room than a second cutting takes time
    blocks = word_blocks(docs, doc_id, text, held)
    words = blocks.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("trained").alias("trained"))
    words, _ = materialize(words, "words")
    n, v = words.where("trained > 0").agg(F.coalesce(F.sum("trained"), F.lit(0)), F.count("*")).first()
    ends = docs.where(~F.col(held)).count()
    n, v = n + ends, v + (ends > 0)
    weight = learn(words, pieces, rounds)
    scale = n + 0.5 * (v + 1)
    if n:
        begins = np.exp(weight[[i for i, p in enumerate(pieces.strings) if p[:1] == b" "] + [int(pieces.byte[32])]]).sum()
        # all ways to write all words through pieces sum to begins / (begins + end)
        spare = np.log(DISCOUNT * (v - (ends > 0)) / n) if v > (ends > 0) else -np.inf
        through = spare + np.log((begins + np.exp(weight[pieces.end])) / begins)
        end_score = np.log10(ends / n) if ends else -np.inf
    else:
        through, end_score = 0.0, weight[pieces.end] / np.log(10)

    def weigh(batches):
        lattice = Lattice(pieces)
        for batch in batches:
            own = lattice.log_probability(batch.column("word").to_pylist(), weight) + through
            count = np.asarray(batch.column("trained"))
            seen = count > 0
            own[seen] = np.logaddexp(own[seen], np.log((count[seen] - DISCOUNT) / n))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("trained"), pa.array(own / np.log(10))], ["spelling", "count", "own"])

    weighed = words.mapInArrow(weigh, "spelling binary, count bigint, own double")
    # heads have keys of their own, which no word equals: words hold no blank
    key = F.coalesce("word", F.concat(F.lit(" "), F.col("block").cast("string")).cast("binary"))
    met = blocks.withColumn("key", key).join(weighed, F.col("key") == F.col("spelling"), "left")
    is_head = F.col("word").isNull()
    count, own = F.when(is_head, F.lit(-1)).otherwise(F.col("count")), F.when(is_head, F.lit(0.0)).otherwise(F.col("own"))
    met = met.select("block", count.cast("bigint").alias("count"), own.alias("own"), "rows", "times")
    schema = f"{doc_id} bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    of_end = float(np.log10((ends + 0.5) / scale))

    def sums(batches):
        head, block = None, None
        base = score = known = None

        def result():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(head["id"], mask=head["known"] == 0),
                    pa.array(head["held"] == 1),
                    pa.array(head["words"] + 1),
                    pa.array(known + (ends > 0)),
                    pa.array(np.full(len(head), n, np.int64)),
                    pa.array(base + of_end),
                    pa.array(score + end_score),
                ],
                [doc_id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

        for batch in batches:
            number, count = np.asarray(batch.column("block")), np.asarray(batch.column("count"))
            own = np.asarray(batch.column("own"))
            cuts = np.flatnonzero(np.diff(number)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)], strict=True):
                if a == b:
                    continue
                if number[a] != block:
                    if head is not None:
                        yield result()
                    head, block = np.frombuffer(batch.column("rows")[a].as_py(), _HEAD), number[a]
                    base, score, known = np.zeros(len(head)), np.zeros(len(head)), np.zeros(len(head), np.int64)
                    a += 1
                rows = batch.column("rows").slice(a, b - a).to_pylist()
                times = np.frombuffer(b"".join(batch.column("times").slice(a, b - a).to_pylist()), "<u4")
                at = np.frombuffer(b"".join(rows), "<u2")
                each = np.fromiter(map(len, rows), np.int64, len(rows)) // 2
                base += np.bincount(at, times * np.repeat(np.log10((count[a:b] + 0.5) / scale), each), minlength=len(head))
                score += np.bincount(at, times * np.repeat(own[a:b], each), minlength=len(head))
                known += np.bincount(at, times * np.repeat(count[a:b] > 0, each), minlength=len(head)).astype(np.int64)
        if head is not None:
            yield result()

    ordered = met.repartition("block").sortWithinPartitions("block", "count")
    return ordered.mapInArrow(sums, schema)
