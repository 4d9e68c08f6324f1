"""Byte-level byte-pair encoding: training by counting jobs, encoding inside the rows.

While training, a symbol is one character. The 256 byte symbols are their printable characters; a
merged symbol gets the next character of a free range. A piece is then a plain string, a merge is a
string replacement, and the binary order of two-character strings is the order of symbol ids.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.functions import text as tx
from repoquarry.functions.arrays import open_array
from repoquarry.functions.paths import forward_slashes
from repoquarry.schemas import BPE_MERGES_SCHEMA, BPE_VOCAB_SCHEMA
from repoquarry.session import drop_table, materialize, spread

# Special tokens (ids 0-4), largest vocabulary and rarest pair that is merged.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
VOCABULARY_SIZE = 10_000
MIN_FREQUENCY = 2
UNKNOWN = "[UNK]"

_FIRST_MERGED = 0x1000
# What a training round asks for: so many candidate pairs, and sequences of so many symbols.
_SEQUENCES = 100_000  # most sequences fetched; fewer pairs or symbols give fewer
_FIRST_CANDIDATES, _MAX_CANDIDATES = 64, 4_096
_FIRST_LENGTH, _SHORTEST, _LONGEST = 16, 4, 64
_CACHED_PIECES = 500_000
_PIECES_AT_ONCE = 1 << 19  # encoded at once


@dataclass
class BpeModel:
    """Vocabulary (token -> id) and merges in rank order; both at most as long as the vocabulary cap."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    cache: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"vocab": self.vocab, "merges": self.merges}

    def __setstate__(self, state):
        self.__init__(**state)

    def __post_init__(self):
        self.tokens = sorted(self.vocab, key=self.vocab.get)
        self.ranks = {pair: rank for rank, pair in enumerate(self.merges)}
        self.unknown = self.vocab.get(UNKNOWN)

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one byte-level piece: always merge the pair of lowest rank, leftmost first."""
        symbols = [c if c in self.vocab else None for c in piece]
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        queue: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols):
                rank = self.ranks.get((symbols[i], symbols[j]))
                if rank is not None:
                    heapq.heappush(queue, (rank, i, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i)
        gone = set()
        while queue:
            _, i, left, right = heapq.heappop(queue)
            if i in gone or symbols[i] != left:
                continue
            j = after[i]
            if j >= len(symbols) or symbols[j] != right:
                continue
            symbols[i] = left + right
            gone.add(j)
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [
            self.unknown if s is None else self.vocab[s]
            for i, s in enumerate(symbols)
            if i not in gone and not (s is None and self.unknown is None)
        ]

    def ids_of(self, piece: str) -> np.ndarray:
        ids = self.cache.get(piece)
        if ids is None:
            if len(self.cache) >= _CACHED_PIECES:
                self.cache.clear()
            spelled = self.encode_piece(tx.to_byte_level(piece))
            ids = self.cache[piece] = np.array(spelled, dtype=np.int64)
        return ids

    def encode_batch(self, pieces: pa.ListArray) -> pa.ListArray:
        """Token arrays for arrays of pieces, some pieces at once; of these each different one is looked up once."""
        flat, known = pieces.flatten(), pa.array(self.tokens, pa.string())
        tokens, counts = [known.slice(0, 0)], [np.zeros(1, np.int64)]
        for a in range(0, len(flat), _PIECES_AT_ONCE):
            coded = flat.slice(a, _PIECES_AT_ONCE).dictionary_encode()
            encoded = [self.ids_of(p) for p in coded.dictionary.to_pylist()]
            lengths = np.array([len(e) for e in encoded], dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            every = np.concatenate(encoded)
            which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths[which])])
            positions = np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[which], lengths[which])
            tokens.append(known.take(pa.array(every[positions])))
            counts.append(lengths[which])
        sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        ends = np.cumsum(np.concatenate(counts))[bounds]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.concat_arrays(tokens))

    def to_frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        vocab = spark.createDataFrame(sorted(self.vocab.items(), key=lambda x: x[1]), BPE_VOCAB_SCHEMA)
        rows = [(rank, left, right) for rank, (left, right) in enumerate(self.merges)]
        return vocab, spark.createDataFrame(rows, BPE_MERGES_SCHEMA)

    @classmethod
    def from_frames(cls, vocab: DataFrame, merges: DataFrame) -> BpeModel:
        return cls(
            {r["token"]: r["id"] for r in vocab.collect()},
            [(r["left"], r["right"]) for r in merges.orderBy("rank").collect()],
        )


def first_merges(model: BpeModel, n: int) -> BpeModel:
    """The model as it was after its first ``n`` merges; the tokens of later ones are left out."""
    later = {left + right for left, right in model.merges[n:]} - {left + right for left, right in model.merges[:n]}
    return BpeModel({token: i for token, i in model.vocab.items() if token not in later}, model.merges[:n])


def save_model(model: BpeModel, spark: SparkSession, path: str) -> None:
    vocab, merges = model.to_frames(spark)
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")


def load_model(spark: SparkSession, path: str) -> BpeModel:
    return BpeModel.from_frames(
        spark.read.schema(BPE_VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(BPE_MERGES_SCHEMA).parquet(f"{path}/merges"),
    )


# --- pieces ---------------------------------------------------------------------------------------


def piece_counts(texts: DataFrame) -> DataFrame:
    """(piece, n) over all texts."""
    raw = open_array(texts, tx.text_pieces(F.col("text")), "piece")
    return raw.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


def byte_level_pieces(counted: DataFrame) -> DataFrame:
    """Counted pieces in byte-level characters; the mapping is one to one, so counts stay."""
    return counted.select(tx.byte_level(F.col("piece")).alias("piece"), "n")


# --- training -------------------------------------------------------------------------------------


def _symbol(number: int) -> str:
    """Character of the n-th merged symbol; the surrogate range holds no characters."""
    code = _FIRST_MERGED + number
    return chr(code if code < 0xD800 else code + 0x800)


def _merged(piece: str, merges: dict[str, tuple[int, str]]) -> str:
    """A piece after a list of merges (pair -> order, new symbol), each applied once, in order."""
    done = -1
    while len(piece) > 1:
        due = min(
            (merges[pair] for i in range(len(piece) - 1) if (pair := piece[i : i + 2]) in merges
             and merges[pair][0] > done),
            default=None,
        )
        if due is None:
            break
        done, new = due
        pair = next(p for i in range(len(piece) - 1) if merges.get(p := piece[i : i + 2]) == due)
        piece = piece.replace(pair, new)
    return piece


def _keys(pairs: Iterable[str]) -> np.ndarray:
    """Pairs of symbols as sorted numbers."""
    return np.unique(np.array([ord(a) << 21 | ord(b) for a, b in pairs], np.int64))


class _Flat:
    """Pieces one behind the other, and the neighbours inside them as numbers."""

    def __init__(self, pieces: list[str]):
        self.text = "".join(pieces)
        self.lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.ends = np.cumsum(self.lengths)
        symbols = np.frombuffer(self.text.encode("utf-32-le"), np.uint32).astype(np.int64)
        self.keys = symbols[:-1] << 21 | symbols[1:]
        last = self.ends[(self.ends > 0) & (self.ends < len(symbols))] - 1
        self.keys[last] = -1  # of two pieces

    def piece_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def runs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest stretches in which all neighbours are wanted (sorted keys)."""
        if not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hit = wanted[np.minimum(np.searchsorted(wanted, self.keys), len(wanted) - 1)] == self.keys
        change = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        return np.flatnonzero(change == 1), np.flatnonzero(change == -1) + 1


def _seams(merges: Sequence[tuple[str, str]]) -> set[str]:
    """The symbols, as they were before a list of merges, that can stand on both sides of a merged seam."""
    seams: set[str] = set()
    spelled: dict[str, set[tuple[str, str]]] = defaultdict(set)  # merged symbol -> its first and last symbol before
    for (a, b), new in merges:
        # a symbol that was there before may be made again
        for first_a, last_a in spelled[a] | {(a, a)}:
            for first_b, last_b in spelled[b] | {(b, b)}:
                seams.add(last_a + first_b)
                spelled[new].add((first_a, last_b))
    return seams


def _rewritten(pieces: list[str], table: dict[str, tuple[int, str]], seams: np.ndarray, known: dict[str, str]) -> list[str]:
    """Pieces after the merges of a table; what lies between two cuts is looked up in ``known`` first."""
    flat = _Flat(pieces)
    text, parts, at = flat.text, [], 0
    starts, ends = flat.runs(seams)
    shorter = np.zeros(len(starts), np.int64)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        new = known.get(run := text[a:b])
        if new is None:
            if len(known) >= _CACHED_PIECES:
                known.clear()
            new = known[run] = _merged(run, table)
        parts += (text[at:a], new)
        shorter[i], at = b - a - len(new), b
    parts.append(text[at:])
    text, lengths = "".join(parts), flat.lengths.copy()
    np.subtract.at(lengths, flat.piece_of(starts), shorter)
    cuts = np.concatenate([[0], np.cumsum(lengths)]).tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def apply_merges(pieces: DataFrame, merges: Sequence[tuple[str, str]]) -> DataFrame:
    """Rewrite counted pieces with the merges of one round; pieces of one symbol are done and leave.

    A piece is cut where no merge can reach over; what lies between the cuts is short, found in many pieces and
    rewritten once as long as a task remembers it.
    """
    table = {pair: (order, new) for order, (pair, new) in enumerate(merges)}
    seams = _keys(_seams(merges))

    @F.arrow_udf("string")
    def rewrite(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, str] = {}
        for column in batches:
            yield pa.array(_rewritten(column.to_pylist(), table, seams, known), pa.string())

    return pieces.select(rewrite(F.col("piece")).alias("piece"), "n").filter(F.length("piece") > 1)


def pair_counts(pieces: DataFrame) -> DataFrame:
    """(pair, n): neighbouring symbols, weighted by how often their piece occurs. Counts are partial before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _Flat(batch.column("piece").to_pylist())
            places = np.flatnonzero(flat.keys >= 0)
            found, which = np.unique(flat.keys[places], return_inverse=True)
            counts = np.zeros(len(found), np.int64)
            np.add.at(counts, which, batch.column("n").to_numpy(zero_copy_only=False)[flat.piece_of(places)])
            pairs = [chr(k >> 21) + chr(k & 0x1FFFFF) for k in found.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array(counts)], names=["pair", "n"])

    parts = pieces.where("piece IS NOT NULL").select("piece", "n").mapInArrow(count, "pair STRING, n BIGINT")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def _cut(piece: str, candidates: set[str]) -> list[str]:
    """Longest stretches of a piece in which all neighbours are candidate pairs."""
    runs, start = [], 0
    for i in range(1, len(piece) + 1):
        if i == len(piece) or piece[i - 1 : i + 1] not in candidates:
            if i - start > 1:
                runs.append(piece[start:i])
            start = i
    return runs


def _sequences(run: str, length: int) -> Iterator[tuple[str, int]]:
    """A run as sequences of at most ``length`` symbols and how often each counts.

    What adds up over neighbouring symbols is the same over the run and over these: a longer run counts by
    all its windows, less the symbols that two windows following one another share.
    """
    last = len(run) - length
    if last <= 0:
        yield run, 1
        return
    for i in range(last + 1):
        yield run[i : i + length], 1
    for i in range(1, last + 1):
        yield run[i : i + length - 1], -1


def sequence_counts(pieces: DataFrame, candidates: Sequence[str], length: int) -> DataFrame:
    """(sequence, n) of the runs made of candidate pairs only.

    There are no more sequences than walks of ``length`` symbols over the candidate pairs, however large
    the corpus is and however long its pieces are. Counts are partial before the shuffle.
    """
    wanted = _keys(candidates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _Flat(batch.column("piece").to_pylist())
            starts, ends = flat.runs(wanted)
            counts = batch.column("n").to_numpy(zero_copy_only=False)[flat.piece_of(starts)]
            runs: dict[str, int] = defaultdict(int)
            for a, b, n in zip(starts.tolist(), ends.tolist(), counts.tolist(), strict=True):
                runs[flat.text[a:b]] += n
            found: dict[str, int] = defaultdict(int)
            for run, n in runs.items():
                for sequence, sign in _sequences(run, length):
                    found[sequence] += sign * n
            columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["sequence", "n"])

    parts = pieces.select("piece", "n").mapInArrow(count, "sequence STRING, n BIGINT")
    return parts.groupBy("sequence").agg(F.sum("n").alias("n")).filter("n != 0")


class _Middles:
    """What is certain about the symbols that two windows of a cut run share.

    A boundary between two symbols depends on nothing but these two. So whatever stands beside a cut
    sequence, only the symbol at its edge can be merged with it; that one is no longer known, nor is a run of
    one symbol that is merged with itself, and the certain middle is what is left. As long as each middle has
    a symbol, windows agree on it, and adding them up is exact.
    """

    def __init__(self, sequences: Iterable[str], length: int):
        cut = {s[i : i + length - 1] for s in sequences if len(s) == length for i in (0, 1)}
        # middle, and the original symbol that stands before and after it (None outside of the sequence)
        self.rows: list[tuple[str, str | None, str | None]] = []
        self.first: dict[str, set[int]] = defaultdict(set)
        self.last: dict[str, set[int]] = defaultdict(set)
        self.holders: dict[str, set[int]] = defaultdict(set)
        self.ends: dict[str, tuple[str, str]] = {}  # merged symbol -> its first and last original symbol
        for number, sequence in enumerate(sorted(cut)):
            self.rows.append((sequence, None, None))
            self._list(number, sequence)

    def _list(self, number: int, middle: str) -> None:
        self.first[middle[0]].add(number)
        self.last[middle[-1]].add(number)
        for i in range(len(middle) - 1):
            self.holders[middle[i : i + 2]].add(number)

    def _after(self, number: int, pair: str) -> tuple[str, str | None, str | None]:
        """A row without the symbols that the pair makes uncertain."""
        (a, b), (middle, before, after) = pair, self.rows[number]
        first, last = (self.ends.get(c, (c, c)) for c in (b, a))
        if middle[:1] == b and before in (None, self.ends.get(a, (a, a))[1]):
            left = middle.lstrip(b) if a == b else middle[1:]
            middle, before = left, first[1]
        if middle[-1:] == a and after in (None, self.ends.get(b, (b, b))[0]):
            right = middle.rstrip(a) if a == b else middle[:-1]
            middle, after = right, last[0]
        return middle, before, after

    def merge(self, pair: str, new: str) -> bool:
        """Merge a pair; False, and nothing is changed, if a middle would be lost."""
        edge = self.first.get(pair[1], set()) | self.last.get(pair[0], set())
        changed = {number: self._after(number, pair) for number in edge}
        if not all(middle for middle, _, _ in changed.values()):
            return False
        for number in self.holders.pop(pair, set()):
            middle, before, after = changed.get(number) or self.rows[number]
            changed[number] = (middle.replace(pair, new), before, after)
        for number, row in changed.items():
            if row != self.rows[number]:
                self.rows[number] = row
                self._list(number, row[0])
        self.ends[new] = tuple(self.ends.get(c, (c, c))[i] for i, c in enumerate(pair))
        return True


class _RunTable:
    """Pair counts over counted sequences, kept up to date while pairs are merged."""

    def __init__(self, runs: Iterable[tuple[str, int]]):
        self.runs = []
        self.counts: dict[str, int] = defaultdict(int)
        self.holders: dict[str, set[int]] = defaultdict(set)
        for run, n in runs:
            self._count(len(self.runs), run, n)
            self.runs.append([run, n])
        self.queue = [(-n, pair) for pair, n in self.counts.items()]
        heapq.heapify(self.queue)

    def _count(self, number: int, run: str, n: int) -> set[str]:
        pairs = {run[i : i + 2] for i in range(len(run) - 1)}
        for i in range(len(run) - 1):
            self.counts[run[i : i + 2]] += n
        for pair in pairs:
            self.holders[pair].add(number)
        return pairs

    def best(self) -> tuple[int, str] | None:
        while self.queue:
            n, pair = self.queue[0]
            if self.counts.get(pair, 0) == -n and n < 0:
                return -n, pair
            heapq.heappop(self.queue)
        return None

    def merge(self, pair: str, new: str) -> None:
        touched = set()
        for number in self.holders.pop(pair, ()):
            run, n = self.runs[number]
            if pair not in run:
                continue
            for i in range(len(run) - 1):
                self.counts[run[i : i + 2]] -= n
                touched.add(run[i : i + 2])
            shorter = run.replace(pair, new)
            self.runs[number][0] = shorter
            touched |= self._count(number, shorter, n)
        for other in touched:
            if self.counts[other] > 0:
                heapq.heappush(self.queue, (-self.counts[other], other))


def train(
    texts: DataFrame,
    vocabulary_size: int = VOCABULARY_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    special_tokens: Sequence[str] = SPECIAL_TOKENS,
) -> BpeModel:
    """Learn merges: always the most frequent neighbouring pair, equal counts by smaller ids.

    Spark keeps the counted pieces and does all counting over them. A round fetches the first pairs
    by (count, ids) and counted sequences of a fixed length made of those pairs only, whose number is bounded
    whatever the corpus. A pair that comes to exist by merging is never more frequent than the pair at its
    seam, so as long as the next merge ranks before the last pair fetched, the sequences hold every
    occurrence that matters and the merges are exactly those of one-by-one counting. The round ends
    there, where the next merge reaches beyond the length of the sequences (``_Middles``), or where a merge
    spells a token that exists already (its seam is not unique). The first pair's count is always known,
    so each round merges one pair at least.
    """
    spark = texts.sparkSession
    table, path = materialize(spread(byte_level_pieces(piece_counts(texts))), "pieces")
    # at most 256 rows: byte symbols
    used = [r[0] for r in table.select(F.explode(F.split("piece", ""))).distinct().collect()]
    alphabet = sorted(c for c in used if c)

    vocab = {token: i for i, token in enumerate(special_tokens)}
    spelled = {c: c for c in alphabet}  # symbol character -> token text
    symbol_of = {c: c for c in alphabet}  # token text -> symbol character
    for c in alphabet:
        vocab.setdefault(c, len(vocab))
    merges: list[tuple[str, str]] = []
    created = 0
    size = _RoundSize()
    table = table.filter(F.length("piece") > 1)

    while len(vocab) < vocabulary_size:
        fetched = (
            pair_counts(table)
            .filter(F.col("n") >= min_frequency)
            .orderBy(F.desc("n"), F.asc("pair"))
            .limit(size.candidates + 1)
            .collect()
        )
        if not fetched:
            break
        sequences, end = _fetch_sequences(table, fetched, size)
        simulated, middles = _RunTable(sequences), _Middles([s for s, _ in sequences], size.length)
        step: list[tuple[str, str]] = []
        cut_short = False
        while len(vocab) < vocabulary_size:
            best = simulated.best()
            if best is None or best[0] < min_frequency:
                break
            n, pair = best
            if end is not None and (-n, pair) >= end:
                break
            left, right = spelled[pair[0]], spelled[pair[1]]
            token = left + right
            repeated = token in symbol_of
            symbol = symbol_of[token] if repeated else _symbol(created)
            cut_short = not middles.merge(pair, symbol)
            if cut_short and step:
                break
            merges.append((left, right))
            if not repeated:
                symbol_of[token] = symbol
                spelled[symbol] = token
                vocab[token] = len(vocab)
                created += 1
            step.append((pair, symbol))
            if repeated or cut_short:
                break
            simulated.merge(pair, symbol)
        if not step:
            break
        old = path
        table, path = materialize(apply_merges(table, step), "pieces")
        drop_table(spark, old)
        size.grow(len(sequences), cut_short)
    drop_table(spark, path)
    return BpeModel(vocab, merges)


@dataclass
class _RoundSize:
    """How many pairs and symbols a round asks for. Only the number of rounds depends on it."""

    candidates: int = _FIRST_CANDIDATES
    length: int = _FIRST_LENGTH
    shrunk: bool = False

    def shrink(self, candidates: int) -> int:
        """After too many sequences: shorter ones, then fewer pairs. Returns the number of pairs."""
        self.shrunk = True
        if self.length > _SHORTEST:
            self.length = max(_SHORTEST, self.length // 2)
            return candidates
        self.candidates = max(1, candidates // 2)
        return self.candidates

    def grow(self, fetched: int, cut_short: bool) -> None:
        """What ended the round is asked for more of, where there is room."""
        if not self.shrunk and fetched * 8 < _SEQUENCES:
            if cut_short:
                self.length = min(_LONGEST, self.length * 2)
            else:
                self.candidates = min(_MAX_CANDIDATES, self.candidates * 2)
        self.shrunk = False


def _fetch_sequences(pieces: DataFrame, fetched: list, size: _RoundSize):
    """Counted sequences over the first pairs, and the rank key of the first pair left out (None if none is)."""
    known = min(size.candidates, len(fetched))
    while True:
        pairs = [r["pair"] for r in fetched[:known]]
        end = (-fetched[known]["n"], fetched[known]["pair"]) if known < len(fetched) else None
        rows = sequence_counts(pieces, pairs, size.length).limit(_SEQUENCES + 1).collect()
        if len(rows) <= _SEQUENCES:
            return [(r["sequence"], r["n"]) for r in rows], end
        if known == 1:
            # sequences of one pair: only a symbol repeated, told apart by its length; merge just that pair
            return [(pairs[0], fetched[0]["n"])], end
        known = min(known, size.shrink(known))


# --- encoding -------------------------------------------------------------------------------------


def with_tokens(df: DataFrame, model: BpeModel, text: str = "text", name: str = "tokens") -> DataFrame:
    """Add the subword tokens of a text column. Rows stay where they are: nothing is shuffled.

    Texts are cut into pieces by Spark. Each task encodes a piece once and remembers it; the model,
    no longer than the vocabulary cap, goes to every executor.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<string>")
    def encode(pieces: pa.Array) -> pa.Array:
        return shared.value.encode_batch(pieces)

    return df.withColumn(name, encode(tx.text_pieces(F.coalesce(F.col(text), F.lit("")))))


def with_path_tokens(df: DataFrame, model: BpeModel, path: str = "file_path", name: str = "tokens") -> DataFrame:
    return with_tokens(df.withColumn("_path", forward_slashes(F.col(path))), model, "_path", name).drop("_path")


def token_frequency(counted_pieces: DataFrame, model: BpeModel) -> DataFrame:
    """(token, frequency) over a corpus from its piece counts: every different piece is encoded once."""
    shared = counted_pieces.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<string>")
    def encode(pieces: pa.Array) -> pa.Array:
        return shared.value.encode_batch(pieces)

    rows = open_array(counted_pieces, encode(F.array("piece")), "token", ["n"])
    return rows.groupBy("token").agg(F.sum("n").alias("frequency"))
