"""Fill-in-middle: a text is cut at two unit boundaries and written in an order that leaves the middle for last.

Units are runs of ASCII letters and all other code points one by one. The boundaries of a text (0 and the end
of each unit, in code points) are kept as a Roaring-style set: one container for each 65,536 code points, an
array, a bitmap or a list of runs, whichever is smallest, and the cardinalities added up over containers. The
k-th boundary is found by a search in these sums and a select inside one container, so a text of any length is
read once, in blocks, and never listed unit by unit.

Where the cuts lie and how a text is written follows from its id alone. Null is the empty text; an empty text,
and one that holds a marker, stays plain. A null id counts as the empty one. Repeated rows, and texts with equal
ids, are treated each for itself. Tables without rows give no rows. New columns replace input columns of their
names, all others pass through.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repoquarry.llm.common import utf8
from repoquarry.session import ship_package

# Marks before prefix, suffix and middle; share of texts left plain, and of the others with the suffix first, in percent.
MARKERS = ("<P>", "<S>", "<M>")
PLAIN, SUFFIX_FIRST = 10, 20

_BITMAP_BYTES = 8192
_BLOCK = 1 << 16


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.below = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.below, k, side="right"))
        inside = k - (int(self.below[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[inside])


class RunContainer:
    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low.astype(np.int32), prepend=-2) != 1)
        self.start = low[first]
        self.below = first  # members before each run

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.below, k, side="right")) - 1
        return int(self.start[run]) + k - int(self.below[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three kinds for sorted 16-bit members."""
    runs = 1 + int(np.count_nonzero(np.diff(low.astype(np.int32)) != 1))
    sizes = {ArrayContainer: 2 * len(low), RunContainer: 4 * runs, BitmapContainer: _BITMAP_BYTES}
    return min(sizes, key=sizes.get)(low)


class BoundarySet:
    """A growing sorted set of code point offsets with select."""

    def __init__(self):
        self.keys: list[int] = []
        self.containers: list = []
        self.below = [0]  # members before each container, and of all
        self._key, self._open = 0, [np.zeros(1, np.uint16)]  # offset 0 is a boundary of every text

    def extend(self, offsets: np.ndarray) -> None:
        """Add offsets larger than all before."""
        for key in range(self._key, (int(offsets[-1]) >> 16) + 1 if len(offsets) else 0):
            if key != self._key:
                self._close()
                self._key = key
            a, b = np.searchsorted(offsets, [key << 16, (key + 1) << 16])
            self._open.append((offsets[a:b] & 0xFFFF).astype(np.uint16))

    def _close(self) -> None:
        low = np.concatenate(self._open) if self._open else np.zeros(0, np.uint16)
        if len(low):
            self.keys.append(self._key)
            self.containers.append(container(low))
            self.below.append(self.below[-1] + len(low))
        self._open = []

    def closed(self) -> BoundarySet:
        self._close()
        return self

    def __len__(self) -> int:
        return self.below[-1]

    def select(self, k: int) -> int:
        """The k-th smallest member, from 0."""
        at = int(np.searchsorted(self.below, k, side="right")) - 1
        return (self.keys[at] << 16) + self.containers[at].select(k - self.below[at])


def boundaries(text: np.ndarray) -> BoundarySet:
    """Boundaries of the units of a text given as UTF-8 bytes."""
    found, points = BoundarySet(), 0
    for a in range(0, len(text), _BLOCK):
        part = text[a : a + _BLOCK + 1]
        starts = (part & 0xC0) != 0x80
        letter = ((part | 0x20) - np.uint8(97)) < 26
        here = min(_BLOCK, len(text) - a)
        after_start, after_letter = starts[1:], letter[1:]
        if len(part) == here:  # the text ends here
            after_start, after_letter = np.append(after_start, True), np.append(after_letter, False)
        count = points + np.cumsum(starts[:here], dtype=np.int64)
        found.extend(count[after_start & ~(letter[:here] & after_letter)])
        points = int(count[-1])
    return found.closed()


def cut_places(text: np.ndarray, one: int, two: int) -> tuple[int, int, int]:
    """(units, code points of the prefix, code points of prefix and middle)."""
    found = boundaries(text)
    first, second = sorted((one % len(found), two % len(found)))
    return len(found) - 1, found.select(first), found.select(second)


_CUT = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "second")])


@F.arrow_udf(_CUT)
def _cut(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    data, at = utf8(texts)
    rows = [
        cut_places(data[a:b], x, y)
        for a, b, x, y in zip(at[:-1].tolist(), at[1:].tolist(), one.to_pylist(), two.to_pylist(), strict=True)
    ]
    columns = np.array(rows, np.int64).reshape(-1, 3)
    return pa.StructArray.from_arrays([pa.array(c) for c in columns.T], _CUT.names)


def _check(markers: Sequence[str]) -> None:
    """Markers must be found again beside any text that holds none: no end of one may begin another."""
    for a, b in product(markers, repeat=2):
        if not a or (a is not b and a in b) or any(b.startswith(a[i:]) for i in range(1, len(a))):
            raise ValueError(f"markers {a!r} and {b!r} cannot be told apart")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salt: str = "1:",
    plain: int = PLAIN,
    suffix_first: int = SUFFIX_FIRST,
    markers: Sequence[str] = MARKERS,
) -> DataFrame:
    """Documents with n_units, form (plain, psm, spm), prefix_chars, middle_chars and the output text."""
    _check(markers)
    ship_package(docs.sparkSession)
    prefix_mark, suffix_mark, middle_mark = map(F.lit, markers)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring("__fim_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = F.lit(False)
    for mark in (prefix_mark, suffix_mark, middle_mark):
        marked = marked | F.contains(F.col("__fim_text"), mark)
    stays = (F.col("__fim_text") == "") | marked | (drawn[2] % 100 >= 100 - plain)
    form = F.when(stays, "plain").when(drawn[3] % 100 < suffix_first, "spm").otherwise("psm")
    cut = docs.withColumns({"__fim_text": text, "__fim_digest": digest})
    cut = cut.withColumns({"__fim_form": form, "__fim": _cut(F.col("__fim_text"), drawn[0], drawn[1])})

    whole, first, second = F.col("__fim_text"), F.col("__fim.first"), F.col("__fim.second")
    prefix = F.substring(whole, F.lit(1), first)
    middle = F.substring(whole, first + 1, second - first)
    suffix = F.substring(whole, second + 1, F.length(whole))
    is_cut = F.col("__fim_form") != "plain"
    written = (
        F.when(F.col("__fim_form") == "psm", F.concat(prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle))
        .when(F.col("__fim_form") == "spm", F.concat(suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle))
        .otherwise(whole)
    )
    done = cut.withColumns(
        {
            "n_units": F.col("__fim.n"),
            "form": F.col("__fim_form"),
            "prefix_chars": F.when(is_cut, first),
            "middle_chars": F.when(is_cut, second - first),
            "output": written,
        }
    )
    return done.drop("__fim_text", "__fim_digest", "__fim_form", "__fim")


def restore(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text again, from output and form alone."""
    parts = F.split(output, "|".join(map(re.escape, markers)))
    prefix, suffix, middle = F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(suffix, middle, prefix))
        .otherwise(output)
    )
