import io
import math
import re
from pathlib import PurePosixPath

import numpy as np
import pytest
from pyspark.sql import functions as F

from repoquarry import schemas
from repoquarry.functions import dates, numbers, paths, text, vectors

ODD_TEXT = [
    "",
    "def f(a, b):\n  return a==b->c::d && x||y",
    "x::y 3.14 1.2.3 007 a_b9 é ñandú",
    "٥٦.٧ nbsp\xa0line sep\x85next\x1cfs\x1funit",
    "emoji 😀👍🏽 tab\tcr\rlf\n",
    " 　 wide   space ",
]


def test_extension_like_pathlib(column):
    names = [".gitignore", "a.tar.gz", "x.", "..a", "d/.env.py", "A/B.PY", "noext", "a.b/c", "dir.d/.x"]
    assert column(paths.extension, names) == [PurePosixPath(n).suffix.lower() for n in names]


def test_extension_label_and_language(column):
    assert column(paths.extension_label, ["a/README", "b.Py"]) == ["[no extension]", ".py"]
    assert column(paths.language, [".py", ".pxi", ".h", ".f90", ".md", ""]) == [
        "Python", "Cython", "C/C++", "Fortran", None, None,
    ]


def test_line_count_like_file_iteration(column):
    contents = ["", "a", "a\n", "a\nb", "\n", "a\r\nb\r\n", "a\rb", "\n\n", "a\n\n"]
    assert column(paths.line_count, contents) == [sum(1 for _ in io.BytesIO(c.encode())) for c in contents]


def test_folders(column):
    assert column(paths.parent_folders, ["a/b/c.py", "c.py"]) == [["a", "a/b"], []]
    assert column(paths.forward_slashes, ["a\\b\\c"]) == ["a/b/c"]


def test_repository_from_url(column):
    urls = [
        "https://github.com/o/name.git",
        " https://www.GitHub.com/o/name/ ",
        "https://github.com/alone",
        "https://example.org/o/name",
        "name",
        "https://github.com/o/sub/deep",
    ]
    assert column(paths.repository_from_url, urls) == ["name", "name", None, None, None, "deep"]


def test_strip_like_python(column):
    values = ["\t a b \n", "\x1c\x85x　", "\xa0", "", "plain", "a\n"]
    assert column(text.strip, values) == [v.strip() for v in values]
    assert column(text.is_blank, values) == [not v.strip() for v in values]


def test_numbers(column):
    values = ["3", " 3.7 ", "-2.5", "12d", "inf", "NaN", "1e3", "", None, "9007199254740993", ".5", "0x10"]
    assert [float(v) for v in column(numbers.number, values)[:3]] == [3.0, 3.7, -2.5]
    assert column(numbers.whole_not_negative, ["-0.5", "0", "2.9", "x"]) == [None, 0, 2, None]
    assert column(numbers.whole, values) == [3, 3, -2, None, None, None, 1000, None, None, 9007199254740993, 0, None]
    assert column(numbers.digits_only, ["12", "-", "", "-3", "1.0"]) == [12, None, None, None, None]


def test_month_in_own_offset(column):
    values = ["2024-01-31T23:30:00-05:00", "2024-02-01T00:30:00+09:00", "2024-13-01T00:00:00Z", "bad", "2024-02-30", "2020-02-29"]
    assert column(dates.local_month, values) == ["2024-01", "2024-02", None, None, None, "2020-02"]


def test_word_tokens_like_python_regex(column):
    pattern = re.compile(r"[A-Za-z_][A-Za-z0-9_]*|\d+(?:\.\d+)?|==|!=|<=|>=|->|=>|::|&&|\|\||[^\s]")
    assert column(text.word_tokens, ODD_TEXT) == [pattern.findall(t) for t in ODD_TEXT]


def test_characters_are_code_points(column):
    assert column(text.characters, ODD_TEXT) == [list(t) for t in ODD_TEXT]


def test_byte_level_spelling(column):
    assert column(text.byte_level, ODD_TEXT) == [text.to_byte_level(t) for t in ODD_TEXT]
    assert text.to_byte_level(" a") == "Ġa"


def test_character_overlap(spark):
    cases = [("connect", "Connected"), ("abc", "xyz"), ("", "a"), ("_", "__init__"), ("aB", "Bc")]
    df = spark.createDataFrame(cases, "a STRING, b STRING")
    got = [r[0] for r in df.select(text.character_overlap(F.col("a"), F.col("b"))).collect()]

    def overlap(a, b):
        x, y = set(a.lower()), set(b.lower())
        return len(x & y) / min(len(x), len(y)) if x and y else 0.0

    assert got == pytest.approx([overlap(a, b) for a, b in cases])


def test_display_token(column):
    assert column(text.display_token, ["a\n", "\r\t"]) == ["a\\n", "\\r\\t"]


def test_cosine_and_normalize(spark):
    rows = [([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    got = df.select(vectors.cosine(F.col("a"), F.col("b")), vectors.l2_normalize(F.col("a"))).collect()
    assert [r[0] for r in got] == pytest.approx([1.0, -1.0, 0.0])
    assert got[2][1] == [0.0, 0.0]
    assert math.hypot(*got[0][1]) == pytest.approx(1.0)


@pytest.mark.parametrize("size", [1, 5, 128])
def test_sinusoidal(spark, size):
    got = spark.range(1).select(vectors.sinusoidal(F.lit(0.37), size)).first()[0]
    want = np.zeros(size)
    for k in range(size // 2):
        angle = 0.37 / 10000 ** (2 * k / size)
        want[2 * k], want[2 * k + 1] = math.sin(angle), math.cos(angle)
    assert got == pytest.approx(want.tolist())


def test_column_checks(spark):
    df = spark.createDataFrame([("x", 1, None)], "word STRING, count INT, code STRING")
    assert schemas.token_frequency_columns(df).columns == ["token", "frequency"]
    assert df.select(schemas.text_column(df)).first()[0] == ""
    with pytest.raises(ValueError):
        schemas.require_columns(df, ["loc"])
    with pytest.raises(ValueError):
        schemas.resolve_column(df, ["nothing"])
