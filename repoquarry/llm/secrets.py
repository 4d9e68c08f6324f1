"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are found by pattern: labelled assignments, access identifiers and long hexadecimal strings. All of
them are reported. A credential often comes in parts, and single parts are too weak to be reported by
themselves: user or key names, short or unlabelled secrets, addresses. Every secret, base or weak, opens a scope:
the interval of REACH code points around it. Identifiers and endpoints are joined to the scopes they start in, and

* a weak secret is reported if an identifier lies in its scope,
* a weak identifier is reported if it lies in the scope of a secret,
* an endpoint is reported if it lies in the scope of a secret that holds an identifier too.

A part does not complete one that it overlaps; added spans may overlap base spans. The interval join is an equal
join on (document, bin): a scope is listed under each bin that it touches, a part under the bin it starts in, so
each pair meets once and a document of any length is spread over many keys. Spans of one kind do not overlap, so
the pairs of a text grow with its length, and no group of rows is gathered but the reported spans of one document.

Places are code points, ends exclusive. Null has no spans. Documents are told apart by id and text: rows equal in
both get the same spans, a null id is an id like any other. Empty tables give no rows. New columns replace
input columns of their names, all others pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry.llm.common import NO_ID, bound, joinable
from repoquarry.session import drop_table, materialize

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""

# The kinds in their order, each with its part of a credential, whether it is a base kind, its pattern and
# what a match must fulfil: (least length, of group, most length, further patterns that must occur in the match).
KINDS = [
    ("assign", "secret", True, rf"((?i:password|passwd|secret|token|api_?key)){_VALUE}([A-Za-z0-9+/_.=-]+)", (6, 2, None, ())),
    ("access", "identifier", True, r"AKIA[A-Z0-9]+", (20, 0, None, ())),
    ("hex", "secret", True, r"[0-9a-f]{16,}", (24, 0, None, ())),
    ("identifier", "identifier", False, rf"((?i:username|user|login|account|client_?id|access_?key_?id)){_VALUE}([A-Za-z0-9@+/_.=-]+)", (3, 2, None, ())),
    ("labelled", "secret", False, rf"((?i:passphrase|pass|pwd|credential|private_?key|access_?key)){_VALUE}([A-Za-z0-9+/_.=-]+)", (4, 2, None, ())),
    ("opaque", "secret", False, r"[A-Za-z0-9+/]{20,}", (20, 0, None, ("[a-z]", "[A-Z]", "[0-9]"))),
    ("short_hex", "secret", False, r"[0-9a-f]{16,}", (16, 0, 23, ("[a-f]", "[0-9]"))),
    ("endpoint", "endpoint", False, rf"""https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+|(?i:hostname|host|server|endpoint){_VALUE}[A-Za-z0-9._:-]+""", (8, 0, None, ())),
]
REACH = 300

_SPAN = "array<struct<start: bigint, kind: int, end: bigint>>"
_KEY = ["__secret_key", "__secret_mark"]


def running_sum(numbers: Column) -> Column:
    """Sums of an array up to each place. Arrays grow by copying, so they are added up in pieces of about
    the square root of the length, and the pieces' sums are added up in the same way."""

    def simple(values: Column) -> Column:
        last = lambda done: F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("bigint"))
        return F.aggregate(values, F.array().cast("array<bigint>"), lambda done, v: F.concat(done, F.array(last(done) + v)))

    def in_pieces(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        pieces = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int")),
            lambda p: simple(F.slice(values, p * width + 1, width)),
        )
        return bound(pieces, shifted)

    def shifted(pieces: Column) -> Column:
        totals = simple(F.transform(pieces, lambda p: F.element_at(p, -1)))
        before = F.concat(F.array(F.lit(0).cast("bigint")), totals)
        return F.flatten(F.zip_with(pieces, F.slice(before, 1, F.size(pieces)), lambda p, b: F.transform(p, lambda v: v + b)))

    return F.when(F.size(numbers) == 0, numbers).otherwise(in_pieces(numbers))


def located(text: Column, pattern: str, group: int, checks: list[tuple]) -> Column:
    """Leftmost matches that do not overlap, as arrays of (start, kind, end): those that pass the check of a kind.

    ``checks`` has (kind, least, most, patterns) with lengths of the group. Matches and the texts between them
    alternate, so their lengths add up to places.
    """

    def passed(found: Column, least: int, most: int | None, patterns: tuple) -> Column:
        size = F.length(F.regexp_extract(found, pattern, group) if group else found)
        tests = [size >= least, *([size <= most] if most else []), *[F.regexp(found, F.lit(p)) for p in patterns]]
        return reduce(lambda a, b: a & b, tests)

    def placed(matches: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        steps = F.zip_with(between, matches, lambda b, m: (F.length(b) + F.length(m)).cast("bigint"))
        return bound(bound(steps, running_sum), lambda ends: F.zip_with(ends, matches, kinds_of))

    def kinds_of(end: Column, found: Column) -> Column:
        kind = F.lit(None).cast("int")
        for number, least, most, patterns in checks:
            kind = F.when(passed(found, least, most, patterns), F.lit(number)).otherwise(kind)
        return F.struct((end - F.length(found)).alias("start"), kind.alias("kind"), end.alias("end"))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = bound(matches, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(F.array().cast(_SPAN)))
    return F.filter(spans, lambda s: s["kind"].isNotNull())


def _all_spans(text: Column) -> Column:
    """Spans of all kinds; kinds with one pattern are searched for together."""
    searches: dict[tuple, list[tuple]] = {}
    for number, (_, _, _, pattern, (least, group, most, patterns)) in enumerate(KINDS):
        searches.setdefault((pattern, group), []).append((number, least, most, patterns))
    return F.concat(*[located(text, pattern, group, checks) for (pattern, group), checks in searches.items()])


def _is(kind: Column, wanted) -> Column:
    return kind.isin([n for n, k in enumerate(KINDS) if wanted(k)])


def _part(name: str):
    return lambda k: k[1] == name


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(document, start, kind, end) of weak parts that others complete. Runs a job for the joined pairs."""
    width = 2 * reach
    secrets = parts.where(_is(F.col("kind"), _part("secret")))
    low, high = F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach
    scopes = secrets.select(
        *_KEY,
        low.alias("low"),
        high.alias("high"),
        F.struct("start", "kind", "end").alias("secret"),
        F.explode(F.sequence(F.floor(low / width), F.floor((high - 1) / width))).alias("bin"),
    )
    others = parts.where(~_is(F.col("kind"), _part("secret"))).select(
        *_KEY, F.floor(F.col("start") / width).alias("bin"), F.struct("start", "kind", "end").alias("other")
    )
    apart = (F.col("other.end") <= F.col("secret.start")) | (F.col("other.start") >= F.col("secret.end"))
    within = (F.col("other.start") >= F.col("low")) & (F.col("other.start") < F.col("high"))
    met, path = materialize(scopes.join(others, [*_KEY, "bin"]).where(within & apart).select(*_KEY, "secret", "other"), "scopes")
    named = met.where(_is(F.col("other.kind"), _part("identifier"))).select(*_KEY, "secret", "other")
    complete = named.select(*_KEY, "secret").distinct()
    addressed = met.where(_is(F.col("other.kind"), _part("endpoint"))).join(complete, [*_KEY, "secret"], "left_semi")
    found = complete.select(*_KEY, F.col("secret").alias("s"))
    found = found.unionByName(named.select(*_KEY, F.col("other").alias("s"))).unionByName(addressed.select(*_KEY, F.col("other").alias("s")))
    weak = found.where(_is(F.col("s.kind"), lambda k: not k[2])).distinct()
    reported, _ = materialize(weak, "linked")
    drop_table(parts.sparkSession, path)
    return reported


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, keep_text: bool = True
) -> DataFrame:
    """Documents with secrets, an array of (kind, start, end, base) by start, then kind. Runs jobs.

    The texts are read once: spans are written to the shared folder with the other columns.
    """
    text = F.col(text_col).cast("string")
    kept = docs if keep_text else docs.drop(text_col)
    scanned = docs.withColumns(
        {
            _KEY[0]: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)),
            _KEY[1]: F.xxhash64(text),
            "__secret_spans": _all_spans(F.coalesce(text, F.lit(""))),
        }
    )
    table, _ = materialize(scanned.select(*kept.columns, *_KEY, "__secret_spans"), "spans")

    spans = F.col("__secret_spans")
    has = lambda name: F.exists(spans, lambda s: _is(s["kind"], _part(name)))
    parts = table.where(has("secret") & has("identifier")).select(*_KEY, F.explode(spans).alias("s")).select(*_KEY, "s.*").distinct()
    extra = linked(parts, reach).groupBy(*_KEY).agg(F.collect_list("s").alias("__secret_more"))
    joined = table.join(joinable(extra, "more"), _KEY, "left")

    base = F.filter(spans, lambda s: _is(s["kind"], lambda k: k[2]))
    every = F.array_sort(F.concat(base, F.coalesce("__secret_more", F.array().cast(_SPAN))))
    names, bases = (F.array(*[F.lit(k[i]) for k in KINDS]) for i in (0, 2))
    shown = F.transform(
        every,
        lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.get(bases, s["kind"]).alias("base")),
    )
    return joined.withColumn("secrets", shown).drop(*_KEY, "__secret_spans", "__secret_more")


def listed(secrets: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
