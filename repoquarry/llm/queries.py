"""The thirteen operators over the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.llm import ann, bpe, chat, decontaminate, fim, lattice, lines, quality, secrets, simhash, substring, suffixes, whitening
from repoquarry.llm.common import remainder_is, table


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def byte_ranks() -> tuple[str, str]:
    """Path of the ranks and the pattern of pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learnt from."""
    return labels.where(~remainder_is(F.col("doc_id"), 4, 2))


def op1_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring.dedup_substrings(_texts(spark, sf))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = lines.dedup_lines(_texts(spark, sf))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "removed")


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality.score_quality(_texts(spark, sf), learnable(table(spark, sf, "labels")), keep_text=False)
    return scored.select("doc_id", remainder_is(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op5_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    return chat.render(chat.collapse(table(spark, sf, "conversations")))


def op6_lattice_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = _texts(spark, sf).withColumn("held", remainder_is(F.col("doc_id"), 5, 1))
    return lattice.score_texts(docs, piece_model(), "held")


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.remove_repeated_bytes(_texts(spark, sf))
    spans = F.size("removed").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(_texts(spark, sf), table(spark, sf, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op9_simhash_components(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_texts(spark, sf), keep_text=False)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_ranks()
    coded = bpe.decode(bpe.encode(_texts(spark, sf), *ranks, keep_text=False), *ranks)
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    done = fim.fill_in_middle(_texts(spark, sf))
    restored = fim.restore(F.col("output"), F.col("form"))
    return done.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op13_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(_texts(spark, sf), keep_text=False)
    base = F.filter("secrets", lambda s: s["base"])
    count_of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    counts = [count_of(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_substring_dedup,
        op3_line_dedup,
        op4_quality_classifier,
        op5_chat_formatting,
        op6_lattice_scores,
        op7_suffix_dedup,
        op8_decontamination,
        op9_simhash_components,
        op10_byte_bpe,
        op11_fill_in_middle,
        op12_embedding_whitening,
        op13_secret_scan,
    )
}



def _secret_sql() -> str:
    """Spans by pattern, then scopes of secrets joined with identifiers and endpoints of the same document."""
    reach = secrets.REACH
    finds, kinds = [], {name: [i for i, k in enumerate(secrets.KINDS) if k[1] == name] for name in ("secret", "identifier", "endpoint")}
    for number, (_, _, _, pattern, (least, group, most, patterns)) in enumerate(secrets.KINDS):
        quoted = pattern.replace("'", "''")
        size = f"length(regexp_extract(m, '{quoted}', {group}))" if group else "length(m)"
        tests = [f"{size} >= {least}", *([f"{size} <= {most}"] if most else []), *[f"regexp_matches(m, '{p}')" for p in patterns]]
        finds.append(f"""SELECT k, {number} AS kind, e - length(m) AS s, e FROM (
  SELECT k, m, sum(length(m) + length(b)) OVER (PARTITION BY k ORDER BY i) AS e FROM (
    SELECT k, unnest(ms) AS m, unnest(bs[1:len(ms)]) AS b, unnest(range(len(ms))) AS i FROM (
      SELECT k, regexp_extract_all(t, '{quoted}') AS ms, string_split_regex(t, '{quoted}') AS bs FROM d))
) WHERE {" AND ".join(tests)}""")
    among = {name: f"IN ({', '.join(map(str, numbers))})" for name, numbers in kinds.items()}
    base = ", ".join(str(i) for i, k in enumerate(secrets.KINDS) if k[2])
    names = "[" + ", ".join(f"'{k[0]}'" for k in secrets.KINDS) + "]"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i})::BIGINT AS n_{secrets.KINDS[i][0]}" for i in range(3))
    return f"""
WITH r AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
d AS (SELECT k, t FROM r),
a AS ({" UNION ALL ".join(finds)}),
j AS (
  SELECT x.k, x.kind AS xk, x.s AS xs, x.e AS xe, y.kind AS yk, y.s AS ys, y.e AS ye FROM a AS x, a AS y
  WHERE x.k = y.k AND x.kind {among["secret"]} AND y.kind NOT {among["secret"]}
    AND y.s >= greatest(x.s - {reach}, 0) AND y.s < x.e + {reach} AND (y.e <= x.s OR y.s >= x.e)
),
c AS (SELECT DISTINCT k, xk, xs, xe FROM j WHERE yk {among["identifier"]}),
f AS (
  SELECT k, kind, s, e FROM a WHERE kind IN ({base})
  UNION SELECT k, xk, xs, xe FROM c
  UNION SELECT k, yk, ys, ye FROM j WHERE yk {among["identifier"]}
  UNION SELECT k, yk, ys, ye FROM j SEMI JOIN c USING (k, xk, xs, xe) WHERE yk {among["endpoint"]}
),
l AS (SELECT *, {names}[kind + 1] || ':' || s || ':' || e AS shown FROM f),
g AS (
  SELECT k, {counts}, string_agg(shown, ',' ORDER BY s, kind) FILTER (WHERE kind IN ({base})) AS base,
    string_agg(shown, ',' ORDER BY s, kind) AS every
  FROM l GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM r LEFT JOIN g ON r.k = g.k"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)
),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE k > 1),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (
  SELECT x.doc_id, count(c.p) AS gone, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE c.p IS NULL) AS kept
  FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op5_chat_formatting": """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l
  FROM t GROUP BY conv_id
),
f AS (SELECT min(conv_id) AS conv_id, l, count(*) AS copies FROM c GROUP BY l),
m AS (
  SELECT * FROM f WHERE NOT EXISTS (
    SELECT 1 FROM f AS b WHERE b.l[1] = f.l[1] AND len(b.l) > len(f.l) AND b.l[1:len(f.l)] = f.l)
)
SELECT conv_id, len(l)::BIGINT AS n_turns, copies::BIGINT AS copies,
  array_to_string(list_transform(l, lambda x: '<|im_start|>' || coalesce(x.r, 'unknown') || chr(10)
    || coalesce(x.t, '') || '<|im_end|>' || chr(10)), '') AS rendered
FROM m""",
    "op7_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, unnest(range(0, len(h) // 2)) AS p, h FROM d),
g AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x,
    CASE WHEN 2 * p + 800 <= len(h) THEN md5(substr(h, 2 * p + 1, 800)) END AS s
  FROM b
),
r AS (SELECT s FROM g WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
m AS (
  SELECT doc_id, p, x, max(CASE WHEN r.s IS NOT NULL THEN p END) OVER (PARTITION BY doc_id ORDER BY p) AS q
  FROM g LEFT JOIN r ON g.s = r.s
),
o AS (SELECT doc_id, p, x, coalesce(p - q < 400, false) AS gone FROM m),
e AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS begins FROM o),
k AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS gone, count(*) FILTER (WHERE begins) AS spans,
    string_agg(x, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM e GROUP BY doc_id
)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op8_decontamination": f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS (
  SELECT DISTINCT item_id, n, array_to_string(w[a:a + n - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS a FROM i)
),
x AS (
  SELECT doc_id, n, a, array_to_string(w[a:a + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM i))
),
m AS (SELECT doc_id, a, x.n, item_id FROM x JOIN g ON x.s = g.s AND x.n = g.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM m) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN l ON d.doc_id = l.doc_id""",
    "op11_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
),
c AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90
      THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
p AS (
  SELECT doc_id, t, n, form, array_to_string(w[1:least(x, y)], '') AS pre,
    array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(w[greatest(x, y) + 1:n], '') AS suf
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form != 'plain' THEN length(coalesce(pre, '')) END::BIGINT AS prefix_chars,
  CASE WHEN form != 'plain' THEN length(coalesce(mid, '')) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
    ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
    "op13_secret_scan": _secret_sql(),
}
