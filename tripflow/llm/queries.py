"""One query per operator over the given tables, and SQL of its result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import bpe, decontaminate, extract, jaccard_join, langid, merkle, pieces, pii, quality, spelling, suffix_dedup, toxicity
from tripflow.llm.common import crc_rest, session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            session(spark)
            return build(lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def sha(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


@query("op2_toxicity")
def op2(table) -> DataFrame:
    docs, labels = table("documents"), table("labels")
    held_out = lambda frame: crc_rest(frame["doc_id"], 5) == 0
    model = toxicity.fit(docs.where(~held_out(docs)), labels.where(~held_out(labels)))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out(scored).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


LEAK_SQL = r"""
WITH fold AS (SELECT doc_id, 0 AS kind, '' AS item, coalesce(text, '') AS t FROM documents
              UNION ALL SELECT NULL, 1, coalesce(CAST(item_id AS VARCHAR), ''), coalesce(text, '') FROM benchmark),
w AS (SELECT doc_id, kind, item, regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM fold),
p AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM w WHERE kind = 1 AND len(w) > 0)),
h AS (SELECT d.doc_id, d.i, p.n, p.item FROM (
        SELECT doc_id, i, s.n, array_to_string(w[i : i + s.n - 1], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE kind = 0)
        CROSS JOIN (SELECT DISTINCT n FROM p) s WHERE i + s.n - 1 <= len(w)) d JOIN p ON p.n = d.n AND p.g = d.g),
k AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM h GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(t.s, '')) AS items_sha256, coalesce(k.n, 0) > 0 AS contaminated
FROM w LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id) WHERE w.kind = 0
"""


@query("op3_decontamination", LEAK_SQL)
def op3(table) -> DataFrame:
    hits = decontaminate.exact_hits(decontaminate.build_index(table("documents")), table("benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op4_language_id")
def op4(table) -> DataFrame:
    docs = table("documents")
    held_out = crc_rest(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op5_byte_bpe")
def op5(table) -> DataFrame:
    import public_tokenizers as public

    return encoded(table("documents"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


def encoded(docs: DataFrame, ranks: str, pattern: str, *keep: str, share: float = 1.0) -> DataFrame:
    """Ids and what they decode to, as counts and digests; `keep` names further columns, ids among them."""
    return bpe.encode(docs, ranks, pattern, decoded="decoded", share=share).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        sha(F.col("ids")).alias("ids_sha256"),
        *keep,
        sha(F.col("decoded")).alias("decoded_sha256"),
    )


@query("op6_pii")
def op6(table) -> DataFrame:
    spans = pii.with_spans(table("documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda found: F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return spans.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        sha(text(F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS)))).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


@query("op7_html_extraction")
def op7(table) -> DataFrame:
    found = extract.extract(table("pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


NEAR_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
      WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.d = w.doc_id GROUP BY w.doc_id
"""


@query("op8_jaccard_join", NEAR_SQL)
def op8(table) -> DataFrame:
    return jaccard_join.near_duplicates(table("documents")).select("doc_id", "n_shingles", "component_id")


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 5)) AS j
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words
      FROM w LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
p AS (SELECT *, CASE WHEN word_chars > 0 THEN least(1000, 1000 * n_symbols // word_chars) ELSE 0 END AS symbols,
             CASE WHEN n_lines > 0 THEN least(1000, 1000 * n_dup_lines // n_lines) ELSE 0 END AS dup_lines,
             CASE WHEN n_words > 0 THEN least(1000, 1000 * n_repeat_words // n_words) ELSE 0 END AS repeats FROM m),
f AS (SELECT grouping_id(lang, source) AS g, lang, source, count(*) AS n,
             greatest(quantile_disc(symbols, 0.9375), CASE WHEN 64 * count(*) FILTER (symbols > 0) >= count(*) THEN coalesce(quantile_disc(symbols, 0.5) FILTER (symbols > 0), 0) ELSE 0 END) AS s,
             greatest(quantile_disc(dup_lines, 0.9375), CASE WHEN 64 * count(*) FILTER (dup_lines > 0) >= count(*) THEN coalesce(quantile_disc(dup_lines, 0.5) FILTER (dup_lines > 0), 0) ELSE 0 END) AS d,
             greatest(quantile_disc(repeats, 0.9375), CASE WHEN 64 * count(*) FILTER (repeats > 0) >= count(*) THEN coalesce(quantile_disc(repeats, 0.5) FILTER (repeats > 0), 0) ELSE 0 END) AS r
      FROM p WHERE NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) GROUP BY GROUPING SETS ((lang, source), (lang), ())),
c AS (SELECT p.*, coalesce(CASE WHEN a.n >= 200 THEN a.s END, CASE WHEN b.n >= 200 THEN b.s END, z.s) AS ms,
             coalesce(CASE WHEN a.n >= 200 THEN a.d END, CASE WHEN b.n >= 200 THEN b.d END, z.d) AS md,
             coalesce(CASE WHEN a.n >= 200 THEN a.r END, CASE WHEN b.n >= 200 THEN b.r END, z.r) AS mr
      FROM p LEFT JOIN f a ON a.g = 0 AND a.lang IS NOT DISTINCT FROM p.lang AND a.source IS NOT DISTINCT FROM p.source
      LEFT JOIN f b ON b.g = 1 AND b.lang IS NOT DISTINCT FROM p.lang LEFT JOIN f z ON z.g = 3)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND symbols <= ms AND dup_lines <= md AND repeats <= mr AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS failed FROM c)
"""


@query("op9_quality_rules", QUALITY_SQL)
def op9(table) -> DataFrame:
    return quality.judge(table("documents"))


REPEAT_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(1, len(h) // 2 + 1)) AS i FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS b,
        CASE WHEN 2 * i + 198 <= len(h) THEN md5(substr(h, 2 * i - 1, 200)) END AS g FROM p),
r AS (SELECT doc_id, i, b, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again FROM w),
c AS (SELECT doc_id, i, b, coalesce(i - max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i) < 100, false) AS gone FROM r),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
s AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed, count(*) FILTER (opens) AS spans,
        string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


@query("op10_suffix_dedup", REPEAT_SQL)
def op10(table) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table("documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", sha(F.col("kept")).alias("kept_sha256"))


@query("op11_sentencepiece")
def op11(table) -> DataFrame:
    import public_tokenizers as public

    model = public.path("piece_bpe_32k.model")
    ids = pieces.encode(table("documents"), model)
    digests = ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        "ids",
    )
    kept = ("doc_id", "n_tokens", "ids_sha256")
    return pieces.decode(digests, model, keep=kept).select(*kept, sha(F.col("decoded")).alias("decoded_sha256"))


# crc32 of ASCII texts: the table of bytes first, then one step per byte.
CRC_TABLE_SQL = """SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
      FROM (SELECT unnest(range(256)) AS i)"""
VARIANT_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
o AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[A-Za-z\x{{00C0}}-\x{{00FF}}]+') AS w FROM documents),
u AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM o) WHERE length(w) >= 6 GROUP BY doc_id, w),
x AS (SELECT w, n, hex(encode(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', w))) AS x FROM u),
h AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(x), 2),
        lambda k: CAST(16 * (strpos('0123456789ABCDEF', substr(x, k, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, k + 1, 1)) - 1 AS BIGINT))),
        lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) AS h FROM x CROSS JOIN crc),
v AS (SELECT CASE WHEN h % 199 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS w, n FROM h),
b AS MATERIALIZED (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT w, i, concat(substr(w, 1, i - 1), substr(w, i + 1)) AS d
        FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM b)),
p AS MATERIALIZED (SELECT d.w AS a, b.w AS b FROM d JOIN b ON b.w = d.d UNION SELECT b.w, d.w FROM d JOIN b ON b.w = d.d
        UNION SELECT d.w, e.w FROM d JOIN d e ON e.i = d.i AND e.d = d.d AND e.w <> d.w),
r AS (SELECT p.a, p.b, y.n, row_number() OVER (PARTITION BY p.a ORDER BY y.n DESC, encode(p.b)) AS k, count(*) OVER (PARTITION BY p.a) AS c
        FROM p JOIN b y ON y.w = p.b),
f AS MATERIALIZED (SELECT b.w, b.n, coalesce(r.c, 0) AS n_near, CASE WHEN r.n >= 5 * b.n THEN r.b END AS form,
        CASE WHEN r.n >= 5 * b.n THEN r.n END AS form_n FROM b LEFT JOIN r ON r.a = b.w AND r.k = 1),
g AS (SELECT w, w AS root, 0 AS k FROM f UNION ALL SELECT g.w, f.form, g.k + 1 FROM g JOIN f ON f.w = g.root WHERE f.form IS NOT NULL)
SELECT f.w AS word, f.form, arg_max(g.root, g.k) AS root, f.n, f.n_near, f.form_n
FROM f JOIN g USING (w) GROUP BY f.w, f.form, f.n, f.n_near, f.form_n
"""


@query("op12_spelling_variants", VARIANT_SQL)
def op12(table) -> DataFrame:
    return spelling.variants(table("documents"))


MERKLE_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
d AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(x) + 1),
             lambda k: CAST(ascii(substr(x, k, 1)) AS BIGINT))), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) % 2 = 0 AS cut
      FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS x FROM documents) CROSS JOIN crc),
f AS (SELECT doc_id, source, cut, text, concat(
             coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
             coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM d),
e AS (SELECT doc_id, coalesce('=' || source, '') AS s, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
             sha256(concat(head, coalesce(strlen(u) || ':' || u, '-'))) AS changed
      FROM (SELECT *, CASE WHEN cut THEN replace(text, chr(10), '') ELSE text END AS u FROM f)),
a AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY s) AS n FROM e),
v AS (SELECT 0 AS l, s, i, n, leaf AS h FROM a
      UNION ALL SELECT l + 1, s, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM v WHERE n > 1 GROUP BY l, s, i // 3, n),
b AS MATERIALIZED (SELECT s, h AS subroot, row_number() OVER (ORDER BY encode(s)) - 1 AS i, count(*) OVER () AS n FROM v WHERE n = 1),
w AS (SELECT 0 AS l, i, n, subroot AS h FROM b
      UNION ALL SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM w WHERE n > 1 GROUP BY l, i // 3, n),
o AS (SELECT a.s, a.i, 0 AS tree, v.l, v.i AS j, v.h, a.i // CAST(pow(3, v.l) AS BIGINT) AS own FROM a JOIN v
      ON v.s = a.s AND v.n > 1 AND v.i // 3 = a.i // CAST(pow(3, v.l + 1) AS BIGINT)
      UNION ALL SELECT a.s, a.i, 1, w.l, w.i, w.h, b.i // CAST(pow(3, w.l) AS BIGINT) FROM a JOIN b USING (s) JOIN w
      ON w.n > 1 AND w.i // 3 = b.i // CAST(pow(3, w.l + 1) AS BIGINT)),
p AS MATERIALIZED (SELECT s, i, row_number() OVER (PARTITION BY s, i ORDER BY tree, l) - 1 AS k,
             coalesce(string_agg(h, '' ORDER BY j) FILTER (j < own), '') AS pre,
             coalesce(string_agg(h, '' ORDER BY j) FILTER (j > own), '') AS post FROM o GROUP BY s, i, tree, l),
g AS (SELECT s, i, 0 AS k, changed AS h FROM a
      UNION ALL SELECT g.s, g.i, g.k + 1, sha256(concat(p.pre, g.h, p.post)) FROM g JOIN p ON p.s = g.s AND p.i = g.i AND p.k = g.k),
z AS (SELECT s, i, arg_max(h, k) AS h FROM g GROUP BY s, i),
q AS (SELECT s, i, string_agg(pre || post, '' ORDER BY k) AS proof FROM p GROUP BY s, i)
SELECT a.doc_id, a.leaf, b.subroot, r.h AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, z.h AS folded_root, z.h = r.h AS verified
FROM a JOIN b USING (s) JOIN (SELECT h FROM w WHERE n = 1) r ON true JOIN z ON z.s = a.s AND z.i = a.i
LEFT JOIN q ON q.s = a.s AND q.i = a.i
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def op13(table) -> DataFrame:
    return merkle.manifest(table("documents"))
