"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from layerwise.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
SPACE_WORDS = r"[^\x20\x09-\x0D]+"
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ 3: benchmark decontamination

OP3_SQL = f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOW}, '{ALNUM_WORDS}') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all({LOW}, '{ALNUM_WORDS}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
          ELSE [array_to_string(w[i:i + 9], ' ') for i in range(1, len(w) - 8)] END) AS k FROM iw),
size AS (SELECT DISTINCT k, len(string_split(k, ' ')) AS m FROM win),
pos AS (SELECT r, m, unnest(range(1, len(w) - m + 2)) AS i, w FROM dw, (SELECT DISTINCT m FROM size) WHERE len(w) >= m),
hit AS (SELECT r, i, pos.m, k FROM pos JOIN size ON array_to_string(w[i:i + pos.m - 1], ' ') = k AND size.m = pos.m),
words_hit AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(i, i + m)) AS x FROM hit) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
          FROM hit JOIN win USING (k) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN words_hit h USING (r) LEFT JOIN named USING (r)
"""


@register("op3_benchmark_decontamination", OP3_SQL)
def op3(spark, sf_dir):
    from layerwise.llm.decontam import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ 5: near-duplicates

OP5_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOW}, '{SPACE_WORDS}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM w),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT i, j FROM p JOIN s a ON a.doc_id = i JOIN s b ON b.doc_id = j
      WHERE 100 * c >= 85 * (len(a.s) + len(b.s) - c)),
reach(d, r) AS (SELECT doc_id, doc_id FROM s UNION SELECT reach.d, e.j FROM reach JOIN e ON e.i = reach.r),
c AS (SELECT d, min(r) AS m FROM reach GROUP BY d)
SELECT doc_id, len(s)::BIGINT AS n_shingles, m AS component_id, doc_id = m AS kept FROM s JOIN c ON d = doc_id
"""


@register("op5_minhash_near_dedup", OP5_SQL)
def op5(spark, sf_dir):
    from layerwise.llm.near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), num=85, bands=24)


# ------------------------------------------------------------------ 2: url filters

def _op2_level(name, counts, up, parent):
    """SQL of one shrinkage level: strength, then posterior."""
    return f"""
{name}_l AS (SELECT c.*, p.m AS pm FROM {counts} c JOIN {parent} p ON c.{up} = p.key),
{name}_f AS (SELECT count(*) AS g, sum(n)::DOUBLE AS n, sum(n * pow(k / n - pm, 2)) AS ss, sum(n * pm * (1 - pm)) AS vv FROM {name}_l WHERE n > 0),
{name}_s AS (SELECT round(greatest(1.0::DOUBLE, least(1000.0::DOUBLE, CASE WHEN g < 2 OR ss / n <= vv / n * g / n THEN 1000.0::DOUBLE
    ELSE (vv / n - ss / n) / (ss / n - vv / n * g / n) END)), 6) AS s FROM {name}_f),
{name}_ab AS (SELECT key, {up}, k + pm * s AS a, n - k + (1 - pm) * s AS b FROM {name}_l, {name}_s),
{name} AS (SELECT *, a / (a + b) AS m FROM {name}_ab)"""


OP2_SQL = f"""
WITH parts AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
outcomes AS (SELECT host, quality = 0 OR toxic = 1 AS bad FROM parts JOIN labels
    ON try_cast(nullif(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1), '') AS BIGINT) = doc_id),
hosts AS (SELECT DISTINCT host FROM parts),
counted AS (SELECT h.host AS key, array_to_string(string_split(h.host, '.')[-2:], '.') AS domain, string_split(h.host, '.')[-1] AS suffix,
    count(*) FILTER (WHERE bad) AS k, count(bad) AS n FROM hosts h LEFT JOIN outcomes o ON h.host = o.host GROUP BY h.host),
domains AS (SELECT domain AS key, suffix, sum(k)::BIGINT AS k, sum(n)::BIGINT AS n FROM counted GROUP BY ALL),
suffixes AS (SELECT suffix AS key, '' AS up, sum(k)::BIGINT AS k, sum(n)::BIGINT AS n FROM domains GROUP BY ALL),
overall AS (SELECT '' AS key, coalesce(sum(k) / nullif(sum(n), 0), 0.5::DOUBLE) AS m FROM suffixes),
{_op2_level('sp', 'suffixes', 'up', 'overall')}, {_op2_level('dp', 'domains', 'suffix', 'sp')}, {_op2_level('hp', 'counted', 'domain', 'dp')},
bounds AS (SELECT key, round(m - 1.645::DOUBLE * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))), 6) AS bound FROM hp),
rules(action, rule, tail, prefix) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
fit AS (SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
    FROM (SELECT DISTINCT host, path FROM parts) p, rules WHERE (host = tail OR ends_with(host, '.' || tail)) AND starts_with(path, prefix) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN bound > 0.35 THEN 'block' ELSE 'allow' END) AS verdict, bound
FROM parts JOIN bounds ON host = key LEFT JOIN fit USING (host, path)
"""


@register("op2_url_filters", OP2_SQL)
def op2(spark, sf_dir):
    """A page's url names its document (``/lang/number``); that document's labels are its outcome."""
    from pyspark.sql import functions as F

    from layerwise.llm.url_filter import judge_urls, path_of
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(path_of(F.col("url")), "^/[a-z]+/([0-9]+)", 1).try_cast("bigint")
    labels = table(spark, sf_dir, "labels")
    outcomes = pages.withColumn("doc_id", number).join(labels, "doc_id") \
        .select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge_urls(pages, outcomes)


# ------------------------------------------------------------------ 7: quality rules

@register("op7_quality_rules")
def op7(spark, sf_dir):
    from layerwise.llm.quality import judge
    labels = table(spark, sf_dir, "labels")
    return judge(table(spark, sf_dir, "documents"), labels.filter("quality = 1 and toxic = 0").select("doc_id"),
                 toxic=labels.filter("toxic = 1").select("doc_id"))


# ------------------------------------------------------------------ 9: secret scans

@register("op9_secret_scans")
def op9(spark, sf_dir):
    from layerwise.llm.secret_scan import scan_report
    return scan_report(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 8: sharding

@register("op8_balanced_shards")
def op8(spark, sf_dir):
    from layerwise.llm.sharding import assign_shards
    return assign_shards(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 6: private data

@register("op6_pii_surrogates")
def op6(spark, sf_dir):
    from pyspark.sql import functions as F

    from layerwise.llm.pii import KINDS, pseudonymise
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", *[F.col(f"_pii.{k}").cast("long").alias(f"n_{k}") for k in KINDS])


# ------------------------------------------------------------------ 10: SentencePiece

@register("op10_sentencepiece")
def op10(spark, sf_dir):
    from pyspark.sql import functions as F

    from layerwise.llm.pieces import encode
    return encode(table(spark, sf_dir, "documents")).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


# ------------------------------------------------------------------ 1: language identification

@register("op1_language_id")
def op1(spark, sf_dir):
    from pyspark.sql import functions as F

    from layerwise.llm.lang_id import fit, predict
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    fitted = fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return predict(docs, fitted).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 4: repeated strings

@register("op4_suffix_array_dedup")
def op4(spark, sf_dir):
    from layerwise.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


# ------------------------------------------------------------------ 13: periodic runs

CRC_STEP = "list_reduce(list_prepend({x}, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
CRC_ID = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda z: ord(z)::BIGINT)), " \
    f"lambda acc, b: {CRC_STEP.format(x='xor(acc, b)')}), 4294967295)"

OP13_SQL = f"""
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{SPACE_WORDS}') AS o, {CRC_ID} AS h FROM documents),
ga AS (SELECT r, doc_id, o, len(o) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a FROM raw),
sized AS (SELECT r, doc_id, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM ga),
orig AS (SELECT r, unnest(range(len(o))) AS i, unnest(o) AS x FROM raw),
idx AS (SELECT r, n, a, p, unnest(range(n)) AS i FROM sized),
w AS (SELECT idx.r, idx.i, n, x FROM idx JOIN orig ON idx.r = orig.r AND orig.i = CASE WHEN a IS NULL OR idx.i < a THEN idx.i ELSE a + (idx.i - a) % p END),
eq AS (SELECT u.r, u.i, v.i - u.i AS d FROM w u JOIN w v ON u.r = v.r AND u.x = v.x AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
island AS (SELECT r, d, i, i - row_number() OVER (PARTITION BY r, d ORDER BY i) AS k FROM eq),
st AS (SELECT r, d, min(i) AS s, count(*) + d AS m FROM island GROUP BY r, d, k HAVING count(*) + d >= greatest(6, 4 * d)),
runs AS (SELECT * FROM st WHERE NOT EXISTS (SELECT 1 FROM st z WHERE z.r = st.r AND z.d < st.d AND z.s <= st.s AND z.s + z.m >= st.s + st.m)),
best AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || m || ',' || d || chr(10), '' ORDER BY s, d) AS listing,
    first(s ORDER BY m::HUGEINT * 1000000000000 // d DESC, s, d) AS s, first(m ORDER BY m::HUGEINT * 1000000000000 // d DESC, s, d) AS m,
    first(d ORDER BY m::HUGEINT * 1000000000000 // d DESC, s, d) AS d FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + d, s + m)) AS i FROM runs),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, m::BIGINT AS length, d::BIGINT AS period, (1000 * m // d)::BIGINT AS exponent_milli,
    sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM raw LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


@register("op13_periodic_runs", OP13_SQL)
def op13(spark, sf_dir):
    from pyspark.sql import functions as F

    from layerwise.llm.periodic_runs import best_run, periodic_runs, repeat_planted
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = periodic_runs(docs.withColumn("text", repeat_planted(F.col("doc_id"), F.col("text")))).withColumn("best", best_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# ------------------------------------------------------------------ 12: collocations

OP12_SQL = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOW}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) AS phrase
    FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM w) WHERE len(w) >= m),
total AS (SELECT lang, count(*) AS n FROM gram WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 30),
covered AS (SELECT DISTINCT s.lang, s.phrase FROM f s JOIN f b ON s.lang = b.lang AND b.m > s.m AND 100 * b.a >= 80 * s.a
    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') WHERE s.m >= 2),
cand AS (SELECT * FROM f ANTI JOIN covered USING (lang, phrase) WHERE m >= 2),
cut AS (SELECT lang, m, phrase, a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS y
    FROM cand, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
scored AS (SELECT cut.lang, cut.phrase, cut.a, u.a AS l, v.a AS r, (2000000::HUGEINT * cut.a // (u.a + v.a)) AS score, k
    FROM cut JOIN f u ON u.lang = cut.lang AND u.phrase = x JOIN f v ON v.lang = cut.lang AND v.phrase = y),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM low)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@register("op12_collocations", OP12_SQL)
def op12(spark, sf_dir):
    from layerwise.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 11: n-gram Jaccard join

OP11_SQL = OP5_SQL.replace("< 5 THEN", "< 4 THEN").replace("w[i:i + 4]", "w[i:i + 3]").replace("len(w) - 3)", "len(w) - 2)") \
    .replace(", doc_id = m AS kept", "")


@register("op11_ngram_jaccard_join", OP11_SQL)
def op11(spark, sf_dir):
    from layerwise.llm.ngram_join import ngram_join
    return ngram_join(table(spark, sf_dir, "documents"), num=85)
