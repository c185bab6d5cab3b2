"""The registered queries of the package and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tributary.llm import align, bpe, exact, language, licenses, mixing, near, phrases, pii, quality, rules, shards, simhash
from tributary.llm.common import table

_TEMPLATES_SQL = ", ".join(
    "({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(licenses.TEMPLATES)
)
WORD_SQL = r"'[^\x20\x09-\x0D]+'"


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def op1_mixing(spark, sf_dir):
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = language.id_crc32(4) == 2
    network, labels = language.fit(docs.filter(~held_out))
    found = language.predicted(docs, network, labels)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language.id_crc32(5) == 0
    found = quality.scored(docs, quality.fit(docs, labels.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_exact_dedup(spark, sf_dir):
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_license_scan(spark, sf_dir):
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op6_personal_data(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def number(kind):
        of_kind = F.filter(F.split("base", ","), lambda x: x.startswith(f"{kind}:"))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_bpe(spark, sf_dir):
    return bpe.digests(bpe.encoded(table(spark, sf_dir, "documents"), bpe.VOCABULARY))


def op8_quality_rules(spark, sf_dir):
    rows = rules.judged(rules.ledger(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("failed").alias("failed_bits"),
    )


def op9_minhash_near_dedup(spark, sf_dir):
    return near.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op10_sharding(spark, sf_dir):
    return shards.shard(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_simhash_near_dedup(spark, sf_dir):
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op13_alignment(spark, sf_dir):
    return align.alignment(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        pipeline, op1_mixing, op2_language_id, op3_quality_classifier, op4_exact_dedup, op5_license_scan, op6_personal_data,
        op7_bpe, op8_quality_rules, op9_minhash_near_dedup, op10_sharding, op11_collocations,
        op12_simhash_near_dedup, op13_alignment,
    )
}

ORACLES = {
    "op1_mixing": f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {WORD_SQL})), 0) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
l AS (SELECT *, (SELECT sum(source_size) FROM s)
      - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free_words,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free_weight
    FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
lev AS (SELECT free_words, free_weight FROM l WHERE 3 * source_size * free_weight >= weight * free_words
    ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN 3 * source_size * free_weight < weight * free_words
    THEN CAST(3 * source_size AS DOUBLE)
    ELSE round(CAST(weight * (SELECT free_words FROM lev) AS DOUBLE) / (SELECT free_weight FROM lev), 6) END AS target FROM l),
w AS (SELECT *, CAST(floor(target) AS HUGEINT) AS share FROM t),
c AS (SELECT *, sum(share) OVER (ORDER BY source NULLS LAST) * 4294967296 // (SELECT sum(share) FROM w) AS high FROM w),
p AS (SELECT *, lag(high, 1, 0) OVER (ORDER BY source NULLS LAST) AS low FROM c),
g AS (SELECT greatest(1, least(1048576, sum(size) // 65536)) AS block, sum(size) AS words FROM d),
slots AS (SELECT (i * 2654435769 + 2147483648) % 4294967296 AS point
    FROM (SELECT unnest(generate_series(0, CAST(ceil(words / block) AS BIGINT) - 1)) AS i FROM g)),
n AS (SELECT source, count(*) AS slots FROM slots JOIN p ON point >= low AND point < high GROUP BY source),
r AS (SELECT t.*, least(CASE WHEN target < 512 * (SELECT block FROM g) THEN CAST(round(target) AS HUGEINT)
    ELSE coalesce(n.slots, 0) * (SELECT block FROM g) END, 3 * t.source_size) AS granted FROM t LEFT JOIN n ON t.source IS NOT DISTINCT FROM n.source),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT b.doc_id, b.source, CAST(b.size AS BIGINT) AS size, r.source_size, r.target, CAST((
    greatest(0, least(b.size, r.granted - b.before)) + greatest(0, least(b.size, r.granted - r.source_size - b.before))
    + greatest(0, least(b.size, r.granted - 2 * r.source_size - b.before))) AS BIGINT) AS taken
FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source""",
    "op4_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
    sha256(norm) AS text_sha256 FROM n WINDOW w AS (PARTITION BY norm)""",
    "op5_license_scan": f"""
WITH t AS (SELECT i, license, ws, greatest(8, CAST(pow(2, ceil(log2(len(ws)))) AS INTEGER)) AS level
    FROM (SELECT i, license, regexp_extract_all(lower(x), '[a-z0-9]+') AS ws FROM (VALUES {_TEMPLATES_SQL}) v(i, license, x))),
p AS (SELECT i, license, level, list_distinct([ws[j] || ' ' || ws[j + 1] || ' ' || ws[j + 2] FOR j IN generate_series(1, len(ws) - 2)])
    AS wanted FROM t),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest([{{'j': j, 's': ws[j] || ' ' || ws[j + 1] || ' ' || ws[j + 2]}} FOR j IN generate_series(1, len(ws) - 2)],
    recursive := true) FROM d WHERE len(ws) > 2),
h AS (SELECT doc_id, j - 1 AS j, s, i, license, level, len(wanted) AS n FROM s JOIN (SELECT *, unnest(wanted) AS w FROM p) q ON s = w),
k AS (SELECT *, unnest([j // level, j // level - 1]) AS win FROM h),
c AS (SELECT doc_id, license, i, level, win, count(DISTINCT s) / max(n) AS containment, list(DISTINCT s) AS holds FROM k
    WHERE win >= 0 AND j + 3 <= win * level + 2 * level GROUP BY ALL HAVING count(DISTINCT s) / max(n) >= 0.8),
x AS (SELECT DISTINCT a.doc_id, a.i, a.level, a.win FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.level = b.level
    AND abs(a.win - b.win) <= 1 AND a.license <> b.license AND b.containment > a.containment
    JOIN p ON p.i = b.i WHERE list_has_all(p.wanted, a.holds))
SELECT doc_id, license, max(containment) AS containment, CAST(min(level * win) AS BIGINT) AS first_word
FROM c ANTI JOIN x USING (doc_id, i, level, win) GROUP BY 1, 2""",
    "op8_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, {WORD_SQL}) AS ws, list_filter(string_split(text, chr(10)),
    lambda x: regexp_matches(x, {WORD_SQL})) AS ls FROM d),
g AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM w WHERE len(ws) > 2),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS times FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM h WHERE times > 1) GROUP BY 1),
m AS (SELECT w.doc_id, len(ws) AS n_words, len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(ws, lambda x: upper(x) <> lower(x))) AS n_letter_words,
    len(list_filter(ws, lambda x: upper(x) <> lower(x) AND x = upper(x))) AS n_upper_words
    FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 AS b0, 100 * n_repeat_words > 50 * n_words AS b1, 100 * n_symbols > 30 * n_words AS b2,
    100 * n_upper_words > 60 * n_letter_words AS b3, word_chars > 25 * n_words AS b4, 100 * n_dup_lines > 30 * n_lines AS b5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 OR b1 AS base_failed,
    NOT (b0 OR b1 OR b2 OR b3 OR b4) AS kept, CAST(b0 AS BIGINT) + 2 * CAST(b1 AS BIGINT) + 4 * CAST(b2 AS BIGINT)
    + 8 * CAST(b3 AS BIGINT) + 16 * CAST(b4 AS BIGINT) + 32 * CAST(b5 AS BIGINT) AS failed_bits FROM f""",
    "op11_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
s AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM p WHERE len(ws) > 0),
g AS (SELECT lang, unnest(generate_series(1, least(4, len(ws) - i + 1))) AS m, ws, i FROM s),
f AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
c AS (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
k AS (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM c),
x AS (SELECT k.lang, k.m, k.phrase, k.f, k, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * k.f // (l.f + r.f) AS BIGINT) AS score
    FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k], ' ')
    JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k + 1:], ' ')),
w AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
q AS (SELECT lang, f AS longer, ws, m, unnest(generate_series(2, m - 1)) AS w FROM c WHERE m > 2),
u AS (SELECT lang, longer, ws, w, unnest(generate_series(1, m - w + 1)) AS i FROM q),
v AS (SELECT lang, array_to_string(ws[i:i + w - 1], ' ') AS phrase, max(longer) AS longer FROM u GROUP BY ALL),
b AS (SELECT w.* FROM w LEFT JOIN v ON w.lang = v.lang AND w.phrase = v.phrase
    WHERE v.longer IS NULL OR CAST(100 AS HUGEINT) * v.longer < CAST(80 AS HUGEINT) * w.f),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM b)
SELECT z.lang, rank, phrase, f AS a, l, r, n, score FROM z JOIN t ON z.lang = t.lang WHERE rank <= 2000""",
}
