"""The registered queries: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.llm.common import table
from sparkmart.llm.decontaminate import contaminated
from sparkmart.llm.host_reputation import judge_urls
from sparkmart.llm.lm_score import lm_scores
from sparkmart.llm.mixing import mix_plan
from sparkmart.llm.outliers import quality_verdicts
from sparkmart.llm.pieces import piece_digests
from sparkmart.llm.quotes import reply_ordered
from sparkmart.llm.registry import llm_query
from sparkmart.llm.repeats import repeat_digests
from sparkmart.llm.sharding import byte_shards
from sparkmart.llm.simhash import near_duplicate_components
from sparkmart.llm.strata import build_index, search
from sparkmart.llm.toxicity import toxicity_scores
from sparkmart.llm.whitening import whitened_rows

# Only the id order is random here: ids are unique in `documents`.
MIX_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source),
w AS (
    SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (
    SELECT *, row_number() OVER o AS level,
        150 * sum(source_size) OVER () - 200 * (sum(source_size) OVER o - source_size) AS rest,
        100 * (sum(weight) OVER () - sum(weight) OVER o + weight) AS others
    FROM w WINDOW o AS (ORDER BY source_size / weight, place ROWS UNBOUNDED PRECEDING)),
f AS (
    SELECT arg_min({'level': level, 'rest': rest, 'others': others}, level) AS cut
    FROM l WHERE rest * weight / others <= 2 * source_size),
t AS (
    SELECT source, source_size,
        CASE WHEN level >= (SELECT cut.level FROM f)
            THEN CAST((SELECT cut.rest FROM f) * weight AS DOUBLE) / CAST((SELECT cut.others FROM f) AS DOUBLE)
            ELSE CAST(2 * source_size AS DOUBLE) END AS target
    FROM l),
p AS (
    SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, t.source_size, t.target,
        CAST(floor(t.target) AS BIGINT) AS budget,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
            - d.size AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
    SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs_full FROM p)
SELECT doc_id, size, source_size, target,
    CAST(epochs_full * size + greatest(0, least(budget - epochs_full * source_size - before, size)) AS BIGINT) AS taken
FROM e
"""


@llm_query("op6_mix_sources", MIX_SQL)
def _(spark, sf_dir):
    return mix_plan(table(spark, sf_dir, "documents")).drop("epochs")


@llm_query("op7_byte_shards")
def _(spark, sf_dir):
    return byte_shards(table(spark, sf_dir, "documents"))


HOSTS_SQL = r"""
WITH p AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
r(rule, rule_host, rule_path, says) AS (VALUES ('org/', 'org', '/', 'allow'),
    ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
    ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
m AS (
    SELECT p.*, (SELECT arg_max({'rule': rule, 'says': says}, length(rule)) FROM r
        WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)) AS hit
    FROM p),
h0 AS (
    SELECT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS labels,
        CAST(count(*) FILTER (hit.says = 'allow') AS DOUBLE) AS good, CAST(count(hit.says) AS DOUBLE) AS n
    FROM m GROUP BY host),
h1 AS (
    SELECT *, CASE WHEN array_to_string(labels[-2:], '.') IN ('ac.uk', 'co.in', 'co.jp', 'co.kr', 'co.nz', 'co.uk',
        'co.za', 'com.au', 'com.br', 'com.cn', 'com.mx', 'com.tr', 'gov.uk', 'net.au', 'org.au', 'org.uk')
        THEN 2 ELSE 1 END AS k
    FROM h0),
h AS (
    SELECT host, good, n, array_to_string(labels[-k:], '.') AS suffix, array_to_string(labels[-k - 1:], '.') AS domain
    FROM h1),
d AS (SELECT suffix, domain, sum(good) AS good, sum(n) AS n FROM h GROUP BY suffix, domain),
s AS (
    SELECT suffix, sum(good) AS good, sum(n) AS n FROM d GROUP BY suffix),
sp AS (SELECT *, (SELECT (sum(good) + 3.0) / (sum(n) + 4.0) FROM s) AS m0 FROM s),
sk AS (
    SELECT CASE WHEN sum(n * m0 * (1 - m0)) > sum(m0 * (1 - m0)) THEN greatest(1.0, least(1000.0, 1 / greatest(
        (sum(n * (good / n - m0) ** 2) - sum(m0 * (1 - m0))) / (sum(n * m0 * (1 - m0)) - sum(m0 * (1 - m0))), 1e-6) - 1))
        ELSE 4.0 END AS k FROM sp WHERE n > 0),
sq AS (SELECT suffix, (good + k * m0) / (n + k) AS m0 FROM sp, sk),
dp AS (SELECT d.*, m0 FROM d JOIN sq USING (suffix)),
dk AS (
    SELECT CASE WHEN sum(n * m0 * (1 - m0)) > sum(m0 * (1 - m0)) THEN greatest(1.0, least(1000.0, 1 / greatest(
        (sum(n * (good / n - m0) ** 2) - sum(m0 * (1 - m0))) / (sum(n * m0 * (1 - m0)) - sum(m0 * (1 - m0))), 1e-6) - 1))
        ELSE 4.0 END AS k FROM dp WHERE n > 0),
dq AS (SELECT domain, (good + k * m0) / (n + k) AS m0 FROM dp, dk),
hp AS (SELECT h.*, m0 FROM h JOIN dq USING (domain)),
hk AS (
    SELECT CASE WHEN sum(n * m0 * (1 - m0)) > sum(m0 * (1 - m0)) THEN greatest(1.0, least(1000.0, 1 / greatest(
        (sum(n * (good / n - m0) ** 2) - sum(m0 * (1 - m0))) / (sum(n * m0 * (1 - m0)) - sum(m0 * (1 - m0))), 1e-6) - 1))
        ELSE 4.0 END AS k FROM hp WHERE n > 0),
hq AS (SELECT host, good + k * m0 AS a, n - good + k * (1 - m0) AS b FROM hp, hk),
v AS (SELECT host, a / (a + b) - sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) >= 0.35 AS trusted FROM hq)
SELECT page_id, m.host, path, hit.rule AS rule,
    coalesce(hit.says, CASE WHEN trusted THEN 'allow' ELSE 'block' END) AS verdict
FROM m JOIN v ON m.host = v.host
"""


@llm_query("op10_host_reputation", HOSTS_SQL)
def _(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


@llm_query("op2_robust_outliers")
def _(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents"))


@llm_query("op9_quote_threads")
def _(spark, sf_dir):
    return reply_ordered(table(spark, sf_dir, "conversations"))


@llm_query("op5_simhash_components")
def _(spark, sf_dir):
    return near_duplicate_components(table(spark, sf_dir, "documents"))


@llm_query("op8_spaced_seeds")
def _(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@llm_query("op3_repeated_passages")
def _(spark, sf_dir):
    return repeat_digests(table(spark, sf_dir, "documents"))


@llm_query("op4_nb_ngram_toxicity")
def _(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@llm_query("op1_backoff_automaton")
def _(spark, sf_dir):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm_scores(table(spark, sf_dir, "documents"), held)


SEARCH_SQL = r"""
WITH t AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM d, c),
w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM f, c GROUP BY term),
q AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
qt AS (SELECT item_id, term, count(*) AS repeats FROM q GROUP BY item_id, term),
s AS (
    SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM qt JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@llm_query("op11_length_strata", SEARCH_SQL)
def _(spark, sf_dir):
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


@llm_query("op12_exact_whitening")
def _(spark, sf_dir):
    return whitened_rows(table(spark, sf_dir, "embeddings"))


@llm_query("op13_piece_agenda")
def _(spark, sf_dir):
    import public_tokenizers

    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
