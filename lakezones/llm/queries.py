"""The operators as queries on the given tables, and SQL that gives the same rows.

Queries without SQL are compared with the tokenizer libraries or a brute-force version in the
tests: token counts, encodings and token files (a library in SQL would be needed), fingerprints
(the hash function) and the classifier (the fitted model).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.llm import (
    bpe,
    fingerprints,
    hard_negatives,
    license_scans,
    manifest,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    token_counts,
    token_files,
    url_filters,
    warc,
)
from lakezones.llm.shipping import prepared

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 4096
RULES = tuple(
    map(
        url_filters.parse_rule,
        ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"),
    )
)


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if it has any."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = lambda spark, folder: function(prepared(spark), folder.rstrip("/"))
        if oracle:
            ORACLES[function.__name__] = oracle.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Java and RE2 read these patterns alike; quotes are doubled for SQL.
HOST_SQL = "translate(regexp_extract({0}, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PATH_SQL = "regexp_extract({0}, '://[^/?#]*([^?#]*)', 1)"


@query(r"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS m
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * m >= 80 * (an + bn - m)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS bigint) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM sets LEFT JOIN least ON doc_id = a
""")
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=4, similarity=80)


@query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"), TOKEN_LIMIT)


@query()
def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


@query()
def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def _rule_sql(host: str, path: str, part: str) -> str:
    """The text or verdict of the longest fitting rule."""
    ordered = sorted(RULES, key=lambda rule: -len(rule.text))
    fits = "({0} = '{1}' OR ends_with({0}, '.{1}')) AND starts_with({2}, '{3}')"
    cases = " ".join(
        f"WHEN {fits.format(host, rule.host, path, rule.path)} THEN '{getattr(rule, part)}'" for rule in ordered
    )
    return f"CASE {cases} END"


def _tag_sql(tag: str, address: str) -> str:
    """The address in the first such tag that has one."""
    tag, address = (pattern.replace("'", "''") for pattern in (tag, address))
    found = "trim(concat(" + ", ".join(f"regexp_extract(one, '{address}', {group})" for group in (1, 2, 3)) + "))"
    for entity, character in url_filters.ENTITIES.items():
        found = "replace({}, '{}', '{}')".format(found, entity, character.replace("'", "''"))
    return f"list_filter(list_transform(regexp_extract_all(coalesce(html, ''), '{tag}'), lambda one: {found}), lambda one: one <> '')[1]"


def _dots_sql(path: str) -> str:
    """The path without dot steps."""
    steps = f"string_split({path}, '/')"
    way = (
        f"list_reduce(list_prepend([''], list_transform({steps}[2:], lambda s: [s])), lambda w, x:"
        " CASE WHEN x[1] = '.' THEN w WHEN x[1] = '..' THEN w[1:greatest(len(w) - 1, 1)] ELSE list_concat(w, x) END)"
    )
    plain = f"array_to_string({way}, '/') || CASE WHEN {steps}[-1] IN ('.', '..') THEN '/' ELSE '' END"
    return f"CASE WHEN regexp_matches({path}, '{url_filters.DOTS}') THEN {plain} ELSE {path} END"


def _node_sql(url: str) -> str:
    query = f"regexp_extract({url}, '://[^/?#]*[^?#]*(\\?[^#]*)', 1)"
    return f"{HOST_SQL.format(url)} || {_dots_sql(PATH_SQL.format(url))} || {query}"


@query(f"""
WITH RECURSIVE
found AS (
  SELECT url, {_tag_sql(url_filters.CANONICAL_TAG, url_filters.LINK_ADDRESS)} AS t FROM pages
  UNION ALL SELECT url, {_tag_sql(url_filters.REFRESH_TAG, url_filters.REFRESH_ADDRESS)} FROM pages),
sited AS (SELECT *, split_part(url, '://', 1) AS scheme, {HOST_SQL.format("url")} AS host, {PATH_SQL.format("url")} AS path
  FROM found WHERE t <> '' AND contains(url, '://')),
resolved AS (SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
  WHEN starts_with(t, '//') THEN scheme || ':' || t
  WHEN starts_with(t, '/') THEN scheme || '://' || host || t
  WHEN starts_with(t, '#') OR starts_with(t, '?') THEN scheme || '://' || host || path || t
  ELSE scheme || '://' || host || CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*/)?') ELSE '/' END || t END AS target
  FROM sited),
targets AS (SELECT url, regexp_extract(target, '^.*?://[^/?#]*') || ({_dots_sql(PATH_SQL.format("target"))}) || regexp_extract(target, '^.*?://[^?#]*(.*)$', 1) AS target
  FROM resolved),
named AS (SELECT {_node_sql("url")} AS a, {_node_sql("target")} AS b, url, target FROM targets),
links AS (SELECT a, b FROM named WHERE a <> b UNION SELECT b, a FROM named WHERE a <> b),
reach AS (SELECT a, a AS b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
own AS (SELECT DISTINCT a, {_rule_sql(HOST_SQL.format("url"), PATH_SQL.format("url"), "verdict")} AS verdict FROM named
  UNION SELECT b, {_rule_sql(HOST_SQL.format("target"), PATH_SQL.format("target"), "verdict")} FROM named),
given AS (SELECT reach.a, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
  FROM reach JOIN own ON reach.b = own.a GROUP BY reach.a),
judged AS (SELECT page_id, {HOST_SQL.format("coalesce(url, '')")} AS host, {PATH_SQL.format("coalesce(url, '')")} AS path,
  CASE WHEN contains(url, '://') THEN {_node_sql("url")} END AS node FROM pages)
SELECT page_id, host, path, {_rule_sql("host", "path", "text")} AS rule,
  coalesce({_rule_sql("host", "path", "verdict")}, given.verdict, 'allow') AS verdict
FROM judged LEFT JOIN given ON node = given.a
""")
def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, folder, "pages"), RULES)


def _line_sql(line: str) -> str:
    """Whether a line fails a rule."""
    count = "(length({0}) - length(translate({0}, '{1}', '')))"
    words = rf"len(regexp_extract_all({line}, '[^\x20\x09-\x0D]+'))"
    separators = count.format(line, quality_rules.SEPARATORS)
    letters = rf"length(regexp_replace({line}, '[\x20\x09-\x0D]+', '', 'g'))"
    closing = quality_rules.CLOSING.replace("'", "''")
    last = rf"right(regexp_replace({line}, '[\x20\x09-\x0D]+\z', ''), 1)"
    return f"""(({separators} >= 2 AND {separators} * 4 >= {words})
    OR regexp_matches(lower({line}), '{"|".join(quality_rules.BOILERPLATE)}')
    OR {count.format(line, quality_rules.SYMBOLS)} * 100 > {letters} * {quality_rules.MAX_LINE_SYMBOLS}
    OR (NOT contains('{closing}', {last}) AND {words} < {quality_rules.MIN_OPEN_WORDS}))"""


@query(rf"""
WITH parts AS (SELECT doc_id, {WORDS_SQL} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
spread AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM parts),
windows AS (SELECT doc_id, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM spread WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice CROSS JOIN range(3) r(k) GROUP BY doc_id),
counted AS (SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(length(array_to_string(w, '')) AS bigint) AS word_chars,
  CAST(length(array_to_string(w, '')) - length(translate(array_to_string(w, ''), '{quality_rules.SYMBOLS}', '')) AS bigint) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  CAST(coalesce(list_sum(list_transform(list_filter(lines, lambda l: {_line_sql("l")}),
    lambda l: len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')))), 0) AS bigint) AS n_lost_words
  FROM parts LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_lost_words * 100 <= n_words * {quality_rules.MAX_LOST} AS kept FROM judged
""")
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_quality_rules(table(spark, folder, "documents"))


@query()
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(f"""
WITH RECURSIVE
sizes AS (SELECT doc_id, source, CAST(len({WORDS_SQL}) AS bigint) AS size,
  md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS varchar), 'null:' || md5(coalesce(text, '')))) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS bigint) AS source_size,
  [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sizes GROUP BY source),
levels AS (SELECT 0 AS round, CAST(0 AS double) AS level UNION ALL
  SELECT round + 1, (SELECT CAST(sum(source_size) - coalesce(sum(source_size * 3) FILTER (source_size * 3 < weight * l.level), 0) AS double)
    / sum(weight) FILTER (source_size * 3 >= weight * l.level) FROM sources)
  FROM levels l WHERE round <= (SELECT count(*) FROM sources)),
filled AS (SELECT *, least(weight * (SELECT level FROM levels ORDER BY round DESC LIMIT 1), CAST(source_size * 3 AS double)) AS target FROM sources),
needs AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS bigint) ELSE 0 END AS whole FROM filled),
ordered AS (SELECT s.*, source_size, target, whole, target - whole * source_size AS need,
  sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
  FROM sizes s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target, CAST(size * copies AS bigint) AS taken, CAST(copies AS bigint) AS copies
FROM (SELECT *, whole + CASE WHEN need > 0 AND key <= coalesce(max(CASE WHEN middle <= need THEN key END) OVER (PARTITION BY source), '')
  THEN 1 ELSE 0 END AS copies FROM ordered)
""")
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


@query()
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


@query("""
WITH payloads AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS bigint) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1),
named AS (SELECT *, first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM payloads LEFT JOIN firsts USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to FROM named
""")
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query(f"""
WITH used AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS bigint) AS label,
  list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * CAST(x AS double))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS bigint) AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {hard_negatives.POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS int) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {hard_negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.HIGH} * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= {hard_negatives.NEGATIVES}
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(items.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


def _license_sql() -> str:
    """Every text block against every template, by counting the words that they share."""
    between, width = license_scans.BETWEEN, license_scans.block_width(license_scans.TEMPLATES)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"list_filter(string_split_regex({{0}}, '{between}+'), lambda w: w <> '')"
    phrases = "|".join(license_scans.PHRASES)
    templates = ", ".join(
        f"('{label}', {sorted(set(license_scans.template_words(text)))})" for label, text in license_scans.TEMPLATES
    )
    joined = "' ' || array_to_string(w, '  ') || ' '"
    place = "len(string_split({0}, '  ')) - 1"
    step = width // 2
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, {lower} AS t FROM documents),
listed AS (SELECT *, {words.format("t")} AS w FROM texts),
spaced AS (SELECT *, {joined} AS s FROM listed),
based AS (SELECT r, doc_id, CAST(len(w) AS bigint) AS n_words, list_filter(range(1, len(w) + 1), lambda i:
    {" OR ".join("(" + " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split())) + ")" for phrase in license_scans.PHRASES)}) AS places,
  list_filter([{", ".join(f"CASE WHEN contains(s, ' {phrase.replace(' ', '  ')} ') THEN '{label}' END" for phrase, label in license_scans.PHRASES.items())}],
    lambda l: l IS NOT NULL) AS base FROM spaced),
paragraphs AS (SELECT r, unnest(string_split_regex(t, '{license_scans.PARAGRAPH_END}')) AS p FROM texts),
long AS (SELECT r, {words.format("p")} AS w FROM paragraphs),
blocks AS (SELECT r, list_distinct(w[i * {step} + 1 : i * {step} + {width}]) AS b
  FROM (SELECT r, w, unnest(range(CAST(greatest(1, ceil((len(w) - {width}) / {step}) + 1) AS bigint))) AS i FROM long)),
templates(label, words) AS (VALUES {templates}),
held AS (SELECT r, label, len(list_intersect(b, words)) AS shared, len(words) AS size FROM blocks, templates),
found AS (SELECT r, list(DISTINCT label) AS method, max(shared / size) AS share FROM held
  WHERE shared * 100 >= size * {license_scans.CONTAINMENT} GROUP BY r),
labelled AS (SELECT *, list_sort(list_distinct(base)) AS b, list_sort(coalesce(method, [])) AS m FROM based LEFT JOIN found USING (r))
SELECT doc_id, n_words, CAST(len(places) AS bigint) AS n_base, CAST(list_min(places) - 1 AS bigint) AS first_word,
  CAST(list_max(places) - 1 AS bigint) AS last_word, array_to_string(b, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(b, m))), ',') AS labels,
  CAST(CASE WHEN len(places) > 0 THEN 1 ELSE coalesce(share, 0) END AS double) AS score, array_to_string(m, ',') AS method_labels
FROM labelled"""


@query(_license_sql())
def op12_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_scans.scan_licenses(table(spark, folder, "documents"))


_FIELD_SQL = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS varchar)) || ':' || {0} END"
_LEAF_SQL = "sha256(" + " || ".join(_FIELD_SQL.format(name) for name in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS varchar), ''),"
    " lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),"
    " lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, (a % 2) * 3988292384) END), 4294967295)"
)


@query(f"""
WITH RECURSIVE
hashed AS (SELECT lang, doc_id, {_LEAF_SQL.replace("{text}", "text")} AS leaf,
  CASE WHEN {_CRC_SQL} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found,
  source, n_chars FROM documents),
leaves AS (SELECT lang, doc_id, leaf, {_LEAF_SQL.replace("{text}", "found")} AS tampered,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
inner_nodes AS (SELECT lang, 0 AS level, place, leaf AS node, n FROM leaves
  UNION ALL SELECT lang, level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), (n + 7) // 8 FROM inner_nodes
    WHERE n > 1 GROUP BY lang, level, place // 8, n),
subroots AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
top_nodes AS (SELECT 0 AS level, place, subroot AS node, n FROM subroots
  UNION ALL SELECT level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), (n + 7) // 8 FROM top_nodes
    WHERE n > 1 GROUP BY level, place // 8, n),
inner_steps AS (SELECT l.lang, l.place, m.level,
    coalesce(string_agg(m.node, '' ORDER BY m.place) FILTER (m.place < l.place // CAST(pow(8, m.level) AS bigint)), '') AS before,
    coalesce(string_agg(m.node, '' ORDER BY m.place) FILTER (m.place > l.place // CAST(pow(8, m.level) AS bigint)), '') AS behind
  FROM leaves l JOIN inner_nodes m ON l.lang IS NOT DISTINCT FROM m.lang AND m.n > 1
    AND m.place // 8 = l.place // CAST(pow(8, m.level + 1) AS bigint) GROUP BY ALL),
top_steps AS (SELECT l.lang, m.level,
    coalesce(string_agg(m.node, '' ORDER BY m.place) FILTER (m.place < l.place // CAST(pow(8, m.level) AS bigint)), '') AS before,
    coalesce(string_agg(m.node, '' ORDER BY m.place) FILTER (m.place > l.place // CAST(pow(8, m.level) AS bigint)), '') AS behind
  FROM subroots l JOIN top_nodes m ON m.n > 1 AND m.place // 8 = l.place // CAST(pow(8, m.level + 1) AS bigint) GROUP BY l.lang, l.place, m.level),
steps AS (SELECT lang, place, level, before, behind FROM inner_steps
  UNION ALL SELECT l.lang, l.place, 100 + t.level, t.before, t.behind FROM leaves l JOIN top_steps t ON l.lang IS NOT DISTINCT FROM t.lang),
paths AS (SELECT lang, place, sha256(string_agg(before || behind, '' ORDER BY level)) AS proof_sha256,
  list({{'before': before, 'behind': behind}} ORDER BY level) AS path FROM steps GROUP BY lang, place),
folds AS (SELECT l.lang, l.place, tampered AS node, coalesce(path, []) AS path, 1 AS step FROM leaves l
    LEFT JOIN paths p ON l.lang IS NOT DISTINCT FROM p.lang AND l.place = p.place
  UNION ALL SELECT lang, place, sha256(path[step].before || node || path[step].behind), path, step + 1 FROM folds WHERE step <= len(path))
SELECT l.lang, l.doc_id, l.place AS position, leaf, subroot, t.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
  f.node AS folded_root, f.node = t.node AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN top_nodes t ON t.n = 1
JOIN folds f ON f.lang IS NOT DISTINCT FROM l.lang AND f.place = l.place AND f.step = len(f.path) + 1
LEFT JOIN paths p ON l.lang IS NOT DISTINCT FROM p.lang AND l.place = p.place
""")
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return manifest.manifest(docs, manifest.lower_cased(docs))
