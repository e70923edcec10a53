"""The registered queries of the corpus operators, over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    chosen_path,
    conversation_repair,
    decontaminate,
    language,
    licenses,
    pieces_codec,
    projection_forest,
    sorted_projections,
    spelling,
    sql,
    suffix_dedup,
    token_counts,
    tool_calls,
    url_filter,
)
from tablewright.llm.common import LOWER, UPPER

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
CALL_SCHEMAS = {
    name: {"type": "object", "required": ["prompt"], "additionalProperties": False,
           "properties": {"prompt": {"type": "string", "minLength": 1},
                          "after": {"type": "string", "pattern": r"^\$call:"}}}
    for name in ("reply", "configure")
}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _license_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    lines = "lower(replace(coalesce(text, ''), '&', ' and '))"
    lines = f"regexp_replace(replace({lines}, '©', ' copyright '), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for old, new in licenses.SPELLINGS:
        lines = f"replace({lines}, '{old}', '{new}')"
    lines = f"regexp_replace({lines}, '{licenses.SENTENCE}', '{licenses.KEPT}\\1', 'g')"
    lines = f"replace(regexp_replace({lines}, '{licenses.NOTICE_LINE}', '', 'g'), '{licenses.KEPT}', '')"
    unit = "trim(regexp_replace({0}, '[ \\n]+', ' ', 'g'))"
    digest = "CASE WHEN " + unit + " <> '' THEN sha256(" + unit + ") END"
    known = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in licenses.KNOWN)
    whole = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in licenses.WHOLE_TEXTS)
    return f"""
        WITH known_texts(license_id, text) AS (VALUES {known}),
        known AS (SELECT {digest.format('lines')} AS digest, min(license_id) AS license_id
                  FROM (SELECT license_id, {lines} AS lines FROM known_texts) GROUP BY 1
                  UNION SELECT digest, license_id FROM (VALUES {whole}) w(license_id, digest)),
        units AS (SELECT doc_id, {lines} AS lines FROM documents),
        split AS (SELECT doc_id, {digest.format('line')} AS digest
                  FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM units)),
        notices AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS names
                    FROM split JOIN known USING (digest) GROUP BY doc_id),
        kept AS (SELECT doc_id, count(digest) AS n_lines FROM split GROUP BY doc_id)
        SELECT u.doc_id, {digest.format('u.lines')} AS digest, license_id, n_lines, coalesce(n, 0) AS n_notices,
               coalesce(names, '') AS notices
        FROM units u LEFT JOIN known k ON k.digest = {digest.format('u.lines')}
        LEFT JOIN kept USING (doc_id) LEFT JOIN notices USING (doc_id)"""


@query(_license_sql())
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(given(spark, folder, "documents"), licenses.known_digests(spark))


@query()
def op2_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with its ids, its round trip, and the library's ids beside them."""
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    coded = pieces_codec.encode_and_check(given(spark, folder, "documents"), model, with_library=True)
    return coded.withColumn("ids_sha256", F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")), 256))  # comma-joined


_WORDS = (
    "[x FOR x IN string_split_regex(translate(coalesce(text, ''), '{0}', '{1}'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> '']").format(UPPER, LOWER)


@query(f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
                  unnest([array_to_string(w[s:s + least(len(w), 10) - 1], ' ')
                          FOR s IN range(1, greatest(len(w) - 10, 0) + 2)]) AS window_text
           FROM i WHERE len(w) > 0),
    lengths AS (SELECT DISTINCT n FROM iw),
    dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s,
                  unnest([array_to_string(w[s:s + n - 1], ' ') FOR s IN range(1, len(w) - n + 2)]) AS window_text
           FROM d, lengths WHERE len(w) >= n),
    hits AS (SELECT doc_id, dw.n, s, item_id FROM dw JOIN iw USING (n, window_text)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
              FROM hits GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(given(spark, folder, "documents"), given(spark, folder, "benchmark"))


@query()
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents")
    counted = token_counts.with_token_counts(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return token_counts.length_histogram(counted)


@query()
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = language.with_hold_out(given(spark, folder, "documents").select("doc_id", "lang", "text"))
    model = language.fit(docs.filter("NOT held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sorted_projections.near_duplicates(given(spark, folder, "embeddings"))


@query("""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, encode(coalesce(text, '')) AS b FROM documents),
    h AS (SELECT doc_id, lower(hex(b)) AS x, octet_length(b) AS n FROM d),
    w AS (SELECT doc_id, p, md5(substr(x, CAST(2 * p + 1 AS BIGINT), 400)) AS k
          FROM (SELECT doc_id, x, unnest(range(0, n - 199)) AS p FROM h WHERE n >= 200)),
    twice AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
    starts AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM w JOIN twice USING (k)),
    marked AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 200 THEN 1 ELSE 0 END)
                   OVER (PARTITION BY doc_id ORDER BY p) AS g FROM starts),
    spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 200 AS e FROM marked GROUP BY doc_id, g),
    edges AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS upto FROM spans),
    kept AS (SELECT doc_id, sum(e - a) AS n_removed, count(*) AS n_spans, max(e) AS last_end,
                    string_agg(substr(x, CAST(2 * upto + 1 AS BIGINT), CAST(2 * (a - upto) AS BIGINT)), '' ORDER BY a) AS head
             FROM edges JOIN h USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(CASE WHEN n_removed IS NULL THEN x
                             ELSE head || substr(x, CAST(2 * last_end + 1 AS BIGINT)) END)) AS kept_sha256
    FROM h LEFT JOIN kept USING (doc_id)""")
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove_repeats(given(spark, folder, "documents")))


def _url_sql() -> str:
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    levels = [("suffix", "suffix"), ("domain", "suffix, domain"), ("server", "suffix, domain, server")]
    sums, strengths, joins, rate, whole = [], [], [], "prior", ""
    for level, keys in levels:
        sums.append(f"{level}_sums AS (SELECT {keys}, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY {keys})")
        strengths.append(f"""{level}_s AS (
            SELECT CASE WHEN g < 2 OR w <= g THEN 10.0 WHEN bt <= ins THEN 1000.0
                        ELSE least(1000.0, greatest(1.0, (bt + (sz - 1) * ins) / (bt - ins) - 1)) END AS strength
            FROM (SELECT g, w, greatest(0, r - b * b / nullif(w, 0)) / nullif(g - 1, 0) AS bt,
                         (b - r) / nullif(w - g, 0) AS ins, (w - q / nullif(w, 0)) / nullif(g - 1, 0) AS sz
                  FROM (SELECT CAST(count(*) AS DOUBLE) AS g, CAST(coalesce(sum(n), 0) AS DOUBLE) AS w,
                               CAST(coalesce(sum(k), 0) AS DOUBLE) AS b, CAST(coalesce(sum(n * n), 0) AS DOUBLE) AS q,
                               coalesce(sum(k * k / CAST(n AS DOUBLE)), 0.0) AS r
                        FROM {level}_sums WHERE n > 0)))""")
        joins.append(f"JOIN {level}_sums ON " + " AND ".join(f"{level}_sums.{x} = h.{x}" for x in keys.split(", ")))
        strength = f"(SELECT strength FROM {level}_s)"
        whole = f"({strength} + {level}_sums.n)"
        rate = f"(({strength} * {rate} + {level}_sums.k) / {whole})"
    long = ", ".join(f"'{x}'" for x in url_filter.LONG_SUFFIXES)
    cases = [
        (h + p, v, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')")
        for h, p, v in sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), r))]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for r, _, c in cases) + " END"
    fixed = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for _, v, c in cases) + " END"
    return f"""
        WITH parsed AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, rest
            FROM (SELECT page_id, coalesce({rest}, '') AS rest FROM pages)),
        keyed AS (SELECT *, TRY_CAST(nullif(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1), '') AS BIGINT) AS doc_id
                  FROM parsed),
        worst AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
                  FROM labels GROUP BY doc_id),
        counted AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k
                    FROM keyed LEFT JOIN worst USING (doc_id) GROUP BY host),
        served AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS server FROM counted),
        labelled AS (SELECT *, string_split(server, '.') AS l, regexp_matches(server, '^[0-9.]+$') AS digits FROM served),
        tails AS (SELECT *, array_to_string(l[-2:], '.') AS two, array_to_string(l[-3:], '.') AS three FROM labelled),
        hosts AS (SELECT host, n, k, server,
                         CASE WHEN digits THEN server WHEN two IN ({long}) AND len(l) > 2 THEN three ELSE two END AS domain,
                         CASE WHEN digits THEN '' WHEN two IN ({long}) AND len(l) > 2 THEN two ELSE l[-1] END AS suffix
                  FROM tails),
        {", ".join(sums)}, {", ".join(strengths)},
        rated AS (
            SELECT host, {rate} AS rate, {whole} AS whole
            FROM (SELECT *, (SELECT (sum(k) + 1) / CAST(sum(n) + 2 AS DOUBLE) FROM hosts) AS prior FROM hosts) h
            {" ".join(joins)})
        SELECT page_id, host, path, {rule} AS rule,
               coalesce({fixed}, CASE WHEN rate - 1.64 * sqrt(rate * (1 - rate) / (whole + 1)) > 0.5
                                      THEN 'block' ELSE 'allow' END) AS verdict,
               round(rate, 6) AS bad_rate, round(rate - 1.64 * sqrt(rate * (1 - rate) / (whole + 1)), 6) AS bound
        FROM parsed JOIN rated USING (host)"""


@query(_url_sql())
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A page is labelled as the document it was made from, whose number ends its path."""
    labels = given(spark, folder, "labels")
    outcomes = labels.select(
        F.col("doc_id").alias("key"), F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0).alias("bad"))
    number = F.regexp_extract(url_filter.url_path(F.col("url")), r"/([0-9]+)[^/]*/?$", 1)
    key = F.expr("try_cast(nullif(number, '') AS BIGINT)")
    pages = given(spark, folder, "pages").select("page_id", "url", number.alias("number"))
    return url_filter.filter_urls(pages, outcomes, URL_RULES, key)


@query()
def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.similarity_join(given(spark, folder, "documents")).drop("mark")


@query()
def op10_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls that messages hold as JSON, and each plain exchange of turns as a call and its result."""
    messages = given(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    calls, results = tool_calls.exchanges(messages)
    calls = calls.unionByName(tool_calls.calls_in_messages(messages))
    results = results.unionByName(tool_calls.results_in_messages(messages))
    return tool_calls.link_conversations(calls, results, CALL_SCHEMAS)


def damaged(messages: DataFrame) -> DataFrame:
    """Messages with faults that crc32 of `conv_id:turn` deals out; null counts as one space, `copies` as so many rows."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    text, role, fault = F.coalesce("text", space), F.coalesce("role", space), F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return messages.withColumn("fault", F.crc32(F.concat(conv, F.lit(":"), turn)) % 20).filter("fault <> 0").select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("copies"))


@query(sql.repairs())
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given_rows = given(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows, findings = conversation_repair.repair(damaged(given_rows))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = given_rows.select("conv_id").distinct()
    for part in (findings, conversation_repair.digests(rows)):
        part = part.withColumnRenamed("conv_id", "own")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query()
def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every hundredth vector against all others."""
    rows = given(spark, folder, "embeddings").select("vec_id", "embedding")
    return projection_forest.nearest(rows, "vec_id % 100 = 0")


DAMAGED_WORDS = 199  # one in so many occurrences of a word loses a letter


@query(sql.spellings(DAMAGED_WORDS, spelling.LEAST_LENGTH, spelling.LEAST_COUNT, spelling.RATIO))
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_spellings(spelling.word_counts(given(spark, folder, "documents"), DAMAGED_WORDS))
