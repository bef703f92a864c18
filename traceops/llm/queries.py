"""The operators bound to the test tables: one query each, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceops.llm import conversation_repair, decontam, html_text, jaccard, line_dedup, neighbour_graph, packing, phrases, quality, secret_scan, token_files, toxicity, url_filter
from traceops.llm.storage import shared_folder

ALLOW = [("org", "/"), ("com", "/fr/")]
BLOCK = [("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/")]


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_token_files(spark, d):
    path = shared_folder(spark, "tokens")
    token_files.write_tokens(_table(spark, d, "documents"), path)
    return token_files.token_digests(spark, path)


def op2_page_text(spark, d):
    return html_text.extract_pages(_table(spark, d, "pages"))


def op3_packing(spark, d):
    return packing.pack_documents(_table(spark, d, "documents"))


def op4_quality(spark, d):
    return quality.score_quality(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op5_line_dedup(spark, d):
    """doc_id, text that is left, n_removed, removed: start:length of each passage cut, in order."""
    rows = line_dedup.dedup_lines(_table(spark, d, "documents"))
    return rows.select("doc_id", "text", F.size("removed").cast("bigint").alias("n_removed"), F.array_join(F.transform(
        "removed", lambda p: F.concat_ws(":", p["start"].cast("string"), p["length"].cast("string"))), " ").alias("removed"))


def op6_toxicity(spark, d):
    return toxicity.score_toxicity(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op7_url_rules(spark, d):
    return url_filter.filter_urls(_table(spark, d, "pages"), ALLOW, BLOCK)


def op8_decontamination(spark, d):
    return decontam.find_contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op9_nearest(spark, d):
    return neighbour_graph.nearest(_table(spark, d, "embeddings"), lambda i: i % 50 == 0)


def op10_jaccard(spark, d):
    return jaccard.jaccard_components(_table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_secrets(spark, d):
    return secret_scan.secret_digests(secret_scan.find_secrets(_table(spark, d, "documents")))


def damaged(rows):
    """Conversations with faults made by the hash of `conv_id:turn`: rows dropped, emptied, cut, repeated or given to the user."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return (rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).filter("fault != 0")
            .withColumns({"role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role")),
                          "text": F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
                          .otherwise(F.col("text")),
                          "copy": F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
            .select("conv_id", "turn", "role", "text"))


def op12_conversations(spark, d):
    rows = _table(spark, d, "conversations")
    return conversation_repair.repair_report(rows.select("conv_id"), damaged(rows))


def op13_phrases(spark, d):
    return phrases.collocations(_table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_page_text, op3_packing, op4_quality, op5_line_dedup, op6_toxicity,
                                   op7_url_rules, op8_decontamination, op9_nearest, op10_jaccard, op11_secrets,
                                   op12_conversations, op13_phrases)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def _secret_rules(rules):
    """Matches of each rule and what lies between them, which says where they are."""
    return "\n    UNION ALL ".join(
        f"""SELECT nr, {place} AS place, '{r.kind}' AS kind, '{r.kind}' IN ({", ".join(f"'{b.kind}'" for b in secret_scan.BASE)}) AS base,
           regexp_extract_all(text, '{p}') AS found, regexp_extract_all(text, '{p}', {1 + r.head.count("(")}) AS tails,
           string_split_regex(text, '{p}') AS between, {r.least} AS least FROM texts"""
        for place, r in enumerate(rules) for p in [f"{r.head}({r.tail})".replace("'", "''")])


def _inserts(steps):
    """The step of inserting a user, then an assistant, before the next row."""
    for states, target, message in (("(0, 1, 3)", 2, "user:"), ("(2)", 3, "assistant:")):
        steps = f"""(SELECT c, n, x.state, min(x.best) AS best FROM (
                SELECT c, n, unnest(CASE WHEN state IN {states} THEN [{{'state': state, 'best': best}}, {{'state': {target}, 'best':
                       {{'cost': best.cost + 3, 'audit': best.audit || 'I', 'kept': list_append(best.kept, '{message}')}}}}]
                       ELSE [{{'state': state, 'best': best}}] END) AS x FROM {steps}) GROUP BY ALL)"""
    return steps


ORACLES = {
    "op5_line_dedup": rf"""
WITH texts AS (SELECT row_number() OVER () AS nr, doc_id, text AS given, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, string_split_regex(text, '{line_dedup.UNIT_END}') AS pieces, regexp_extract_all(text, '{line_dedup.UNIT_END}') AS ends FROM texts),
numbered AS (SELECT *, unnest(range(1, len(pieces) + 1)) AS i FROM split),
units AS (SELECT nr, doc_id, i, pieces[i] || coalesce(ends[i], '') AS unit FROM numbered),
placed AS (
    SELECT nr, doc_id, i, length(unit) AS length, cast(sum(length(unit)) OVER (PARTITION BY nr ORDER BY i) AS BIGINT) - length(unit) AS start,
           trim(regexp_replace(translate(unit, '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS words
    FROM units),
worded AS (SELECT *, len(string_split(words, ' ')) AS n, row_number() OVER (PARTITION BY nr ORDER BY i) AS number FROM placed WHERE words <> ''),
ranked AS (
    SELECT *, coalesce(doc_id, 9223372036854775807) AS rank, min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY words) AS first,
           row_number() OVER (PARTITION BY nr, words ORDER BY i) AS copy
    FROM worded),
repeats AS (SELECT *, number - row_number() OVER (PARTITION BY nr ORDER BY i) AS run FROM ranked WHERE first < rank OR copy > 1),
runs AS (SELECT nr, min(start) AS start, max(start + length) AS stop FROM repeats GROUP BY nr, run HAVING sum(n) >= {line_dedup.RUN_WORDS}),
gaps AS (SELECT *, coalesce(lag(stop) OVER (PARTITION BY nr ORDER BY start), 0) AS before FROM runs),
cuts AS (
    SELECT nr, count(*) AS n_removed, string_agg(cast(start AS VARCHAR) || ':' || cast(stop - start AS VARCHAR), ' ' ORDER BY start) AS removed,
           string_agg(substr(text, before + 1, start - before), '' ORDER BY start) AS kept, max(stop) AS last
    FROM gaps JOIN texts USING (nr) GROUP BY nr)
SELECT doc_id, CASE WHEN cuts.nr IS NULL THEN given ELSE kept || substr(text, last + 1) END AS text, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed, '') AS removed
FROM texts LEFT JOIN cuts USING (nr)""",
    "op7_url_rules": f"""
WITH parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages),
rules(domain, start, verdict) AS (VALUES {", ".join([f"('{h}', '{p}', 'allow')" for h, p in ALLOW] + [f"('{h}', '{p}', 'block')" for h, p in BLOCK])}),
fits AS (
    SELECT page_id, host, path, domain || start AS rule, verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(domain || start) DESC NULLS LAST, length(domain) DESC) AS place
    FROM parts LEFT JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1""",
    "op10_jaccard": rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
    FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)""",
    "op11_secrets": f"""
WITH texts AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text FROM documents),
matches AS (
    {_secret_rules(secret_scan.BASE + secret_scan.MORE)}),
places AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches),
spans AS (
    SELECT nr, place, kind, base, length(found[i]) AS size,
           cast(list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM places WHERE length(tails[i]) >= least),
texted AS (SELECT *, kind || ':' || cast(start AS VARCHAR) || ':' || cast(start + size AS VARCHAR) AS span FROM spans),
digests AS (
    SELECT nr, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY start, place) FILTER (base) AS base, string_agg(span, ',' ORDER BY start, place) AS spans
    FROM texted GROUP BY nr)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN digests USING (nr)""",
    "op12_conversations": rf"""
WITH RECURSIVE convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
given AS (
    SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
               coalesce(cast(conversations.conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' '), ''), lambda x: ord(x)::BIGINT)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::BIGINT)),
                   lambda rest, i: CASE WHEN rest & 1 = 1 THEN xor(rest >> 1, 3988292384::BIGINT) ELSE rest >> 1 END)) AS crc
    FROM conversations JOIN convs ON conversations.conv_id IS NOT DISTINCT FROM convs.conv_id),
faulty AS (SELECT *, xor(crc, 4294967295::BIGINT) % 20 AS fault FROM given),
damaged AS (
    SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM faulty WHERE fault <> 0),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS n, substr(role, 1, 1) AS initial,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
    FROM damaged),
judged AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 THEN 'duplicate'
                   WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY c ORDER BY n) || initial AS pair
    FROM ordered),
steps AS (
    SELECT c, 0::BIGINT AS n, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'kept': []::VARCHAR[]}} AS best FROM convs
    UNION ALL
    SELECT c, n, move.state, min(move.best) AS best FROM (
        SELECT o.c, j.n, unnest(list_filter([
                   {{'state': state, 'best': {{'cost': best.cost + 4, 'audit': best.audit || 'D', 'kept': best.kept}}}},
                   {{'state': CASE WHEN state = 0 AND initial = 's' THEN 1 WHEN state <> 2 AND initial = 'u' THEN 2 WHEN state = 2 AND initial = 'a' THEN 3 ELSE -1 END,
                     'best': {{'cost': best.cost + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'audit': best.audit || 'K',
                              'kept': list_append(best.kept, role || ':' || text)}}}},
                   {{'state': CASE WHEN state = 2 THEN 3 ELSE 2 END,
                     'best': {{'cost': best.cost + 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'audit': best.audit || 'R',
                              'kept': list_append(best.kept, CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END || text)}}}}],
                   lambda x: x.state >= 0 AND (x.best.audit[-1:] = 'D' OR fault NOT IN ('blank', 'duplicate')))) AS move
        FROM {_inserts("steps")} o JOIN judged j ON j.c = o.c AND j.n = o.n + 1) GROUP BY ALL),
counted AS (
    SELECT c, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY c),
ends AS (
    SELECT c, min(best) AS best FROM {_inserts("(SELECT steps.* FROM steps LEFT JOIN counted USING (c) WHERE n = coalesce(rows, 0))")}
    WHERE state IN (0, 3) GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit, sha256(array_to_string(best.kept, chr(10))) AS repaired_sha256
FROM convs JOIN ends USING (c) LEFT JOIN counted USING (c)""",
    "op13_phrases": rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
texts AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
    {" UNION ALL ".join(f"SELECT lang, {k} AS size, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM texts" for k in (1, 2, 3))}),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, cast(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10),
parted AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
cuts AS MATERIALIZED (SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest FROM parted),
scored AS (
    SELECT c.lang, c.phrase, c.size, c.a, c.w, k, x.a AS l, y.a AS r, cast((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ones AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE size = 3),
around AS (SELECT lang, phrase, max(a) AS most FROM inner_ones GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN around USING (lang, phrase) WHERE 100 * coalesce(most, 0) < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
