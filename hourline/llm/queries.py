"""The operators bound to the given tables, next to SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline.llm import bpe, blocks, language, merkle, neighbours, packing, periods, quality, records, revisits, simhash, site_lines, toxicity
from hourline.llm.common import WS, held_out, table

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(language.training_rows(table(spark, sf_dir, "documents")))
    found = language.identify(_documents(spark, sf_dir), model, keep_text=False)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.record_digests(_documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), end_id=2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), end_id=0, size=1024)


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures derived from the pages: every page as a full response, and a revisit of it with one kind of validator.

    Page n is fetched at 10 n and revisited at 10 n + 5 under another spelling of its URL; each seventh revisit comes
    before its page, each fifth one carries a tag that does not fit.
    """
    n, sha = F.col("page_id"), F.sha2(F.coalesce("html", F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    modified = (n * 10).cast("string")
    full = pages.select(
        n.alias("id"), "url", (n * 10).alias("time"), F.lit("response").alias("kind"), tag.alias("etag"), modified.alias("last_modified"), sha.alias("digest"),
        F.create_map(F.lit("date"), modified, F.lit("etag"), tag, F.lit("content-length"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")).alias("headers"),
        F.col("html").alias("payload"),
    )
    own = F.when(n % 5 == 0, F.lit('"other"')).when(n % 3 == 0, F.concat(F.lit("W/"), tag)).when(n % 3 == 1, tag)
    spelled = F.concat(F.regexp_replace(F.col("url"), "^http(s?)://", "HTTP$1://www."), F.lit("#again"))
    at = (n * 10 + F.when(n % 7 == 0, -5).otherwise(5)).cast("long")
    revisit = pages.select(
        n.alias("id"), F.regexp_replace(spelled, r"://www\.www\.", "://www.").alias("url"), at.alias("time"), F.lit("revisit").alias("kind"),
        own.alias("etag"), F.when(n % 2 == 0, modified).alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("date"), at.cast("string"), F.lit("content-length"), F.lit("0"), F.lit("vary"), F.lit("accept")).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return full.unionByName(revisit)


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.select(
        F.col("id").alias("page_id"), "key", "status", F.col("source_id").alias("source_page_id"),
        F.array_join(lines, "\n").alias("headers"), F.sha2("payload", 256).alias("payload_sha256"),
    )


OP4_SQL = r"""
WITH pages_ AS (SELECT page_id AS n, url, html, '"' || md5(coalesce(html, '')) || '"' AS tag FROM pages),
captures AS (
  SELECT n AS id, url, n * 10 AS time, 'response' AS kind, tag AS etag, CAST(n * 10 AS VARCHAR) AS last_modified, html,
         CAST(coalesce(strlen(html), 0) AS VARCHAR) AS len FROM pages_
  UNION ALL
  SELECT n, regexp_replace(regexp_replace(url, '^http(s?)://', 'HTTP\1://www.') || '#again', '://www\.www\.', '://www.'),
         n * 10 + CASE WHEN n % 7 = 0 THEN -5 ELSE 5 END, 'revisit',
         CASE WHEN n % 5 = 0 THEN '"other"' WHEN n % 3 = 0 THEN 'W/' || tag WHEN n % 3 = 1 THEN tag END,
         CASE WHEN n % 2 = 0 THEN CAST(n * 10 AS VARCHAR) END, NULL, NULL FROM pages_),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '(?i)^https?://(www\.)?', '') AS b FROM captures),
hosts AS (SELECT *, regexp_extract(b, '^[^/?]*', 0) AS h FROM bare),
keyed AS (SELECT * EXCLUDE (b, h), regexp_replace(lower(h), ':(80|443)$', '') || regexp_replace(regexp_replace(
  regexp_replace(substr(b, length(h) + 1), '([?&])(utm_[a-z]+=[^&]*&?)+', '\1'), '[?&]+$', ''), '/+$', '') AS key FROM hosts),
full_ AS (SELECT * FROM keyed WHERE kind = 'response'), revisit_ AS (SELECT * FROM keyed WHERE kind = 'revisit'),
joined AS (SELECT r.id, r.key, r.time, r.etag, r.last_modified, f.id AS fid, f.etag AS fetag, f.last_modified AS flm, f.html, f.len
  FROM revisit_ r ASOF LEFT JOIN full_ f ON r.key = f.key AND r.time > f.time),
judged AS (SELECT *, coalesce(regexp_replace(etag, '^W/', '') = regexp_replace(fetag, '^W/', ''), last_modified = flm) AS same FROM joined),
named AS (SELECT *, CASE WHEN key IS NULL THEN 'no_url' WHEN fid IS NULL THEN 'no_earlier_response' WHEN same IS NULL THEN 'no_validator'
  WHEN same THEN 'resolved' ELSE 'mismatch' END AS status FROM judged)
SELECT id AS page_id, key, status, CASE WHEN status = 'resolved' THEN fid END AS source_page_id,
  CASE WHEN status = 'resolved' THEN 'content-length: ' || len || chr(10) || 'date: ' || time || chr(10) || 'etag: ' || fetag || chr(10) || 'vary: accept'
       ELSE 'content-length: 0' || chr(10) || 'date: ' || time || chr(10) || 'vary: accept' END AS headers,
  CASE WHEN status = 'resolved' THEN sha256(html) END AS payload_sha256
FROM named
"""


def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.exact_duplicates(_documents(spark, sf_dir))


OP5_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.link_vectors(table(spark, sf_dir, "embeddings"))


def op8_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return site_lines.line_report(docs, "doc_id")


OP8_SQL = r"""
WITH rows_ AS (SELECT doc_id, source AS host, text, string_split(text, chr(10)) AS ls FROM documents),
totals AS (SELECT host, count(*) AS total FROM rows_ WHERE host IS NOT NULL GROUP BY host),
held AS (SELECT host, unnest(list_distinct(list_transform(ls, lambda x: trim(x, ' ')))) AS line FROM rows_ WHERE host IS NOT NULL),
bad AS (SELECT host, line FROM held JOIN totals USING (host) WHERE line <> '' GROUP BY host, line
        HAVING count(*) > 0.05 * max(total) AND count(*) >= 3),
listed AS (SELECT host, list(line) AS bad FROM bad GROUP BY host),
kept AS (SELECT doc_id, host, text, ls, list_filter(ls, lambda x: NOT list_contains(coalesce(bad, []), trim(x, ' '))) AS k
         FROM rows_ LEFT JOIN listed USING (host))
SELECT doc_id, host, CASE WHEN text IS NULL THEN 0 ELSE len(ls) END AS n_lines,
       CASE WHEN text IS NULL THEN 0 ELSE len(ls) - len(k) END AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(k, chr(10)), '') END AS text FROM kept
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_documents(_documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    found = toxicity.score_toxicity(docs, model, keep_text=False)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(*values)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf_digest(*[F.col(v) for v in values[:-1]], lowered))
    made = merkle.build(docs, values, carry=[F.col("doc_id"), tampered.alias("tampered")])
    held = merkle.prove(made).select("carried.*", F.col("digest").alias("leaf"), "subroot", "left", "right")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("left"), F.col("right"))
    root = F.lit(made.root).cast("string")
    found = held.select("doc_id", "leaf", "subroot", root.alias("root"), merkle.siblings_digest(F.col("left"), F.col("right")).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_BYTES = "list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1)))"
_STEP = "list_reduce(list_concat([xor(a, CAST(b AS BIGINT))], CAST(range(8) AS BIGINT[])), lambda x, _: xor(x >> 1, (x & 1) * 3988292384))"
#: crc32 of the decimal id, for lists that hold a bit pattern each.
CRC_SQL = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], CAST({_BYTES} AS BIGINT[])), lambda a, b: {_STEP}), 4294967295)"
_FRAMED = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || {v}, '-')" for v in ("doc_id", "source", "lang", "n_chars")]
_LEAF = lambda text: "sha256(" + " || ".join([*_FRAMED, f"coalesce(strlen({text}) || ':' || {text}, '-')"]) + ")"
_RUNS = """SELECT tree, level + 1 AS level, place // 16 AS place, (size + 15) // 16 AS size, sha256(string_agg(digest, '' ORDER BY place)) AS digest
  FROM {0} WHERE size > 1 GROUP BY tree, level, place // 16, size"""
OP11_SQL = rf"""
WITH RECURSIVE leaf_ AS (SELECT doc_id, source, {_LEAF("text")} AS leaf,
  CASE WHEN {CRC_SQL} % 5 = 0 THEN {_LEAF("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) AS tree, count(*) OVER (PARTITION BY source) AS size,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaf_),
below AS (SELECT tree, 0 AS level, place, size, leaf AS digest FROM placed UNION ALL {_RUNS.format("below")}),
subs AS (SELECT tree, digest FROM below WHERE size = 1),
above AS (SELECT CAST(0 AS BIGINT) AS tree, 0 AS level, tree - 1 AS place, (SELECT count(*) FROM subs) AS size, digest FROM subs UNION ALL {_RUNS.format("above")}),
runs AS (SELECT tree, level, place // 16 AS run, size, list(digest ORDER BY place) AS held FROM (FROM below UNION ALL FROM above) GROUP BY ALL HAVING size > 1),
path AS (
  SELECT doc_id, leaf, tree AS own, tree, 0 AS level, place, size, '' AS proof, coalesce(tampered, leaf) AS folded FROM placed
  UNION ALL
  SELECT doc_id, leaf, own, CASE WHEN p.size = 1 THEN 0 ELSE p.tree END, CASE WHEN p.size = 1 THEN 0 ELSE p.level + 1 END,
    CASE WHEN p.size = 1 THEN own - 1 ELSE p.place // 16 END, CASE WHEN p.size = 1 THEN (SELECT count(*) FROM subs) ELSE (p.size + 15) // 16 END,
    CASE WHEN p.size = 1 THEN proof ELSE proof || array_to_string(held[:p.place % 16], '') || array_to_string(held[p.place % 16 + 2:], '') END,
    CASE WHEN p.size = 1 THEN folded ELSE sha256(array_to_string(held[:p.place % 16], '') || folded || array_to_string(held[p.place % 16 + 2:], '')) END
  FROM path p LEFT JOIN runs r ON p.tree = r.tree AND p.level = r.level AND p.place // 16 = r.run WHERE p.tree > 0 OR p.size > 1)
SELECT doc_id, leaf, s.digest AS subroot, a.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = a.digest AS verified
FROM path p JOIN subs s ON s.tree = p.own JOIN above a ON a.size = 1 WHERE p.tree = 0 AND p.size = 1
"""


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.clean_lines(_documents(spark, sf_dir), keep_text=False)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *base, *quality.COUNTS[5:], F.sha2("cleaned", 256).alias("cleaned_sha256"))


_QUOTED = lambda text: text.replace("'", "''")
_LINE_WORDS = rf"len(regexp_extract_all(line, '[^{WS}]+'))"
_LINE_CHARS = rf"length(regexp_replace(line, '[{WS}]+', '', 'g'))"
_SYMBOL_COUNT = lambda text: f"length({text}) - length(regexp_replace({text}, '[{quality.SYMBOLS}]', '', 'g'))"
OP12_SQL = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^{WS}]+') AS w, string_split(text, chr(10)) AS ls FROM docs),
at_line AS (SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM split),
judged AS (SELECT r, i, line, {_LINE_WORDS} AS n, {_LINE_CHARS} AS chars, row_number() OVER (PARTITION BY r, line ORDER BY i) AS nth,
  CASE WHEN {_LINE_WORDS} = 0 THEN NULL
    WHEN 100 * len(list_filter(regexp_extract_all(line, '[^{WS}]+'), lambda x: regexp_full_match(x, '{quality.SEPARATOR}'))) > {quality.MOST_SEPARATORS} * {_LINE_WORDS} THEN 'navigation'
    WHEN {_LINE_WORDS} <= {quality.BOILERPLATE_WORDS}
      AND regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{"|".join(quality.BOILERPLATE)}') THEN 'boilerplate'
    WHEN NOT regexp_matches(line, '{_QUOTED(quality.SENTENCE_END)}') OR 100 * ({_SYMBOL_COUNT("line")}) > {quality.MOST_SYMBOLS} * {_LINE_WORDS} THEN 'punctuation' END AS fault FROM at_line),
by_line AS (SELECT r, count(*) FILTER (n > 0 AND nth > 1) AS n_dup_lines, count(*) FILTER (fault = 'navigation') AS navigation,
  count(*) FILTER (fault = 'boilerplate') AS boilerplate, count(*) FILTER (fault = 'punctuation') AS punctuation,
  CAST(coalesce(sum(chars) FILTER (fault IS NOT NULL), 0) AS BIGINT) AS lost_chars,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (fault IS NULL), '') AS cleaned FROM judged GROUP BY r),
wide AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM split WHERE len(w) >= 5),
named AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM wide),
again AS (SELECT r, i FROM named QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, range(5) AS s(k) GROUP BY r),
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, {_SYMBOL_COUNT("text")} AS n_symbols,
  coalesce(n_repeat_words, 0) AS n_repeat_words, b.* FROM split s JOIN by_line b USING (r) LEFT JOIN covered c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, navigation, boilerplate, punctuation, lost_chars,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT base_failed AND 100 * lost_chars <= {quality.MOST_LOST} * word_chars AS kept,
  sha256(cleaned) AS cleaned_sha256 FROM counted
"""


def repeating(text: Column, doc_id: Column) -> Column:
    """The text of every tenth id by digest with its last words replaced by copies of the first few of them; others as they are."""
    digest = F.crc32(doc_id.cast("string"))
    g = F.floor(digest / 10)

    def again(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " "))

    # A function of an array of one: the words are taken once, however often they are named.
    made = F.transform(F.array(F.regexp_extract_all(text, F.lit(f"([^{WS}]+)"), F.lit(1))), again)[0]
    return F.when(digest % 10 == 0, F.coalesce(made, text)).otherwise(text)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    made = docs.select("doc_id", repeating(F.col("text"), F.col("doc_id")).alias("text"))
    found = periods.find_runs(made, keep_text=False)
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.withColumns({"first": first, "runs_sha256": F.sha2(listed, 256), "collapsed_sha256": F.sha2("collapsed", 256)})
    length, period = -F.col("first.less"), F.col("first.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "first.start", length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


QUERIES = {
    "op1_language": (op1_language, None),
    "op2_records": (op2_records, None),
    "op3_packing": (op3_packing, None),
    "op4_revisits": (op4_revisits, OP4_SQL),
    "op5_exact_duplicates": (op5_exact_duplicates, OP5_SQL),
    "op6_bpe": (op6_bpe, None),
    "op7_neighbours": (op7_neighbours, None),
    "op8_site_lines": (op8_site_lines, OP8_SQL),
    "op9_simhash": (op9_simhash, None),
    "op10_toxicity": (op10_toxicity, None),
    "op11_manifest": (op11_manifest, OP11_SQL),
    "op12_quality": (op12_quality, OP12_SQL),
    "op13_runs": (op13_runs, None),
}
