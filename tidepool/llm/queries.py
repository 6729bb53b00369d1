"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, conversations, decontam, html, jaccard, licenses, pivots, runs, secrets, tokenfile, toxicity, urlrules, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f

    return add


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_hits(docs, common.read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontam.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op9_decontamination"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS k,
         array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') AS words
  FROM items, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS t(i) WHERE len(ws) > 0),
docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
places AS (
  SELECT doc_id, i, k, array_to_string(ws[i : i + k - 1], ' ') AS words
  FROM docs, (SELECT DISTINCT k FROM windows) AS sizes, unnest(range(1, len(ws) - k + 2)) AS t(i)),
found AS (SELECT doc_id, i, p.k, item_id FROM places AS p JOIN windows AS w ON p.k = w.k AND p.words = w.words),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM found, unnest(range(i, i + k)) AS t(pos) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, common.read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.spelled(F.col("secrets"), True).cast("binary"), 256).alias("base_sha256"),
        secrets.spelled(F.col("secrets"), False).alias("spans"),
    )


@query("op8_licenses")
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.summarise(licenses.detect(docs)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.join(docs).select("doc_id", "n_shingles", "component_id")


ORACLE["op4_jaccard_join"] = """
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y
  WHERE 100 * i >= 80 * (p.n + q.n - i)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.y FROM reach AS r JOIN edges AS e ON e.x = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query("op5_token_file")
def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = tokenfile.encode(docs, path, end_id=2).drop("text")
    folder = common.shared_path(spark, "token-file")
    tokenfile.write(encoded, folder, vocabulary=tokenfile.encoder_of(path).vocabulary, ids_from=docs)
    return tokenfile.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: Verdict, host and path of the given url rules.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op6_url_rules")
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "confidence")


@query("op7_top_k")
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pivots.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


ORACLE["op7_top_k"] = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM valid AS q JOIN valid AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read_table(spark, sf_dir, "pages").select("page_id", "html")
    return html.extract(pages).select("page_id", F.length("text").cast("long").alias("n_chars"), "text")


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.summarise(runs.detect(with_planted_period(docs).select("doc_id", "text"))).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The contract's texts: one id in ten has its words from a place of its own on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumn("g", F.floor(h / 10)).withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))))
    n = F.size("words")
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    docs = docs.withColumn("p", F.expr("int(1 + (size(words) - a) div (3 + g % 8))"))
    planted = F.expr("""array_join(concat(slice(words, 1, a), slice(
        flatten(array_repeat(slice(words, a + 1, p), int((size(words) - a) div p + 1))), 1, size(words) - a)), ' ')""")
    return docs.withColumn("text", F.when(n > 0, planted).otherwise(F.col("text")))


#: Unsigned crc32 of a short ASCII text ``{0}`` in SQL, from a table of the 256 remainders.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))"""
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split({0}, ''), lambda s: CAST(ascii(s) AS BIGINT))),
  lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295)"""

ORACLE["op13_periodic_runs"] = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS tab),
whole AS (
  SELECT doc_id, {_CRC.format("CAST(doc_id AS VARCHAR)")} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents, crc),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM whole),
docs AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(len(ws)), lambda i: ws[1 + CASE
    WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(ws) - a) // (3 + (h // 10) % 8)) END]) END AS ws FROM placed),
seeds AS (SELECT doc_id, i, array_to_string(ws[i + 1 : i + 6], ' ') AS s FROM docs, unnest(range(len(ws) - 5)) AS t(i)),
twins AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM seeds AS x JOIN seeds AS y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM twins),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12),
runs AS (
  SELECT * FROM stretches AS s WHERE NOT EXISTS (
    SELECT 1 FROM stretches AS t WHERE t.doc_id = s.doc_id AND t.q < s.q
    AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS spelled,
         list((-length, start, q) ORDER BY -length, start, q)[1] AS top
  FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, i, ws[i + 1] AS w FROM docs, unnest(range(len(ws))) AS t(i)
  WHERE NOT EXISTS (SELECT 1 FROM runs AS r WHERE r.doc_id = docs.doc_id AND i >= r.start + r.q AND i < r.start + r.length)),
texts AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top[2] AS start, -top[1] AS length, top[3] AS period,
       1000 * -top[1] // top[3] AS exponent_milli, sha256(coalesce(spelled, '')) AS runs_sha256,
       sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN texts USING (doc_id)
"""


@query("op12_warc")
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = common.shared_path(spark, "warc")
    warc.write(warc.with_revisits(pages, "page_id", F.encode("html", "UTF-8")), folder)
    records = warc.read(spark, folder, payload="false").where("record_type IN ('response', 'revisit')")
    page = lambda c: F.regexp_extract(c, "^urn:page:(.*)$", 1).try_cast("long")
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"), "intact"
    )


ORACLE["op12_warc"] = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY html)
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY html)
            THEN max(page_id) OVER (PARTITION BY html) END AS refers_to,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY html)
            THEN NULL ELSE true END AS intact
FROM pages
"""


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(damaged(rows), rows)


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: by row, dropped, emptied, without stops, repeated, or with role user."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    role = F.when(kind == 4, "user").otherwise(plain("role"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


#: Relaxations of the state list s (cost as nine digits, then the audit; null: not reached).
_PAID = "(lpad(CAST(CAST({0}[1:9] AS INTEGER) + {1} AS VARCHAR), 9, '0') || {0}[10:] || '{2}')"
_INSERTED = _PAID.format("{0}", 3, "I")

ORACLE["op11_conversation_repair"] = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS tab),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations, crc),
left_over AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM left_over),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM ordered),
faulty AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pos > 1 AND concat(before, left(role, 1)) NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'i': left(role, 1), 'gone': fault IN ('b', 'd'), 'more': CASE fault WHEN 't' THEN 3 ELSE 0 END}} ORDER BY pos) AS steps
  FROM faulty GROUP BY conv_id),
-- the four states' cheapest, then least, audits: START, SYSTEM, USER, ASSISTANT; a fold row by row
walked AS (
  SELECT *, list_reduce(list_prepend({{'s': ['000000000', NULL, '000000003I', '000000006II'], 'i': '', 'gone': false, 'more': 0}},
      list_transform(steps, lambda x: {{'s': CAST(NULL AS VARCHAR[]), 'i': x.i, 'gone': x.gone, 'more': x.more}})),
    lambda a, x: list_transform([CASE WHEN x.gone THEN list_transform(a.s, lambda t: {_PAID.format("t", 4, "D")}) ELSE [
        {_PAID.format("a.s[1]", 4, "D")},
        least({_PAID.format("a.s[2]", 4, "D")}, CASE x.i WHEN 's' THEN {_PAID.format("a.s[1]", "x.more", "K")} END),
        least({_PAID.format("a.s[3]", 4, "D")}, list_min(list_transform([a.s[1], a.s[2], a.s[4]], lambda t:
          CASE x.i WHEN 'u' THEN {_PAID.format("t", "x.more", "K")} ELSE {_PAID.format("t", "x.more + 3", "R")} END))),
        least({_PAID.format("a.s[4]", 4, "D")},
          CASE x.i WHEN 'a' THEN {_PAID.format("a.s[3]", "x.more", "K")} ELSE {_PAID.format("a.s[3]", "x.more + 3", "R")} END)] END],
      lambda r: {{'s': list_transform([least(r[3], {_INSERTED.format("r[1]")}, {_INSERTED.format("r[2]")}, {_INSERTED.format("r[4]")})],
        lambda u: [r[1], r[2], u, least(r[4], {_INSERTED.format("u")})])[1], 'i': '', 'gone': false, 'more': 0}})[1]).s AS s
  FROM counted),
chosen AS (SELECT *, least(s[1], s[4]) AS won FROM walked),
edits AS (
  SELECT conv_id, i, won[9 + i] AS edit, (length(won) - 9 - length(regexp_replace(won[10:], '[^D]', '', 'g'))) % 2 AS odd,
         count(*) FILTER (won[9 + i] <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS pos,
         count(*) FILTER (won[9 + i] <> 'D') OVER (PARTITION BY conv_id ORDER BY i) AS place
  FROM chosen, unnest(range(1, length(won) - 8)) AS t(i)),
repaired AS (
  SELECT e.conv_id, string_agg(concat(
    CASE WHEN edit = 'K' THEN f.role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':',
    CASE WHEN edit = 'I' THEN '' ELSE f.text END), chr(10) ORDER BY i) AS text
  FROM edits AS e JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.pos = greatest(e.pos, 1)
  WHERE edit <> 'D' GROUP BY e.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(won[1:9] AS BIGINT), 0) AS cost,
       coalesce(won[10:], '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN chosen AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
