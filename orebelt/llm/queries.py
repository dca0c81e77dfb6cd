"""One registered query per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.llm import ann, chat, decontaminate, language, licenses, lines, mixing, mixlm, negatives, periodic, quality, simhash, tokens
from orebelt.llm.common import BLANK_WORD, quality_weights, table, words
from orebelt.llm.registry import ORACLE, QUERIES, query  # noqa: F401

@query("op1_nearest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector among all."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.neighbours(vectors, F.col("vec_id") % 100 == 0)


@query("op2_licenses")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that the documents state, with the wording's differences."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


_OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 20 + length(role) + length(text)
         + len(regexp_extract_all(role, '[<\[]~*(\||/?s>|/?INST\])')) + len(regexp_extract_all(text, '[<\[]~*(\||/?s>|/?INST\])')) AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) + 2 * count(*) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op3_chat", _OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, then read back from the format."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    turns = turns.unionAll(own).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"))
    formatted = chat.format_chats(turns)
    back = chat.read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        "loss_chars", F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32,000-piece model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


_OP5 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
txt AS (SELECT DISTINCT text, ls FROM doc WHERE text IS NOT NULL),
line AS (SELECT text, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM txt),
tok AS (SELECT text, line, pos, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS raw FROM line),
seen AS (
  SELECT text, line, pos, len(raw) AS n, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN raw] AS toks FROM tok WHERE len(raw) >= 3),
leafed AS (SELECT *, {'n': n, 'lead': toks[1:3]} AS leaf FROM seen),
mine AS (SELECT * FROM leafed WHERE leaf IN (SELECT leaf FROM leafed GROUP BY leaf HAVING count(DISTINCT text) >= 3)),
body AS (SELECT leaf, line, any_value(toks) AS toks, count(DISTINCT text) AS w FROM mine GROUP BY leaf, line),
token AS (SELECT leaf, line, w, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS idx FROM body),
frequent AS (SELECT leaf, idx, token FROM token WHERE token <> '<*>' GROUP BY leaf, idx, token HAVING sum(w) >= 3),
part AS (
  SELECT token.leaf, line, token.idx, CASE WHEN frequent.token IS NULL THEN '<*>' ELSE token.token END AS part, frequent.token IS NOT NULL AS fixed
  FROM token LEFT JOIN frequent ON token.leaf = frequent.leaf AND token.idx = frequent.idx AND token.token = frequent.token),
tpl AS (
  SELECT line, string_agg(part, ' ' ORDER BY idx) AS template FROM part GROUP BY leaf, line
  HAVING count(*) FILTER (WHERE fixed) >= 0.6 * count(*)),
spot AS (SELECT DISTINCT template, text FROM mine JOIN tpl USING (line)),
piece AS (SELECT DISTINCT text, md5(array_to_string(raw[i : i + 4], ' ')) AS piece FROM (SELECT text, raw, unnest(range(1, len(raw) + 1, 5)) AS i FROM tok)),
lows AS (SELECT text, piece, count(*) OVER (PARTITION BY text) AS size FROM piece QUALIFY row_number() OVER (PARTITION BY text ORDER BY piece) <= 12),
sketch AS (SELECT text, piece, ('0x' || substr(md5(text), 1, 15))::BIGINT AS k, least(size, 12) AS size FROM lows),
brought AS (SELECT template, piece, min({'k': k, 'size': size}) AS f FROM spot JOIN sketch USING (text) GROUP BY template, piece),
firsts AS (SELECT template, f FROM brought GROUP BY template, f HAVING 2 * count(*) > f.size),
rec AS (SELECT template FROM firsts GROUP BY template HAVING count(*) >= 3),
gone AS (SELECT DISTINCT text, pos FROM seen JOIN tpl USING (line) JOIN rec USING (template)),
kept AS (
  SELECT line.text, count(*) FILTER (WHERE gone.pos IS NOT NULL) AS n_dropped,
         string_agg(line.line, chr(10) ORDER BY line.pos) FILTER (WHERE gone.pos IS NULL) AS body
  FROM line LEFT JOIN gone ON line.text = gone.text AND line.pos = gone.pos GROUP BY line.text)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(length(coalesce(body, '')), 0) AS n_chars_kept,
       sha256(coalesce(body, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (text)
"""


@query("op5_line_templates", _OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs across documents."""
    kept = lines.drop_recurring_lines(table(spark, sf_dir, "documents"), counts=True)
    body = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.length(body).cast("long").alias("n_chars_kept"), F.sha2(body, 256).alias("kept_sha256"))


_OP6 = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, w[i : i + 9] AS win
  FROM item, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
lens AS (SELECT DISTINCT len(win) AS n FROM win),
docwin AS (
  SELECT r, i, w[i : i + n - 1] AS win
  FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS i FROM doc, lens)),
hit AS (SELECT DISTINCT r, i, len(win.win) AS n, item FROM docwin JOIN win ON docwin.win = win.win),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN found USING (r)
"""


@query("op6_decontaminate", _OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the two folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


_OP9 = r"""
WITH RECURSIVE doc AS (
  SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':20'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
           / coalesce(q, 1.0) AS key
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END) AS q FROM labels GROUP BY doc_id) USING (doc_id)),
src AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS s,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM doc GROUP BY source),
step(n, source, s, w, t) AS (
  SELECT 0, source, s, w, w / sum(w) OVER () * sum(s) OVER () FROM src
  UNION ALL
  SELECT n + 1, source, s, w,
         CASE WHEN t >= 3 * s THEN 3 * s
              ELSE (sum(s) OVER () - sum(CASE WHEN t >= 3 * s THEN 3 * s ELSE 0 END) OVER ())
                   / sum(CASE WHEN t < 3 * s THEN w END) OVER () * w END
  FROM step WHERE n < 60),
target AS (SELECT source, s, t FROM step WHERE n = 60),
run AS (
  SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, t, CASE WHEN s > 0 THEN CAST(floor(t / s) AS BIGINT) ELSE 0 END AS epochs, s,
         sum(size) OVER (PARTITION BY doc.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS through
  FROM doc JOIN target ON doc.source IS NOT DISTINCT FROM target.source)
SELECT doc_id, size, source_size, t AS target,
       CAST(size * (epochs + CASE WHEN size > 0 AND through - size / 2.0 <= t - epochs * s THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""


@query("op9_mixing", _OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality=quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, lines, near copies, decontamination and mixing over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


@query("op10_context_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, learned from the six folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out(F.col("doc_id"), 7, 2)
    scored = mixlm.score_documents(docs, ~held_out)
    return scored.withColumn("held_out", held_out)


_OP11 = r"""
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s
  FROM v a, v b WHERE a.id % 100 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)),
p AS (SELECT * FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.s DESC, n.other_id) AS INT) AS rank,
       n.other_id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM p JOIN met n ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.s DESC, n.other_id) <= 10
"""


@query("op11_hard_negatives", _OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, one label in seven moved on."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # what has no exact integer of 31 bits is no component; the operator leaves such rows out
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(F.abs(x) < float(1 << 22), F.floor(x * 256)))
    return negatives.mine(rows.select("vec_id", label.alias("label"), whole.alias("embedding")), F.col("vec_id") % 100 == 0)


_OP12 = r"""
WITH crc AS (
  SELECT [list_reduce(list_concat([b], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) FOR b IN range(256)] AS t),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         xor(4294967295, list_reduce(list_concat([4294967295], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
                                     lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]))) AS h
  FROM documents, crc),
aimed AS (
  SELECT r, doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS made, (h // 10) % greatest(len(w), 1) AS a,
         1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p
  FROM doc),
word AS (
  SELECT r, n, i, CASE WHEN made AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM aimed)),
gram AS (
  SELECT r, n, i, [x, lead(x, 1) OVER t, lead(x, 2) OVER t, lead(x, 3) OVER t, lead(x, 4) OVER t] AS g
  FROM word WINDOW t AS (PARTITION BY r ORDER BY i)),
met AS (
  SELECT b.r, b.i, c.i - b.i AS q FROM gram b JOIN gram c ON b.r = c.r AND b.g = c.g
  WHERE b.i < c.i AND b.i + 5 <= b.n AND c.i + 5 <= b.n AND c.i - b.i <= b.n / 4),
island AS (
  SELECT r, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM met) GROUP BY r, q, isle),
run AS (
  SELECT r, start, length, min(q) AS period FROM island WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
         min({'l': -length, 's': start, 'q': period}) AS top
  FROM run GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
body AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS body FROM word ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, -top.l AS length, top.q AS period,
       (-1000 * top.l) // top.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (r) LEFT JOIN body USING (r)
"""


@query("op12_periodic_runs", _OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one document in ten made to repeat first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text"), BLANK_WORD).alias("words"))
    n, h = F.size("words"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    made = F.coalesce(h % 10 == 0, F.lit(False)) & (n > 0)
    docs = docs.withColumn("a", F.when(made, F.pmod(g, F.greatest(n, F.lit(1)))).cast("int"))
    docs = docs.withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8))).cast("int"))
    repeated = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w))
    docs = docs.select("doc_id", F.when(F.col("a").isNull(), F.col("words")).otherwise(repeated).alias("words"))
    found = periodic.find_runs(docs).withColumn("top", F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    length, start, period = -F.col("top.col1"), F.col("top.start"), F.col("top.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(periodic.collapse(F.col("words"), F.col("kept")), 256).alias("collapsed_sha256"),
    )


@query("op13_quality_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document and the verdict of trees fitted to the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge(docs, model)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
