"""The queries of the training-data operators, as __spark_entry__ registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: A byte-level BPE vocabulary, as installed; only the driver reads it.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pattern that cuts texts for that vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def op1_training_order_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trainorder import Tokenizer, training_order

    return training_order(_read(spark, sf_dir), Tokenizer(RANKS, WORD_PATTERN), key=20240229)


def op2_line_dedup_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linefilter import common_lines_dropped

    return common_lines_dropped(_read(spark, sf_dir), min_docs=10).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op3_quality_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import mil

    docs, labels = _read(spark, sf_dir), _read(spark, sf_dir, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = mil.fit(docs, labels.where(~held), "quality")
    found = mil.score(docs, model)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages", "top_passage")


def op4_exact_dedup_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .blocknames import exact_groups

    return exact_groups(_read(spark, sf_dir))


def op5_difference_cover_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .anchors import repeated_windows

    return repeated_windows(_read(spark, sf_dir), window=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The SentencePiece model, as installed; only the driver reads it.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op6_sentencepiece_gumbel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lattice import Vocabulary, encode

    return encode(_read(spark, sf_dir), Vocabulary.load(PIECES), k=2, seed=1)


def op7_language_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import hyperlang

    docs = _read(spark, sf_dir)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    found = hyperlang.predict(docs, hyperlang.fit(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_suffix_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import repeated_bytes

    return repeated_bytes(_read(spark, sf_dir), length=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_ngram_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(_read(spark, sf_dir), percent=90, n=3).select("doc_id", "n_shingles", "component_id")


def op10_decontamination_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .winnow import contamination

    found = contamination(_read(spark, sf_dir), _read(spark, sf_dir, "benchmark"), window=13)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SQL = {
    "op2_line_dedup_cuckoo": r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split),
keyed AS (SELECT *, LOWERED(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY doc_id""",
    "op4_exact_dedup_block_names": """
WITH t AS (SELECT doc_id, LOWERED(coalesce(text, '')) AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)""",
    "op5_difference_cover_anchors": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM d WHERE len(words) >= 50),
w AS (SELECT doc_id, pos, sha256(array_to_string(words[pos:pos + 49], ' ')) AS key FROM p),
least AS (SELECT key, min(doc_id) AS doc FROM w GROUP BY key HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT w.doc_id, w.pos FROM w JOIN least USING (key) WHERE least.doc < w.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS place FROM hit),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS body FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_suffix_difference_cover": """
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents),
b AS (SELECT doc, body, unnest(range(0, len(body) // 2 - 399, 400)) AS since FROM d),
c AS (SELECT doc, since, substr(body, 2 * since + 1, 1598) AS part FROM b),
p AS (SELECT doc, since, part, unnest(range(0, least(400, len(part) // 2 - 399))) AS pos FROM c),
s AS (SELECT doc, since + pos AS pos, md5(substr(part, 2 * pos + 1, 800)) AS key FROM p),
again AS (SELECT key FROM s GROUP BY key HAVING count(*) > 1),
hit AS (SELECT doc, pos, pos > 400 + lag(pos) OVER (PARTITION BY doc ORDER BY pos) AS apart FROM s SEMI JOIN again USING (key)),
run AS (SELECT doc, pos, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc ORDER BY pos) AS run FROM hit),
span AS (SELECT doc, min(pos) AS since, max(pos) + 400 AS till FROM run GROUP BY doc, run),
gap AS (SELECT doc, till AS since, lead(since) OVER (PARTITION BY doc ORDER BY since) AS till FROM span
        UNION ALL SELECT doc, 0, min(since) FROM span GROUP BY doc),
kept AS (SELECT doc, string_agg(substr(body, 2 * since + 1, 2 * (coalesce(till, len(body) // 2) - since)), '' ORDER BY since) AS rest
         FROM gap JOIN d USING (doc) GROUP BY doc),
gone AS (SELECT doc, count(*) AS n_spans, CAST(sum(till - since) AS BIGINT) AS n_removed FROM span GROUP BY doc)
SELECT doc_id, len(body) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, body))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc) LEFT JOIN kept USING (doc)""",
    "op9_ngram_jaccard_rtree": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(LOWERED(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, hash(unnest(list_transform(range(1, greatest(2, len(words) - 1)), lambda i: array_to_string(words[i:i + 2], ' ')))) AS gram
      FROM d WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, n, md5(array_to_string(list(gram ORDER BY gram), ',')) AS body FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
lead AS (SELECT body, min(doc_id) AS lead FROM sets GROUP BY body),
r AS (SELECT s.doc_id, s.gram, n.n FROM s JOIN n USING (doc_id) WHERE doc_id IN (SELECT lead FROM lead)),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM r a JOIN r b ON a.gram = b.gram AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT lead AS node, lead AS top FROM lead UNION SELECT l.v, reach.top FROM reach JOIN links l ON l.u = reach.node AND reach.top < l.v),
tops AS (SELECT node, min(top) AS top FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(tops.top, d.doc_id) AS component_id
FROM d LEFT JOIN sets USING (doc_id) LEFT JOIN lead USING (body) LEFT JOIN tops ON tops.node = lead.lead""",
    "op10_decontamination_winnowing": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(LOWERED(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(LOWERED(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(words)) AS n, unnest(list_transform(range(1, greatest(2, len(words) - 11)), lambda i: array_to_string(words[i:i + 12], ' '))) AS key
       FROM b WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS pos FROM d, sizes WHERE len(words) >= n),
dw AS (SELECT doc_id, n, pos, array_to_string(words[pos:pos + n - 1], ' ') AS key FROM dp),
met AS (SELECT doc_id, item_id, n, pos FROM dw JOIN bw USING (n, key)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    return {k: _lowered(v) for k, v in _SQL.items()}


def _lowered(sql: str) -> str:
    """LOWERED(x) written out: A-Z only."""
    while (at := sql.find("LOWERED(")) >= 0:
        end, depth = at + 8, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:at] + _LOWER.format(sql[at + 8 : end - 1]) + sql[end:]
    return sql


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
