"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from sentispark.llm import (block_knn, byte_bpe, chat_format, fill_in_middle, html_extraction, language_id, mixing, ngram_join,
                            packing, substring_dedup, toxicity, vector_dedup, whitening)

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHINGLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
         ELSE array_to_string(ws[i:i + 4], ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
          JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (SELECT a AS x, b AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.y, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = w.doc_id"""


@query("op9_ngram_join", _SHINGLE_SQL)
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the component of their 5-word shingle links at a Jaccard similarity of 0.75."""
    return ngram_join.shingle_components(table(spark, sf_dir, "documents"))


_REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
           FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM win JOIN again USING (h)),
j AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(coalesce(js, []))::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(ws, lambda x, k: NOT list_contains(coalesce(js, []), k)), ' ')) AS kept_sha256
FROM w LEFT JOIN j USING (doc_id)"""


@query("op1_substring_dedup", _REPEATS_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of any 35-word window that occurs again."""
    docs = substring_dedup.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix by source weights takes of every document."""
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; 1 marks held-out documents."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, F.when(remainder() != 1, F.col("lang")))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder() == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


_USABLE_SQL = """
u AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0)"""


@query("op8_block_knn", f"""WITH {_USABLE_SQL},
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.x, c.x) AS score
      FROM u q JOIN u c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 20""")
def op8_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return block_knn.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op10_vector_dedup", f"""WITH RECURSIVE {_USABLE_SQL},
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT a AS x, b AS y FROM l UNION SELECT r.x, l.b FROM reach r JOIN l ON l.a = r.y),
m AS (SELECT x, min(y) AS y FROM reach GROUP BY x), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m.y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m.y, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.x = vec_id""")
def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links of a cosine of 0.9 and the component they make."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), "n_chars")


_CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
t AS (SELECT *, 5 + length(role) + 8 + length(text) + (length(text) - length(replace(text, '\', '')))
             + (length(text) - length(replace(text, '</turn>', ''))) // 7
             + (length(text) - length(replace(text, '#', ''))) - len(regexp_extract_all(text, '#+')) AS n,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM c),
p AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS prefix FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
             coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
             sum(prefix) FILTER (role = 'assistant' OR back = 1)::BIGINT AS formatted_chars FROM p GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""


@query("op5_chat_format", _CHAT_SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from the examples of every conversation, and of one that imitates the template."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select((F.col("id") * 0 - 7).alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    back = chat_format.read_back(chat_format.examples(turns.unionByName(own)))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["said"], F.lit("\n")))
    loss = F.array_join("losses", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder() != 1).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", (remainder() == 1).alias("held_out"), F.col("toxicity").alias("score"),
                        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"))


_FILL_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
d AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                  WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
c AS (SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
             array_to_string(units[greatest(a, b) + 1:], '') AS suffix FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM c"""


@query("op11_fill_in_middle", _FILL_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two token boundaries and written as a fill-in-middle example, and what is read back from it."""
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as ids of a byte-level vocabulary, and the text that the ids give back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    both = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight components of largest variance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
