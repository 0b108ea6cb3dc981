"""The operators applied to whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (chat, decontaminate, exact_dedup, language, minhash, packing, pieces, pii,
                          quality, sentence_dedup, spelling, sql, suffix_dedup, turn_repair)
from tidemark.llm.common import read
from tidemark.llm.registry import query

#: Vocabulary files of public tokenizers; the package is on every executor.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS>>|\|(?:im_start|im_end|im_sep|endoftext)\|>)"
OP1_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), s AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       -- each text escaped; a head and an end for each message, a mark between its texts
       sum(length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g'))
           + CASE WHEN before IS DISTINCT FROM role
             THEN 12 + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '{_CONTROL}', '\1\\\2\3', 'g')) + 1 + 11
             ELSE 10 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


@query("op1_chat_format", OP1_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.createDataFrame(
        [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(asked)
    out = chat.format_chats(turns).select(
        "conv_id", "formatted", chat.parse_chat(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query("op2_sentence_dedup")
def op2_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _removed(sentence_dedup.sentence_dedup(read(spark, sf_dir, "documents")))


def _removed(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _removed(suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents")))


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.fit(docs))

    def listed(*spans: str):
        """``kind:start:end`` by kind as listed, then place."""
        order = F.array(*[F.lit(k) for k in pii.KINDS])
        ordered = F.array_sort(F.transform(F.concat(*spans), lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
                        listed("base", "added").alias("spans"), F.size("added").cast("long").alias("n_added"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS x FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(m, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""


@query("op5_minhash", OP5_SQL)
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), n_words=2)


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.profiles(docs)).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op7_pieces")
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_pieces(read(spark, sf_dir, "documents"), PIECE_MODEL)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "item_ids", "distances", (F.size("item_ids") > 0).alias("contaminated"))


@query("op9_token_blocks")
def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = packing.write_blocks(read(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)
    return packing.digests(packing.read_blocks(blocks))


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""


@query("op10_exact_dedup", OP10_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH RECURSIVE {sql.CRC_TABLE},
r AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, turn, coalesce(role, ' ') AS role,
             coalesce(text, ' ') AS text,
             {sql.crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how
      FROM conversations, crc),
d AS (SELECT c, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
             CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM r, LATERAL (SELECT unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))) AS copies),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth,
             regexp_replace(text, '[ \t\n\x0B\f\r]+$', '') AS bare FROM o),
k AS (SELECT *, left(role, 1) AS x, CASE WHEN bare = '' THEN 'b' WHEN nth > 1 THEN 'd'
             WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM n),
-- what may follow what: 0 nothing yet, 1 system, 2 user, 3 assistant
follow(s, x, s2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(s, n, s2, o) AS (
  SELECT s, 0, s, []::VARCHAR[] FROM (VALUES (0), (1), (2), (3)) v(s)
  UNION ALL SELECT ins.s, n + 1, f.s2, list_append(o, CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
  FROM ins JOIN follow f ON f.s = ins.s2 AND f.x <> 's' WHERE n < 2),
act AS (
  SELECT c, i, s, s AS s2, 'D' AS letter, 2 AS cost, []::VARCHAR[] AS o FROM k, (VALUES (0), (1), (2), (3)) v(s)
  UNION ALL SELECT c, i, s, s2, 'K', CASE fault WHEN 't' THEN 5 ELSE 0 END, [role || ':' || text]
  FROM k JOIN follow f ON f.x = k.x WHERE fault NOT IN ('b', 'd')
  UNION ALL SELECT c, i, s, s2, 'R', CASE fault WHEN 't' THEN 6 ELSE 1 END,
         [CASE f.x WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM k JOIN follow f ON f.x <> 's' WHERE fault NOT IN ('b', 'd')),
dp AS (
  SELECT DISTINCT c, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'o': []::VARCHAR[]}} AS b FROM r
  UNION ALL
  SELECT dp.c, act.i, act.s2, min({{'cost': b.cost + 5 * ins.n + act.cost, 'audit': b.audit || repeat('I', ins.n) || letter,
                                   'o': b.o || ins.o || act.o}})
  FROM dp JOIN ins ON ins.s = dp.s JOIN act ON act.c = dp.c AND act.i = dp.i + 1 AND act.s = ins.s2
  GROUP BY dp.c, act.i, act.s2),
own AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
               count(*) FILTER (fault = 't') AS truncated FROM k GROUP BY c),
pairs AS (SELECT c, count(*) FILTER (p NOT IN ('su', 'ua', 'au')) AS illegal
          FROM (SELECT c, lag(x) OVER (PARTITION BY c ORDER BY i) || x AS p FROM k) GROUP BY c),
best AS (SELECT dp.c, min({{'cost': b.cost + 5 * ins.n, 'audit': b.audit || repeat('I', ins.n), 'o': b.o || ins.o}}) AS b
         FROM dp LEFT JOIN own USING (c) JOIN ins ON ins.s = dp.s AND ins.s2 IN (0, 3)
         WHERE dp.i = coalesce(own.n, 0) GROUP BY dp.c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.cost::BIGINT AS cost, b.audit AS audit,
       sha256(array_to_string(b.o, chr(10))) AS repaired_sha256, coalesce(n, 0) AS n_turns
FROM (SELECT DISTINCT conv_id, c FROM r) JOIN best USING (c) LEFT JOIN own USING (c) LEFT JOIN pairs USING (c)
"""


@query("op11_turn_repair", OP11_SQL)
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = turn_repair.repair(turn_repair.damage(read(spark, sf_dir, "conversations")))
    lines = F.transform("repaired", lambda t: F.concat_ws(":", t["role"], t["text"]))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"), "n_turns")


OP12_SQL = rf"""
WITH RECURSIVE {sql.CRC_TABLE},
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS run FROM documents)
      GROUP BY ALL),
h AS (SELECT run, k, {sql.crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r, crc),
w AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
             ELSE run END AS word, k FROM h),
words AS (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
-- words less one code point: the same rest in the same place is a replaced one, the word itself an inserted one
less AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
cut AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM less),
pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min({{'minus': -m, 'near': near}}) AS b FROM pairs GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.minus >= 10 * w.n THEN b.near END AS form,
             CASE WHEN -b.minus >= 10 * w.n THEN -b.minus END AS form_n FROM words w LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root FROM f WHERE form IS NULL
       UNION ALL SELECT f.word, up.root FROM up JOIN f ON f.form = up.word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN up USING (word)
"""


@query("op12_spelling", OP12_SQL)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"), change=spelling.damaged)


@query("op13_quality")
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels"))).select(
        "doc_id", language.held_out().alias("held_out"), "score", "predicted")
