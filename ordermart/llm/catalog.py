"""The registered queries of the training-data operators.

Each query applies one operator, with production parameters, to its whole
table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermart.llm import (bpe, bytebpe, chat, decontam, langid, nndescent, pii, repair, resample, sharding, simhash,
                           tokenfiles, warc)
from ordermart.llm.common import stored, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document written to files and read back."""
    folder = tokenfiles.token_folder(spark)
    manifest = tokenfiles.write_token_files(table(spark, sf_dir, "documents"), folder,
                                            public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokenfiles.read_token_files(spark, folder, manifest)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    found = pii.find(table(spark, sf_dir, "documents"), support=1, unit="document")
    base = pii.base_of(F.col("spans"))
    counts = [F.size(pii.of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}")
              for k in pii.KINDS if k != "term"]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best window."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation whose texts hold control strings, as a list of messages.
CONTROL_CONVERSATION = "</s>[INST] ok [/INST]"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back from the output."""
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.array(*[F.struct(F.lit(role).alias("role"), F.lit(CONTROL_CONVERSATION).alias("content"))
                  for role in ("user", "assistant")]).alias("messages"))
    turns = chat.to_turns(table(spark, sf_dir, "conversations")).unionByName(chat.to_turns(extra))
    back = chat.read_segments(stored(chat.segments(turns), "chat"))
    each = F.struct("turn", "role", "text", "loss_text")
    whole = back.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(each)).alias("s"),
        F.sum(F.char_length("loss_text")).alias("loss_chars"), F.sum("n_chars").alias("formatted_chars"))
    turn_text = F.transform("s", lambda s: F.concat(s["role"], F.lit("\n"), s["text"], F.lit("\n")))
    loss_text = F.transform("s", lambda s: s["loss_text"])     # null joins as nothing
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(turn_text, ""), 256).alias("turns_sha256"),
        F.coalesce("loss_chars", F.lit(0)).cast("long").alias("loss_chars"),
        F.sha2(F.array_join(loss_text, ""), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    folder = warc.archive_folder(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held))
    return langid.predict(docs, model, keep={"held_out": held})


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids of every document and the text decoded from them."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of nearly equal bytes."""
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings."""
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged, with its faults and its cheapest repair."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    reports = stored(repair.report(rows), "repair")
    hashes = repair.digests(repair.repaired_turns(rows, reports)).withColumnRenamed("conv_id", "id")
    return reports.join(hashes, reports.conv_id.eqNullSafe(hashes.id), "left").select(
        *reports.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the longer documents, drawn towards the benchmark's texts."""
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by a rank file, and the bytes decoded from them."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bytebpe.encode_documents(table(spark, sf_dir, "documents"), *vocabulary)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bytebpe.decode_documents(encoded, vocabulary[0]).select(
        "doc_id", "n_tokens", F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_chat": op5_chat,
    "op6_warc": op6_warc,
    "op7_langid": op7_langid,
    "op8_bpe": op8_bpe,
    "op9_sharding": op9_sharding,
    "op10_nn_descent": op10_nn_descent,
    "op11_repair": op11_repair,
    "op12_resample": op12_resample,
    "op13_byte_bpe": op13_byte_bpe,
}

# -- SQL ---------------------------------------------------------------------------
# Written from the contracts.  The template's marks and escape rule are its own
# fixed values, stated here a second time.

_ESCAPE = r"""regexp_replace(regexp_replace({0},
    '(<)(\x{{E000}}*)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>|\|endoftext\|>)',
    '\1' || chr(57344) || '\2\3', 'g'),
    '(\[)(\x{{E000}}*)(INST\]|/INST\])', '\1' || chr(57344) || '\2\3', 'g')"""

OP5_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length({_ESCAPE.format("role")}) + length('<|im_sep|>')
      + length({_ESCAPE.format("text")}) + length('<|im_end|>'))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS latest
  FROM pages),
d AS (SELECT *, sha1(payload) AS h FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31), 1)
    FOR i IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM d
"""

# All links by comparing all pairs of a label; the search finds all of them on
# the given tables (its audit says so), so the results are equal.
OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding])),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""

# CRC-32 byte by byte, over a table that the rule makes.
_CRC_TABLE = """
crc_bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crc FROM crc_bits WHERE k = 8)"""


def _crc_sql(text: str) -> str:
    """CRC-32 of a string; ``crc`` is the table."""
    octets = f"[('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen({text}))]"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])), 4294967295)")


# The cheapest edits by steps over all conversations at once: for every state,
# the least cost and audit so far, as text with the cost in front.
OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
dealt AS (SELECT keyed.*, {_crc_sql("k")} % 20 AS fault FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dealt WHERE fault <> 0),
placed AS (
  SELECT *, sha256(length(role) || ':' || role || text) AS h,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS n
  FROM damaged),
faults AS (
  SELECT *, substr(role, 1, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS seen
  FROM placed),
rows_ AS (
  SELECT *, said = '' AS blank, said <> '' AND seen AS duplicate,
    said <> '' AND NOT seen AND right(said, 1) NOT IN ('.', '!', '?') AS truncated
  FROM faults),
conv AS (
  SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
items AS (
  SELECT c, n, initial, blank OR duplicate AS must_go, CASE WHEN truncated THEN 5 ELSE 0 END AS price
  FROM rows_ JOIN conv ON rows_.conv_id IS NOT DISTINCT FROM conv.conv_id),
edges(letter, initial, cost, before, after) AS (
  VALUES ('D', NULL, 2, 0, 0), ('D', NULL, 2, 1, 1), ('D', NULL, 2, 2, 2), ('D', NULL, 2, 3, 3),
    ('R', NULL, 1, 0, 2), ('R', NULL, 1, 1, 2), ('R', NULL, 1, 2, 3), ('R', NULL, 1, 3, 2),
    ('K', 's', 0, 0, 1), ('K', 'u', 0, 0, 2), ('K', 'u', 0, 1, 2), ('K', 'u', 0, 3, 2), ('K', 'a', 0, 2, 3)),
inserts(letters, cost, before, after) AS (
  VALUES ('', 0, 0, 0), ('', 0, 1, 1), ('', 0, 2, 2), ('', 0, 3, 3),
    ('I', 5, 0, 2), ('I', 5, 1, 2), ('I', 5, 2, 3), ('I', 5, 3, 2),
    ('II', 10, 0, 3), ('II', 10, 1, 3), ('II', 10, 2, 2), ('II', 10, 3, 3)),
paths(c, n, state, best) AS (
  SELECT c, 0, 0, '0000000000' FROM conv
  UNION ALL
  SELECT paths.c, any_value(items.n)::INT, edges.after,
    min(printf('%010d', left(best, 10)::BIGINT + inserts.cost + edges.cost
          + CASE WHEN edges.letter = 'D' THEN 0 ELSE price END)
        || substr(best, 11) || inserts.letters || edges.letter)
  FROM paths JOIN items ON items.c = paths.c AND items.n = paths.n + 1
  JOIN inserts ON inserts.before = paths.state
  JOIN edges ON edges.before = inserts.after AND (edges.letter = 'D' OR NOT must_go)
    AND (edges.letter <> 'K' OR edges.initial = items.initial)
  GROUP BY paths.c, edges.after),
ended AS (
  SELECT paths.c, min(printf('%010d', left(best, 10)::BIGINT + inserts.cost) || substr(best, 11) || letters) AS best
  FROM paths JOIN inserts ON inserts.before = paths.state
  WHERE inserts.after IN (0, 3) AND paths.n = (SELECT coalesce(max(n), 0) FROM items WHERE items.c = paths.c)
  GROUP BY paths.c),
letters AS (
  SELECT c, i, substr(best, 10 + i, 1) AS letter FROM (
    SELECT c, best, unnest(range(1, length(best) - 9)) AS i FROM ended)),
edits AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY c ORDER BY i) AS n FROM letters),
kept AS (
  SELECT edits.c, i, letter, items.initial, r.role, r.text,
    count(*) FILTER (NOT (letter = 'K' AND items.initial = 's')) OVER (PARTITION BY edits.c ORDER BY i) AS spoken
  FROM edits JOIN conv ON conv.c = edits.c
  LEFT JOIN items ON items.c = edits.c AND items.n = edits.n AND letter <> 'I'
  LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM conv.conv_id AND r.n = edits.n AND letter <> 'I'
  WHERE letter <> 'D'),
lines AS (
  SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN spoken % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS whole
  FROM kept GROUP BY c),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(blank) AS blank,
    count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
    count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id)
SELECT conv.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, left(best, 10)::BIGINT AS cost, substr(best, 11) AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM conv JOIN ended ON ended.c = conv.c LEFT JOIN lines ON lines.c = conv.c
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM conv.conv_id
"""

OP12_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
texts AS (
  SELECT 's' AS side, doc_id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 't', NULL, row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, doc_id, r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT side, r, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM words),
feature_counts AS (SELECT f, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM features GROUP BY f),
hashed AS (SELECT f, s, t, {_crc_sql("f")} % 10000 AS bucket FROM feature_counts, crc_table),
buckets AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM hashed GROUP BY bucket),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM buckets),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM buckets, totals),
weights AS (
  SELECT r, count(*) AS n_features, floor(sum(gain)::BIGINT / count(*))::BIGINT AS weight
  FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 's'),
places AS (
  SELECT *, CASE WHEN n_words >= 20 THEN
    row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) END AS place
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) FROM scored WHERE n_words >= 20) * 25 // 100 THEN place END AS rank
FROM places
"""

SQL: dict[str, str] = {"op5_chat": OP5_SQL, "op6_warc": OP6_SQL, "op10_nn_descent": OP10_SQL,
                       "op11_repair": OP11_SQL, "op12_resample": OP12_SQL}
