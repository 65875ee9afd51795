"""The registered queries of the operators in this subpackage.

Each takes (spark, sf_dir), applies its operator to the whole of its table with
production parameters, and returns the operator's full result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .balltree import top_k
from .common import table
from .leaks import decontaminate
from .mixing import mix
from .pagetext import extract
from .preference import format_pairs, swapped_replies
from .repeats import remove_passages
from .simhash import near_duplicates
from .suffix import remove_repeats
from .tokencount import count_tokens
from .toxicity import score, train
from .variants import variants
from .warc import round_trip
from .whitening import whiten

# The public byte-pair vocabulary that the token files are made with, and the
# free id that ends a document in them.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return extract(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found in flat token files."""
    return count_tokens(table(spark, sf_dir, "documents"), VOCABULARY, END_OF_DOCUMENT).select("doc_id", "n_tokens")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations against themselves with a neighbour's last reply."""
    return format_pairs(*swapped_replies(table(spark, sf_dir, "conversations")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier elsewhere go from every document."""
    return remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighing 5, 2, 1 share one and a half times all words."""
    return mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives, normalised, and read back record by record."""
    return round_trip(table(spark, sf_dir, "pages"), least=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of benchmark items, found in whole documents; also with
    their words moved or parted, within twelve words."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, span=12)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two or fewer bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 leading components, with unit variance."""
    return whiten(table(spark, sf_dir, "embeddings"), columns=16, scale=64, shift=1_000_000)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, each with the form and the root it belongs to."""
    return variants(table(spark, sf_dir, "documents"), least=5, seen=3, factor=2, every=97)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words that start earlier elsewhere go from every document."""
    return remove_passages(table(spark, sf_dir, "documents"), length=20)


LLM_QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_token_counts": op2_token_counts,
    "op3_topk_search": op3_topk_search,
    "op4_preference_format": op4_preference_format,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_substring_dedup": op13_substring_dedup,
}

LLM_ORACLES: dict[str, str] = {
    "op9_decontamination": """
        WITH d AS (
          SELECT row_number() OVER () AS row, doc_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        b AS (
          SELECT item_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS words
          FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0)),
        places AS (
          SELECT row, size, p, array_to_string(ws[p:p + size - 1], ' ') AS words
          FROM (SELECT row, ws, size, unnest(range(1, len(ws) - size + 2)) AS p
                FROM d JOIN (SELECT DISTINCT size FROM windows) ON len(ws) >= size)),
        hits AS (SELECT row, item_id, p, size FROM places JOIN windows USING (size, words)),
        covered AS (
          SELECT row, count(DISTINCT place) AS n_hit
          FROM (SELECT row, unnest(range(p, p + size)) AS place FROM (SELECT DISTINCT row, p, size FROM hits)) GROUP BY row),
        items AS (
          SELECT row, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY row),
        sets AS (
          SELECT row_number() OVER () AS set_no, item_id, terms
          FROM (SELECT DISTINCT item_id, list_sort(list_distinct(string_split(words, ' '))) AS terms
                FROM windows WHERE item_id IS NOT NULL)),
        term AS (SELECT set_no, unnest(terms) AS word FROM sets),
        word AS (SELECT row, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
        often AS (SELECT word, count(*) AS n FROM word SEMI JOIN term USING (word) GROUP BY word),
        rare AS (SELECT set_no, arg_min(word, coalesce(n, 0)) AS word FROM term LEFT JOIN often USING (word) GROUP BY set_no),
        around AS (
          SELECT row, item_id, terms, p, ws[greatest(p - 11, 1):p + 11] AS part, least(p - 1, 11) AS back
          FROM word JOIN rare USING (word) JOIN sets USING (set_no) JOIN d USING (row)
          WHERE list_has_all(ws[greatest(p - 11, 1):p + 11], terms)),
        near AS (
          SELECT row, count(*) AS n_near, string_agg(name, ',' ORDER BY name) AS near_names
          FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS name
                FROM (SELECT *, unnest(range(1, back + 2)) AS f FROM around)
                WHERE list_has_all(part[f:f + 11], terms)) GROUP BY row)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated,
               CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, sha256(coalesce(near_names, '')) AS near_sha256
        FROM d LEFT JOIN covered USING (row) LEFT JOIN items USING (row) LEFT JOIN near USING (row)
    """,
    "op4_preference_format": """
        WITH turns AS (
          SELECT DISTINCT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC) AS back
          FROM turns WHERE role = 'assistant'),
        swap AS (
          SELECT a.pair_id, a.turn AS last, coalesce(b.text, '') AS other
          FROM numbered a LEFT JOIN numbered b ON b.pair_id = xor(a.pair_id, 1) AND b.back = 1
          WHERE a.back = 1),
        rejected AS (
          SELECT DISTINCT pair_id, turn, role,
                 CASE WHEN turn = last AND role = 'assistant' THEN other ELSE text END AS text
          FROM turns JOIN swap USING (pair_id)),
        chosen AS (SELECT turns.* FROM turns JOIN swap USING (pair_id)),
        differ AS (
          (SELECT * FROM chosen EXCEPT SELECT * FROM rejected) UNION ALL
          (SELECT * FROM rejected EXCEPT SELECT * FROM chosen)),
        split AS (SELECT pair_id, min(turn) AS split FROM differ GROUP BY pair_id),
        parts AS (
          SELECT c.*, CASE WHEN s.split IS NULL OR turn < s.split THEN 'prompt' ELSE 'chosen' END AS part
          FROM chosen c LEFT JOIN split s USING (pair_id)
          UNION ALL
          SELECT r.*, 'rejected' AS part FROM rejected r JOIN split s USING (pair_id) WHERE turn >= s.split),
        turned AS (
          SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
                 part <> 'prompt' AND role = 'assistant' AS learned
          FROM parts),
        spans AS (
          SELECT *, CAST(sum(length(rendered)) OVER (
                   PARTITION BY pair_id, part ORDER BY turn, substr(md5(length(role) || ':' || role || text), 1, 15)
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS span_end
          FROM turned)
        SELECT pair_id, part, turn, role, rendered, CAST(learned AS INT) AS loss_mask,
               span_end - length(rendered) AS span_start, span_end,
               CASE WHEN learned THEN span_end - length(rendered) + length(role) + 5 END AS learn_start,
               CASE WHEN learned THEN span_end END AS learn_end
        FROM spans
    """,
    "op3_topk_search": """
        WITH codes AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS code
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, v.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.code, v.code), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM codes q JOIN codes v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
        ranked AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
          FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op7_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
        digested AS (
          SELECT *, array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((CAST('0x' || substr(h, (j // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31) + 1, 1)), '') AS digest
          FROM p),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY payload ORDER BY page_id NULLS LAST) AS k,
                 first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id NULLS LAST) AS lead
          FROM digested)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN k > 1 THEN lead END AS refers_to
        FROM ranked
    """,
    "op13_substring_dedup": """
        WITH d AS (
          SELECT row_number() OVER () AS row, doc_id,
                 regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        places AS (
          SELECT row, doc_id, p, array_to_string(ws[p:p + 19], ' ') AS words
          FROM (SELECT *, unnest(range(1, len(ws) - 18)) AS p FROM d WHERE len(ws) >= 20)),
        ranked AS (
          SELECT row, p, row_number() OVER (PARTITION BY words ORDER BY doc_id NULLS LAST, p) AS k FROM places),
        gone AS (SELECT DISTINCT row, unnest(range(p, p + 20)) AS place FROM ranked WHERE k > 1),
        word AS (SELECT row, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS place FROM d),
        kept AS (
          SELECT row, count(*) AS n, string_agg(w, ' ' ORDER BY place) AS text
          FROM word ANTI JOIN gone USING (row, place) GROUP BY row)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (row)
    """,
    "op12_spelling_variants": """
        WITH RECURSIVE crc_table AS (
          SELECT list(list_reduce(list_prepend(b, range(8)),
                      lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS t
          FROM (SELECT unnest(range(256)) AS b)),
        runs AS (
          SELECT doc_id, run, count(*) AS n
          FROM (SELECT doc_id, unnest(regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
                FROM documents)
          GROUP BY doc_id, run),
        bytes AS (
          SELECT doc_id, run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
        summed AS (
          SELECT run, n, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(1, length(x), 2),
                     lambda i: (instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
          FROM bytes, crc_table),
        w AS (
          SELECT word, CAST(sum(n) AS BIGINT) AS n
          FROM (SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
                FROM summed)
          GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
        holes AS (
          SELECT word, p, word[1:p - 1] || word[p + 1:] AS rest
          FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM w)),
        near AS (
          SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT holes.word, w.word FROM holes JOIN w ON rest = w.word
          UNION SELECT w.word, holes.word FROM holes JOIN w ON rest = w.word),
        best AS (
          SELECT near.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS other, max(o.n) AS other_n
          FROM near JOIN w o ON near.other = o.word GROUP BY near.word),
        formed AS (
          SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
                 CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
          FROM w LEFT JOIN best USING (word)),
        walk AS (
          SELECT word, word AS root FROM formed
          UNION SELECT walk.word, formed.form FROM walk JOIN formed ON walk.root = formed.word WHERE formed.form IS NOT NULL),
        last AS (SELECT walk.word, walk.root FROM walk JOIN formed ON walk.root = formed.word WHERE formed.form IS NULL)
        SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
        FROM formed JOIN last USING (word)
    """,
}
