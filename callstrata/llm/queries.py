"""Queries of the corpus operators over the given tables, and the SQL some of them must equal."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from callstrata.llm import align as G
from callstrata.llm import ann as A
from callstrata.llm import decontaminate as D
from callstrata.llm import docprints as H
from callstrata.llm import licenses as N
from callstrata.llm import lines as L
from callstrata.llm import packing as P
from callstrata.llm import quality as Q
from callstrata.llm import ranked as K
from callstrata.llm import simhash as S
from callstrata.llm import spans as R
from callstrata.llm import token_store as T
from callstrata.llm import warc as C
from callstrata.llm.common import table
from callstrata.llm.tokens import with_crc
from callstrata.session import use_checkpoint_dir

END_ID = 2


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _folder(spark, name: str) -> str:
    """A new folder that all executors share."""
    return f"{use_checkpoint_dir(spark).rstrip('/')}/callstrata/{name}-{uuid.uuid4().hex}"


def op1_quality(spark, sf):
    docs = table(spark, sf, "documents")
    weights = Q.fit(docs, table(spark, sf, "labels"))
    return Q.score(docs.select("doc_id", "text"), weights).select(
        "doc_id", Q.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= Q.Settings.accept).cast("int").alias("predicted"),
    )


def op2_token_store(spark, sf):
    path = _folder(spark, "tokens")
    T.write_tokens(table(spark, sf, "documents"), path, tokenizer_file("word_bpe_49k.json"), END_ID)
    return with_crc(T.read_tokens(spark, path))


def op3_simhash(spark, sf):
    found = S.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_repeated_spans(spark, sf):
    """Documents that repeat passages, and the documents that keep them, by sentence numbers."""
    return R.repeated_sentences(table(spark, sf, "documents")).groupBy("doc_id", "first_doc_id").agg(
        F.count(F.lit(1)).alias("sentences"), F.min("sentence").cast("bigint").alias("first_sentence"),
        F.max("sentence").cast("bigint").alias("last_sentence"))


def op5_packing(spark, sf):
    return P.pack(table(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"), END_ID).drop("ids")


def op6_licenses(spark, sf):
    """Documents that state a license, with the notice and where it stands."""
    return N.licenses(table(spark, sf, "documents")).drop("text_key")


def op7_warc(spark, sf):
    path = _folder(spark, "warc")
    C.archive(table(spark, sf, "pages"), path)
    return C.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_decontamination(spark, sf):
    """Documents that hold a benchmark passage, with the item and where it lies."""
    return D.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("text_key")


def op9_line_dedup(spark, sf):
    return L.drop_boilerplate(table(spark, sf, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "source", "text", F.col("__lines_dropped").cast("bigint").alias("lines_dropped"))


def op10_neighbours(spark, sf):
    return A.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_document_prints(spark, sf):
    return H.edited_likeness(table(spark, sf, "documents"))


def op12_ranked_search(spark, sf):
    return K.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_token_alignment(spark, sf):
    return G.tokens_aligned(
        table(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


OP4_SQL = r"""
WITH pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?][ \t\r\n\f]+|\n[ \t\r\n\f]*)', '\1' || chr(1), 'g'), chr(1)) AS p
        FROM documents)),
plain AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS p, s
  FROM (SELECT doc_id, k, trim(regexp_replace(lower(piece), '[ \t\r\n\f]+', ' ', 'g')) AS s FROM pieces)
  WHERE s <> ''),
counted AS (SELECT *, sum(len(string_split(s, ' '))) OVER (PARTITION BY doc_id ORDER BY p) AS upto FROM plain),
ends AS (
  SELECT a.doc_id, a.p, b.p AS last, b.upto - a.upto + len(string_split(a.s, ' ')) AS w
  FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p + 1 AND a.p + 49
  WHERE b.upto - a.upto + len(string_split(a.s, ' ')) >= 25),
-- longer runs cover no sentence that those below do not
reach AS (SELECT * FROM (SELECT *, min(w) OVER (PARTITION BY doc_id, p) AS least FROM ends) WHERE w < least + 25),
long_runs AS (
  SELECT r.doc_id, r.p, r.last - r.p + 1 AS n, string_agg(c.s, chr(1) ORDER BY c.p) AS run
  FROM reach r JOIN plain c ON r.doc_id = c.doc_id AND c.p BETWEEN r.p AND r.last GROUP BY r.doc_id, r.p, r.last),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS place,
         min(doc_id) OVER (PARTITION BY run) AS first_doc_id FROM long_runs),
covered AS (
  SELECT doc_id, unnest(range(p, p + n)) AS sentence, first_doc_id FROM ranked WHERE place > 1),
each AS (SELECT doc_id, sentence, min(first_doc_id) AS first_doc_id FROM covered GROUP BY ALL)
SELECT doc_id, first_doc_id, count(*) AS sentences, min(sentence) AS first_sentence, max(sentence) AS last_sentence
FROM each GROUP BY doc_id, first_doc_id
"""

OP7_SQL = """
WITH own AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (SELECT page_id, payload, octet_length(encode(payload)) AS n FROM own),
best AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM sized)
SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM best
"""

OP9_SQL = """
WITH pages AS (SELECT DISTINCT source, text FROM documents),
on_page AS (
  SELECT DISTINCT source, text, trim(line) AS line
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)
  WHERE trim(line) <> ''),
listed AS (
  SELECT l.source, l.line
  FROM (SELECT source, line, count(*) AS n FROM on_page GROUP BY ALL) l
  JOIN (SELECT source, count(*) AS total FROM pages GROUP BY ALL) t
    ON l.source IS NOT DISTINCT FROM t.source
  WHERE l.n >= 5 AND l.n > 0.08 * t.total),
own AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
marked AS (
  SELECT o.*, l.line IS NOT NULL AS bad
  FROM own o LEFT JOIN listed l ON o.source IS NOT DISTINCT FROM l.source AND trim(o.line) = l.line)
SELECT doc_id, source, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS text,
       count(*) FILTER (bad) AS lines_dropped
FROM marked GROUP BY doc_id, source
"""

OP12_SQL = r"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, row, words, len(words) AS n FROM cut WHERE len(words) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sized),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(words) AS term FROM sized) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, row,
         sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN df USING (term) CROSS JOIN whole GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def all_queries():
    return {
        "op1_quality": op1_quality, "op2_token_store": op2_token_store, "op3_simhash": op3_simhash,
        "op4_repeated_spans": op4_repeated_spans, "op5_packing": op5_packing, "op6_licenses": op6_licenses, "op7_warc": op7_warc,
        "op8_decontamination": op8_decontamination,
        "op9_line_dedup": op9_line_dedup, "op10_neighbours": op10_neighbours,
        "op11_document_prints": op11_document_prints, "op12_ranked_search": op12_ranked_search,
        "op13_token_alignment": op13_token_alignment,
    }


def all_sql():
    return {"op4_repeated_spans": OP4_SQL, "op7_warc": OP7_SQL, "op9_line_dedup": OP9_SQL,
            "op12_ranked_search": OP12_SQL}
