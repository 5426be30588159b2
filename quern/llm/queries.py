"""The registered queries of the operators of this package, each with its SQL where SQL can express it.

Every query applies its operator with production parameters to the whole of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.chat import format_turns, read_back
from quern.llm.exact_dedup import exact_groups
from quern.llm.host_paths import main_text
from quern.llm.language import held_out, identify, train
from quern.llm.licenses import scan, scan_sql
from quern.llm.max_score import top_k
from quern.llm.packing import pack
from quern.llm.piecewise import edited_pairs
from quern.llm.residues import hard_negatives
from quern.llm.reversed_search import search
from quern.llm.shingle_join import linked_components
from quern.llm.transducer import digests
from quern.llm.warc import archived
from quern.plans.tables import table


def op1_warc(spark: SparkSession, directory: str) -> DataFrame:
    """Every page as a WARC record, read back through the merged index. Captures are a second apart by page id."""
    index = archived(
        spark, table(spark, directory, "pages"), timestamp=F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id"))
    )
    return index.select(
        F.col("record").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "url_key",
    )


OP1_SQL = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
  regexp_replace(regexp_replace(lower(trim(coalesce(url, ''))), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '') AS url
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id,
  regexp_replace(regexp_replace(regexp_extract(url, '^[^/?]*'), '^[^@]*@|:[0-9]*$', ''), '^www[0-9]*\\.', '') AS host
  FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to,
  array_to_string(list_reverse(string_split(host, '.')), ',') || ')/'
    || regexp_replace(url, '^[^/?]*/?', '') AS url_key
FROM f
"""


def op2_licenses(spark: SparkSession, directory: str) -> DataFrame:
    """Licences of all documents as files: source, then two directories by id; every fifth is named LICENSE."""
    number = F.col("doc_id").cast("string")
    path = F.concat_ws(
        "/",
        F.coalesce("source", F.lit("none")),
        F.concat(F.lit("a"), (F.col("doc_id") % 7).cast("string")),
        F.concat(F.lit("b"), (F.col("doc_id") % 11).cast("string")),
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("LICENSE."), number)).otherwise(F.concat(number, F.lit(".txt"))),
    )
    docs = table(spark, directory, "documents")
    return scan(docs.select("doc_id", path.alias("path"), "text"))


OP2_SQL = scan_sql("""
SELECT concat_ws('/', coalesce(source, 'none'), 'a' || doc_id % 7, 'b' || doc_id % 11,
  CASE WHEN doc_id % 5 = 0 THEN 'LICENSE.' || doc_id ELSE doc_id || '.txt' END) AS path, doc_id, coalesce(text, '') AS text
FROM documents""")


def op3_main_text(spark: SparkSession, directory: str) -> DataFrame:
    """The main text of all pages."""
    return main_text(table(spark, directory, "pages"))


def op4_pieces(spark: SparkSession, directory: str) -> DataFrame:
    """All documents encoded into SentencePiece ids and decoded again."""
    return digests(table(spark, directory, "documents"))


def op5_packing(spark: SparkSession, directory: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(spark, table(spark, directory, "documents")).withColumnRenamed("doc", "doc_id")


def op6_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Exact groups of all documents, with the digest of every row."""
    return exact_groups(table(spark, directory, "documents"), hash_all=True).withColumnRenamed("keep", "keep_id")


OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS n FROM documents),
g AS (SELECT doc_id, n, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY n) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(n) AS text_sha256 FROM g
"""


def op7_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_pairs(table(spark, directory, "documents"))


def op8_language(spark: SparkSession, directory: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = table(spark, directory, "documents")
    model = train(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_shingle_join(spark: SparkSession, directory: str) -> DataFrame:
    """Components of all documents under links of 0.8 Jaccard similarity of five-word shingles."""
    return linked_components(table(spark, directory, "documents")).withColumnRenamed("component", "component_id")


OP9_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5
    THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS set FROM w),
t AS MATERIALIZED (SELECT doc_id, unnest(set) AS shingle FROM s),
z AS MATERIALIZED (SELECT doc_id, len(set) AS n FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM c JOIN z p ON p.doc_id = x JOIN z q ON q.doc_id = y
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM z UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.reached = l.x)
SELECT z.doc_id, CAST(n AS BIGINT) AS n_shingles, min(reached) AS component_id
FROM z JOIN r ON z.doc_id = r.doc_id GROUP BY z.doc_id, n
"""


def op10_chat(spark: SparkSession, directory: str) -> DataFrame:
    """All conversations and one full of control strings, formatted and read back."""
    turns = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return read_back(format_turns(turns.unionByName(probe)))


OP10_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (SELECT *,
  replace(replace(replace(text, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\c') AS escaped,
  replace(replace(replace(replace(role, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\c'), ': ', '\\d') AS name FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ') + length(name) + length(': ') + length(escaped) + length('</turn>') + 1) AS BIGINT)
    AS formatted_chars
FROM e GROUP BY conv_id
"""


def op11_reversed_search(spark: SparkSession, directory: str) -> DataFrame:
    """The ten best of all documents per benchmark item."""
    items = spark.read.schema("item_id bigint, text string").parquet(f"{directory}/benchmark.parquet")
    return search(table(spark, directory, "documents"), items)


OP11_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS repeats FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
c AS MATERIALIZED (SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
z AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM c, z GROUP BY term),
s AS (SELECT item, item_id, row, doc_id, CAST(sum(repeats * weight
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN c USING (term) JOIN w USING (term), z GROUP BY item, item_id, row, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 10
"""


def _embeddings(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.schema("vec_id bigint, embedding array<float>, label int").parquet(f"{directory}/embeddings.parquet")


def op12_max_score(spark: SparkSession, directory: str) -> DataFrame:
    """The twenty nearest of all embeddings for every twentieth."""
    return top_k(_embeddings(spark, directory), F.col("vec_id") % 20 == 0)


_FINITE_SQL = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP12_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS c
  FROM embeddings WHERE {_FINITE_SQL}),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.c, v.c) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""


def op13_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    """Ten negatives for each of the five positives of every hundredth embedding, every seventh label moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_embeddings(spark, directory), F.col("vec_id") % 100 == 0, moved)


OP13_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings WHERE label IS NOT NULL AND {_FINITE_SQL}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_inner_product(a.c, v.c) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 10
"""

QUERIES = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_licenses": (op2_licenses, OP2_SQL),
    "op3_main_text": (op3_main_text, None),
    "op4_pieces": (op4_pieces, None),
    "op5_packing": (op5_packing, None),
    "op6_exact_dedup": (op6_exact_dedup, OP6_SQL),
    "op7_fingerprints": (op7_fingerprints, None),
    "op8_language": (op8_language, None),
    "op9_shingle_join": (op9_shingle_join, OP9_SQL),
    "op10_chat": (op10_chat, OP10_SQL),
    "op11_reversed_search": (op11_reversed_search, OP11_SQL),
    "op12_max_score": (op12_max_score, OP12_SQL),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
