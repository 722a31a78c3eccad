"""The registered ``opN_<name>`` queries: each operator over its whole table.

The digest columns are derived here from the operators' outputs. Where SQL can
state the result, ``ORACLES`` has it for DuckDB; the tests compare the others
with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch
from tillandsia.llm.bpe_codec import bpe_round_trip
from tillandsia.llm.centroid_clusters import centroid_clusters, with_inertia
from tillandsia.llm.chat_format import chat_examples, loss_text, parsed_turns
from tillandsia.llm.embedding_dedup import embedding_components
from tillandsia.llm.exact_dedup import exact_groups
from tillandsia.llm.minhash_dedup import minhash_components
from tillandsia.llm.packing import pack_documents
from tillandsia.llm.phrase_mining import phrases
from tillandsia.llm.quality import quality_scores
from tillandsia.llm.sharding import shard_documents
from tillandsia.llm.token_counts import token_counts
from tillandsia.llm.token_grammar import read_token_files, write_token_files
from tillandsia.llm.warc import read_warc, write_warc
from tillandsia.sources.tables import read_table

#: Special tokens of byte_bpe_50k.json, whose strings count as one id.
SPECIAL = {"<|endoftext|>": 50256}


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a WARC record per page to the shared folder and reads the archives back."""
    scratch = Scratch(spark, "warc")
    pages = read_table(spark, sf_dir, "pages")
    archives = scratch.save(write_warc(pages, f"{scratch.path}/archives"), "manifest")
    return read_warc(archives, with_payload=False).select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by byte_bpe_50k.json."""
    docs = read_table(spark, sf_dir, "documents")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal counts."""
    return shard_documents(read_table(spark, sf_dir, "documents"), 40)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return embedding_components(read_table(spark, sf_dir, "embeddings"), 0.95)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 3-word shingles at 85 percent."""
    docs = read_table(spark, sf_dir, "documents")
    return minhash_components(docs, words=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and number -1, formatted and read back from the examples."""
    control = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(control).alias("text"),
    )
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    examples = chat_examples(table.unionByName(own))
    back = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.array_sort(
            F.collect_list(F.struct("example", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("text")))
        ).alias("losses"),
        F.sum(F.char_length("formatted")).alias("formatted_chars"),
    )
    turns, losses = F.col("turns"), F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return back.select("conv_id", parsed_turns(F.col("whole")).alias("turns"), losses.alias("loss"), "formatted_chars").select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from labels that are not held out."""
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by byte_bpe_50k.tiktoken and decoded again."""
    docs = read_table(spark, sf_dir, "documents")
    out = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best collocations."""
    return phrases(read_table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 40 clusters after 5 rounds."""
    return with_inertia(*centroid_clusters(read_table(spark, sf_dir, "embeddings")))


def op13_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents to grammar-compressed files and reads them back."""
    scratch = Scratch(spark, "token-files")
    docs = read_table(spark, sf_dir, "documents")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    files = write_token_files(docs, f"{scratch.path}/files", vocabulary, public_tokenizers.PATTERN)
    return read_token_files(scratch.save(files, "manifest"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_sharding": op3_sharding,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_packing": op10_packing,
    "op11_phrases": op11_phrases,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_token_grammar": op13_token_grammar,
}

#: One round of the clustering in SQL: assignments ``a{i}`` by centroids ``c{i}``, and the centroids after it.
_ASSIGN = """
a{i} AS MATERIALIZED (
    SELECT vec_id, x, CAST(m % 1000 AS INTEGER) AS c, CAST(m // 1000 AS BIGINT) AS d FROM (
        SELECT v.vec_id, v.x, min(1000 * CAST(list_sum(list_transform(list_zip(v.x, c{i}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS HUGEINT) + c{i}.c) AS m
        FROM v, c{i} GROUP BY v.vec_id, v.x)
)"""
_MOVE = """,
s{i} AS (SELECT c, j, sum(x[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) r(j) GROUP BY c, j),
c{k} AS MATERIALIZED (
    SELECT c{i}.c, coalesce(y.x, c{i}.x) AS x FROM c{i}
    LEFT JOIN (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM s{i} GROUP BY c) y ON y.c = c{i}.c
),"""
_ROUNDS = "".join(_ASSIGN.format(i=i) + _MOVE.format(i=i, k=i + 1) for i in range(5)) + _ASSIGN.format(i=5)

#: DuckDB SQL of the results that SQL can state. ``translate`` lower-cases A-Z alone. Tokens,
#: learned scores, shards and packings it can't state.
ORACLES = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT html, min(page_id) AS first_id, upper(sha1(html)) AS hex FROM p GROUP BY html),
b AS (
    SELECT html, first_id, array_to_string(list_transform(range(1, 41), lambda i:
        substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789ABCDEF', substr(hex, i, 1)) - 3, 4)), '') AS bits
    FROM d
),
g AS (
    SELECT html, first_id, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
        + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INTEGER)
        + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INTEGER)
        + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER), 1)), '') AS payload_digest
    FROM b
)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, g.payload_digest,
       CASE WHEN g.first_id IS NULL OR p.page_id = g.first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.first_id IS NULL OR p.page_id = g.first_id THEN NULL ELSE g.first_id END AS refers_to
FROM p JOIN g ON p.html = g.html
""".strip(),
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
heads AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT h.vec_id, coalesce(d.n_links, 0) AS n_links, h.component_id, h.vec_id = h.component_id AS kept
FROM heads h LEFT JOIN degrees d ON h.vec_id = d.vec_id
""".strip(),
    "op5_minhash_dedup": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingles
    FROM w
),
x AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON r.other = p.a
),
heads AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, h.component_id, s.doc_id = h.component_id AS kept
FROM s JOIN heads h ON s.doc_id = h.doc_id
""".strip(),
    "op6_chat_format": r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
n AS (
    SELECT *, row_number() OVER own AS i, count(*) OVER (PARTITION BY conv_id) AS turns,
        length('<s>[INST][/INST]</s>')
        + length(regexp_replace(role, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g'))
        + length(regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g')) AS chars
    FROM c WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
e AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = 'assistant' OR i = turns) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""".strip(),
    "op8_exact_dedup": """
WITH n AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
""".strip(),
    "op11_phrases": r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, m, w[i:i + m - 1] AS p FROM w, range(1, 6) ms(m), range(1, len(w) - m + 2) starts(i)),
f AS MATERIALIZED (SELECT lang, p, count(*) AS f FROM g GROUP BY lang, p HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
absorbed AS (
    SELECT DISTINCT x.lang, x.p[i:i + m - 1] AS p FROM f x, range(2, 5) ms(m), range(1, len(x.p) - m + 2) starts(i)
    JOIN f y ON true WHERE len(x.p) > m AND y.lang = x.lang AND y.p = x.p[i:i + m - 1] AND 100 * x.f >= 100 * y.f
),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND (lang, p) NOT IN (SELECT (lang, p) FROM absorbed)),
cuts AS (
    SELECT c.lang, c.p, c.a, n.n, x.f AS l, y.f AS r, k,
        CAST(CAST(1000 AS HUGEINT) * c.a * n.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, len(p))) AS k FROM c) c JOIN n ON n.lang = c.lang
    JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
    SELECT *, array_to_string(p, ' ') AS phrase,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, CAST(encode(array_to_string(p, ' ')) AS BLOB)) AS rank
    FROM lowest
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""".strip(),
    "op12_centroid_clusters": f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER o - 1 AS INTEGER) AS c, x FROM v
    WINDOW o AS (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) QUALIFY row_number() OVER o <= 40
),{_ROUNDS}
SELECT a.vec_id, a.c AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c5.x, ',')) AS centroid_sha256
FROM a5 a JOIN c5 ON a.c = c5.c
""".strip(),
}
