"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.llm import (
    bpe,
    chat,
    imatch,
    lexical_search,
    mixing,
    near_dedup,
    prefix_trie,
    quality_gam,
    quality_rules,
    sharding,
    site_style,
    suffix_dedup,
    token_files,
)
from pointlake.llm.common import table
from pointlake.plans.registry import Query

QUERIES: dict[str, Query] = {}


def query(oracle: str | None = None):
    def register(run):
        QUERIES[run.__name__] = Query(run, oracle)
        return run

    return register


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token ids of all documents to files and reads them back."""
    folder = token_files.write_tokens(table(spark, sf_dir, "documents"))
    return token_files.read_tokens(spark, folder)


@query()
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every document; documents of good quality by their label are the target."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = quality_rules.judge(docs.select("doc_id", "text"), labels.where("quality = 1"))
    return judged.select("doc_id", *quality_rules.RESULTS)


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of all documents and of the text they decode to."""
    decoded = bpe.roundtrip(table(spark, sf_dir, "documents"))
    return decoded.select(
        "doc_id", "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


MIX_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)) AS BIGINT) AS h
  FROM documents
), sources AS (
  SELECT source, source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place,
         1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
), ordered AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights,
         coalesce(sum(3 * source_size) OVER w, 0) AS fixed, coalesce(sum(weight) OVER w, 0) AS gone
  FROM sources
  WINDOW w AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), limits AS (
  SELECT arg_min(total - fixed, source_size / weight) AS rest,
         arg_min(all_weights - gone, source_size / weight) AS weights
  FROM ordered
  WHERE (total - fixed) * weight <= 3 * source_size * (all_weights - gone)
), targets AS (
  SELECT source, source_size,
         CASE WHEN rest * weight > 3 * source_size * weights THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(rest * weight AS DOUBLE) / weights END AS target
  FROM sources CROSS JOIN limits
), running AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds,
         sum(size) OVER (PARTITION BY s.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (rounds + CASE WHEN upto <= CAST(floor(target) AS BIGINT) - rounds * source_size THEN 1 ELSE 0 END) AS BIGINT)
         AS taken
FROM running
"""


@query(MIX_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(mixing.document_sizes(docs), size=F.col("size"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


@query()
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates that every document belongs to."""
    return near_dedup.classes(table(spark, sf_dir, "documents"))


@query()
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks the template's own marks, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.read_back(chat.format_turns(turns.unionByName(probe)))


@query()
def op3_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return site_style.extract(table(spark, sf_dir, "pages"))


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the removal of repeated passages leaves of every document."""
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


@query()
def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, by a model of the labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_gam.score(docs, quality_gam.train(docs, labels))


@query()
def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return imatch.with_edits(table(spark, sf_dir, "documents"))


TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place,
         length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
         strlen(coalesce(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL
), lengths AS (
  SELECT conv_id, count(*) AS n,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda r, b: list_reduce(list_concat([xor(r, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
               lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h
  FROM own GROUP BY conv_id
), convs AS (
  SELECT a.*, a.conv_id - ((a.conv_id % 5) + 5) % 5 AS base, least(a.h, coalesce(b.n, 0)) AS head
  FROM lengths a LEFT JOIN lengths b ON b.conv_id = a.conv_id - ((a.conv_id % 5) + 5) % 5
), turns AS (
  SELECT c.conv_id, o.place - c.h + c.head + 1 AS depth, said, n_bytes FROM own o JOIN convs c ON o.conv_id = c.conv_id WHERE o.place >= c.h
  UNION ALL
  SELECT c.conv_id, o.place + 1, said, n_bytes FROM own o JOIN convs c ON o.conv_id = c.base WHERE o.place < c.head
), prefixes AS (
  SELECT conv_id, depth, n_bytes,
         sha256(string_agg(sha256(said), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM turns
  UNION ALL
  SELECT conv_id, 0, 0, '', NOT EXISTS (SELECT 1 FROM turns t WHERE t.conv_id = c.conv_id) FROM convs c
), nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(n_bytes) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), links AS (
  SELECT a.node, p.node AS parent
  FROM nodes a JOIN prefixes p ON p.conv_id = a.conv_id AND p.depth = a.depth - 1
), kids AS (
  SELECT parent AS node, count(*) AS n_children FROM links GROUP BY parent
), below AS (
  SELECT p.node, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.node = n.node
  GROUP BY p.node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN kids k ON k.node = n.node
LEFT JOIN links l ON l.node = n.node LEFT JOIN nodes u ON u.node = l.parent
"""


@query(TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with its members."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query()
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and the place in it of every document."""
    return sharding.placed(table(spark, sf_dir, "documents"))


SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), lengths AS (
  SELECT place, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM docs WHERE len(terms) > 0
), sums AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), occurrences AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM lengths)
  WHERE term IN (SELECT term FROM items) GROUP BY place, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(s.docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM occurrences, sums s GROUP BY term
), scores AS (
  SELECT i.item_id, l.place, l.doc_id,
         CAST(sum(w.w * ((1000000000 * o.tf) // (1000 * o.tf + 8 * (100 - 90 + (90 * l.n * s.docs) // s.words)))) AS BIGINT) AS score
  FROM items i JOIN occurrences o ON o.term = i.term JOIN weights w ON w.term = i.term
  JOIN lengths l ON l.place = o.place CROSS JOIN sums s
  GROUP BY i.item_id, l.place, l.doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


@query(SEARCH_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
