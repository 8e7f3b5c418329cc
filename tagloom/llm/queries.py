"""Registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    alignment, convnet, dac, decontaminate, doubling, labelled, mixing, packing, prefix_trie, simhash, subwords, suffixes, urls, vptree,
)
from tagloom.llm.tokens import vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, radius=2)
    return found.select(
        "doc_id", simhash.hex_digits(F.col("simhash")).alias("fingerprint"), F.col("component").alias("component_id")
    )


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The pages have no labels of their own; the labels table is read as outcomes of the pages with its ids."""
    labels = table(spark, folder, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = labels.select(F.col("doc_id").alias("id"), bad.alias("bad"))
    judged = urls.judge(table(spark, folder, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op2_url_filter"] = f"""
WITH two_labels AS (
    SELECT unnest([{', '.join(repr(s) for s in urls.SUFFIXES)}]) AS name
), parsed AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), known AS (
    SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels GROUP BY doc_id
), hosts AS (
    SELECT host, n, bad, array_to_string(list_slice(labels, -1 - size, -1), '.') AS domain,
        array_to_string(list_slice(labels, -size, -1), '.') AS suffix
    FROM (SELECT *, CASE WHEN array_to_string(list_slice(labels, -2, -1), '.') IN (SELECT name FROM two_labels) THEN 2 ELSE 1 END AS size
          FROM (SELECT host, string_split(host, '.') AS labels, count(bad) AS n, coalesce(sum(bad), 0) AS bad
                FROM parsed LEFT JOIN known USING (page_id) GROUP BY host))
), domains0 AS (
    SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix
), suffixes0 AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains0 GROUP BY suffix
), overall AS (
    SELECT (coalesce(sum(bad), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 2.0::DOUBLE) AS mu FROM suffixes0
), suffixes1 AS (
    SELECT s.*, mu FROM suffixes0 s, overall
), suffixes2 AS (
    SELECT *, (SELECT 1 / least(greatest(coalesce((sum(power(bad - n * mu, 2) / (n * mu * (1 - mu))) - count(n))
        / greatest(sum(n) - count(n), 1), 0.001), 0.001), 0.5::DOUBLE) - 1 FROM suffixes1 WHERE n > 0) AS w
    FROM suffixes1
), domains1 AS (
    SELECT d.*, (s.bad + s.w * s.mu) / (s.n + s.w) AS mu FROM domains0 d JOIN suffixes2 s USING (suffix)
), domains2 AS (
    SELECT *, (SELECT 1 / least(greatest(coalesce((sum(power(bad - n * mu, 2) / (n * mu * (1 - mu))) - count(n))
        / greatest(sum(n) - count(n), 1), 0.001), 0.001), 0.5::DOUBLE) - 1 FROM domains1 WHERE n > 0) AS w
    FROM domains1
), hosts1 AS (
    SELECT h.*, (d.bad + d.w * d.mu) / (d.n + d.w) AS mu FROM hosts h JOIN domains2 d USING (domain)
), hosts2 AS (
    SELECT *, (SELECT 1 / least(greatest(coalesce((sum(power(bad - n * mu, 2) / (n * mu * (1 - mu))) - count(n))
        / greatest(sum(n) - count(n), 1), 0.001), 0.001), 0.5::DOUBLE) - 1 FROM hosts1 WHERE n > 0) AS w
    FROM hosts1
), shares AS (
    SELECT host, n + w AS total, (bad + w * mu) / (n + w) AS share FROM hosts2
), fitting AS (
    SELECT p.*, CASE WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM parsed p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN share - 1.645::DOUBLE * sqrt(share * (1 - share) / (total + 1)) > 0.25 THEN 'block' ELSE 'allow' END AS verdict
FROM fitting JOIN shares USING (host)
"""


QUALITY_SAMPLE = 2000  # labelled documents of each class that the classifier is fitted on, at any size
REJECT_BELOW = 0.3


def quality_model(spark: SparkSession, folder: str) -> subwords.Model:
    """Fitted on a bounded sample of the labelled documents that are not held out."""
    labels = table(spark, folder, "labels").filter(~labelled.held_out(F.col("doc_id"), 5, 0))
    sample = labelled.training_sample(table(spark, folder, "documents"), labels, "quality", QUALITY_SAMPLE, cut=subwords.packed)
    return subwords.train(sample.texts, sample.labels, sample.weights)


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = subwords.score(table(spark, folder, "documents"), quality_model(spark, folder), keep=("doc_id",))
    return scored.select(
        "doc_id", labelled.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )



@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on all labelled documents that are not held out.

    ``flagged`` uses the calibrated threshold of the document's language; the language is no input of the score.
    """
    docs = table(spark, folder, "documents")
    free = ~labelled.held_out(F.col("doc_id"), 4, 2)
    labels = table(spark, folder, "labels").filter(free)
    model = convnet.fit(labelled.training_blocks(docs.filter(free), labels, "toxic", convnet.packed, lang="lang"))
    scored = convnet.score(docs, model, keep=("doc_id", "lang"))
    return scored.select(
        "doc_id", labelled.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        convnet.flagged(F.col("score"), F.col("lang"), model).alias("flagged"),
    )


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = dac.write_corpus(table(spark, folder, "documents"), vocabulary())
    read = dac.read_digests(spark.read.parquet(path))
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


ANN_FACTOR = 1.0  # exact


@query
def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=ANN_FACTOR)


ORACLE_SQL["op5_nearest"] = """
WITH usable AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=13)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


ORACLE_SQL["op4_decontamination"] = r"""
WITH item AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), cut AS (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos FROM item WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, list_slice(w, pos, pos + 12) AS words FROM cut
), doc AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), spread AS (
    SELECT row, size, unnest(range(1, len(w) - size + 2)) AS pos, w FROM doc, (SELECT DISTINCT size FROM windows)
), found AS (
    SELECT s.row, s.pos, s.size, item_id FROM spread s JOIN windows v
    ON s.size = v.size AND list_slice(s.w, s.pos, s.pos + s.size - 1) = v.words
), hit AS (
    SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY row
), named AS (
    SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""


@query
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = doubling.remove_repeats(table(spark, folder, "documents"), width=20, digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


@query
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, folder, "documents"), width=100, digest=True)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.col("kept").cast("string").alias("kept_sha256"),
    )


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(packing.token_counts(table(spark, folder, "documents"), vocabulary()))

@query
def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.repetitions(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, most=2.0, keep=("doc_id",))
    return found.select(
        F.col("kept.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )


ORACLE_SQL["op11_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || substr(md5(concat_ws(':', '42', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 13))::BIGINT
            / power(16::DOUBLE, 13) AS coin
    FROM documents
), summed AS (
    SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source::BLOB) - 1) % 3 + 1] AS weight FROM summed
), ordered AS (
    SELECT *, row_number() OVER by_ratio AS place, sum(size) OVER () AS total,
        coalesce(sum(size) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
        sum(weight) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM weighed WINDOW by_ratio AS (ORDER BY size::DOUBLE / weight, source IS NULL, source::BLOB)
), levels AS (
    SELECT *, (1.5::DOUBLE * total::DOUBLE - 2.0::DOUBLE * filled::DOUBLE) / rest::DOUBLE AS level FROM ordered
), chosen AS (
    SELECT arg_min(level, place) AS level FROM levels WHERE weight * level <= 2.0::DOUBLE * size
), targets AS (
    SELECT source, size AS source_size, CASE WHEN weight * level > 2.0::DOUBLE * size THEN 2.0::DOUBLE * size
        ELSE weight * level END AS target
    FROM weighed, chosen
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
), counted AS (
    SELECT doc_id, size, source_size, target,
        (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
    FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM counted
"""


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.shared_prefixes(table(spark, folder, "conversations"), every=20, most=4)


ORACLE_SQL["op13_prefix_trie"] = r"""
WITH numbered AS (
    SELECT conv_id AS c, [coalesce(role, ''), coalesce(text, '')] AS t,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT c, list(t ORDER BY pos) AS turns, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
        string_split(c::VARCHAR, ''), lambda d: list_transform(range(8), lambda i: (ascii(d) >> i::INTEGER) & 1)))),
        lambda crc, bit: xor(crc >> 1, CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END)) AS crc
    FROM numbered GROUP BY c
), known AS (
    SELECT c, turns, xor(crc, 4294967295) % 4 AS h FROM own
), paths AS (
    SELECT k.c, list_concat(coalesce(list_slice(b.turns, 1, k.h), []), list_slice(k.turns, k.h + 1, len(k.turns))) AS path
    FROM known k LEFT JOIN known b ON b.c = k.c - k.c % 20
), spread AS (
    SELECT c, len(path) AS size, unnest(range(len(path) + 1)) AS depth, path FROM paths
), cut AS (
    SELECT c, size, depth, list_slice(path, 1, depth) AS prefix FROM spread
), nodes AS (
    SELECT depth, prefix, min(c) AS conv_id, count(*) AS n, CASE WHEN depth = 0 THEN NULL ELSE list_slice(prefix, 1, depth - 1) END AS up,
        CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[-1][2], '[^\x20\x09-\x0D]+')) END AS words,
        sha256(coalesce(string_agg(CASE WHEN size = depth THEN c END::VARCHAR, ',' ORDER BY c), '')) AS ends_sha256
    FROM cut GROUP BY depth, prefix
), children AS (
    SELECT up AS prefix, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)
), above AS (
    SELECT list_slice(prefix, 1, a) AS prefix, n_children = 0 AS leaf, (n - 1) * words AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS a FROM counted)
), summed AS (
    SELECT prefix, count_if(leaf)::BIGINT AS n_leaves, sum(saved) AS saved FROM above GROUP BY prefix
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
    v.ends_sha256
FROM counted v JOIN summed s USING (prefix) LEFT JOIN counted p ON p.prefix = v.up
"""


@query
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(table(spark, folder, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
