"""The registered queries of the text operators and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from public_tokenizers import path as vocabulary_path

from cascata.llm import (
    ann, bpe, cap_filters, ctw, filter_audit, hybrid_search, lang_id, packing, perfect_dedup, quality, simhash, toxicity, url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, divisor: int):
    """crc32 of the id written as text, modulo a number."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def language_model(docs: DataFrame) -> lang_id.LanguageModel:
    return lang_id.fit(docs, id_remainder("doc_id", 4) != 2)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lang_id.predict(docs.select("doc_id", "text"), language_model(docs))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 10) == 0, stored=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs)).drop("text")


def packed(docs: DataFrame) -> DataFrame:
    crc = packing.Digest("ids_crc32", T.LongType(), pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"), digest=crc)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.grade(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("text")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


# The rules of the contract, and the host names whose pages make up the list.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]
LISTED_HOSTS = ["ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets"]
LISTED_PATTERN = f"(^|[.])({'|'.join(LISTED_HOSTS)})[.]"


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is every canonical URL met on one of the listed hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    listed = pages.where(host.rlike(LISTED_PATTERN)).select(url_filter.canonical(host, path).alias("canonical_url"))
    return url_filter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = f"""
WITH parsed AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), named AS (
    SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '')
                || regexp_replace(regexp_replace(path, '\\.html$', ''), '/+$', '') END AS canonical_url
    FROM parsed
), listed AS (
    SELECT DISTINCT canonical_url AS u FROM named WHERE regexp_matches(host, '{LISTED_PATTERN}') AND canonical_url IS NOT NULL
), ruled AS (
    SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                   WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                   WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                   WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM named
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN u IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed ON canonical_url = u
"""


def op9_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = vocabulary_path("byte_bpe_50k.json")
    shared = bpe.share(docs, path)

    def digests(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        coded = bpe.encode_blocks(blocks, bpe.encoder_of(vocabulary, path), "text", "ids")
        for block in bpe.decode_blocks(coded, vocabulary.pieces, "ids", "decoded"):
            lists = block.column(2)
            flat, ends = np.asarray(lists.flatten()).astype("<u4"), np.asarray(lists.offsets)
            ends = (ends - ends[0]).tolist()
            of_ids = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])]
            of_text = [hashlib.sha256(t).hexdigest() for t in block.column(3).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = hybrid_search.build_index(table(spark, sf_dir, "documents"))
    return hybrid_search.rank(index, table(spark, sf_dir, "benchmark"), 50)


OP11_SQL = r"""
WITH found AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), corpus AS (
    SELECT count(*) FILTER (WHERE len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM found
), posting AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM found) GROUP BY ALL
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weight AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM posting, corpus GROUP BY term
), scored AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))))) AS BIGINT) AS score
    FROM asked JOIN posting USING (term) JOIN weight USING (term), corpus GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.masked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP12_SQL = r"""
WITH typed AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), judged AS (
    SELECT part, doc_id,
           (len(words) < 50)::INT
           + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
           + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
           + 8 * regexp_matches(t, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
    FROM typed
), known AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), counted AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM judged LEFT JOIN known USING (doc_id) GROUP BY ALL
), letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a JOIN letter b ON b.x <> a.x JOIN letter c ON c.x NOT IN (a.x, b.x)
    JOIN letter d ON d.x NOT IN (a.x, b.x, c.x) JOIN letter e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
    SELECT *, CAST(1 << (ascii(substr(filter_order, step, 1)) - 65) AS INT) AS bit,
           CAST(coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, CAST(i AS INT), 1)) - 65))), 0) AS INT) AS before
    FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM orders)
), walked AS (
    SELECT part, filter_order, step, bit,
           CAST(sum(n) FILTER (WHERE mask & (bit | before) = 0) AS BIGINT) AS kept,
           CAST(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS BIGINT) AS removed,
           CAST(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0) AS BIGINT) AS redundant,
           CAST(sum(n) FILTER (WHERE mask = bit) AS BIGINT) AS unique_fails,
           CAST(sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS BIGINT) AS good_lost,
           CAST(sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS BIGINT) AS toxic_lost
    FROM counted JOIN steps ON mask >= 0 GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
       coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM walked
"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by the checksum of their ids, count as loaded before."""
    return perfect_dedup.deduplicate(table(spark, sf_dir, "documents"), id_remainder("doc_id", 2) == 0)


OP13_SQL = r"""
WITH named AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size FROM named)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_lm_score": op3_lm_score,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_ann": op7_ann,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_neardup": op9_embedding_neardup,
    "op10_bpe": op10_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op8_url_filter": OP8_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_exact_dedup": OP13_SQL,
}
