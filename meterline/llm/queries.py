"""The registered queries of the training-data operators: thin callers that
read whole tables and derive the result columns from the operators' output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    divergence,
    edit_embedding,
    merkle,
    minhash,
    mixing,
    oracles,
    packing,
    sentencepiece_codec,
    sharding,
    spherical,
    substring,
    toxicity,
    url_lists,
    warc,
)
from meterline.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOXIC_AT = 0.3
SHARDS = 40


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def bytes_of(col) -> F.Column:
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


@register("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", toxicity.hold_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


@register("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    data = bytes_of("text")
    return sharding.shuffle_into_shards(docs, SHARDS).select(
        "doc_id", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op5_minhash", oracles.MINHASH)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op3_substring_dedup", oracles.SUBSTRING)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op8_spherical_caps", oracles.SPHERICAL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical.near_vectors(read_table(spark, sf_dir, "embeddings"))


@register("op4_warc", oracles.WARC)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_bundles(read_table(spark, sf_dir, "pages"))
    return warc.read_bundles(index, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_edit_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = edit_embedding.fingerprint_documents(read_table(spark, sf_dir, "documents"))
    return prints.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                         "fingerprint", "edited_fingerprint", "near_edited", "near_next")


# The pages table has neither capture times nor block lists. Both are derived
# from it by the same text expressions in Spark and in the oracle: a page's day
# from its id, and list events of hosts, domains and urls from their MD5 digits.
def _digit(text: str, at: int, n: int = 1) -> str:
    """SQL for a number from ``n`` hex digits of an MD5 text."""
    one = [f"(instr('0123456789abcdef', substr({text}, {at + i}, 1)) - 1) * {16 ** (n - 1 - i)}" for i in range(n)]
    return f"({' + '.join(one)})"


def _events(kind: str, source: str, share: int, plus_days: str) -> list[str]:
    """SQL selects of the add, remove and second add events of one kind."""
    def select(action: str, after: str, condition: str) -> str:
        return (f"SELECT CASE WHEN {_digit('h', 8)} < 4 THEN 'friends' ELSE 'bans' END AS list_name, CASE WHEN {_digit('h', 8)} < 4 THEN 'allow' ELSE 'block' END AS policy, "
                f"'{kind}' AS kind, p AS pattern, '{action}' AS action, {plus_days.format(days=after)} AS day FROM {source} WHERE {_digit('h', 1)} < {share}{condition}")

    add, gone = _digit("h", 2, 2), f"({_digit('h', 2, 2)} + 1 + {_digit('h', 4, 2)} % 90)"
    return [select("add", add, ""), select("remove", gone, f" AND {_digit('h', 6)} < 12"),
            select("add", f"({gone} + 1 + {_digit('h', 7)})", f" AND {_digit('h', 6)} < 6")]


def _list_sql(plus_days: str, hosts: str, domains: str, urls: str) -> str:
    return " UNION ALL ".join([*_events("domain", hosts, 5, plus_days), *_events("domain", domains, 3, plus_days), *_events("url", urls, 1, plus_days)])


URL_ORACLE = f"""
WITH c AS (SELECT page_id, url, lower(regexp_extract(url, '{url_lists.HOST}', 1)) AS host, regexp_replace(url, '#.*$', '') AS u,
                  DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched_on FROM pages),
hosts AS (SELECT DISTINCT host AS p, md5(host) AS h FROM c WHERE host <> ''),
domains AS (SELECT DISTINCT regexp_extract(p, '[^.]+[.][^.]+$') AS p, md5('d' || regexp_extract(p, '[^.]+[.][^.]+$')) AS h FROM hosts WHERE regexp_extract(p, '[^.]+[.][^.]+$') <> ''),
urls AS (SELECT DISTINCT u AS p, md5(u) AS h FROM c WHERE u IS NOT NULL),
events AS ({_list_sql("DATE '2024-01-01' + CAST({days} AS INTEGER)", "hosts", "domains", "urls")}),
daily AS (SELECT list_name, policy, kind, pattern, day, min(CASE WHEN action = 'add' THEN 1 ELSE 0 END) AS act FROM events GROUP BY ALL),
changes AS (SELECT * FROM (SELECT *, lag(act) OVER w AS was FROM daily WINDOW w AS (PARTITION BY list_name, policy, kind, pattern ORDER BY day)) WHERE act <> coalesce(was, 0)),
spans AS (SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list_name, policy, kind, pattern ORDER BY day) AS until FROM changes) WHERE act = 1),
hits AS (SELECT c.page_id, c.url, c.fetched_on, s.*, row_number() OVER (PARTITION BY c.page_id
           ORDER BY s.kind = 'url' DESC, length(s.pattern) DESC, s.policy = 'allow' DESC, s.list_name DESC, s.day DESC, s.pattern DESC) AS rn
         FROM c JOIN spans s ON s.day <= c.fetched_on AND (s.until IS NULL OR c.fetched_on < s.until)
          AND ((s.kind = 'url' AND s.pattern = c.u) OR (s.kind = 'domain' AND c.host <> '' AND (s.pattern = c.host OR ends_with(c.host, '.' || s.pattern)))))
SELECT c.page_id, c.url, c.fetched_on, coalesce(h.policy = 'block', false) AS blocked, h.list_name AS matched_list, h.pattern AS matched_pattern, h.day AS listed_from
FROM c LEFT JOIN hits h ON h.page_id = c.page_id AND h.rn = 1
"""


@register("op7_url_lists", URL_ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")))
    host, tail = url_lists.host_of(F.col("url")), r"[^.]+[.][^.]+$"
    hosts = pages.select(host.alias("p")).where("p is not null").distinct()
    domains = hosts.select(F.regexp_extract("p", tail, 0).alias("p")).where("p <> ''").distinct()
    urls = pages.select(url_lists.url_key(F.col("url")).alias("p")).where("p is not null").distinct()
    events = spark.sql(_list_sql("date_add(DATE '2024-01-01', CAST({days} AS INT))", "{hosts}", "{domains}", "{urls}"),
                       hosts=hosts.withColumn("h", F.md5("p")), domains=domains.withColumn("h", F.md5(F.concat(F.lit("d"), "p"))), urls=urls.withColumn("h", F.md5("p")))
    return url_lists.filter_captures(captures, events)


@register("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_codec.encode(read_table(spark, sf_dir, "documents"), model)
    return sentencepiece_codec.decode(coded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@register("op11_source_mix")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixing.taken_words(mix).select("doc_id", "size", "source_size", "target", "taken")


@register("op12_source_divergence", oracles.DIVERGENCE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def tampered_text() -> F.Column:
    """The text without line feeds where 2 divides the CRC-32 of the decimal id, else null."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit("")))


@register("op13_merkle_manifest", oracles.MERKLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = merkle.manifest(read_table(spark, sf_dir, "documents"), tampered_text())
    return merkle.verify(audit).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
