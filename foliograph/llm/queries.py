"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, conversations, decontam, exact, html, langid, linededup, packing, sharding, simhash, toxicity, urls
from .common import table


def ranks() -> tuple[bytes, str]:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def definition(name: str) -> str:
    """The content of a public tokenizer's file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), *ranks(), keep=["doc_id"], ids=False, digests=True)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it; clean documents have none."""
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_external_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.shard(table(spark, sf_dir, "documents"), 24)
    crc = F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long")
    return records.select("doc_id", sharding.size_of().alias("size"), crc.alias("text_crc32"), "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


#: Verdict, host, path.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op6_url_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS rules(verdict, host, path)")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def op7_kernel_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.Model.train(langid.sample(docs.where(~held_out)))
    return langid.identify(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op8_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(table(spark, sf_dir, "documents"), digests=True)


def op9_patricia_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


#: In the order of the chain: columns of ``labels`` as probabilities of 0/1 values.
TOXICITY_CHAIN = {"low_quality": "1 - quality", "toxic": "toxic"}


def toxicity_chain(spark: SparkSession, sf_dir: str) -> toxicity.Chain:
    return toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TOXICITY_CHAIN)


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), toxicity_chain(spark, sf_dir))


def op11_viterbi_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")), F.col("lost"))


def op12_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), definition("word_bpe_49k.json"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return alignment.alignment(table(spark, sf_dir, "documents"), definition("byte_bpe_50k.json"), model)


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_simhash_near_dedup,
        op3_pigeonhole_decontamination,
        op4_external_shuffle_shards,
        op5_html_extraction,
        op6_url_range_join,
        op7_kernel_language_id,
        op8_cuckoo_line_dedup,
        op9_patricia_exact_dedup,
        op10_toxicity_chain,
        op11_viterbi_conversation_repair,
        op12_hilbert_packing,
        op13_token_alignment,
    )
}

_WHITE = r"[\x20\x09-\x0D]+"



def _repair_sql() -> str:
    """The search as a recursion over each conversation's rows; a state is 'cost:audit' with nine digits, so that the least
    string is the cheapest path."""

    def path(state: str, cost: int | str, edit: str) -> str:
        return f"lpad(CAST(CAST(left({state}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{edit}'"

    def kept(initial: str, *states: str) -> list[str]:
        return [f"CASE WHEN NOT gone THEN {path(p, '3 + extra', 'R')} END" for p in states] + [f"CASE WHEN NOT gone AND initial = '{initial}' THEN {path(p, 'extra', 'K')} END" for p in states]

    def least(*options: str) -> str:
        return f"least({', '.join(options)})"

    closing = f"""
            SELECT conv_id, n, p0, p1, u AS p2, least(a, {path("u", 3, "I")}) AS p3 FROM (
                SELECT conv_id, n, p0, p1, {least("u", *(path(p, 3, "I") for p in ("p0", "p1", "a")))} AS u, a"""
    return rf"""
        WITH RECURSIVE keyed AS (
            SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
        ), struck AS (
            SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind FROM keyed
        ), damaged AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text
            FROM struck, (VALUES (0), (1)) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
        ), lines AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e
            FROM damaged
        ), repeats AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again FROM lines
        ), faulty AS (
            SELECT *, CASE WHEN e = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(e, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
                lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au') AS illegal
            FROM repeats
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
            FROM faulty GROUP BY conv_id
        ), judged AS (
            SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM faulty
        ), search AS (
            {closing} FROM (SELECT conv_id, 0::BIGINT AS n, '000000000:' AS p0, NULL::VARCHAR AS p1, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM counted))
            UNION ALL
            {closing} FROM (
                SELECT j.conv_id, j.n, {path("p0", 4, "D")} AS p0, {least(path("p1", 4, "D"), f"CASE WHEN NOT gone AND initial = 's' THEN {path('p0', 'extra', 'K')} END")} AS p1,
                    {least(path("p2", 4, "D"), *kept("u", "p0", "p1", "p3"))} AS u, {least(path("p3", 4, "D"), *kept("a", "p2"))} AS a
                FROM search AS s JOIN judged AS j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.n = s.n + 1))
        ), cheapest AS (
            SELECT c.*, least(p0, p3) AS best FROM counted AS c JOIN search AS s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.n = c.n
        ), edits AS (
            SELECT conv_id, unnest(string_split(substr(best, 11), '')) AS edit, generate_subscripts(string_split(substr(best, 11), ''), 1) AS i FROM cheapest
        ), placed AS (
            SELECT *, sum(CASE edit WHEN 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS n FROM edits
        ), outs AS (
            SELECT p.conv_id, i, edit, role, CASE edit WHEN 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY p.conv_id ORDER BY i) AS k, edit = 'K' AND initial = 's' AS opens
            FROM placed AS p LEFT JOIN judged AS j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.n = p.n WHERE edit IN ('K', 'R', 'I')
        ), told AS (
            SELECT conv_id, i, CASE WHEN edit = 'K' THEN role WHEN (k - CASE WHEN bool_or(opens) OVER (PARTITION BY conv_id) THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text AS line FROM outs
        ), joined AS (
            SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS whole FROM told GROUP BY conv_id
        )
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 11), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS ids LEFT JOIN cheapest AS c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN joined AS t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id"""


SQL = {
    "op11_viterbi_conversation_repair": _repair_sql(),
    "op8_cuckoo_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
        ), keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
        ), repeated AS (
            SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
        ), judged AS (
            SELECT doc_id, pos, line, coalesce(doc_id <> last, false) AS gone FROM keyed LEFT JOIN repeated USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op6_url_range_join": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut
        ), rules(verdict, rule_host, rule_path) AS (
            VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'), ('allow', 'example.net', '/de/8'), ('block', 'org', '/es/')
        ), fits AS (
            SELECT page_id, host, path, verdict, rule_host || rule_path AS rule,
                row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS k
            FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1""",
    "op9_patricia_exact_dedup": rf"""
        WITH normal AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WHITE}', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM normal WINDOW same AS (PARTITION BY t)""",
}
