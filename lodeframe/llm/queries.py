"""One query per corpus operator, over whole tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeframe.llm.exact_dedup import exact_dedup
from lodeframe.llm.html_text import extract_text
from lodeframe.llm.jaccard_join import near_duplicates
from lodeframe.llm.licenses import scan_licenses
from lodeframe.llm.mixing import mix
from lodeframe.llm.packing import VOCABULARY, pack
from lodeframe.llm.pii import find_pii
from lodeframe.llm.quality import quality
from lodeframe.llm.substring_dedup import without_repeats
from lodeframe.llm.url_rules import judge_urls

#: host, path, action.
URL_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_documents(spark, sf_dir))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_pages(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_documents(spark, sf_dir), digest=True)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir)).drop("detections")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir)).drop("ratio", "bad_share")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return judge_urls(_pages(spark, sf_dir), rules)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_pii, op3_html_text, op4_mixing, op5_substring_dedup, op6_licenses, op7_quality, op8_packing, op9_url_rules, op10_jaccard_join
    )
}

_SPACE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {
    "op1_exact_dedup": rf"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS norm FROM documents),
        g AS (SELECT norm, arg_min(doc_id, struct_pack(a := -chars, b := doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)""",
    "op4_mixing": rf"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, md5('mix-1:' || doc_id::VARCHAR) AS k FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
        l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
              FROM s WINDOW w AS (ORDER BY source_size * 3::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT arg_min(level, source_size * 3::DOUBLE / weight) AS final FROM l WHERE level * weight <= 3 * source_size),
        t AS (SELECT source, source_size, least(source_size * 3::DOUBLE, coalesce(final * weight, 0)) AS target FROM l, f),
        r AS (SELECT d.doc_id, size, source_size, target, round(target)::BIGINT AS budget,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (CASE WHEN source_size > 0 THEN budget // source_size * size + greatest(0, least(size, budget % source_size - ahead)) ELSE 0 END)::BIGINT AS taken FROM r""",
    "op5_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
        w AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
        f AS (SELECT k, min(struct_pack(d := doc_id, i := i)) AS first FROM w GROUP BY k HAVING count(*) > 1),
        r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM w JOIN f USING (k) WHERE struct_pack(d := doc_id, i := i) <> first),
        a AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
        k AS (SELECT a.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept FROM a ANTI JOIN r USING (doc_id, i) GROUP BY 1)
        SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op9_url_rules": r"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        h AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(rule_host, rule_path, verdict) AS (VALUES """ + ", ".join(str(r) for r in URL_RULES) + r"""),
        m AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
              FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)""",
    "op10_jaccard_join": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
              ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM d)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
        b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
        r(doc_id, z) AS (SELECT x, y FROM b UNION SELECT r.doc_id, b.y FROM r JOIN b ON r.z = b.x)
        SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(z), d.doc_id)) AS component_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id""",
}
