"""Queries of this package and, where SQL can express them, their DuckDB counterparts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from convocases.llm import bpe, credentials, exact, fim, merkle, minhash, packing, pii, quality, suffixes, toxicity, urls, warc

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_exact_dedup", r"""
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
        FROM documents),
    g AS (
        SELECT doc_id, n_chars, content, count(*) OVER (PARTITION BY content) AS group_size,
            first_value(doc_id) OVER (PARTITION BY content ORDER BY n_chars DESC, doc_id) AS keep_id
        FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256, n_chars::INTEGER AS n_chars FROM g""")
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf, "documents"))


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_bpe")
def byte_pairs(spark: SparkSession, sf: str) -> DataFrame:
    path = word_vocabulary()
    both = bpe.decode(bpe.encode(table(spark, sf, "documents"), path), path)
    return both.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op3_pii")
def personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_data(table(spark, sf, "documents"))


@query("op4_quality_rules")
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf, "documents"))


@query("op6_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), word_vocabulary(), with_ids=False)


#: The rules of the query.
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


@query("op8_url_filters", r"""
    WITH rules(rule_host, rule_path, verdict) AS (VALUES
        ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (
        SELECT page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut),
    hits AS (
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS nth,
            rule_host || rule_path AS rule, verdict
        FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND nth = 1""")
def url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.sql("VALUES " + ", ".join(map(str, URL_RULES))).toDF("host", "path", "verdict")
    return urls.judge_urls(table(spark, sf, "pages"), rules)


@query("op9_minhash")
def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), size=4)


@query("op7_toxicity")
def toxic_documents(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op10_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (
        SELECT page_id, html, strlen(html) AS payload_bytes,
            CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
        FROM p)
    SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
        CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN first <> page_id THEN first END AS refers_to
    FROM f""")
def warc_archives(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_suffix_array")
def repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.drop_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_secret_scans")
def secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    return credentials.secrets(table(spark, sf, "documents"))


@query("op12_fill_in_middle", r"""
    WITH t AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
            list_transform(regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+'), lambda x: length(x)) AS units
        FROM documents),
    drawn AS (
        SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS c2,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100
                THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM t),
    cuts AS (
        SELECT *, coalesce(list_sum(units[1:least(c1, c2)]), 0)::BIGINT AS a, coalesce(list_sum(units[1:greatest(c1, c2)]), 0)::BIGINT AS b FROM drawn),
    parts AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cuts)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts""")
def fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored().cast("binary"), 256).alias("restored_sha256"))


@query("op13_merkle", r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, row_number() OVER () AS r,
            list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT),
                lambda c, x: list_reduce([xor(c, x)] || range(8), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))) % 2 = 1 AND doc_id IS NOT NULL AS even,
            concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
            text, replace(text, chr(10), '') AS cut
        FROM documents),
    leaf AS (
        SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN even THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-'))
                ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS other
        FROM d),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            dense_rank() OVER (ORDER BY source IS NOT NULL, encode(coalesce(source, ''))) AS g FROM leaf),
    low AS (
        SELECT g, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY g) AS m FROM placed
        UNION ALL
        SELECT g, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 2) // 3) FROM low WHERE m > 1 GROUP BY g, level, i // 3),
    subroots AS (SELECT g, h, level AS depth FROM low WHERE m = 1),
    high AS (
        SELECT 0 AS level, g - 1 AS i, h, count(*) OVER () AS m FROM subroots
        UNION ALL
        SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 2) // 3) FROM high WHERE m > 1 GROUP BY level, i // 3),
    steps AS (
        SELECT p.r, n.level, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < p.i // power(3, n.level)::BIGINT), '') AS before,
            coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > p.i // power(3, n.level)::BIGINT), '') AS after
        FROM placed p JOIN low n ON n.g = p.g AND n.m > 1 AND n.i // 3 = p.i // power(3, n.level + 1)::BIGINT
        GROUP BY p.r, n.level
        UNION ALL
        SELECT p.r, s.depth + n.level, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < (p.g - 1) // power(3, n.level)::BIGINT), ''),
            coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > (p.g - 1) // power(3, n.level)::BIGINT), '')
        FROM placed p JOIN subroots s ON s.g = p.g JOIN high n ON n.m > 1 AND n.i // 3 = (p.g - 1) // power(3, n.level + 1)::BIGINT
        GROUP BY p.r, s.depth, n.level),
    folded AS (
        SELECT r, 0 AS level, other AS h FROM placed
        UNION ALL
        SELECT f.r, f.level + 1, sha256(before || h || after) FROM folded f JOIN steps s ON s.r = f.r AND s.level = f.level),
    ends AS (SELECT r, arg_max(h, level) AS folded_root FROM folded GROUP BY r),
    proofs AS (SELECT r, string_agg(before || after, '' ORDER BY level) AS proof FROM steps GROUP BY r)
    SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(x.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = t.h AS verified
    FROM placed p JOIN subroots s ON s.g = p.g JOIN ends e ON e.r = p.r JOIN high t ON t.m = 1 LEFT JOIN proofs x ON x.r = p.r""")
def merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    changed = F.when(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0, F.replace(docs["text"], F.lit("\n"), F.lit("")))
    digest = merkle.leaf_digest([*(docs[c] for c in merkle.COLUMNS[:-1]), changed])
    tampered = F.when(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0, digest)
    found = merkle.manifest(docs, other=tampered)
    folded = merkle.fold(F.coalesce("other", "leaf"), F.col("steps"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
