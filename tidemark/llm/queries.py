"""One query for each corpus operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, divergence, html_text, line_dedup, merkle, ngram_jaccard, packing, pii, quality, substring_dedup, token_counts, top_k, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crc_is(modulus: int, remainder: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated spans of sentences: doc_id, n_sentences, n_removed, text."""
    out = substring_dedup.without_repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__sentences").alias("n_sentences"), F.col("__removed").alias("n_removed"), "text")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars").withColumn("held_out", _crc_is(3, 1))
    taught = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(~_crc_is(3, 1))
    machine = quality.fit(docs.where(~F.col("held_out")), taught)
    return quality.score(docs, machine).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains: doc_id, item_id, n_shingles, n_found."""
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_classes(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document: doc_id, section, start, end, n_tokens, n_crossing."""
    out = token_counts.section_tokens(_table(spark, sf_dir, "documents"), "doc_id", ["text"], by_line=True)
    return out.select(F.col("id").alias("doc_id"), "section", "start", "end", "n_tokens", "n_crossing")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs: doc_id, n_deleted, longest, text."""
    out = line_dedup.line_report(_table(spark, sf_dir, "documents").select("doc_id", "text"), long_words=line_dedup.LONG_WORDS)
    return out.select("doc_id", F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_deleted"), F.coalesce("__longest", F.lit(0)).cast("long").alias("longest"), "text")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _crc_is(5, 0))
    taught = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(~_crc_is(5, 0))
    model = toxicity.fit(docs.where(~F.col("held_out")), taught)
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: the patterns' counts by kind and the hash of their spans, and all spans, those that the field adds among them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    field = pii.fit(pii.labelled_texts(spark), pii.ordinary_texts(docs))
    return pii.digest_of(pii.private_spans(docs, field, ["doc_id"]))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, proof and the root folded from it, or from its tampered text."""
    tampered = F.when(_crc_is(5, 0), merkle.lower_cased(F.col("text")))
    return merkle.manifest(_table(spark, sf_dir, "documents"), tampered)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_html_extraction, op3_quality_classifier, op4_exact_top_k, op5_benchmark_decontamination, op6_ngram_jaccard_join, op7_token_counts, op8_line_dedup, op9_best_fit_packing, op10_toxicity, op11_pii, op12_merkle_manifest, op13_source_divergence)
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_SHINGLES = """
    SELECT DISTINCT {id}, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
    FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (SELECT {id}, {words} AS w FROM {table}) WHERE len(w) > 0)
"""

#: zlib's crc32 of a text of ASCII characters, as an unsigned number.
_CRC32 = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v // 2, v % 2 * 3988292384))))"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, start: str) -> str:
    """Nodes (lv, k, n, d, more) of the trees over `start`, and their siblings on the left and right."""
    return f"""
            {name}(lv, k, n, d, more) AS ({start}
                UNION ALL SELECT lv + 1, k, n // 16, sha256(string_agg(d, '' ORDER BY n)), count(*) OVER (PARTITION BY k) > 1 FROM {name} WHERE more GROUP BY lv, k, n // 16),
            {name}_side AS MATERIALIZED (
                SELECT a.lv, a.k, a.n, coalesce(string_agg(b.d, '' ORDER BY b.n) FILTER (b.n < a.n), '') AS l, coalesce(string_agg(b.d, '' ORDER BY b.n) FILTER (b.n > a.n), '') AS r
                FROM {name} a JOIN {name} b ON a.lv = b.lv AND a.k IS NOT DISTINCT FROM b.k AND a.n // 16 = b.n // 16 WHERE a.more GROUP BY a.lv, a.k, a.n)"""


SQL: dict[str, str] = {
    "op4_exact_top_k": """
        WITH v AS (
            SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.r, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
    """,
    "op5_benchmark_decontamination": f"""
        WITH iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark), dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
             i AS (SELECT *, least(len(w), 5) AS m FROM iw WHERE len(w) > 0),
             b AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, k, k + m - 1), ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS k FROM i)),
             n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id),
             d AS (SELECT DISTINCT doc_id, m, array_to_string(list_slice(w, k, k + m - 1), ' ') AS s
                   FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM dw, (SELECT DISTINCT m FROM i) WHERE len(w) >= m))
        SELECT doc_id, item_id, CAST(any_value(n_shingles) AS BIGINT) AS n_shingles, CAST(count(*) AS BIGINT) AS n_found
        FROM d JOIN b USING (m, s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_shingles)
    """,
    "op6_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS MATERIALIZED ({_SHINGLES.format(id="doc_id", words=_WORDS, table="documents")}),
             n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
             l AS MATERIALIZED (
                SELECT x.doc_id AS a, y.doc_id AS b FROM d x JOIN d y USING (s) JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
                WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
             r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
        SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
        FROM documents t LEFT JOIN n ON n.doc_id = t.doc_id JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = t.doc_id
    """,
    "op8_line_dedup": r"""
        WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents),
             l AS (SELECT doc_id, i AS pos, trim(p[i + 1], chr(9) || chr(11) || chr(12) || chr(13) || ' ') AS line FROM (SELECT doc_id, p, unnest(range(0, len(p))) AS i FROM raw)),
             k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq FROM l WHERE line <> ''),
             w AS (SELECT doc_id, pos, seq, line, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS following, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AS long FROM k),
             p2 AS (SELECT a.doc_id AS d, a.seq AS s, b.doc_id AS e, b.seq AS t, (b.doc_id, b.seq) < (a.doc_id, a.seq) AS after
                    FROM w a JOIN w b ON a.line = b.line AND (a.doc_id <> b.doc_id OR a.seq <> b.seq)),
             island AS (SELECT *, s - row_number() OVER (PARTITION BY d, e, s - t ORDER BY s) AS g FROM p2 WHERE after),
             run AS (SELECT d AS doc_id, s AS seq, e, t, max(s) OVER (PARTITION BY d, e, s - t, g) - s + 1 AS n FROM island),
             suffix AS (SELECT w.doc_id, pos, following, long, n, row_number() OVER (PARTITION BY w.doc_id, seq ORDER BY e, t) AS k, row_number() OVER (PARTITION BY w.doc_id, seq, n >= 2 ORDER BY e, t) AS k2 FROM run JOIN w USING (doc_id, seq)),
             later AS (SELECT doc_id, pos, following AS until, n AS common FROM suffix WHERE n >= 2 AND k2 = 1
                       UNION ALL SELECT doc_id, pos, pos, n FROM suffix WHERE long AND k = 1),
             most AS (SELECT doc_id, max(common) AS longest FROM later GROUP BY doc_id),
             gone AS (SELECT doc_id, list(DISTINCT x) AS xs FROM (SELECT doc_id, unnest(range(pos, until + 1)) AS x FROM later) GROUP BY doc_id)
        SELECT raw.doc_id, CAST(coalesce(len(gone.xs), 0) AS BIGINT) AS n_deleted, CAST(coalesce(most.longest, 0) AS BIGINT) AS longest,
               CASE WHEN gone.xs IS NULL THEN raw.text
                    ELSE array_to_string(list_transform(list_filter(range(0, len(p)), lambda i: NOT list_contains(gone.xs, i)), lambda i: p[i + 1]), chr(10)) END AS text
        FROM raw LEFT JOIN gone USING (doc_id) LEFT JOIN most USING (doc_id)
    """,
    "op12_merkle_manifest": f"""
        WITH RECURSIVE f AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n FROM (
                SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(_LOWER)} END AS other FROM documents)),
            {_tree("t", "SELECT 0, source, n, leaf, count(*) OVER (PARTITION BY source) > 1 FROM f")},
            s AS MATERIALIZED (SELECT k AS source, d, row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS n FROM t WHERE NOT more),
            {_tree("u", "SELECT 0, 0, n, d, count(*) OVER () > 1 FROM s")},
            x AS (SELECT f.*, s.d AS subroot, s.n AS top FROM f JOIN s ON s.source IS NOT DISTINCT FROM f.source),
            y AS (SELECT x.source, x.n, 0 AS g, lv, l, r FROM x JOIN t_side q ON q.k IS NOT DISTINCT FROM x.source AND q.n = x.n // CAST(16 ** lv AS BIGINT)
                  UNION ALL SELECT x.source, x.n, 1, lv, l, r FROM x JOIN u_side q ON q.n = x.top // CAST(16 ** lv AS BIGINT)),
            z AS (SELECT source, n, string_agg(l || r, '' ORDER BY g, lv) AS proof, list({{'l': l, 'r': r}} ORDER BY g, lv) AS path FROM y GROUP BY source, n),
            v AS (SELECT x.*, (SELECT d FROM u WHERE NOT more) AS root, coalesce(proof, '') AS proof, list_reduce(list_prepend({{'l': coalesce(other, leaf), 'r': ''}}, coalesce(path, [])), lambda a, b: {{'l': sha256(b.l || a.l || b.r), 'r': ''}}).l AS folded
                  FROM x LEFT JOIN z ON z.source IS NOT DISTINCT FROM x.source AND z.n = x.n)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM v
    """,
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
             t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
             k AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
             c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
             v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
             g AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
             p AS MATERIALIZED (SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // CAST(g.n + 2 * v AS BIGINT) AS p FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
             q AS (SELECT lang, term, 1 + 1000000000 * (total + 2) // CAST(v.n + 2 * v AS BIGINT) AS q FROM k JOIN v USING (lang)),
             pairs AS (SELECT lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
             every AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
             marks AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
        SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
        UNION ALL SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM marks QUALIFY rank <= 10
    """,
}
