"""Queries of the training-text operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks.llm._store import workers_find_package
from candleworks.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its DuckDB text."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            workers_find_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[name] = (run, sql)
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_licenses")
def op1_licenses(spark, sf_dir):
    """Licence phrases, notices and tag expressions of every document."""
    from candleworks.llm import license_scan

    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


@query("op3_secrets")
def op3_secrets(spark, sf_dir):
    """Spans of secrets in every document."""
    from candleworks.llm import secret_scan

    return secret_scan.summary(secret_scan.scan(table(spark, sf_dir, "documents")))


@query("op2_exact_dedup", """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body""")
def op2_exact_dedup(spark, sf_dir):
    """Every document with the copy of its text that stays."""
    from candleworks.llm import exact_dedup

    return exact_dedup.decide(table(spark, sf_dir, "documents")).withColumnRenamed("text_digest", "text_sha256")


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    """Every text of ``documents`` as BPE ids and back."""
    from candleworks.llm import bpe

    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), bpe.default_path()))


@query("op7_decontamination", """
WITH w AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS ws FROM benchmark),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS ws FROM documents),
i AS (SELECT DISTINCT item_id, array_to_string(ws[k:k + least(len(ws), 5) - 1], ' ') AS gram
      FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(len(ws), 5) + 1)) AS k FROM w WHERE len(ws) > 0)),
d AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS k FROM dw WHERE len(ws) > 4)),
q AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN i ON d.gram = i.gram GROUP BY doc_id, item_id)
SELECT doc_id, f.item_id, n_item, n_found, n_found / n_item AS containment
FROM f JOIN q ON f.item_id = q.item_id WHERE n_found * 100 >= n_item * 80""")
def op7_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item (the items of the table have five words or more)."""
    from candleworks.llm import decontaminate

    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_ngram_join", """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + least(len(ws), 3) - 1], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - least(len(ws), 3) + 1)) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.size + y.size - shared)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(r.reached) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id""")
def op8_ngram_join(spark, sf_dir):
    """Components of documents whose word triples agree to nine tenths."""
    from candleworks.llm import ngram_join

    return ngram_join.join(table(spark, sf_dir, "documents"))


@query("op8_ngram_links", """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + least(len(ws), 3) - 1], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - least(len(ws), 3) + 1)) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.size + y.size - shared)),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(r.reached) AS component_id, coalesce(any_value(k.n_links), 0) AS n_links
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.a = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id""")
def op8_ngram_links(spark, sf_dir):
    """The components of op8_ngram_join, and the number of documents that each document links with."""
    from candleworks.llm import ngram_join

    return ngram_join.join_links(table(spark, sf_dir, "documents"))


@query("op10_substring_dedup", """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, array_to_string(ws[k:k + 19], ' ') AS body, k
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS k FROM w WHERE len(ws) > 19)),
f AS (SELECT doc_id, k, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS n FROM s),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + 19)) AS p FROM f WHERE n > 1),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM w WHERE len(ws) > 0),
t AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) FILTER (WHERE r.p IS NULL) AS body, count(r.p) AS gone
      FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.p = r.p GROUP BY p.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN t ON w.doc_id = t.doc_id""")
def op10_substring_dedup(spark, sf_dir):
    """Every document without the words of windows that start earlier elsewhere."""
    from candleworks.llm import substring_dedup

    out = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op5_quality")
def op5_quality(spark, sf_dir):
    """A quality score of every document."""
    from candleworks.llm import _labels, quality
    from candleworks.llm._store import written

    described = written(quality.describe(table(spark, sf_dir, "documents")), "quality-statistics")
    model = quality.fit(described, table(spark, sf_dir, "labels"))
    return quality.score(described, model).select(
        "doc_id", (_labels.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


TOXIC_FROM = 0.3


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """A toxicity score of every document."""
    from candleworks.llm import _labels, toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (_labels.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query("op9_line_dedup", """
WITH w AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
s AS (SELECT doc_id, array_to_string(ls[k:k + 2], chr(10)) AS body, k
      FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls) - 2)) AS k FROM w WHERE len(ls) > 2)),
f AS (SELECT doc_id, k, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS n FROM s),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + 2)) AS p FROM f WHERE n > 1),
p AS (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS p FROM w WHERE len(ls) > 0),
t AS (SELECT p.doc_id, string_agg(line, chr(10) ORDER BY p.p) FILTER (WHERE r.p IS NULL) AS body, count(r.p) AS gone
      FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.p = r.p GROUP BY p.doc_id)
SELECT w.doc_id, len(ls) AS n_lines, coalesce(gone, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN t ON w.doc_id = t.doc_id""")
def op9_line_dedup(spark, sf_dir):
    """Every document without runs of three lines or more that start earlier elsewhere."""
    from candleworks.llm import line_dedup

    out = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op9_passage_dedup", """
WITH w AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
s AS (SELECT doc_id, array_to_string(ls[k:k + m - 1], chr(10)) AS body, k, m
      FROM (SELECT doc_id, ls, m, unnest(generate_series(1, len(ls) - m + 1)) AS k FROM w, (VALUES (1), (2), (3)) v(m) WHERE len(ls) >= m)),
f AS (SELECT doc_id, k, m, row_number() OVER (PARTITION BY m, body ORDER BY doc_id, k) AS n FROM s
      WHERE m = 3 OR len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')) >= 50),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + m - 1)) AS p FROM f WHERE n > 1),
p AS (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS p FROM w WHERE len(ls) > 0),
t AS (SELECT p.doc_id, string_agg(line, chr(10) ORDER BY p.p) FILTER (WHERE r.p IS NULL) AS body, count(r.p) AS gone
      FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.p = r.p GROUP BY p.doc_id)
SELECT w.doc_id, len(ls) AS n_lines, coalesce(gone, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN t ON w.doc_id = t.doc_id""")
def op9_passage_dedup(spark, sf_dir):
    """Every document without runs of three lines, or of fewer lines with fifty words, that start earlier elsewhere."""
    from candleworks.llm import line_dedup

    out = line_dedup.dedup(table(spark, sf_dir, "documents"), words=line_dedup.PASSAGE_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op11_collocations", """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(ws) >= k)),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
i AS (SELECT lang, array_to_string(ws[j:j + 1], ' ') AS phrase, max(f) AS whole FROM c, (VALUES (1), (2)) v(j) WHERE k = 3 GROUP BY 1, 2),
d AS (SELECT c.* FROM c LEFT JOIN i ON c.k = 2 AND c.lang = i.lang AND c.phrase = i.phrase WHERE c.k > 1 AND (whole IS NULL OR 100 * whole < 50 * f)),
t AS (SELECT lang, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS tail FROM d, (VALUES (1), (2)) v(j) WHERE j < k),
s AS (SELECT t.lang, t.phrase, a, j, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
      FROM t JOIN c x ON x.lang = t.lang AND x.phrase = t.head JOIN c y ON y.lang = t.lang AND y.phrase = t.tail),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON o.lang = n.lang WHERE rank <= 2000""")
def op11_collocations(spark, sf_dir):
    """The first 2,000 collocations of two and three words of every language."""
    from candleworks.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_byte_bpe")
def op12_byte_bpe(spark, sf_dir):
    """Every text of ``documents`` as byte-level BPE ids and back."""
    from candleworks.llm import byte_bpe

    return byte_bpe.digests(byte_bpe.encode(table(spark, sf_dir, "documents"), byte_bpe.default_path(), byte_bpe.default_pattern()))


@query("op13_lexical_search", """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
c AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d),
h AS (SELECT term, count(*) AS df FROM f GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, f.doc_id, sum(floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
      FROM q JOIN h ON h.term = q.term JOIN f ON f.term = q.term JOIN d ON d.doc_id = f.doc_id, c GROUP BY item_id, f.doc_id),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10""")
def op13_lexical_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    from candleworks.llm import lexical_search

    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
