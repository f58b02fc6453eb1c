"""Registered queries of the training-data operators, and their DuckDB SQL.

Every query reads its whole tables and takes production parameters; the thin
``opN_`` functions derive the digest columns from the operators' outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, bwt, decontam, jaccard, lm, merkle, oddsketch, phrases, pii, quality, substrings, toxicity, urls
from panelspark.llm.tables import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """The tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


#: Fixed values of the contract (host/path rules), then the library's own globs
#: for urls that no rule fits.
URL_RULES = [
    urls.Rule("net/", urls.BLOCK),
    urls.Rule("example.net/en/", urls.ALLOW),
    urls.Rule("example.com/de/", urls.BLOCK),
    urls.Rule("org/fr/", urls.ALLOW),
    urls.Rule("*/login*", urls.BLOCK, glob=True),
    urls.Rule("*/cart/*", urls.BLOCK, glob=True),
    urls.Rule("*.exe", urls.BLOCK, glob=True),
    urls.Rule("ads.*", urls.BLOCK, glob=True),
    urls.Rule("*/es/?.html", urls.BLOCK, glob=True),
]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt.dedup(table(spark, sf_dir, "documents")).drop("spans", "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, model, columns=("doc_id", "text"))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target corpus is the documents labelled as good quality."""
    docs = table(spark, sf_dir, "documents")
    scored = lm.score(docs, lm.train(docs, table(spark, sf_dir, "labels").where("quality = 1")), ("doc_id",))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "target_loss", "background_loss", "score")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(pii.labelled_by_patterns(docs)), columns=("doc_id", "text"))
    listed = F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.split("base", ","))
    of = lambda kind: F.size(F.filter(listed, lambda s: F.startswith(s, F.lit(f"{kind}:")))).cast("long").alias(f"n_{kind}")
    return found.select(F.col("row.doc_id").alias("doc_id"), *[of(kind) for kind in pii.KINDS],
                        F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.scan(docs, quality.train(docs, table(spark, sf_dir, "labels")), columns=("doc_id", "text"))
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "probability")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("spans", "kept")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op10_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path, keep_ids=False, keep_decoded=False)


def op11_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.dedup(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, F.crc32(docs["doc_id"].cast("string")) % 5 == 0)


_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_SQL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, """ + _LOWER_SQL.format("regexp_extract(rest, '^[^/?#]*')") + r""" AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), fit AS (
    SELECT *, ('.' || host) AS h FROM parts
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN h LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN h LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN h LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN h LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM fit
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host || path, '/login|/cart/|\.exe$|^ads\.|/es/.\.html$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

_WORDS_SQL = "regexp_extract_all(" + _LOWER_SQL.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS_SQL} AS w FROM benchmark),
piece AS (
    SELECT DISTINCT id, len(w[i:i + 12]) AS n, array_to_string(w[i:i + 12], ' ') AS s
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
size AS (SELECT DISTINCT n FROM piece),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
place AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
found AS (
    SELECT p.r, p.i, q.n, q.id FROM place p JOIN size s ON p.i + s.n - 1 <= len(p.w)
    JOIN piece q ON q.n = s.n AND q.s = array_to_string(p.w[p.i:p.i + s.n - 1], ' ')
),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


_SPACE_WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1_SQL = f"""
WITH RECURSIVE doc AS (
    SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, {_SPACE_WORDS_SQL.format(_LOWER_SQL.format("coalesce(text, '')"))} AS w FROM documents
),
shingle AS (
    SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.r != b.r GROUP BY ALL),
link AS (SELECT a, b FROM common c JOIN size x ON c.a = x.r JOIN size y ON c.b = y.r WHERE 10 * c.n >= 8 * (x.n + y.n - c.n)),
reach(a, b) AS (SELECT r, r FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
head AS (SELECT a AS r, min(doc_id) AS class_id FROM reach JOIN doc ON reach.b = doc.r GROUP BY a),
degree AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM doc JOIN head USING (r) LEFT JOIN degree USING (r)
"""


OP2_SQL = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (SELECT r, doc_id, substr(h, 2 * i - 1, 100) AS s, i FROM (
    SELECT r, doc_id, h, unnest(range(1, length(h) // 2 - 48)) AS i FROM doc WHERE length(h) >= 100)),
low AS (SELECT s, min(doc_id) AS low FROM place GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT p.r, p.i FROM place p JOIN low USING (s) WHERE low.low < p.doc_id),
marked AS (SELECT r, i, max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM gone),
led AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g FROM marked),
span AS (SELECT r, g, min(i) AS a, max(i) + 50 AS b FROM led GROUP BY r, g),
cut AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 1) AS from_, row_number() OVER (PARTITION BY r ORDER BY a DESC) AS back FROM span),
kept AS (
    SELECT c.r, sum(b - a) AS n_removed, count(*) AS n_spans,
           string_agg(substr(h, 2 * from_ - 1, 2 * (a - from_)), '' ORDER BY a) || any_value(CASE WHEN back = 1 THEN substr(h, 2 * b - 1) END) AS left_
    FROM cut c JOIN doc USING (r) GROUP BY c.r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(left_, h))) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

OP8_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_SPACE_WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
place AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM (
    SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35)),
again AS (SELECT s FROM place GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM place JOIN again USING (s)),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM doc),
left_ AS (
    SELECT word.r, count(gone.k) AS n_removed, string_agg(CASE WHEN gone.k IS NULL THEN x END, ' ' ORDER BY word.k) AS s
    FROM word LEFT JOIN gone ON word.r = gone.r AND word.k = gone.k GROUP BY word.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM doc LEFT JOIN left_ USING (r)
"""


OP11_SQL = f"""
WITH RECURSIVE doc AS (
    SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, {_SPACE_WORDS_SQL.format(_LOWER_SQL.format("coalesce(text, '')"))} AS w FROM documents
),
shingle AS (
    SELECT DISTINCT r, array_to_string(w[i:i + 1], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.r != b.r GROUP BY ALL),
link AS (SELECT a, b FROM common c JOIN size x ON c.a = x.r JOIN size y ON c.b = y.r WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach(a, b) AS (SELECT r, r FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
head AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN doc ON reach.b = doc.r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM doc JOIN head USING (r) LEFT JOIN size USING (r)
"""

OP12_SQL = r"""
WITH doc AS (SELECT coalesce(lang, 'und') AS lang, """ + _LOWER_SQL.format("coalesce(text, '')") + r""" AS t FROM documents),
piece AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM doc)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
gram AS (SELECT lang, s, w[i:i + s - 1] AS g FROM (
    SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM piece, (VALUES (1), (2), (3), (4)) AS size(s) WHERE len(w) >= s)),
known AS (SELECT lang, s, array_to_string(g, ' ') AS phrase, g, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT * FROM known WHERE s > 1),
inner_ AS (
    SELECT lang, array_to_string(g[i:i + m - 1], ' ') AS phrase, max(a) AS around FROM (
        SELECT lang, g, a, m, unnest(range(1, s - m + 2)) AS i FROM cand, (VALUES (2), (3)) AS size(m) WHERE m < s)
    GROUP BY ALL),
left_ AS (SELECT c.* FROM cand c LEFT JOIN inner_ i USING (lang, phrase) WHERE i.around IS NULL OR 100 * i.around < 80 * c.a),
cut AS (SELECT *, unnest(range(1, s)) AS k FROM left_),
scored AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, c.k,
           CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.a + y.a) AS BIGINT) AS score
    FROM cut c JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(c.g[1:c.k], ' ')
    JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(c.g[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN total USING (lang) QUALIFY rank <= 2000
"""


def _op13_sql(source_levels: int = 6, top_levels: int = 4) -> str:
    """Levels are unrolled: up to 16 ** 6 rows a source and 16 ** 4 sources."""
    framed = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"
    line = " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))")
    parts = [f"""
WITH doc AS (SELECT *, CAST(doc_id AS VARCHAR) AS s, coalesce('=' || source, '') AS tree FROM documents),
leaf AS (
    SELECT tree, doc_id, sha256({line} || {framed("text")}) AS digest,
           CASE WHEN {crc} % 5 = 0 THEN sha256({line} || {framed(_LOWER_SQL.format("text"))}) ELSE sha256({line} || {framed("text")}) END AS touched
    FROM doc
)"""]

    def tier(name: str, base: str, count: int) -> None:
        parts.append(f"{name}0 AS ({base})")
        for k in range(1, count + 1):
            parts.append(f"""{name}{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM (
    SELECT tree, rank // 16 AS rank, sha256(string_agg(digest, '' ORDER BY rank)) AS digest FROM {name}{k - 1} WHERE m > 1 GROUP BY ALL))""")
        for k in range(count + 1):
            run = "OVER (PARTITION BY tree, rank // 16 ORDER BY rank ROWS BETWEEN {} AND {})"
            parts.append(f"""{name}{k}s AS (SELECT *, coalesce(string_agg(digest, '') {run.format("UNBOUNDED PRECEDING", "1 PRECEDING")}, '') AS l,
    coalesce(string_agg(digest, '') {run.format("1 FOLLOWING", "UNBOUNDED FOLLOWING")}, '') AS r FROM {name}{k})""")
        parts.append(f"{name}_root AS (" + " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE m = 1" for k in range(count + 1)) + ")")

    tier("a", "SELECT tree, doc_id, touched, digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank, "
         "count(*) OVER (PARTITION BY tree) AS m FROM leaf", source_levels)
    tier("b", "SELECT '' AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS m FROM a_root", top_levels)
    joins, steps, proof = ["a0s"], [], []
    for name, count in (("a", source_levels), ("b", top_levels)):
        for k in range(count + 1):
            at = f"{name}{k}s"
            if (name, k) == ("b", 0):
                joins.append("JOIN b0s ON b0s.source = a0s.tree")
            elif k:
                below = f"{name}{k - 1}s"
                joins.append(f"LEFT JOIN {at} ON {at}.tree = {below}.tree AND {at}.rank = {below}.rank // 16 AND {below}.m > 1")
            proof.append(f"CASE WHEN {at}.m > 1 THEN {at}.l || {at}.r ELSE '' END")
            steps.append(at)
    sql = ",\n".join(parts)
    sql += ",\nwide AS (SELECT a0s.doc_id, a0s.digest AS leaf, a0s.touched AS f0, b0s.digest AS subroot, (SELECT digest FROM b_root) AS root, " + \
        " || ".join(proof) + " AS proof, " + \
        ", ".join(f"{at}.m > 1 AS c{k}, {at}.l AS l{k}, {at}.r AS r{k}" for k, at in enumerate(steps)) + \
        "\nFROM " + "\n".join(joins) + ")"
    for k in range(len(steps)):
        sql += f",\nfold{k + 1} AS (SELECT *, CASE WHEN c{k} THEN sha256(l{k} || f{k} || r{k}) ELSE f{k} END AS f{k + 1} FROM {f'fold{k}' if k else 'wide'})"
    last = len(steps)
    return sql + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f{last} AS folded_root, f{last} = root AS verified FROM fold{last}"


OP13_SQL = _op13_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_suffix_array_dedup, op3_toxicity, op4_lm_scoring, op5_personal_data, op6_url_filters,
        op7_quality_rules, op8_substring_dedup, op9_benchmark_decontamination, op10_bpe_roundtrip,
        op11_odd_sketch_dedup, op12_phrase_collocations, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": OP1_SQL, "op2_suffix_array_dedup": OP2_SQL, "op8_substring_dedup": OP8_SQL,
            "op6_url_filters": OP6_SQL, "op9_benchmark_decontamination": OP9_SQL,
            "op11_odd_sketch_dedup": OP11_SQL, "op12_phrase_collocations": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
