"""Registered queries of the corpus operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import decontaminate, exact, forest, jaccard, language, lexical, mixing, packing, quality, repeats, secretscan, tokens, whitening
from fleetlens.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str = "documents", oracle: str | None = None):
    """Register ``fn(table, read)`` where ``read(name)`` gives another table."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)

            def read(other: str) -> DataFrame:
                return spark.read.parquet(f"{sf_dir}/{other}.parquet")

            return fn(read(table), read)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


#: The blanks of the texts as an SQL pattern.
WORD_SQL = r"[^\x20\x09-\x0D]+"


def water_sql(level: str, keys: list[str]) -> str:
    """One level of the budget hand-down as SQL: nodes of ``level`` under ``parent``."""
    cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in mixing.WEIGHTS.get(level, {}).items())
    weight = f"CASE {level} {cases} ELSE 1 END" if cases else "1"
    parent = ", ".join(keys[:-1]) or "1"
    order = f"PARTITION BY {parent} ORDER BY holds / weight, {', '.join(keys)}"
    return f"""
    SELECT {', '.join(keys)}, CASE WHEN dry THEN holds ELSE CAST((fits * weight) // fit_weight AS BIGINT) END AS given
    FROM (SELECT *, max(CASE WHEN NOT dry THEN rest_weight END) OVER (PARTITION BY {parent}) AS fit_weight,
        max(CASE WHEN NOT dry THEN struct_pack(w := rest_weight, l := left_over) END) OVER (PARTITION BY {parent}).l AS fits
      FROM (SELECT *, CAST(holds AS HUGEINT) * rest_weight <= CAST(left_over AS HUGEINT) * weight AS dry
        FROM (SELECT *, budget - coalesce(sum(holds) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
            sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
          FROM (SELECT {', '.join(keys)}, CAST({weight} AS HUGEINT) AS weight, CAST(sum(capacity) AS HUGEINT) AS holds, any_value(CAST(budget AS HUGEINT)) AS budget
            FROM source_{level} GROUP BY {', '.join(keys)}))))"""


def mix_sql() -> str:
    names = ", ".join(f"'{d}'" for d in mixing.DOMAINS)
    parts = [
        f"""rows_ AS MATERIALIZED (SELECT doc_id,
        coalesce(([{names}])[CAST(TRY_CAST(right(regexp_extract(source, '([0-9]+)$', 1), 9) AS INT) % {len(mixing.DOMAINS)} AS INT) + 1], 'other') AS domain,
        coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}')) AS BIGINT) AS n_tokens FROM documents)""",
        f"leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply, sum(n_tokens) * {mixing.MAX_EPOCHS} AS capacity FROM rows_ GROUP BY ALL)",
        f"source_domain AS (SELECT *, least((sum(supply) OVER () * {mixing.BUDGET_PERCENT}) // 100, sum(capacity) OVER ()) AS budget FROM leaves)",
    ]
    keys: list[str] = []
    for i, level in enumerate(mixing.LEVELS):
        keys.append(level)
        parts.append(f"given_{level} AS ({water_sql(level, keys)})")
        following = mixing.LEVELS[i + 1] if i + 1 < len(mixing.LEVELS) else "leaf"
        parts.append(f"source_{following} AS (SELECT s.* REPLACE (g.given AS budget) FROM source_{level} s JOIN given_{level} g USING ({', '.join(keys)}))")
    return f"""WITH {', '.join(parts)},
    taken AS (SELECT r.*, CAST(budget AS BIGINT) AS leaf_budget, CAST(CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS INT) AS whole, CASE WHEN supply > 0 THEN budget % supply ELSE 0 END AS part
      FROM rows_ r JOIN source_leaf USING (domain, lang, source)),
    placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY CAST('0x' || substr(md5('{mixing.SEED}:' || (whole + 1) || ':' || coalesce(doc_id, 0)), 1, 7) AS BIGINT), doc_id, n_tokens
      ROWS UNBOUNDED PRECEDING) AS upto FROM taken)
    SELECT doc_id, CAST(unnest(range(1, whole + 1)) AS INT) AS epoch, domain, lang, source, n_tokens, leaf_budget FROM taken
    UNION ALL SELECT doc_id, whole + 1, domain, lang, source, n_tokens, leaf_budget FROM placed WHERE part > 0 AND upto <= part"""


@query("op1_mix_sources", oracle=mix_sql())
def op1(docs, read):
    return mixing.select_mix(docs)


@query("op2_pack_sequences")
def op2(docs, read):
    return packing.pack(docs)


@query("op3_count_tokens")
def op3(docs, read):
    return tokens.count_tokens(docs)


@query(
    "op4_exact_dedup",
    oracle=r"""
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
      doc_id = first_value(doc_id) OVER best AS kept, h AS text_sha256
    FROM (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h FROM documents)
    WINDOW best AS (PARTITION BY h ORDER BY n DESC, doc_id)""",
)
def op4(docs, read):
    return exact.keepers(docs)


@query("op5_language_id")
def op5(docs, read):
    return language.identify(docs)


@query("op7_secret_scan")
def op7(docs, read):
    return secretscan.scan_secrets(docs)


@query("op9_quality_rank")
def op9(docs, read):
    return quality.rank(docs, quality.fit(docs, read("labels")))


def reach_sql(key: str) -> str:
    """``reach`` and ``component`` over a relation ``links`` (a, b) that holds both directions."""
    return f"""reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    component AS (SELECT a AS {key}, min(b) AS least FROM reach GROUP BY a)"""


@query(
    "op6_ngram_jaccard",
    oracle=rf"""
    WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORD_SQL}') AS w FROM documents),
    grams AS MATERIALIZED (SELECT DISTINCT doc_id, hash(unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1),
        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM texts),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    sized AS MATERIALIZED (SELECT doc_id, g, n FROM grams JOIN sizes USING (doc_id)),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c FROM sized x JOIN sized y
        ON x.g = y.g AND x.doc_id <> y.doc_id AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 90 GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * c >= 90 * (na + nb - c)),
    {reach_sql("doc_id")}
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id
    FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN component USING (doc_id)""",
)
def op6(docs, read):
    return jaccard.similar_groups(docs, width=3, percent=90)


@query(
    "op8_embedding_forest",
    table="embeddings",
    oracle=f"""
    WITH RECURSIVE vectors AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
        ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.95),
    {reach_sql("vec_id")}
    SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = vec_id) AS n_links,
      least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
    FROM embeddings LEFT JOIN component USING (vec_id)""",
)
def op8(vectors, read):
    return forest.near_vectors(vectors)


@query(
    "op10_suffix_dedup",
    oracle="""
    WITH texts AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    places AS MATERIALIZED (SELECT doc_id, CAST(p AS BIGINT) AS p, substr(h, CAST(2 * p + 1 AS BIGINT), 100) AS s
        FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS p FROM texts)),
    firsts AS (SELECT s, min(doc_id) AS owner FROM places GROUP BY s),
    hits AS MATERIALIZED (SELECT doc_id, p FROM places JOIN firsts USING (s) WHERE owner < doc_id),
    marked AS (SELECT *, CASE WHEN p <= lag(p) OVER w + 50 THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
    runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM marked) GROUP BY doc_id, r),
    spans AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM runs GROUP BY doc_id),
    cut AS (SELECT t.doc_id, h, coalesce(removed, 0) AS removed, coalesce(n, 0) AS n, list_prepend(0, coalesce(ends, [])) AS from_,
        list_append(coalesce(starts, []), len(h) // 2) AS to_ FROM texts t LEFT JOIN spans USING (doc_id))
    SELECT doc_id, len(h) // 2 AS n_bytes, CAST(removed AS BIGINT) AS n_removed, n AS n_spans, sha256(unhex(array_to_string(
      list_transform(range(1, len(from_) + 1), lambda i: substr(h, CAST(2 * from_[i] + 1 AS BIGINT), CAST(2 * (to_[i] - from_[i]) AS BIGINT))), ''))) AS kept_sha256
    FROM cut""",
)
def op10(docs, read):
    return repeats.remove_repeats(docs)


#: A column's words as SQL, with A-Z as a-z.
TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op11_decontaminate",
    oracle=f"""
    WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {TERMS_SQL} AS w FROM documents),
    items AS (SELECT item_id, {TERMS_SQL} AS w FROM benchmark),
    windows AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest(CASE WHEN len(w) > 10
        THEN list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) ELSE [array_to_string(w, ' ')] END) AS g FROM items WHERE len(w) > 0),
    grams AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
        FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM texts, (SELECT DISTINCT size FROM windows))),
    hits AS MATERIALIZED (SELECT r, i, size, item_id FROM grams JOIN windows USING (size, g)),
    hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
    hit_items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
      n_hit IS NOT NULL AS contaminated
    FROM texts LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)""",
)
def op11(docs, read):
    return decontaminate.report(docs, read("benchmark"))


@query("op12_whiten_embeddings", table="embeddings")
def op12(vectors, read):
    return whitening.whiten(vectors)


@query(
    "op13_lexical_search",
    oracle=f"""
    WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {TERMS_SQL} AS w FROM documents),
    sizes AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM texts WHERE len(w) > 0),
    stats AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
    counts AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM texts) GROUP BY r, t),
    weights AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
        FROM (SELECT t, count(*) AS df FROM counts GROUP BY t), stats),
    asked AS (SELECT q, item_id, unnest(list_distinct(w)) AS t FROM (SELECT row_number() OVER () AS q, item_id, {TERMS_SQL} AS w FROM benchmark)),
    parts AS (SELECT q, item_id, r, doc_id, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))) AS part
        FROM asked JOIN counts USING (t) JOIN weights USING (t) JOIN sizes USING (r), stats),
    scores AS (SELECT q, item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY ALL HAVING sum(part) > 0)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 50""",
)
def op13(docs, read):
    return lexical.search(docs, read("benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(prepare(spark), sf_dir)


QUERIES["pipeline"] = pipeline
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
