"""Queries and oracle SQL of the corpus operators, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_repair,
    embedding_join,
    minhash,
    mixing,
    nearest_neighbours,
    pii,
    quality_gam,
    quality_rules,
    sentencepiece_bpe,
    sharding,
    suffix_dedup,
    token_counts,
    whitening,
)
from .common import materialize, shared_dir


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Target file size of the sharding query; as many arrivals as a tier takes, so that at every scale there is something to merge.
SHARD_TARGET, SHARD_FANOUT = 128 << 20, 4


def filled_store(spark: SparkSession, sf_dir: str) -> tuple[sharding.ShardStore, int]:
    """A store that the documents arrived in, compacted after each arrival; and how many compactions merged something."""
    docs, merged = table(spark, sf_dir, "documents"), 0
    store = sharding.ShardStore(spark, f"{shared_dir(spark)}/shards/{uuid.uuid4().hex}", SHARD_TARGET, SHARD_FANOUT)
    for arrival in range(SHARD_FANOUT):
        store.append(docs.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SHARD_FANOUT)) == arrival))
        while store.compact() is not None:
            merged += 1
        store.vacuum()
    return store, merged


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends the documents as arrivals, compacting after each, and reads the last version back."""
    store, _ = filled_store(spark, sf_dir)
    return store.read().select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))


OP1_SQL = "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents"


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_bpe.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.rule_ledger(table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(ledger).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.fails(quality_rules.BASE_RULES).alias("base_failed"),
        "kept",
        "failed_bits",
    )


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
g AS (SELECT rid, pos, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY rid ORDER BY pos)),
c AS (SELECT rid, pos, w3, count(*) OVER (PARTITION BY rid, word, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS p FROM c WHERE n >= 2) GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM w),
ld AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
    len(list_distinct(ws)) AS n_distinct_words
  FROM w LEFT JOIN r USING (rid) LEFT JOIN ld USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN 10 * n_upper > 3 * (n_upper + n_lower) THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END)
    + (CASE WHEN n_words >= 50 AND 100 * n_distinct_words < 15 * n_words THEN 128 ELSE 0 END) AS failed_bits
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits::BIGINT AS failed_bits
FROM b
"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op5_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_groups(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN n USING (vec_id)
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality_gam.score_quality(docs, model)
    return scored.select("doc_id", quality_gam.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: The production mixture: weights by level, any value not named weighing 1 (10 for domains).
MIX_WEIGHTS = {
    "domain": {"web": 30, "books": 35, "news": 20, "forum": 15},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}
MIX_DEFAULTS = {"domain": 10, "lang": 1, "source": 1}
MIX_SEED = 20240


def domain_of_source() -> Column:
    """The domain of a source by its number: 0-4 web, 5-9 books, 10-14 news, others forum."""
    number = F.expr(r"try_cast(regexp_extract(coalesce(source, ''), '^src([0-9]{1,6})$', 1) as int)")
    names = F.when(number < 5, "web").when(number < 10, "books").when(number < 15, "news")
    return F.when(number.isNull(), "unknown").otherwise(names.otherwise("forum"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Texts are read once: measured, and their tie-break taken.
    docs = materialize(docs.select("doc_id", "lang", "source", mixing.word_tokens().alias("__tokens"), mixing.ident_of("doc_id", "text").alias("__ident")))
    mixed = mixing.mix(
        docs,
        tokens=F.col("__tokens"),
        ident=F.col("__ident"),
        budget=F.expr("all_tokens * 3 div 4"),
        weights=MIX_WEIGHTS,
        domain=domain_of_source(),
        defaults=MIX_DEFAULTS,
        max_epochs=2,
        seed=MIX_SEED,
    )
    return mixed.select("doc_id", "domain", F.col("lang"), F.col("source"), "n_tokens", "copies")


def mix_sql(docs: str, budget: str, max_epochs: int) -> str:
    """DuckDB SQL of the mixture over a relation ``docs`` (doc_id, text, lang, source)."""

    def pour(name: str, above: str, keys: list[str], level: str, weight: str) -> str:
        every, parent = ", ".join([*keys, level]), ", ".join(keys)
        by = f"PARTITION BY {parent} " if keys else ""
        join = f"JOIN {above} USING ({parent})" if keys else f"CROSS JOIN {above}"
        return f"""
{name}_n AS (SELECT {every}, capacity, budget, {weight} AS w FROM
  (SELECT {every}, sum(tokens * {max_epochs})::HUGEINT AS capacity FROM leaves GROUP BY {every}) {join}),
{name}_o AS (SELECT *, budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, row_number() OVER o AS rk
  FROM {name}_n WINDOW o AS ({by}ORDER BY capacity::DOUBLE / w::DOUBLE, {level})),
{name}_p AS (SELECT *, first_value(CASE WHEN capacity * rest >= w * lft THEN lft END IGNORE NULLS) OVER f AS l0,
    first_value(CASE WHEN capacity * rest >= w * lft THEN rest END IGNORE NULLS) OVER f AS r0
  FROM {name}_o WINDOW f AS ({by}ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
{name} AS (SELECT {every}, greatest(CASE WHEN l0 IS NULL THEN capacity ELSE least(capacity, (w * l0)::HUGEINT // r0::HUGEINT) END, 0)::HUGEINT AS budget FROM {name}_p)"""

    def case(level: str) -> str:
        arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS.get(level, {}).items())
        other = MIX_DEFAULTS[level]
        return f"(CASE {level} {arms} ELSE {other} END)::HUGEINT" if arms else f"{other}::HUGEINT"

    number = "try_cast(regexp_extract(coalesce(source, ''), '^src([0-9]{1,6})$', 1) AS INT)"
    return rf"""
d0 AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '~' || md5(coalesce(text, ''))) AS ident, source, coalesce(lang, 'unknown') AS lang, {number} AS num,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n_tokens FROM {docs}),
d AS (SELECT doc_id, lang, coalesce(source, 'unknown') AS source, n_tokens, ident,
    CASE WHEN num IS NULL THEN 'unknown' WHEN num < 5 THEN 'web' WHEN num < 10 THEN 'books' WHEN num < 15 THEN 'news' ELSE 'forum' END AS domain FROM d0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM d GROUP BY ALL),
whole AS (SELECT least(sum(tokens) * {max_epochs}, {budget})::HUGEINT AS budget FROM (SELECT *, sum(tokens) OVER () AS all_tokens FROM leaves) GROUP BY all_tokens),
{pour("b1", "whole", [], "domain", case("domain"))},
{pour("b2", "b1", ["domain"], "lang", case("lang"))},
{pour("b3", "b2", ["domain", "lang"], "source", case("source"))},
plan AS (SELECT leaves.*, budget // greatest(tokens, 1) AS epochs, budget % greatest(tokens, 1) AS prefix
  FROM leaves JOIN b3 USING (domain, lang, source) WHERE tokens > 0),
ordered AS (SELECT d.*, epochs, prefix, md5('{MIX_SEED}:' || epochs || ':' || ident) AS h FROM d JOIN plan USING (domain, lang, source)),
running AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, ident
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM ordered),
mixed AS (SELECT doc_id, domain, lang, source, n_tokens, (epochs + CASE WHEN upto <= prefix THEN 1 ELSE 0 END)::INT AS copies FROM running)"""


OP7_SQL = f"""WITH {mix_sql("documents", "(all_tokens * 3) // 4", 2)}
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, copies FROM mixed WHERE copies > 0"""


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.fit_field(pii.labelled_table(spark))
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), field=field)
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped (``gone``), emptied, cut, repeated or given the wrong role, by a hash of their place."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(place.cast("binary")) % 20).alias("harm")
    )
    cut = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"), "harm")
    copies = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", "role", "text", (F.col("harm") == 0).alias("gone"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_summaries(damaged(table(spark, sf_dir, "conversations")), gone=F.col("gone"))


def _op12_sql() -> str:
    """The suffix recursion row by row, from the last to the first: of every grammar state the least (cost, audit)."""
    states, turn = "[1, 2, 3, 4]", "[3, 3, 4, 3][q]"
    kept = "(CASE WHEN ini = 's' AND q = 1 THEN 2 WHEN ini = 'u' AND q IN (1, 2, 4) THEN 3 WHEN ini = 'a' AND q = 3 THEN 4 END)"
    pair = lambda cost, letter, of: f"{{'c': v[{of}].c + {cost}, 'a': '{letter}' || v[{of}].a}}"
    options = f"[{pair(2, 'D', 'q')}, CASE WHEN sound AND {kept} IS NOT NULL THEN {pair('late', 'K', kept)} END, CASE WHEN sound THEN {pair('1 + late', 'R', turn)} END]"
    inserted = lambda b: f"list_transform({states}, lambda q: list_min([base[q], {{'c': {b}[{turn}].c + 5, 'a': 'I' || {b}[{turn}].a}}]))"
    return rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
p AS (SELECT *, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes FROM conversations),
c AS (SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS harm FROM p, tab),
d AS (SELECT k, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE harm <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
f AS (SELECT k, i, turn, role, text, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 2
  WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 3 ELSE 0 END AS fault FROM n),
w(k, i, v) AS (SELECT k, max(i) + 1, [{{'c': 0, 'a': ''}}, {{'c': 10, 'a': 'II'}}, {{'c': 5, 'a': 'I'}}, {{'c': 0, 'a': ''}}] FROM f GROUP BY k
  UNION ALL SELECT k, i, {inserted("two")} FROM (SELECT *, {inserted("one")} AS two FROM (SELECT *, {inserted("base")} AS one FROM (
    SELECT k, i, list_transform({states}, lambda q: list_min(list_filter({options}, lambda x: x IS NOT NULL))) AS base
    FROM (SELECT w.k, f.i, v, ini, fault IN (0, 3) AS sound, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS late FROM w JOIN f ON f.k = w.k AND f.i = w.i - 1))))),
r AS (SELECT k, v[1].c AS cost, v[1].a AS audit FROM w WHERE i = 1),
l AS (SELECT k, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS pos FROM r WHERE audit <> ''),
m AS (SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY k ORDER BY pos) AS i FROM l),
o AS (SELECT m.k, pos, letter, role, ini, text, row_number() OVER (PARTITION BY m.k ORDER BY pos) AS place FROM m LEFT JOIN f ON f.k = m.k AND f.i = m.i AND letter <> 'I' WHERE letter <> 'D'),
q AS (SELECT *, place - max((place = 1 AND letter = 'K' AND ini = 's')::INT) OVER (PARTITION BY k) AS spoken FROM o),
h AS (SELECT k, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN spoken % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY pos)) AS sha FROM q GROUP BY k),
a AS (SELECT k, ini || lead(ini) OVER (PARTITION BY k ORDER BY i) AS pair, lead(ini) OVER (PARTITION BY k ORDER BY i) IS NOT NULL AS follows, fault, turn FROM f),
g AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
  count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM a GROUP BY k)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM c) LEFT JOIN g USING (k) LEFT JOIN r USING (k) LEFT JOIN h USING (k)
"""


OP12_SQL = _op12_sql()

#: Rows that op13 searches for, and how many it finds.
NEAREST_QUERIES, NEAREST = "vec_id % 20 = 0", 20


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), queries=F.expr(NEAREST_QUERIES), k=NEAREST)


OP13_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM (SELECT * FROM v WHERE {NEAREST_QUERIES}) q JOIN v c ON q.rid <> c.rid AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM p)
SELECT query_id, place::INT AS rank, vec_id, score FROM r WHERE place <= {NEAREST}
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_groups": op5_embedding_groups,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_personal_data": op8_personal_data,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_whitening": op11_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLE_SQL: dict[str, str] = {
    "op1_sharding": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op5_embedding_groups": OP5_SQL,
    "op7_mixing": OP7_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_nearest_neighbours": OP13_SQL,
}
