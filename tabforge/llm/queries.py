"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontam, fingerprints, licenses, merkle, minhash, mixing, recompress, repetition, sharding, tokens, toxicity, warc
from .stage import Stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))


#: CRC-32 over the bytes of a text in SQL: the table of the polynomial EDB88320, then one step for each byte.
_CRC_CTE = """
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i))),
hexed AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, strlen(text) + 1 AS size, text,
  xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, strlen(text) + 1), lambda k: ((strpos('0123456789ABCDEF', h[2 * k - 1]) - 1) * 16
      + strpos('0123456789ABCDEF', h[2 * k]) - 1)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32
  FROM hexed, crc_table)"""


@_query(f"""WITH {_CRC_CTE},
placed AS (SELECT *, sum(size) OVER w - size AS before, row_number() OVER w - 1 AS row
  FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, ((2 * before + size) * 16 // (2 * (SELECT sum(size) FROM sized)))::INT AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
  (row - min(row) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard FROM cut""")
def op2_sharding(spark, sf_dir):
    out = sharding.shard_assignments(spark, _table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


#: Target weights of the query: sources fall into four domains by their number.
MIX_DOMAIN = "concat('domain', cast(coalesce(try_cast(regexp_extract(source, '[0-9]+', 0) AS INT), 0) % 4 AS STRING))"
MIX_WEIGHTS = {
    "domain": "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END",
    "lang": "CASE lang WHEN 'en' THEN 6 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 ELSE 1 END",
    "source": "CASE source WHEN 'src0' THEN 2 ELSE 1 END",
}
MIX_SEED = 20240607


def mix_documents(spark, docs, percent, epochs):
    return mixing.mix(spark, docs, F.expr(MIX_DOMAIN), {k: F.expr(v) for k, v in MIX_WEIGHTS.items()}, percent, epochs, MIX_SEED)


def _share_sql(source: str, parent: str, budget: str) -> str:
    """One level of the budget tree: children of ``source`` share ``budget`` by weight, filled up at their capacity."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""SELECT *, CASE WHEN filled THEN cap ELSE least(cap, (b - taken) * w // open) END::BIGINT AS own FROM (
      SELECT *, coalesce(sum(CASE WHEN filled THEN cap END) OVER ({by}), 0)::HUGEINT AS taken,
        coalesce(sum(CASE WHEN NOT filled THEN w END) OVER ({by}), 0)::HUGEINT AS open FROM (
        SELECT *, (caps * w + cap * (ws - upto) <= b * w) AS filled FROM (
          SELECT *, {budget}::HUGEINT AS b,
            sum(cap) OVER ({by} ORDER BY cap / w, k ROWS UNBOUNDED PRECEDING)::HUGEINT AS caps,
            sum(w) OVER ({by} ORDER BY cap / w, k ROWS UNBOUNDED PRECEDING)::HUGEINT AS upto,
            sum(w) OVER ({by})::HUGEINT AS ws FROM {source})))"""


def mix_sql(percent: int, epochs: int, docs: str = "documents") -> str:
    duck = MIX_DOMAIN.replace("STRING", "VARCHAR")
    return f"""WITH base AS (SELECT doc_id, {duck} AS domain, lang, source,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM {docs}),
leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens, sum(tokens) * {epochs} AS cap FROM base GROUP BY ALL),
total AS (SELECT least(sum(tokens) * {percent} // 100, sum(cap))::HUGEINT AS b FROM leaves),
n1 AS (SELECT domain, domain AS k, sum(cap)::HUGEINT AS cap, {MIX_WEIGHTS["domain"]} AS w FROM leaves GROUP BY domain),
s1 AS ({_share_sql("n1", "", "(SELECT b FROM total)")}),
n2 AS (SELECT l.domain, lang, lang AS k, sum(l.cap)::HUGEINT AS cap, {MIX_WEIGHTS["lang"]} AS w, any_value(s1.own) AS given
  FROM leaves l JOIN s1 USING (domain) GROUP BY l.domain, lang),
s2 AS ({_share_sql("n2", "domain", "given")}),
n3 AS (SELECT l.domain, l.lang, source, source AS k, l.cap::HUGEINT AS cap, {MIX_WEIGHTS["source"]} AS w, s2.own AS given
  FROM leaves l JOIN s2 USING (domain, lang)),
s3 AS ({_share_sql("n3", "domain, lang", "given")}),
queue AS (SELECT base.*, epoch, md5('{MIX_SEED}:' || epoch || ':' || doc_id) AS key FROM base, range({epochs}) e(epoch)),
placed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, key, tokens
  ROWS UNBOUNDED PRECEDING) - tokens AS before FROM queue)
SELECT p.doc_id, p.domain, p.lang, p.source, p.epoch::INT AS epoch, p.tokens::BIGINT AS tokens
FROM placed p JOIN s3 USING (domain, lang, source) WHERE p.before < s3.own"""


@_query(mix_sql(60, 3))
def op8_mixing(spark, sf_dir):
    out = mix_documents(spark, _table(spark, sf_dir, "documents"), 60, 3)
    return out.select("doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"),
                      F.col("_source").alias("source"), F.col("_epoch").alias("epoch"), F.col("_tokens").alias("tokens"))


def _windows_sql(size: int) -> str:
    """Words of each document that a window of ``size`` words covers which stands twice or more in it."""
    return f"""SELECT DISTINCT doc_id, pos + o AS pos FROM (
      SELECT doc_id, unnest(p) AS pos FROM (
        SELECT doc_id, g, list(pos) AS p FROM (
          SELECT doc_id, i AS pos, array_to_string(w[i:i + {size - 1}], ' ') AS g FROM (
            SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM words))
        GROUP BY doc_id, g HAVING count(*) > 1)), range({size}) r(o)"""


@_query(f"""WITH words AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
three AS (SELECT doc_id, count(*) AS n FROM ({_windows_sql(3)}) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n FROM ({_windows_sql(repetition.MIN_REPEAT)}) GROUP BY doc_id),
over AS (SELECT DISTINCT doc_id FROM ({_windows_sql(repetition.MAX_LONGEST + 1)})),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
counts AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
  coalesce(three.n, 0)::BIGINT AS n_repeat_words, coalesce(held.n, 0)::BIGINT AS covered_words, over.doc_id IS NOT NULL AS long_one
  FROM words LEFT JOIN three USING (doc_id) LEFT JOIN held USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN over USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
  NOT base_failed AND 100 * covered_words <= {repetition.MAX_COVERED_PERCENT} * n_words AND NOT long_one AS kept FROM judged""")
def op3_repetition(spark, sf_dir):
    out = repetition.repetition_rules(spark, _table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "base_failed", "kept")


@_query("""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to, true AS verified FROM f""")
def op9_warc(spark, sf_dir):
    path = Stage(spark, "archives").path("warc")
    warc.write_archives(spark, _table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


@_query()
def op10_token_ids(spark, sf_dir):
    import public_tokenizers
    path = Stage(spark, "token-files").path("tokens")
    tokens.write_tokens(spark, _table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokens.token_digests(spark, path)


@_query()
def op6_recompression(spark, sf_dir):
    out = recompress.remove_repeats(spark, _table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


@_query()
def op4_toxicity(spark, sf_dir):
    out = toxicity.score_documents(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@_query()
def op5_decontamination(spark, sf_dir):
    return decontam.contaminated(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query()
def op7_licenses(spark, sf_dir):
    return licenses.license_notices(spark, _table(spark, sf_dir, "documents"))


def merkle_report(spark, docs):
    """Proofs of the rows, and the root that each row's leaf gives after tampering: where 7 divides the CRC-32 of the
    doc_id in decimal, n_chars is one more (a null stays null)."""
    fields = [F.col(c) for c in merkle.FIELDS]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    now = [F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars")) if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    out = merkle.merkle_proofs(spark, docs, also={"_now": F.when(touched, merkle.leaf_digest(*now)).otherwise(merkle.leaf_digest(*fields))})
    return (out.withColumn("folded_root", merkle.fold("_now"))
            .select("doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def _leaf_sql(n_chars: str) -> str:
    coded = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(coded)})"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, idx, h); n is the number of nodes of the level."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, idx, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 2, n)"""


@_query(f"""WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i))),
docs AS (SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 7 = 0 AS touched
  FROM documents, crc_table),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS h,
    CASE WHEN touched THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS now FROM docs)),
{_tree_sql("nodes", "leaves")},
groups AS (SELECT tree AS own, h, row_number() OVER (ORDER BY tree) - 1 AS idx, 'top' AS tree FROM nodes WHERE n = 1),
{_tree_sql("tops", "groups")},
links AS (
  SELECT me.tree, me.level, me.idx, me.tree AS up_tree, me.level + 1 AS up_level, me.idx // 2 AS up_idx, me.idx % 2 = 1 AS left_one, coalesce(s.h, '') AS sib
  FROM nodes me LEFT JOIN nodes s ON s.tree = me.tree AND s.level = me.level AND s.idx = xor(me.idx, 1) WHERE me.n > 1
  UNION ALL
  SELECT CASE WHEN me.level = 0 THEN g.own ELSE 'top' END, CASE WHEN me.level = 0 THEN o.level ELSE me.level END, CASE WHEN me.level = 0 THEN 0 ELSE me.idx END,
    'top', me.level + 1, me.idx // 2, me.idx % 2 = 1, coalesce(s.h, '')
  FROM tops me LEFT JOIN tops s ON s.level = me.level AND s.idx = xor(me.idx, 1)
    LEFT JOIN groups g ON me.level = 0 AND g.idx = me.idx LEFT JOIN nodes o ON o.tree = g.own AND o.n = 1 WHERE me.n > 1),
walk AS (
  SELECT doc_id, tree AS own, tree, 0 AS level, idx, h AS leaf, now, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.own, l.up_tree, l.up_level, l.up_idx, w.leaf, sha256(CASE WHEN left_one THEN sib || w.now ELSE w.now || sib END), w.proof || sib
  FROM walk w JOIN links l USING (tree, level, idx))
SELECT w.doc_id, w.leaf, g.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.now AS folded_root, w.now = r.h AS verified
FROM walk w JOIN groups g USING (own) CROSS JOIN (SELECT h FROM tops WHERE n = 1) r
WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.tree = w.tree AND l.level = w.level AND l.idx = w.idx)""")
def op11_merkle_manifest(spark, sf_dir):
    return merkle_report(spark, _table(spark, sf_dir, "documents"))


@_query("""WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]') AS p FROM documents),
pieces AS (SELECT d, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM docs),
cut AS (SELECT d, lang, i, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
words AS (SELECT d, lang, i, unnest(w) AS w1, generate_subscripts(w, 1) AS pos FROM cut),
near AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY d, i ORDER BY pos)),
f1 AS (SELECT lang, w1, count(*) AS a FROM near GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS a FROM near WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM near WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (SELECT lang, w1, w2, max(a) AS best FROM (
  SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
cuts AS (SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, 1 AS k, f2.a, x.a AS l, y.a AS r
    FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
      LEFT JOIN longer g ON g.lang = f2.lang AND g.w1 = f2.w1 AND g.w2 = f2.w2 WHERE best IS NULL OR 100 * best < 50 * f2.a
  UNION ALL SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.a, x.a, y.a
    FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.a, x.a, y.a
    FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
scored AS (SELECT *, (1000000 * a::HUGEINT * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
low AS (SELECT lang, phrase, a, min_by(l, (score, k)) AS l, min_by(r, (score, k)) AS r, min(score) AS score FROM scored GROUP BY lang, phrase, a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score
FROM low JOIN (SELECT lang, sum(a) AS n FROM f1 GROUP BY lang) USING (lang) QUALIFY rank <= 2000""")
def op12_collocations(spark, sf_dir):
    return collocations.top_collocations(spark, _table(spark, sf_dir, "documents"))


@_query()
def op13_fingerprints(spark, sf_dir):
    return fingerprints.edit_report(spark, _table(spark, sf_dir, "documents"))
