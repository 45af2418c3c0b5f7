"""The registered queries of the document operators, with the SQL that checks them."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folkmeter.llm import (
    bpe,
    decontaminate,
    fingerprints,
    merkle,
    near_duplicates,
    packed,
    packing,
    periodic_runs,
    quality,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
)
from folkmeter.llm.common import new_folder, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


# DuckDB has no CRC-32: the usual table, and a fold over the digits of the id.
CRC_SQL = """
crc_table AS (SELECT list(v ORDER BY b) AS tab FROM (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(b))),
crc AS (
  SELECT doc_id, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM documents, crc_table)"""


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


# DuckDB has no lower-casing of A-Z alone, hence translate.
OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS x
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS x
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n),
occ AS (SELECT g.doc_id, g.n, g.i, win.item FROM grams g JOIN win ON g.n = win.n AND g.x = win.x),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM occ, unnest(range(occ.i, occ.i + occ.n)) AS r(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
    sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
  FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op5_suffix_automaton", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op3_digest_cache")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run starts with an empty cache, so that it counts the whole table."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count(documents(spark, sf_dir), model, new_folder(spark, "counts"))


END_OF_DOCUMENT = 2
END_OF_SEQUENCE = 0


@query("op7_arrow_sequences")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "ids")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = packed.write(documents(spark, sf_dir), path, END_OF_DOCUMENT, folder)
    return packed.read_documents(manifest, folder)


@query("op8_hilbert_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards in the space of language, source and size."""
    rows = documents(spark, sf_dir, "lang", "source").select(
        "doc_id",
        sharding.text_size().alias("size"),
        sharding.text_crc32().alias("text_crc32"),
        "lang",
        "source",
    )
    rows = sharding.with_ranks(rows, {"lang_rank": "lang", "source_rank": "source"}).drop("lang", "source")
    dimensions = {c: F.col(c) for c in ("lang_rank", "source_rank", "size")}
    placed = sharding.assign(rows, dimensions, ["doc_id", "text_crc32", "size"])
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", grown, "curve")


@query("op4_cumulative_link")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


@query("op6_fourier_ridge")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(quality.features(documents(spark, sf_dir)), "statistics")
    model = quality.fit(found, table(spark, sf_dir, "labels"))
    return quality.score(found, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", "predicted"
    )


@query("op10_lookup_sketch")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(documents(spark, sf_dir))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_slice(w, i, i + 4) AS x, count(*) AS n
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0 GROUP BY ALL),
size AS (SELECT doc_id, sum(n) AS total FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS p, b.doc_id AS q, sum(least(a.n, b.n)) AS m
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT p, q FROM shared JOIN size x ON x.doc_id = p JOIN size y ON y.doc_id = q
  WHERE m >= 0.8 * (x.total + y.total - m) - 1e-9
  UNION ALL
  SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.t = b.t AND a.doc_id < b.doc_id AND len(a.w) = 0),
near AS (SELECT p, q FROM link UNION ALL SELECT q, p FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, near.q FROM reach JOIN near ON near.p = other)
SELECT doc_id, min(other) AS class_id, doc_id = min(other) AS stays FROM reach GROUP BY doc_id
"""


@query("op9_bag_minhash", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class, named by the least id in it, and whether it stays."""
    rows, _ = near_duplicates.classes(documents(spark, sf_dir))
    return rows.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("stays"))


# Every byte place of every text, with the digest of the 100 bytes that start there.
OP1_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS (SELECT doc_id, hex(encode(t)) AS x, octet_length(encode(t)) AS n FROM d),
e AS (
  SELECT doc_id, n, o, substr(x, 2 * o + 1, 1222) AS y FROM h, unnest(range(0, n, 512)) AS r(o)),
p AS (
  SELECT doc_id, i, substr(y, 2 * (i - o) + 1, 2) AS b,
    CASE WHEN i + 100 <= n THEN md5(substr(y, 2 * (i - o) + 1, 200)) END AS k
  FROM e, unnest(range(o, least(o + 512, n))) AS r(i)),
f AS (
  SELECT doc_id, i, b, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS dup
  FROM p),
c AS (
  SELECT doc_id, i, b, coalesce(bool_or(dup) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), false) AS gone FROM f),
s AS (
  SELECT doc_id, i, b, gone,
    gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM c),
g AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
    coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM s GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM h LEFT JOIN g USING (doc_id)
"""


@query("op1_suffix_array", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(documents(spark, sf_dir))


@query("op13_harmonic_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(documents(spark, sf_dir), path, END_OF_SEQUENCE)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


OP12_SQL = (
    "WITH RECURSIVE"
    + CRC_SQL
    + r""",
fields AS (
  SELECT d.doc_id, coalesce('1' || lang, '0') AS tree, h % 3 = 0 AS tampered, text,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents d JOIN crc ON crc.doc_id = d.doc_id),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
    ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS other,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM fields),
low(l, tree, idx, n, h) AS (
  SELECT 0, tree, idx, n, leaf FROM leaves UNION ALL
  SELECT l + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM low WHERE n > 1 GROUP BY l, tree, idx // 8, n),
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
top(l, idx, n, h) AS (
  SELECT 0, idx, n, h FROM subroots UNION ALL
  SELECT l + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY l, idx // 8, n),
heights AS (SELECT DISTINCT l, tree FROM low WHERE n > 1),
way AS (
  SELECT doc_id, l AS k, tree, idx >> (3 * l) AS place FROM leaves JOIN heights USING (tree) UNION ALL
  SELECT doc_id, 1000 + l, '', s.idx >> (3 * l)
  FROM leaves JOIN subroots s USING (tree), (SELECT DISTINCT l FROM top WHERE n > 1) AS t),
nodes AS (
  SELECT l AS k, tree, idx, h FROM low WHERE n > 1 UNION ALL SELECT 1000 + l, '', idx, h FROM top WHERE n > 1),
steps AS (
  SELECT doc_id, way.k, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < place), '') AS b,
    coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > place), '') AS a
  FROM way JOIN nodes ON nodes.k = way.k AND nodes.tree = way.tree AND idx // 8 = place // 8
  GROUP BY doc_id, way.k),
paths AS (
  SELECT doc_id, list({'b': b, 'a': a} ORDER BY k) AS path, string_agg(b || a, '' ORDER BY k) AS joined
  FROM steps GROUP BY doc_id),
folded(doc_id, i, h) AS (
  SELECT doc_id, 0, other FROM leaves UNION ALL
  SELECT f.doc_id, i + 1, sha256(path[i + 1].b || h || path[i + 1].a)
  FROM folded f JOIN paths p ON p.doc_id = f.doc_id WHERE i < len(path)),
ends AS (SELECT doc_id, arg_max(h, i) AS folded_root FROM folded GROUP BY doc_id)
SELECT d.doc_id, leaf, s.h AS subroot, t.h AS root, sha256(coalesce(joined, '')) AS proof_sha256,
  folded_root, folded_root = t.h AS verified
FROM leaves d JOIN subroots s USING (tree) JOIN ends USING (doc_id) LEFT JOIN paths USING (doc_id),
  (SELECT h FROM top WHERE n = 1) AS t
"""
)


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree per language; a third of the documents is checked with a text in lower case."""
    docs = documents(spark, sf_dir, "source", "lang", "n_chars")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    other = merkle.leaf(*[lower if c == "text" else F.col(c) for c in columns])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = merkle.manifest(
        docs, columns, "lang", ["doc_id"], {"doc_id": F.col("doc_id"), "other": F.when(tampered, other)}
    )
    rows = rows.withColumn("start", F.coalesce("other", "leaf"))
    folded = rows.withColumn("folded_root", merkle.fold("start"))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# Pairs of equal words q apart; consecutive ones make the stretches of period q.
OP11_SQL = (
    "WITH RECURSIVE"
    + CRC_SQL
    + r""",
plain AS (
  SELECT d.doc_id, h, h // 10 AS g,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents d JOIN crc ON crc.doc_id = d.doc_id),
params AS (
  SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) END AS a,
    CASE WHEN len(w) > 0 THEN 1 + (len(w) - g % len(w)) // (3 + g % 8) END AS p FROM plain),
edited AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
    lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM params),
pos AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM edited),
pairs AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM pos a JOIN pos b
  ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM islands GROUP BY doc_id, q, k
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, len, min(q) AS q FROM stretches GROUP BY doc_id, s, len),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
sums AS (
  SELECT doc_id, count(*) AS n_runs, sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q)) AS digest
  FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len DESC, s, q) = 1)
SELECT e.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period,
  1000 * len // q AS exponent_milli, coalesce(digest, sha256('')) AS runs_sha256,
  sha256(coalesce(t, '')) AS collapsed_sha256
FROM edited e LEFT JOIN sums USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
)


@query("op11_cover_runs", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words, after a tenth of the documents had their tails made periodic."""
    docs = documents(spark, sf_dir).withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, periodic_runs.split_words("text")))
    n, g = F.size("words"), F.expr("h div 10")
    start = (g % n).cast("int")
    period = (F.floor((n - start) / (g % 8 + 3)) + 1).cast("int")
    edited = F.when(n > 0, F.array_join(periodic_runs.repeat_tail("words", start, period), " "))
    found = periodic_runs.find(docs.select("doc_id", F.coalesce(edited, "text").alias("text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    order = F.transform(
        "runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))
    )
    found = found.withColumn("best", F.array_max(order))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        "best.length",
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
