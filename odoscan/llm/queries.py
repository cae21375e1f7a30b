"""The operators as named queries over the shared tables, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op3_secrets")
def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.secrets import letter_pairs, scan_secrets

    docs = table(spark, sf_dir, "documents")
    found = scan_secrets(docs, vocabulary("byte_bpe_50k.tiktoken"), pairs=letter_pairs(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.col("joined").alias("spans"), "n_random",
    )


@query("op5_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row is known by its file and its place there, so null and repeated ids are rows like any others.

    Rows follow one another by id, nulls first, and rows of one id by file and place.
    """
    from odoscan.llm.common import stage
    from odoscan.llm.simhash import fingerprints, following, hexed, likeness

    rows = table(spark, sf_dir, "documents")
    place = [F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")]
    text = F.coalesce("text", F.lit(""))
    docs = rows.select(*place, text.alias("text"))  # nothing else, so that both joins read one shuffle of the texts
    key = ["f", "i"]
    lengths = rows.select(*place, "doc_id", F.length(text).cast("long").alias("n_chars"))
    links = stage(following(lengths, ["doc_id", *key], key))
    # The beginning that a document lends to the one before it is all that travels of it besides its own text.
    wanted = links.select(F.col("next_f").alias("f"), F.col("next_i").alias("i"), F.col("f").alias("to_f"), F.col("i").alias("to_i"), F.floor(F.col("n_chars") / 4).alias("n"))
    lent = docs.join(wanted, key).select(F.col("to_f").alias("f"), F.col("to_i").alias("i"), "n", F.expr("left(text, int(n))").alias("head"))
    edited = docs.join(lent, key).select(
        *key, "text", F.concat(F.expr("left(text, int(length(text) - n))"), "head").alias("edited"),
    )
    known = [*key, "edited_sha256", "version"]
    both = edited.select(
        *key, F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("version", "text"),
    )
    prints = fingerprints(both.select(F.struct(*known).alias("key"), "text"), "key", "text").select("key.*", "fingerprint")
    wide = prints.groupBy(*key).agg(
        F.max(F.when(F.col("version") == 1, F.col("edited_sha256"))).alias("edited_sha256"),
        F.max(F.when(F.col("version") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("version") == 1, F.col("fingerprint"))).alias("edited"),
    )
    wide = stage(wide)
    after = links.select(*key, "doc_id", "n_chars", F.col("next_f").alias("g"), F.col("next_i").alias("j")).join(
        wide.select(F.col("f").alias("g"), F.col("i").alias("j"), F.col("own").alias("next")), ["g", "j"]
    )
    return wide.join(after.drop("g", "j"), key).select(
        "doc_id", "n_chars", "edited_sha256", hexed(F.col("own")).alias("fingerprint"),
        hexed(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


@query("simhash_radius")
def simhash_radius_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct fingerprint within three bits of that of a row whose id is divisible by 100, with its smallest id and its rows."""
    from odoscan.llm.common import stage
    from odoscan.llm.simhash import fingerprints, hexed, within_radius

    docs = table(spark, sf_dir, "documents").select(F.struct(F.xxhash64("_metadata.file_path").alias("f"), "_metadata.row_index", "doc_id").alias("key"), "text")
    prints = stage(fingerprints(docs, "key", "text").select("key.doc_id", "fingerprint"))
    asking = prints.filter("doc_id % 100 = 0")
    groups = prints.groupBy(F.col("fingerprint").alias("other")).agg(F.min("doc_id").alias("other_id"), F.count(F.lit(1)).alias("other_rows"))
    found = within_radius(asking, prints).join(groups, "other")
    return asking.join(found, "fingerprint").select("doc_id", hexed(F.col("other")).alias("other"), "distance", "other_id", "other_rows")


@query("op8_substring_dedup")
def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.substring import remove_repeats

    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op7_mixing")
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.mixing import mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    # Targets: one to four parts, in turn, by the sources' order. One row per source.
    names = sorted((r["source"] for r in docs.select("source").distinct().collect()), key=lambda s: (s is None, str(s)))
    placed = mix(docs, ["doc_id"], weights={s: 1 + i % 4 for i, s in enumerate(names)})
    return placed.select("doc_id", "source", *[F.col(f"_{c}").alias(c) for c in ("block", "place", "release", "deadline", "slot")])


@query("op9_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.toxicity import remainder, score_texts, threshold_of, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, table(spark, sf_dir, "labels"))
    cut = threshold_of(model, F.col("lang"))
    return score_texts(docs, model).select(
        "doc_id", (remainder("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        cut.alias("threshold"), (F.col("score") >= cut).alias("rejected"),
    )


@query("op10_token_counts")
def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


@query("op4_order_minhash")
def order_minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.order_minhash import near_classes

    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "keep")


@query("op2_nearest")
def nearest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_suffix_dedup")
def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.suffix import remove_repeated_bytes

    kept = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _codes_sql(rounds: int = 4) -> str:
    """Every round as one common table: the nearest entries, then the entries' new means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} AS MATERIALIZED (
  SELECT vec_id, label, p, part, min(struct_pack(
    d := list_sum(list_transform(list_zip(part, centre), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, entry := entry)) AS best
  FROM parts JOIN book{i} USING (p) GROUP BY vec_id, label, p, part)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} AS MATERIALIZED (
  SELECT p, entry, coalesce(mean, centre) AS centre FROM book{i} LEFT JOIN (
    SELECT p, entry, list(floor(total / n)::BIGINT ORDER BY k) AS mean FROM (
      SELECT p, best.entry AS entry, k, sum(part[k]) AS total, count(*) AS n FROM near{i}, generate_series(1, len(part)) g(k) GROUP BY ALL)
    GROUP BY p, entry) USING (p, entry))"""
            )
    return f"""WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS part FROM kept, range(4) r(p)),
book0 AS MATERIALIZED (
  SELECT p, entry, part AS centre FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) USING (vec_id)
  WHERE entry < 256),
{", ".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(centre, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded"""


@query("op11_codes", _codes_sql())
def codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.codes import compress

    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"), "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


_IMPORTANCE_SQL = r"""WITH crc AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
texts AS (
  SELECT doc_id, text, true AS own FROM documents UNION ALL SELECT item_id, text, false FROM benchmark),
words AS MATERIALIZED (
  SELECT own, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
buckets AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_transform(range(len(h) // 2),
      lambda i: (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM words), crc),
held AS MATERIALIZED (SELECT own, doc_id, bucket, count(*) AS n FROM words JOIN buckets USING (word) GROUP BY ALL),
gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t FROM held GROUP BY bucket)),
weighed AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(floor(total / n_features), 0)::BIGINT AS weight
  FROM documents d LEFT JOIN (
    SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS total FROM held JOIN gains USING (bucket) WHERE own GROUP BY doc_id) USING (doc_id)),
scored AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296))))::BIGINT AS score FROM weighed),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON s.doc_id = p.doc_id"""


@query("op12_importance", _IMPORTANCE_SQL)
def importance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.importance import resample

    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_private")
def private_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odoscan.llm.private import find_private, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_private(docs, train(docs))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.col("joined").alias("spans"), "n_added",
    )
