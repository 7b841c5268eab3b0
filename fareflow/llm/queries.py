"""The queries ``opN_<name>`` over the driver's tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import materialize
from . import codes, imatch, lines, merkle, neighbours, packing, passages, pieces, quality, shards, simhash, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: A document is toxic from this score on.
TOXIC = 0.7


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match token counts of every document."""
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _held_out():
    """Documents whose labels nothing may be learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted on a bounded sample of the labelled documents outside the held-out third."""
    known = labels.filter(~_held_out()).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    return toxicity.fit_sample(documents.select(F.col("doc_id").alias("id"), "text"), known)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is toxic."""
    documents = _table(spark, sf_dir, "documents")
    found = toxicity.score(documents, toxicity_model(documents, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted")
    )


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 4096."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that a document shares with one of smaller id: first word, number of words, that document."""
    found = passages.repeated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first", "words", "first_doc_id")


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document; a shard holds at most 8 MiB of text."""
    return shards.assign(_table(spark, sf_dir, "documents"), max_bytes=8 << 20)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines of 40 code points that 5 documents share, but for the last of them."""
    found = lines.drop_repeated(_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_BLANKS = " || ".join(f"chr({ord(c)})" for c in lines.BLANKS)
ORACLE["op7_line_dedup"] = f"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
numbered AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM texts),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM numbered),
frequent AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT a.doc_id, a.i, a.line, coalesce(a.doc_id <> f.keeper, false) AS gone FROM keyed a LEFT JOIN frequent f ON a.k = f.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and of its edited text."""
    return imatch.compare_with_edited(_table(spark, sf_dir, "documents"))


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: number and hash of the ids, digest of the text that came back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    there = pieces.encode(_table(spark, sf_dir, "documents"), model)
    back = pieces.decode(there, model)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), F.sha2("text", 256).alias("text_sha256")
    )


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("_id") % 50 == 0, k=5)


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures, the rules it breaks as bits, and the verdict of the full policy."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    entries = materialize(quality.ledger(documents), "quality-ledger")
    return quality.apply(entries, quality.FULL).select(
        "doc_id", *quality.MEASURES, quality.BASE.rejects(F.col("failed")).alias("base_failed"), "failed", "kept"
    )


ORACLE["op11_quality_rules"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM documents),
words AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM t),
windows AS (SELECT doc_id, i, a, lead(a) OVER s AS b, lead(a, 2) OVER s AS c FROM words WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
spots AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL),
repeats AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM spots, (VALUES (0), (1), (2)) o(d) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(array_to_string(w, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    length(regexp_replace(array_to_string(w, ''), '\P{L}', '', 'g')) AS n_letters,
    length(regexp_replace(array_to_string(w, ''), '\P{Lu}', '', 'g')) AS n_capitals
  FROM t LEFT JOIN repeats r ON r.doc_id = t.doc_id),
f AS (SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
    + 4 * CAST(10 * n_symbols > n_words AS BIGINT) + 8 * CAST(word_chars < 3 * n_words OR word_chars > 10 * n_words AS BIGINT)
    + 16 * CAST(10 * n_dup_lines > 4 * n_lines AS BIGINT) + 32 * CAST(100 * n_letters < 60 * word_chars AS BIGINT)
    + 64 * CAST(2 * n_capitals > n_letters AS BIGINT) AS failed FROM m)
SELECT *, failed % 4 > 0 AS base_failed, failed = 0 AS kept FROM f"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its group's and the dataset's root, and what its proof says of a tampered copy."""
    documents = _table(spark, sf_dir, "documents")
    leaf = lambda text: merkle.digest(*[merkle.framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], merkle.framed(text))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered & F.contains("text", F.lit("\n")), leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    found = merkle.manifest(documents, leaf(F.col("text")), keep={"changed": changed})
    folded = merkle.fold(F.coalesce("changed", "leaf"), "lefts", "rights")
    proofs = found.select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings()).alias("proof_sha256"), folded.alias("folded_root"))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's codes, its error, and that of all vectors of its label."""
    found = codes.compress(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    code = F.array_join(F.transform("codes", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")
    rows = found.rows.select("vec_id", "label", code.alias("code"), F.aggregate("errors", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    rows = codes.total_by(materialize(rows, "vector-codes"), "label", "error", "label_error")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


_FRAMED = " || ".join(
    f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
)
ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE rest AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS crc FROM range(256) r(i)),
marked AS (SELECT d.*, list_reduce(list_concat([4294967295], [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])) AS code FROM documents d, rest),
leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, sha256({_FRAMED.format(text="text")}) AS leaf,
    sha256({_FRAMED.format(text="CASE WHEN code % 2 = 1 THEN replace(text, chr(10), '') ELSE text END")}) AS held FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place FROM leaves),
small AS (SELECT tree, 0 AS level, place, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest FROM placed UNION ALL
  SELECT tree, level + 1, place // 3, max((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM small WHERE n > 1 GROUP BY tree, level, place // 3),
tops AS (SELECT tree, digest FROM small WHERE n = 1),
large AS (SELECT 0 AS level, tree AS place, (SELECT count(*) FROM tops) AS n, digest FROM tops UNION ALL
  SELECT level + 1, place // 3, max((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM large WHERE n > 1 GROUP BY level, place // 3),
paths AS (SELECT p.doc_id, s.level, s.place AS spot, p.place // CAST(pow(3, s.level) AS BIGINT) AS own, s.digest
  FROM placed p JOIN small s ON s.tree = p.tree AND s.n > 1 AND s.place // 3 = p.place // CAST(pow(3, s.level + 1) AS BIGINT) UNION ALL
  SELECT p.doc_id, 100 + l.level, l.place, p.tree // CAST(pow(3, l.level) AS BIGINT), l.digest
  FROM placed p JOIN large l ON l.n > 1 AND l.place // 3 = p.tree // CAST(pow(3, l.level + 1) AS BIGINT)),
steps AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS step, coalesce(string_agg(digest, '' ORDER BY spot) FILTER (spot < own), '') AS a,
    coalesce(string_agg(digest, '' ORDER BY spot) FILTER (spot > own), '') AS b FROM paths GROUP BY doc_id, level),
folds AS (SELECT doc_id, 0 AS step, held AS digest FROM placed UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(a || f.digest || b) FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step + 1),
ends AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id),
proofs AS (SELECT doc_id, sha256(string_agg(a || b, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY doc_id)
SELECT p.doc_id, leaf, t.digest AS subroot, r.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.digest AS verified
FROM placed p JOIN tops t ON t.tree = p.tree JOIN (SELECT digest FROM large WHERE n = 1) r ON true JOIN ends e ON e.doc_id = p.doc_id
  LEFT JOIN proofs q ON q.doc_id = p.doc_id"""


def _codes_sql(rounds: int = 6) -> str:
    found = """near{r} AS (SELECT vec_id, part, min(d * 64 + entry) AS best FROM (
    SELECT vec_id, part, entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS d FROM c JOIN b{r} b USING (part, spot) GROUP BY ALL) GROUP BY ALL)"""
    moved = """m{r} AS (SELECT part, best % 64 AS entry, spot, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM near{r} JOIN c USING (vec_id, part) GROUP BY ALL),
b{n} AS (SELECT part, entry, spot, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN m{r} m USING (part, entry, spot))"""
    chain = ",\n".join(f"{found.format(r=r)},\n{moved.format(r=r, n=r + 1)}" for r in range(rounds))
    return f"""WITH v AS (SELECT * FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
w AS (SELECT min(len(embedding)) // 8 AS w FROM v),
long AS (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM v),
c AS (SELECT vec_id, i // w AS part, i % w AS spot, CAST(floor(4096 * CAST(e AS DOUBLE)) AS BIGINT) AS x FROM long, w),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < 16),
b0 AS (SELECT part, entry, spot, x FROM seeds JOIN c USING (vec_id)),
{chain},
{found.format(r=rounds)},
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', CAST(best % 64 AS INT)), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, spot)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)"""


ORACLE["op13_vector_codes"] = _codes_sql()
