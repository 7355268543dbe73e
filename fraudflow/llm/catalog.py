"""Registered queries of this subpackage: each dealt operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, work_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned from the labels that aren't held out."""
    from .toxicity import fit, held_out, score_documents

    docs = _table(spark, sf_dir, "documents")
    model = fit(docs, _table(spark, sf_dir, "labels").where(~held_out()))
    return score_documents(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "terms", "neighbours")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back of every conversation from its formatted windows."""
    from .chat import chat_windows, read_loss, read_turns

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    windows = chat_windows(turns.unionByName(extra)).select(
        "conv_id", "window", F.length("text").alias("chars"), read_turns(F.col("text")).alias("turns"), "n_repeated",
        F.array_join(read_loss(F.col("text"), F.col("loss_spans")), "").alias("loss"))
    new = F.slice("turns", (F.col("n_repeated") + 1).cast("int"), F.greatest(F.lit(0), F.size("turns") - F.col("n_repeated").cast("int")))
    windows = windows.select("conv_id", "window", "chars", "loss", F.size(new).alias("n"), F.array_join(
        F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"))
    both = windows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                          F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"))
    loss = F.array_join(F.transform("w", lambda w: w["loss"]), "")
    return both.select("conv_id", "n_turns", F.sha2(F.array_join(F.transform("w", lambda w: w["said"]), ""), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    import public_tokenizers

    from .packing import pack_documents

    placed = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            derive={"ids_crc32": F.crc32("ids")}, keep_ids=False)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, through an empty digest cache of its own."""
    import public_tokenizers

    from .token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        work_path(spark, "token-cache"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words and benchmark items in shared windows of ten words."""
    from .positional_index import decontaminate

    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its WARC record says, after a round trip through Zstandard archives."""
    from .warc import read_archives, with_originals, write_archives

    path = work_path(spark, "warc")
    # content is compressed already
    write_archives(with_originals(_table(spark, sf_dir, "pages"))).write.option("compression", "uncompressed").parquet(path)
    out = read_archives(spark.read.parquet(path), payload=False)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    bad = F.raise_error(F.concat(F.lit("invalid record in "), "archive", F.lit(": "), "error"))
    return out.select(number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                      F.when(F.col("error").isNotNull(), bad).otherwise(F.col("record_type")).alias("record_type"),
                      number(F.col("refers_to")).alias("refers_to"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confirmed licence families of every document, and what the classifier found."""
    from .licenses import corpus_paragraphs, scan_licenses, train

    docs = _table(spark, sf_dir, "documents")
    out = scan_licenses(docs, train(corpus_paragraphs(docs)))
    families = F.array_sort(F.array_distinct(F.transform(F.filter("found", lambda x: x["confirmed"]), lambda x: x["family"])))
    return out.select("doc_id", "n_lines", F.size("found").cast("long").alias("n_found"), F.array_join(families, ",").alias("licenses"), "found")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules and the learned list's verdict."""
    from .quality import learn_rules, text_statistics
    from .store import stored

    stats = stored(text_statistics(_table(spark, sf_dir, "documents")), "statistics")
    rules = learn_rules(stats, _table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                        (~failed & rules.verdict()).alias("kept"), rules.rule_number().alias("rule"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of 0.75 or more on five-word shingles."""
    from .jaccard import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier."""
    from .substrings import drop_repeats

    out = drop_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, sources weighing 5, 2, 1 in turn."""
    from .mixing import mix

    out = mix(_table(spark, sf_dir, "documents"), (5, 2, 1), most=3)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two to four words of each language."""
    from .collocations import collocations

    return collocations(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, and whether its row, tampered with for every other crc32, still proves it."""
    from .merkle import digest, field, fold, leaf, prove, siblings

    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    bare = leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.replace("text", F.lit("\n"), F.lit("")))
    out = prove(_table(spark, sf_dir, "documents"), carry={"tampered": F.when(even, bare)})
    folded = out.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_chat_formatting, op3_packing, op4_token_counts, op5_decontamination, op6_warc, op7_license_scan, op8_quality_rules, op9_ngram_jaccard_join, op10_substring_dedup,
                                      op11_mixing, op12_collocations, op13_merkle_manifest)}
#: DuckDB twins, where SQL can express a query
ORACLE: dict[str, str] = {
    # the stops are taken in order of size over weight; ids are unique there, so no draw needs a row's place
    "op11_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM docs GROUP BY source),
stops AS (
  SELECT *, sum(s) OVER ()::BIGINT AS total, sum(w) OVER () AS weight,
         coalesce(sum(s) OVER before, 0)::BIGINT AS used, coalesce(sum(w) OVER before, 0) AS closed
  FROM sources WINDOW before AS (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (
  SELECT (total - 3 * used)::DOUBLE AS free, weight - closed AS open FROM stops
  WHERE (total - 3 * used)::DOUBLE * w / (weight - closed) <= 3 * s ORDER BY used, closed LIMIT 1),
rates AS (
  SELECT source, s, least(free * w / open, (3 * s)::DOUBLE) AS target,
         CASE WHEN s > 0 THEN least(free * w / open, (3 * s)::DOUBLE) / s ELSE 0 END AS rate FROM stops, share),
draws AS (
  SELECT doc_id, size, s, target, rate,
         ('0x' || substr(md5(concat_ws(':', '0', coalesce(doc_id::VARCHAR, '-'), md5(body))), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source)
SELECT doc_id, size, s AS source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM draws""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
found AS (
  SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM found GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
phrases AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT p.lang, p.phrase, p.m, p.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * p.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM phrases) p
  JOIN counts x ON x.lang = p.lang AND x.m = k AND x.phrase = array_to_string(p.w[1:k], ' ')
  JOIN counts y ON y.lang = p.lang AND y.m = p.m - k AND y.phrase = array_to_string(p.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT s.lang, array_to_string(s.w[i:i + size - 1], ' ') AS phrase, s.a
  FROM (SELECT *, unnest(range(1, m - size + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS size FROM phrases WHERE m > 2)) s),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inside o WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.a >= 80 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}

__all__ = ["ORACLE", "QUERIES", "ensure_checkpoint_dir"]
