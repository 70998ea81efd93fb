"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor:

1. ``language``: rows whose language is not recognised go, and rows whose text is
   unlike all languages learned: other languages and scripts, codes, mere signs.
2. ``quality``: rows that the weak-label classifier finds bad go.
3. ``near_dedup``: of each group of near-copies (five-word shingles, likeness 0.8)
   the row with the smallest id stays, rows without an id counting last. Rows that
   repeat id and text stay once; rows that share an id only are told apart by text.
4. ``mix``: tokens of domains, languages and sources are brought to their target
   weights; a row is repeated for every epoch in which it is read. Rows are kept
   whole, so a leaf may exceed its budget by less than one document.
5. ``pieces``: texts become piece ids.

All but the last return the columns of their input. NULL and empty texts go in
the first stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.llm import bottom_sketch, language_id, mixing, pieces, reachable, weak_quality
from renewlens.session import staged

# Confidence from which a language counts as recognised; clean texts, even of one
# word, reach 0.39 and more. So do texts in unknown languages: those are told by
# their runs (language_id.recognised).
LEAST_LANGUAGE_SCORE = 0.3
DOMAINS = 4
MIX = mixing.Mix(budget_share=1.0, max_epochs=2, seed=11, default_power=0.75)


def domain() -> Column:
    """Sources are dealt to a fixed number of domains."""
    return F.concat(F.lit("domain"), F.crc32(F.col("source")) % DOMAINS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 != 1, F.lit(True)))
    return language_id.recognised(docs, language_id.fit(learned), LEAST_LANGUAGE_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_quality.accepted(docs, weak_quality.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A key for every different row, in the order of the ids.
    number = F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    ordered = F.coalesce(F.lpad(number.cast("string"), 20, "0"), F.lit("~"))
    mark = F.lpad(F.hex(F.xxhash64("text")), 16, "0")
    keyed = docs.withColumn("__row_key", F.concat_ws("-", ordered, mark))
    found = bottom_sketch.near_copies(
        keyed.select(F.col("__row_key").alias("doc_id"), "text"), bottom_sketch.Settings(width=5)
    )
    chosen = found.where("kept").select(F.col("doc_id").alias("__row_key")).distinct()
    kept = keyed.join(chosen, "__row_key", "semi").dropDuplicates(["__row_key"])
    return kept.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    levels = {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}
    chosen, _ = mixing.select(docs, levels, MIX)
    # Exact repeats of a row are counted once here and repeated by the join again.
    reads = chosen.select(
        F.col("doc_id").alias("__mix_id"), F.col("text_hash").alias("__mix_text"), "epoch"
    ).distinct()
    reads = reads.groupBy("__mix_id", "__mix_text").agg(
        F.count("*").cast("int").alias("__mix_reads")
    )
    # Own names on both sides, whatever the columns of the documents are called.
    marked = docs.withColumn("__mix_mark", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (
        F.col("__mix_mark") == F.col("__mix_text")
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("__mix_reads"))).alias("__mix_read")
    return marked.join(reads, same).select(*docs.columns, copies).drop("__mix_read")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.Vocabulary.load(), ("doc_id", "lang", "source"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pieces", to_pieces),
]

# Hash orders, kernels and transducers are not SQL; tests/llm compares brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reachable(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
