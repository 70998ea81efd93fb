"""Named queries of the operators, over whole tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.llm import (
    bottom_sketch,
    conversation_repair,
    duckdb_checks,
    host_reputation,
    language_id,
    merkle_manifest,
    mixing,
    multi_index,
    order_minhash,
    pieces,
    pitman_yor,
    reachable,
    tool_calls,
    toxic_spans,
    weak_quality,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _remainder(column: str, modulus: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % modulus


def _domain() -> Column:
    """Sources are dealt to four domains, the upper level of the mixing tree."""
    return F.concat(F.lit("domain"), F.crc32(F.col("source")) % 4)


MIX = mixing.Mix(
    budget_share=1.0,
    max_epochs=4,
    seed=7,
    weights={
        ("domain0",): 3.0,
        ("domain1",): 2.0,
        ("domain0", "de"): 2.0,
        ("domain1", "fr"): 0.5,
        ("domain0", "en", "src0"): 0.25,
    },
    default_power=0.0,
)


def op1_hierarchical_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What is read of every document, by epoch, under the budgets of its branch."""
    levels = {"domain": _domain(), "lang": F.col("lang"), "source": F.col("source")}
    chosen, _ = mixing.select(_table(spark, folder, "documents"), levels, MIX)
    return chosen.select("doc_id", "domain", "lang", "source", "epoch", "tokens", "take_tokens")


POLICY = host_reputation.Policy(
    rules=(
        ("net/", "block"),
        ("example.net/en/", "allow"),
        ("example.com/de/", "block"),
        ("org/fr/", "allow"),
    )
)


def op2_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by rule or host; outcomes are the labels under the page's number."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    labels = _table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), good.cast("int").alias("good")
    )
    return host_reputation.judge(_table(spark, folder, "pages"), labels, POLICY)


TOOLS = {
    "answer": {
        "prompt": tool_calls.Argument("string", least=1),
        "turn": tool_calls.Argument("integer", least=0),
    }
}


def op3_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    """User turns as calls of a tool, assistant turns as their results.

    A call uses the result that stands on the turn before it, if there is one. Turns of
    other roles are carried through.
    """
    turns = _table(spark, folder, "conversations")

    def call_id(turn: Column) -> Column:
        return F.concat_ws("-", F.col("conv_id"), turn)

    calls = turns.where("role = 'user'").select(
        "conv_id",
        "turn",
        call_id(F.col("turn")).alias("call_id"),
        F.lit("answer").alias("tool"),
        F.to_json(F.struct("turn", F.col("text").alias("prompt"))).alias("arguments"),
        F.array(call_id(F.col("turn") - 2)).alias("uses"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    of_neither = ~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))
    others = turns.where(of_neither).select(
        "conv_id", "turn", "role", F.col("text").alias("content")
    )
    return tool_calls.link(calls, results, TOOLS, others)


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited form."""
    return order_minhash.edit_check(_table(spark, folder, "documents"))


def op5_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score; learned where the remainder of its id by 5 is not 1."""
    held_out = F.coalesce(_remainder("doc_id", 5) == 1, F.lit(False))
    found = pitman_yor.scores(_table(spark, folder, "documents"), held_out)
    rest = [c for c in found.columns if c != "doc_id"]
    return found.select("doc_id", held_out.alias("held_out"), *rest)


def op6_sentencepiece_transducer(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every whole text."""
    return pieces.encode(_table(spark, folder, "documents"), pieces.Vocabulary.load())


def op7_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return multi_index.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, judged by the scorer trained on weak labels of the table."""
    docs = _table(spark, folder, "documents")
    return weak_quality.score(docs, weak_quality.fit(docs))


def op9_bottom_sketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share four-word shingles, likeness 0.8."""
    docs = _table(spark, folder, "documents")
    return bottom_sketch.near_copies(docs, bottom_sketch.Settings(width=4, percent=80))


def op10_string_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language; learned where the remainder of its id by 3 is not 1."""
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_four_russians_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged by a checksum and repaired at the least cost."""
    turns = _table(spark, folder, "conversations")
    spoilt = conversation_repair.damaged(turns, "conv_id", "turn", "role", "text")
    found = conversation_repair.repair(spoilt)
    return conversation_repair.all_conversations(found.conversations, turns)


def op12_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity; learned where the remainder of its id by 5 is not 0."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    model = toxic_spans.fit(docs, labels.where(~held_out))
    found = toxic_spans.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op13_octopus_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof, checked after tampering with some rows."""
    tampered = _remainder("doc_id", 7) == 0
    found = merkle_manifest.manifest(
        _table(spark, folder, "documents"),
        changed={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))},
    )
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_hierarchical_mixing,
            op2_host_reputation,
            op3_tool_call_linking,
            op4_order_minhash,
            op5_pitman_yor,
            op6_sentencepiece_transducer,
            op7_inverted_multi_index,
            op8_weak_label_quality,
            op9_bottom_sketch_dedup,
            op10_string_kernel_language,
            op11_four_russians_repair,
            op12_toxic_spans,
            op13_octopus_manifest,
        )
    }


def oracle_sql() -> dict[str, str]:
    return duckdb_checks.oracle_sql()
