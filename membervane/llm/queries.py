"""One registered query per operator of this folder, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membervane.llm import chunks, digests, language, linealign, mixing, mtree, personal, pieces, prefixtrie, repair, simhash, templates, tokencount
from membervane.llm.common import read
from membervane.session import tune

#: Public vocabularies that the queries use; the operators take any path.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TOKEN_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(tune(spark), sf)

    run.__doc__ = fn.__doc__
    _registry[fn.__name__] = run
    return run


def llm_queries() -> dict[str, Query]:
    return dict(_registry)


@query
def op1_mtree(spark, sf):
    """The 20 highest integer inner products of every twentieth vector."""
    rows = read(spark, sf, "embeddings")
    return mtree.top_k(rows.select("vec_id", mtree.as_integers(F.col("embedding")).alias("vector")), every=20, k=20)


@query
def op2_token_counts(spark, sf):
    """Tokens of every document, counted in flat token streams without an index."""
    return tokencount.count_documents(read(spark, sf, "documents"), TOKEN_RANKS)


@query
def op3_improbable_features(spark, sf):
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's."""
    return digests.compare_with_next(read(spark, sf, "documents"))


@query
def op4_line_alignment(spark, sf):
    """What each document keeps: lines removed, and length and checksum of the text that stays."""
    docs = linealign.dedup_blocks(read(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "lines_removed", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def op5_chunk_dedup(spark, sf):
    """Every span of a document that was seen before, in bytes, and the document that holds it first."""
    return chunks.repeated_spans(read(spark, sf, "documents"))


@query
def op6_simhash(spark, sf):
    found = simhash.near_duplicates(read(spark, sf, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash.as_hex(found.fingerprint).alias("fingerprint"), "component_id")


@query
def op7_sentencepiece(spark, sf):
    """Every text encoded and decoded again."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    done = pieces.encode_and_decode(docs, PIECE_MODEL)
    return done.select(
        "doc_id",
        (F.length("ids") / 2).cast("long").alias("n_tokens"),
        F.md5("ids").alias("ids_md5"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@query
def op8_pareto_mix(spark, sf):
    mixed = mixing.mix(read(spark, sf, "documents"), weights=(5, 2, 1), most=3)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op9_language(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_templates(spark, sf):
    pages = templates.extract(read(spark, sf, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op13_prefix_trie(spark, sf):
    """The trie of all conversations, each begun with the first turns of its group's first one."""
    turns = prefixtrie.turns_of(read(spark, sf, "conversations"))
    return prefixtrie.trie(*prefixtrie.share_heads(turns, every=20, most=4))


@query
def op11_structure_repair(spark, sf):
    """Damaged conversations: their faults, the cheapest edits and a hash of what these give."""
    rows = read(spark, sf, "conversations")
    return repair.audit(repair.damage(rows), rows.select("conv_id"))


@query
def op12_anchor_expansion(spark, sf):
    """Personal data in every text: numbers of the base kinds, a hash of their spans, and all spans."""
    found = personal.find_spans(read(spark, sf, "documents").select("doc_id", "text")).drop("text")
    base = personal.as_text(F.col("spans"), personal.BASE)
    return found.select(
        "doc_id",
        *[personal.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in personal.BASE],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        personal.as_text(F.col("spans")).alias("spans"),
    )
