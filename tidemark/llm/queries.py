"""One thin query per operator over its whole table: ``REGISTRY``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules that the query of operator 8 applies: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: The conversation that the query of operator 9 adds.
EXTRA_TURNS = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


@_query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every url of ``pages`` by four host and path rules, through Bloom filter cascades."""
    from tidemark.llm.url_filter import filter_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(_table(spark, sf_dir, "pages"), rules)


@_query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all ``conversations`` (and conversation -7) in windows; digests read back from the output."""
    from tidemark.llm.chat_format import format_conversations, read_back
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.unionByName(extra)))


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every text of ``documents`` by positive-unlabelled learning from two folds of ``labels``."""
    from tidemark.llm.toxicity import fit_toxicity, held_out, learnable_label, score_toxicity
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"), learnable_label())
    out = score_toxicity(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@_query
def op10_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``, learned from four folds of five."""
    from tidemark.llm.lang_id import fit_language_model, held_out, identify_language
    docs = _table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~held_out("doc_id", 5, 0)))
    out = identify_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


#: Model file of the query of operator 4.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@_query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text of ``documents`` by the transducer and decode it again."""
    from tidemark.llm.piece_codec import encode_pieces
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, PIECE_MODEL).select("doc_id", "n_pieces", "decodes", "ids")


@_query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents``: 5-word shingles, similarity 0.75 and more."""
    from tidemark.llm.near_dedup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark``, with the item and the score of the overlap."""
    from tidemark.llm.decontaminate import find_contamination
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of ``embeddings`` at a cosine of 0.98 and more."""
    from tidemark.llm.vector_dedup import link_vectors
    return link_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without lines that repeat an earlier one, exactly or nearly; the kept text by its digest."""
    from pyspark.sql import functions as F

    from tidemark.llm.line_dedup import dedup_lines
    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").alias("kept_chars"),
                      F.sha2("text", 256).alias("kept_sha256"))


@_query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Take 100-byte strings that also start earlier out of every text of ``documents``."""
    from tidemark.llm.suffix_dedup import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents"), with_bytes=False)


#: Tokenizer file of the queries of operators 12 and 13, and the id that ends a document.
BYTE_TOKENIZER, END_ID = "/opt/tokenizers/byte_bpe_50k.json", 2


@_query
def op12_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text of ``documents`` into token files of planes and read the files back."""
    from pyspark.sql import functions as F

    from tidemark.llm.plane_files import read_tokens, write_tokens
    from tidemark.session import scratch_dir
    folder = scratch_dir(spark, "llm-token-planes")
    write_tokens(_table(spark, sf_dir, "documents"), folder, BYTE_TOKENIZER, END_ID)
    return read_tokens(spark, folder).select(F.col("key").alias("doc_id"), "start", "n_tokens",
                                             F.crc32("ids").alias("ids_crc32"))


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align two tokenizers over every text of ``documents`` and weigh the links by the corpus' counts."""
    from tidemark.llm.token_align import align_tokens
    return align_tokens(_table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL, with_groups=False)


@_query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best ``documents`` for every ``benchmark`` item, by K2-treaps over all documents."""
    from tidemark.llm.ranked_search import build_index, search
    return search(build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))
