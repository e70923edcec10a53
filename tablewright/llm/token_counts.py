"""Token counts: one exact histogram of encoded lengths answers totals, quantiles and truncated totals."""

from __future__ import annotations

import base64
import functools

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cut, pieces

# fixed value: the pattern that splits text before the merges of the rank files
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1024  # lengths in a block of the histogram


@functools.lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def with_token_counts(docs: DataFrame, ranks_file: str, pattern: str = PATTERN, threads: int = 2) -> DataFrame:
    """doc_id and n_tokens of every row: the length of the whole text under a byte-level vocabulary.

    Null and empty texts have 0 tokens; strings of special tokens are ordinary text.
    """
    with open(ranks_file, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def count(batches):
        encoding = _encoding(ranks.value, pattern)
        for batch in pieces(batches, "text", 2 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes = [len(x) for x in encoding.encode_ordinary_batch(texts, num_threads=threads)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def length_histogram(counted: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with sums over all lengths up to it and beyond it.

    n_tokens (a length, as context limit), n_docs (of that length), docs_upto, docs_longer, tokens_upto,
    tokens_longer, truncated_total (tokens kept if every document is cut to this limit), share_upto (documents that
    fit). Between two lengths all of these are constant or linear, so that the rows answer every limit. No documents:
    no rows. Sums run within blocks of lengths, and over the totals of the blocks.
    """
    length = F.col(length).cast("long")
    counts = cut(counted.groupBy(length.alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    block = F.floor(F.col("n_tokens") / BLOCK)
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = counts.groupBy(block.alias("block")).agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block", F.coalesce(F.sum("docs").over(before), zero).alias("docs_before"),
        F.coalesce(F.sum("tokens").over(before), zero).alias("tokens_before"),
        F.sum("docs").over(whole).alias("all_docs"), F.sum("tokens").over(whole).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select("*", block.alias("block")).join(blocks, "block").select(
        "n_tokens", "n_docs", "all_docs", "all_tokens",
        (F.col("docs_before") + F.sum("n_docs").over(inside)).alias("docs_upto"),
        (F.col("tokens_before") + F.sum(tokens).over(inside)).alias("tokens_upto"))
    longer = F.col("all_docs") - F.col("docs_upto")
    return sums.select(
        "n_tokens", "n_docs", "docs_upto", longer.alias("docs_longer"), "tokens_upto",
        (F.col("all_tokens") - F.col("tokens_upto")).alias("tokens_longer"),
        (F.col("tokens_upto") + F.col("n_tokens") * longer).alias("truncated_total"),
        (F.col("docs_upto") / F.col("all_docs")).alias("share_upto"))


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """n_tokens: the smallest length that at least this share of the documents does not exceed."""
    return histogram.filter(F.col("share_upto") >= share - 1e-12).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """total: tokens that remain if every document is cut to `limit` tokens, whether or not a document has that length."""
    return histogram.agg(
        F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("total"))
