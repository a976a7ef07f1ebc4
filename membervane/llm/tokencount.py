"""Token counts of documents in flat, unindexed token files.

A stream is a run of fixed-width token ids in which only an end-of-document id tells where a document ends. It is read in blocks
that know nothing of documents. Each block finds its separators with one vectorised comparison; prefix
scans over one row per block (tokens so far, place of the last separator so far) stitch together what the block
boundaries cut. Streams are independent of one another.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from membervane.llm.common import staged

#: Tokens of a block.
BLOCK = 1 << 19
#: How texts are cut before merging (the pattern published with the vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def flat_blocks(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """``stream, block, tokens`` of flat files of little-endian ids of ``width`` bytes; a stream is a file.

    Spark reads a file as one value, so a file may have 2 GB at most; longer streams are given as blocks.
    """
    size = width * block

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                for k, at in enumerate(range(0, len(content), size)):
                    yield pd.DataFrame({"stream": [name], "block": [k], "tokens": [content[at : at + size]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "stream string, block long, tokens binary")


def count_tokens(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """``stream, ordinal, start, n_tokens`` of every document: place in its stream, first token, tokens without the separator.

    ``blocks`` has ``stream, block, tokens`` (any order; null tokens are none). Two separators in a row enclose an empty document of 0 tokens. Tokens after the last
    separator of a stream are one more document. A block that ends inside an id is an error. Equal (stream, block) rows must not
    occur. Empty tables give empty results; other columns are not read.
    """
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ends, n = [], []
            for tokens in batch.pop("tokens"):
                ids = np.frombuffer(tokens or b"", kind)
                ends.append(np.flatnonzero(ids == separator))
                n.append(len(ids))
            batch["n"], batch["ends"] = n, ends
            yield batch

    found = blocks.select("stream", "block", "tokens")
    kinds = {c: t for c, t in found.dtypes}
    schema = f"stream {kinds['stream']}, block {kinds['block']}, n long, ends array<long>"
    found = staged(found.mapInPandas(run, schema), "separators")
    earlier = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("stream", "block", "n", F.size("ends").alias("k"), F.get("ends", F.size("ends") - 1).alias("last"))
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    sums = sums.withColumns(
        {
            "before": F.coalesce(F.max(F.when(F.col("k") > 0, F.col("base") + F.col("last"))).over(earlier), F.lit(-1)),
            "done": F.coalesce(F.sum("k").over(earlier), F.lit(0)),
        }
    )
    sums = staged(sums, "prefix-scan")
    ends = found.select("stream", "block", "ends").join(sums.drop("n", "k", "last"), ["stream", "block"])
    whole = ends.select("stream", "base", "before", "done", "ends", F.posexplode("ends").alias("at", "end"))
    start = F.when(F.col("at") == 0, F.col("before")).otherwise(F.col("base") + F.get("ends", F.col("at") - 1)) + 1
    whole = whole.select("stream", (F.col("done") + F.col("at")).alias("ordinal"), start.alias("start"), (F.col("base") + F.col("end") - start).alias("n_tokens"))
    last = F.coalesce(F.max(F.when(F.col("k") > 0, F.col("base") + F.col("last"))), F.lit(-1))
    rest = sums.groupBy("stream").agg(F.sum("k").alias("ordinal"), (last + 1).alias("start"), (F.sum("n") - last - 1).alias("n_tokens"))
    return whole.unionByName(rest.where("n_tokens > 0"))


_encodings: dict[int, tiktoken.Encoding] = {}


def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The byte-level tokenizer of a rank file, built once per process."""
    key = hash(ranks)
    if key not in _encodings:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encodings[key] = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encodings[key]


def token_streams(docs: DataFrame, rank_file: str, block: int = BLOCK) -> DataFrame:
    """``stream, block, tokens, ends_here``: the tokens of ``doc_id, text`` rows, one flat stream per task.

    Each document is followed by a separator, the first id after those of the rank file. ``ends_here`` lists the ids of the documents that
    end in a block, for giving names to the documents afterwards; counting doesn't look at it. Null texts are empty documents.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoding(ranks.value)
        separator = coder.max_token_value + 1
        kind = np.dtype("<u2") if separator < 1 << 16 else np.dtype("<u4")
        held: list[np.ndarray] = []
        size, number, names = 0, 0, []

        def row(tokens: np.ndarray, ids: list) -> pd.DataFrame:
            return pd.DataFrame({"stream": [stream], "block": [number], "tokens": [tokens.tobytes()], "ends_here": [ids]})

        for batch in batches:
            for doc_id, text, stream in zip(batch["doc_id"].astype(object), batch["text"], batch["_task"]):
                held.append(np.array([*coder.encode_ordinary(text or ""), separator], kind))
                size += len(held[-1])
                names.append((None if pd.isna(doc_id) else int(doc_id), size - 1))
                while size >= block:
                    flat = np.concatenate(held)
                    yield row(flat[:block], [i for i, end in names if end < block])
                    names = [(i, end - block) for i, end in names if end >= block]
                    held, size, number = [flat[block:]], size - block, number + 1
        if size:
            yield row(np.concatenate(held), [i for i, _ in names])

    rows = docs.select("doc_id", "text", F.spark_partition_id().alias("_task"))
    return rows.mapInPandas(run, "stream int, block long, tokens binary, ends_here array<long>")


def count_documents(docs: DataFrame, rank_file: str, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_tokens`` of every row of ``doc_id, text``, counted in the flat streams of all texts.

    Null and empty texts have 0 tokens; repeated rows are counted each; a row without ``doc_id`` has a null one.
    """
    separator = encoding(Path(rank_file).read_bytes()).max_token_value + 1
    streams = staged(token_streams(docs, rank_file, block), "token-streams")
    counts = count_tokens(streams, separator, 2 if separator < 1 << 16 else 4)
    done = F.sum(F.size("ends_here")).over(Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    named = streams.select("stream", "block", "ends_here").withColumn("_done", F.coalesce(done, F.lit(0)))
    named = named.select("stream", "_done", F.posexplode("ends_here").alias("_at", "doc_id"))
    named = named.select("stream", (F.col("_done") + F.col("_at")).alias("ordinal"), "doc_id")
    return named.join(counts, ["stream", "ordinal"]).select("doc_id", "n_tokens")
