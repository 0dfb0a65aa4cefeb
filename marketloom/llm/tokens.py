"""Token counts with a public byte-level vocabulary."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published split pattern of byte-level BPE vocabularies. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def count_tokens(docs: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """keep columns and n_tokens of each row; null and empty texts have 0 tokens.

    The vocabulary is read on the driver's machine and shipped to every executor.
    """
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = rows.drop("_text").schema.add("n_tokens", T.LongType())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = pa.array([len(encoding.encode_ordinary(t)) for t in batch["_text"].to_pylist()], pa.int64())
            kept = [batch[c] for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, n], names=[*keep, "n_tokens"])

    return rows.mapInArrow(count, schema)
