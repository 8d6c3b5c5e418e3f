"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.functions.lineage import spread

#: Folder of the vocabulary files, present on every worker; the file; the pattern that cuts text before merging.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    import tiktoken

    with open(f"{folder}/{vocabulary}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("parallax", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "n_tokens", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns of `keep` and the number of tokens of the whole text; 0 for a null or empty one."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    schema = rows.drop("_text").withColumn(out, F.lit(0)).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(folder, vocabulary).encode_ordinary
        for batch in batches:
            sizes = [len(encode(x)) for x in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, out])

    return spread(rows).mapInArrow(measure, schema)
