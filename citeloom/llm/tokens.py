"""Text sizes in tokens of a public tokenizer.

The vocabulary file is a parameter, read by each Python worker once; it is not part of this repository. Whole texts
are counted; a null text has no tokens.
"""

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published pre-tokenization pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str, keep: list[str], path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` of ``df`` and ``n_tokens``, the size of the column ``text``."""
    kinds = dict(df.dtypes)
    out = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes, pa.int64())], names=[*keep, "n_tokens"])

    return df.select(*keep, df[text].alias("__text")).mapInArrow(run, out)
