"""Sizes of documents in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER = os.environ.get("LOOMSPAN_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pattern that splits text before the merges of a byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def sizer(path: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts by a vocabulary file: ranks (.tiktoken), sentence pieces (.model) or a tokenizer (.json).

    Strings of special tokens count as ordinary text.
    """
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encode = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: [len(encode(t)) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e.ids) for at in range(0, len(texts), 256) for e in tokenizer.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)]


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = sizer(path)
        for batch in batches:
            names = [c for c in batch.schema.names if c != "text"]
            sizes = pa.array(size([t or "" for t in batch["text"].to_pylist()]), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), sizes], names=[*names, "tokens"])

    return run


def token_counts(documents: DataFrame, keep: tuple[str, ...], path: str = TOKENIZER) -> DataFrame:
    """The columns `keep` and `tokens`; a null or empty text has 0 tokens. `path` must exist on all executors."""
    chosen = documents.select(*keep, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "text")
    return chosen.mapInArrow(_counter(path), schema + ", tokens long")
