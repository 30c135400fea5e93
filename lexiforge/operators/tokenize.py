"""Token ids, masks and labels of chat texts, and their statistics."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from .export import _qa, chat_text, prompt_text


class ByteTokenizer:
    """UTF-8 bytes as ids from 3 on; 0 pads and 1 begins a text. Stands in where no model's tokenizer is given."""

    pad_id = 0

    def encode(self, text: str, special: bool) -> list[int]:
        return [1] * special + [b + 3 for b in text.encode()]


class FileTokenizer:
    """A tokenizer file by its ending: .json (tokenizers), .model (sentencepiece) or .tiktoken ranks; opened where it is used.

    pattern: how .tiktoken texts are cut into pieces. begin and pad: ids that the file does not name itself.
    """

    def __init__(self, path: str, begin: int | None = None, pad: int = 0, pattern: str | None = None):
        self.path, self.begin, self.pad_id, self.pattern, self._encode = path, begin, pad, pattern, None

    def __getstate__(self):
        return self.__dict__ | {"_encode": None}

    def _opened(self):
        if self.path.endswith(".json"):
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(self.path)
            return lambda text: library.encode(text, add_special_tokens=False).ids
        if self.path.endswith(".model"):
            import sentencepiece

            return sentencepiece.SentencePieceProcessor(model_file=self.path).encode
        if self.path.endswith(".tiktoken"):
            import base64

            import tiktoken

            if not self.pattern:
                raise ValueError("a .tiktoken file needs the pattern of its pieces")
            with open(self.path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        raise ValueError(f"unknown kind of tokenizer file: {self.path}")

    def encode(self, text: str, special: bool) -> list[int]:
        if self._encode is None:
            self._encode = self._opened()
        return [self.begin] * (special and self.begin is not None) + list(self._encode(text))


def tokenized(df: DataFrame, tokenizer=None, template: str = "vistral", system: str = X.PROMPT_TOKENS, max_length: int = 2048, pad: bool = True, mask_prompt: bool = True) -> DataFrame:
    """input_ids, attention_mask, labels, source_doc, chunk_id; pairs without question or answer are skipped.

    The prompt's tokens (counted without special tokens) and padding are labelled -100. Only encoding runs in Python;
    padding and labels are expressions.
    """
    import pyarrow as pa

    tok = tokenizer or ByteTokenizer()
    q, a = _qa(df)
    rows = df.filter((F.length(q) > 0) & (F.length(a) > 0))
    q, a = _qa(rows)
    source = F.coalesce(F.col("source_doc"), F.lit("")) if "source_doc" in df.columns else F.lit("")
    chunk = F.coalesce(F.col("chunk_id").cast("int"), F.lit(-1)) if "chunk_id" in df.columns else F.lit(-1)
    texts = rows.select(chat_text(q, a, template, system).alias("full"), prompt_text(q, template, system).alias("prompt"), source.alias("source_doc"), chunk.alias("chunk_id"))

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            ids = [tok.encode(x.as_py(), True)[:max_length] for x in b.column(0)]
            n = [len(tok.encode(x.as_py(), False)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(n, pa.int32()), b.column(2), b.column(3)], names=["ids", "prompt_length", "source_doc", "chunk_id"])

    got = texts.mapInArrow(run, "ids array<int>, prompt_length int, source_doc string, chunk_id int")
    missing = F.greatest(F.lit(0), F.lit(max_length) - F.size("ids")) if pad else F.lit(0)
    got = got.withColumn("_pad", missing)
    skip = F.col("prompt_length") if mask_prompt else F.lit(0)
    labels = F.transform("ids", lambda x, i: F.when(i < skip, F.lit(X.LABEL_IGNORED)).otherwise(x))
    return got.select(
        F.concat("ids", F.array_repeat(F.lit(tok.pad_id), F.col("_pad"))).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), F.col("_pad"))).alias("attention_mask"),
        F.concat(labels, F.array_repeat(F.lit(X.LABEL_IGNORED), F.col("_pad"))).alias("labels"),
        "source_doc",
        "chunk_id",
    )


def token_stats(tokens: DataFrame, max_length: int = 2048) -> DataFrame:
    n = F.size("input_ids")
    masked = F.size(F.filter("labels", lambda x: x == X.LABEL_IGNORED))
    out = tokens.agg(
        F.count("*").alias("total_samples"),
        F.sum(n).alias("total_tokens"),
        F.sum(masked).alias("masked_tokens"),
        F.avg(n).alias("avg_length"),
        F.max(n).alias("max_length"),
        F.min(n).alias("min_length"),
        F.count_if(n >= max_length).alias("truncated"),
    )
    return out.withColumn("trainable_tokens", F.col("total_tokens") - F.col("masked_tokens"))
