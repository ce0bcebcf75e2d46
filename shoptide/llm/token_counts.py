"""Token counts: sentencepiece encodes byte-balanced Arrow batches and only lengths come back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A text is cut only inside "letter, one space, letter" of ASCII. No piece of the models holds a space mark after
# another character (checked when a model is loaded), so no piece can reach over such a space, and the space
# itself comes back as the mark that the model puts before every text.
CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")

_models: dict[str, object] = {}


def model(path: str):
    """The model of a file, loaded once per Python worker."""
    if path not in _models:
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any("▁" in loaded.id_to_piece(i).lstrip("▁") for i in range(loaded.vocab_size()))
        _models[path] = (loaded, not inner)
    return _models[path]


def split_text(text: str, most: int) -> list[str]:
    """The text in parts of about ``most`` characters whose token counts add up to the whole text's."""
    parts, start = [], 0
    while len(text) - start > most:
        cut = CUT.search(text, start + most)
        if cut is None:
            break
        parts.append(text[start : cut.start()])
        start = cut.end()
    return [*parts, text[start:]]


def count_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
                 batch_bytes: int = 1 << 20, part_chars: int = 1 << 16) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, whole texts, no begin or end tokens.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows each give a row; an empty table gives an
    empty table; other columns of ``docs`` are not read. Texts over ``part_chars`` are cut at safe boundaries;
    the parts are encoded in batches of about ``batch_bytes``, so that memory does not follow the text length
    beyond one text.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, safe = model(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            counts = [0] * batch.num_rows
            owners: list[int] = []
            parts: list[str] = []
            size = 0

            def flush(counts=counts, owners=owners, parts=parts):
                for owner, found in zip(owners, tokens.encode(parts, num_threads=1), strict=True):
                    counts[owner] += len(found)
                owners.clear()
                parts.clear()

            for i, value in enumerate(texts):
                text = value.as_py()
                for part in split_text(text, part_chars) if safe and len(text) > part_chars else (text,):
                    owners.append(i)
                    parts.append(part)
                    size += len(part) if part.isascii() else len(part.encode())
                    if size >= batch_bytes:
                        flush()
                        size = 0
            flush()
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(counts, pa.int64())], ["_id", "n_bytes", "n_tokens"])

    id_type = rows.schema["_id"].dataType.simpleString()
    counted = rows.mapInArrow(lengths, f"_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
