"""Encoding of a corpus with a public byte-level tokenizer, and the way back.

The scan is map-only: text flows through Arrow batches into the ``tokenizers`` library, one tokenizer per
Python worker. A byte-level vocabulary spells each byte as one printable character; ``byte_alphabet`` is
that mapping, from which byte offsets follow and by which decoding is reversed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
#: Texts of about so many characters go to the library at once; this bounds a worker's memory and drops nothing.
CHARS_PER_CALL = 400_000


def tokenizer_path(name: str = BYTE_BPE, folder: str | None = None) -> str:
    """Path of a vocabulary file; the folder is a parameter, or SCREENLOOM_TOKENIZERS, or the default."""
    return os.path.join(folder or os.environ.get("SCREENLOOM_TOKENIZERS", DEFAULT_TOKENIZER_DIR), name)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """Printable character -> byte, by the rule of byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others get the code points from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _token_bytes(path: str) -> dict[int, bytes]:
    table, vocab = byte_alphabet(), _tokenizer(path).get_vocab(with_added_tokens=False)
    return {i: bytes(table[c] for c in token) for token, i in vocab.items()}


def _calls(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded length together, with the position of the first."""
    at, run, size = 0, [], 0
    for k, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= CHARS_PER_CALL:
            yield at, run
            at, run, size = k + 1, [], 0
    if run:
        yield at, run


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id_col`` and ``ids array<int>`` of every row, without special tokens, the text taken as it stands.

    A null or empty text gives an empty list. Rows are neither merged nor dropped (repeated rows repeat),
    other columns of the input don't matter, and an empty table gives an empty result.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for at, part in _calls(texts):
                ids = [e.ids for e in tok.encode_batch_fast(part, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(part)), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def encode_with_offsets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """As ``encode``, with ``char_start``, ``char_end`` (characters) and ``byte_start`` (UTF-8 bytes) per token.

    A character that is split over several tokens gives each of them that whole character as its span;
    byte starts are exact for every token.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, sizes = _tokenizer(path), {i: len(b) for i, b in _token_bytes(path).items()}
        ints = pa.list_(pa.int32())
        for batch in batches:
            keys = batch.column(0)
            for at, part in _calls(batch.column(1).to_pylist()):
                found = tok.encode_batch(part, add_special_tokens=False)
                ids = [e.ids for e in found]
                starts = []
                for row in ids:
                    pos, own = 0, []
                    for i in row:
                        own.append(pos)
                        pos += sizes[i]
                    starts.append(own)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(part)), pa.array(ids, ints), pa.array([[a for a, _ in e.offsets] for e in found], ints), pa.array([[b for _, b in e.offsets] for e in found], ints), pa.array(starts, ints)],
                    names=[id_col, "ids", "char_start", "char_end", "byte_start"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, char_start array<int>, char_end array<int>, byte_start array<int>")


def decode_ids(ids: list[int] | None, path: str | None = None) -> str:
    """Text of a list of ids. Bytes are joined before UTF-8 is read, so characters split over tokens come
    back whole; bytes that are no UTF-8 (a list cut inside a character) become U+FFFD. Null gives ''."""
    table = _token_bytes(path or tokenizer_path())
    return b"".join(table[i] for i in ids or []).decode("utf-8", errors="replace")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``id_col`` and ``text`` of every row; an empty or null list gives ''."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(x, path) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


def roundtrip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: number of tokens, UTF-8 bytes and characters, and whether decoding gives the text back."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for batch in batches:
            keys = batch.column(0)
            for at, part in _calls(batch.column(1).to_pylist()):
                ids = [e.ids for e in tok.encode_batch_fast(part, add_special_tokens=False)]
                same = [decode_ids(i, path) == t for i, t in zip(ids, part, strict=True)]
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(part)), pa.array([len(i) for i in ids], pa.int64()), pa.array(same, pa.bool_())], names=[id_col, "n_tokens", "same"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, same boolean")
