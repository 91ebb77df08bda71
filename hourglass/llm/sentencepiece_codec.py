"""Operator 3: SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is read field by field (no generated classes), and the library's parts are set up
to do what the model says: the normaliser (its precompiled character map, the dummy prefix, white-space
folding), the marker for blanks, the unigram scores or the merges that the scores of a BPE model
imply, and byte fallback.  Batches of whole texts are encoded and decoded multithreaded.

The 32,000-piece model in use is BPE with byte fallback; unigram models are built the same way.
Texts are encoded where they lie: no shuffle, and a task holds one batch.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import map_texts, utf8

MARK = "▁"
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Characters encoded at a time.
BATCH_CHARS = 1 << 18
#: Threads of a task's encoder.
THREADS = 2
#: One text in so many (by the hash of the text) is also encoded by the reference encoder and decoded by the library.
PARITY = 64


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    def unknown_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(field number, value)`` of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) if kind != 2 else varint()
        if size is None:
            raise ValueError(f"wire type {kind} is not used by this format")
        yield tag >> 3, data[at:at + size]
        at += size


def parse_model(data: bytes) -> Model:
    """Pieces (field 1), trainer settings (2) and normaliser settings (3) of a model file."""
    m = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            m.pieces.append((piece.get(1, b"").decode("utf-8"), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0],
                             piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            m.model_type, m.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif number == 3:
            norm = dict(_fields(value))
            m.charsmap = norm.get(2, b"")
            m.add_dummy_prefix, m.remove_extra_whitespaces = bool(norm.get(3, 1)), bool(norm.get(4, 1))
            m.escape_whitespaces = bool(norm.get(5, 1))
    if m.model_type not in (UNIGRAM, BPE):
        raise ValueError(f"model type {m.model_type} is neither unigram nor BPE")
    return m


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, best scores first: the merges of a BPE model."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    order = sorted((i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL and len(p) > 1),
                   key=lambda i: (-pieces[i][1], i))
    out = []
    for i in order:
        p = pieces[i][0]
        splits = [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        out += sorted(splits, key=lambda s: (ids[s[0]], ids[s[1]]))
    return out


def word_bound(pieces: list[tuple[str, float, int]]) -> bool:
    """Whether no piece has a marker after another character, so that words can be encoded one by one."""
    return not any(kind in (NORMAL, USER_DEFINED) and MARK in p.lstrip(MARK) for p, _, kind in pieces)


def build_tokenizer(m: Model):
    """The library's tokenizer with the behaviour that the model states."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = m.unknown_id()
    if m.model_type == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unknown, m.byte_fallback)
    else:
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges_of(m.pieces),
                           unk_token=m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback)
    t = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.add_dummy_prefix:
        steps.append(normalizers.Prepend(" " if not m.escape_whitespaces else MARK))
    if m.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        t.normalizer = normalizers.Sequence(steps)
    out = [decoders.Replace(MARK, " ")] if m.escape_whitespaces else []
    if m.byte_fallback:
        out.append(decoders.ByteFallback())
    out.append(decoders.Fuse())
    if m.add_dummy_prefix:
        out.append(decoders.Strip(" ", 1, 0))
    t.decoder = decoders.Sequence(out)
    return t


class Encoder:
    """Encodes batches of whole texts with the library's tokenizer, multithreaded.

    Where a model turns blanks into markers and no piece reaches over a word's end, the tokenizer cuts
    at the markers first (a run of markers goes with the word after it, since pieces of several
    markers exist); the ids are the same, and long texts take time in proportion to their length.
    """

    def __init__(self, m: Model):
        from tokenizers import Regex, pre_tokenizers

        self.tokenizer = build_tokenizer(m)
        if m.escape_whitespaces and word_bound(m.pieces):
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        # what every id stands for, as bytes
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else (p.replace(MARK, " ") if m.escape_whitespaces else p).encode()
                      for p, _, kind in m.pieces]
        self.prefix = m.add_dummy_prefix

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def text(self, ids: np.ndarray) -> str:
        """What the ids decode to, joined from their bytes (bytes that are no UTF-8 are replaced)."""
        s = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return s[1:] if self.prefix and s[:1] == " " else s


def normalised(tokenizer, text: str) -> str:
    """What a round trip gives back: the text after the model's normaliser."""
    s = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
    return s.replace(MARK, " ")[1:] if s[:1] == MARK else s.replace(MARK, " ")


def model_bytes(spark: SparkSession, path: str = MODEL_FILE) -> bytes:
    """The model file's content (half a megabyte), read on the driver."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", parity: int = PARITY) -> DataFrame:
    """All columns of ``docs`` and ``ids``, ``n_tokens`` and ``round_trip`` (replacing columns so named).

    ``round_trip`` says whether decoding the ids gives the normalised text back; every text is decoded.
    A null text has null ids, no tokens and a true round trip; an empty text has no ids.  Of every
    ``parity`` texts one, chosen by the crc32 of the text, is also encoded by the sentencepiece library and
    decoded by the tokenizers library; a difference stops the job (0: no text).  Repeated rows are encoded each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        import sentencepiece

        parsed = parse_model(shared.value)
        encoder = Encoder(parsed)
        other = sentencepiece.SentencePieceProcessor(model_proto=shared.value) if parity else None
        plain = not parsed.charsmap and not parsed.remove_extra_whitespaces

        def run(texts: list) -> tuple[None, dict[str, list]]:
            full = [t or "" for t in texts]
            ids = encoder.encode(full)
            ok = [encoder.text(i) == (t if plain and MARK not in t else normalised(encoder.tokenizer, t))
                  for i, t in zip(ids, full, strict=True)]
            if other is not None:
                for t, i in zip(full, ids, strict=True):
                    if zlib.crc32(t.encode()) % parity == 0:
                        if other.encode(t) != i.tolist():
                            raise ValueError(f"ids differ from the reference encoder's for a text of {len(t)} characters")
                        if encoder.tokenizer.decode(i.tolist(), skip_special_tokens=False) != encoder.text(i):
                            raise ValueError(f"the library decodes a text of {len(t)} characters differently")
            return None, {"ids": [None if t is None else i for t, i in zip(texts, ids, strict=True)],
                          "n_tokens": [len(i) for i in ids], "round_trip": ok}

        return run

    return map_texts(docs, text, start, {"ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
                                         "n_tokens": (T.LongType(), pa.int64()), "round_trip": (T.BooleanType(), pa.bool_())},
                     slice_bytes=BATCH_CHARS)


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of ``ids`` (null for null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def start():
        tokenizer = build_tokenizer(parse_model(shared.value))

        def run(rows: list) -> tuple[None, dict[str, list]]:
            text = tokenizer.decode_batch([r or [] for r in rows], skip_special_tokens=False)
            return None, {name: [None if r is None else t for r, t in zip(rows, text, strict=True)]}

        return run

    return map_texts(encoded, ids, start, {name: (T.StringType(), pa.string())})


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, model_bytes(spark)).select(
        "doc_id", F.octet_length(utf8(F.col("text"))).cast("long").alias("n_bytes"), "n_tokens", "ids", "round_trip")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: token ids of every document.

    A null text has null ids and no tokens, an empty one no ids; repeated rows are encoded each; columns
    of the input named like new ones are replaced; an empty table gives an empty result.
    """
    return encode(docs, model_bytes(spark)).select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")
