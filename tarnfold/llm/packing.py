"""Hierarchical packing of documents into sequences of several context sizes."""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import first_row_key, in_small_batches

TIERS = (1024, 512, 256, 128)
#: Fixed value: how a byte-level vocabulary of this kind cuts texts before it merges bytes.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with a run of so many characters without a cut go to the library whose time does not grow with its square.
LONG_RUN = 20_000


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others in turn from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, those of the tokenizer file at `path`.

    If the file's merges come in the order of their ids, merging by id gives the same ids as the
    file's own library and is done by one that is faster at it; else, and for texts with a run
    of LONG_RUN, by that library.
    """

    def __init__(self, path: str):
        self.path, self.slow = path, None
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        vocabulary, letters = file["model"]["vocab"], _byte_letters()
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in file["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        plain = file["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not file["normalizer"]
        self.fast = None
        if plain and all(x < y for x, y in zip(merged, merged[1:])) and len(merged) + 256 == len(vocabulary):
            import tiktoken

            ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
            self.fast = tiktoken.Encoding("of the file", pat_str=CUTS, mergeable_ranks=ranks, special_tokens=self.special)

    def __call__(self, text: str) -> bytes:
        if self.fast is None or (len(text) >= LONG_RUN and self._long_run(text)):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            ids = self.slow.encode(text, add_special_tokens=False).ids
        elif any(x in text for x in self.special):
            ids = self.fast.encode(text, allowed_special="all")
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    @staticmethod
    def _long_run(text: str) -> bool:
        return max(map(len, text.split()), default=0) >= LONG_RUN or re.search(rf"\s{{{LONG_RUN}}}", text) is not None


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Piece:
    __slots__ = ("doc_id", "ids", "start", "total")

    def __init__(self, doc_id: int | None, ids: bytes, start: int, total: int):
        self.doc_id, self.ids, self.start, self.total = doc_id, ids, start, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.ids[: 4 * n], self.start, self.total), Piece(self.doc_id, self.ids[4 * n :], self.start + n, self.total)


def _tier_of(tiers: tuple[int, ...], n: int) -> int:
    return next((t for t in reversed(tiers) if t >= n), tiers[0])


def _fill(tiers: tuple[int, ...], queues: dict[int, deque], size: int, first: int) -> list[Piece]:
    """Pieces of exactly `size` ids, of which the queues hold as many.

    It opens with a piece of tier `first`; shorter ones that fit follow, and one is cut at last.
    """
    window, room = [], size
    shorter = [t for t in tiers if t < first]
    others = [*[t for t in reversed(tiers) if t < first], first, *[t for t in reversed(tiers) if t > first]]
    while room:
        fits = first if not window and queues[first] else next((t for t in shorter if t <= room and queues[t]), None)
        piece = queues[fits if fits is not None else next(t for t in others if queues[t])].popleft()
        if len(piece) > room:
            piece, rest = piece.split(room)
            queues[_tier_of(tiers, len(rest))].append(rest)
        window.append(piece)
        room -= len(piece)
    return window


def pack_block(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> Iterator[tuple[int, list[Piece]]]:
    """Windows (tier, pieces) of a block of documents.

    A document's full windows of the longest tier stand alone; what is left of it goes to the
    shortest tier that holds it. Each piece of the longest tier opens a window whose gap shorter
    pieces fill; what then is left fills windows of its own tier exactly. Only the last window can
    end short: all others hold exactly their tier's size.
    """
    longest, left = tiers[0], 0
    queues: dict[int, deque] = {t: deque() for t in tiers}
    for piece in pieces:
        while len(piece) >= longest:
            full, piece = piece.split(longest)
            yield longest, [full]
        if len(piece):
            queues[_tier_of(tiers, len(piece))].append(piece)
            left += len(piece)
    for tier in tiers:
        while left >= tier and queues[tier]:
            yield tier, _fill(tiers, queues, tier, tier)
            left -= tier
    for tier in tiers:  # pieces of a tier that too few ids were left for
        while left >= tier:
            yield tier, _fill(tiers, queues, tier, tier)
            left -= tier
    if left:
        yield longest, _fill(tiers, queues, left, longest)


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step long"


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = 1_000_000, step_tokens: int = 1 << 16, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Pieces of all documents, each at its place in a sequence of at most tiers[0] ids.

    A document's ids are those of the tokenizer at `tokenizer_path` and then 0. Each task packs its
    own documents in blocks of about `block_tokens` ids: no shuffle, memory bounded by a block (or
    by one longer document), and one short window a block at most, so padding falls with the
    block's size and not with the table's. Windows of one tier go to steps of `step_tokens` ids, so
    all windows of a step are of one length and all steps of a task hold equal numbers of ids, but
    for the last one of each tier, which holds what is left.

    Defined cases: a null text is an empty one and gives the single id 0; equal and repeated rows
    are packed each for itself; a null doc_id is carried along; an empty table gives an empty
    result; further columns are dropped.
    """
    columns = [x.split() for x in SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[k]) for n, k in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sequence, block, tokens = _encoder(tokenizer_path), first_row_key(), [], 0
        filled = dict.fromkeys(tiers, 0)
        base = sequence

        def out() -> pa.RecordBatch:
            nonlocal sequence
            rows: list[tuple] = []
            for tier, window in pack_block(block, tiers):
                step, at = base + (filled[tier] * tier // step_tokens) * len(tiers) + tiers.index(tier), 0
                for p in window:
                    rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.total, sequence, at, tier, step))
                    at += len(p)
                filled[tier] += 1
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + b"\0\0\0\0"
                block.append(Piece(doc_id, ids, 0, len(ids) // 4))
                tokens += len(ids) // 4
                if tokens >= block_tokens:
                    yield out()
                    block, tokens = [], 0
        if block:
            yield out()

    return in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
