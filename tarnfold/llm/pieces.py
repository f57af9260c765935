"""SentencePiece encoding by streaming Viterbi, and decoding."""

from __future__ import annotations

import hashlib
import zlib
from collections import ChainMap
from collections.abc import Iterable, Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import in_small_batches

BLANK = "▁"


class Pieces:
    """The pieces of a model file with their scores, and single bytes for what no piece covers."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.id_of: dict[str, int] = {}
        self.score: list[float] = [0.0] * model.get_piece_size()
        self.text: list[bytes | None] = [None] * model.get_piece_size()
        self.byte_id = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id_of[piece] = i
                self.score[i] = model.get_score(i)
                self.text[i] = piece.replace(BLANK, " ").encode()
        #: Whether scores are minus the ranks of a BPE model's merges and not log probabilities.
        self.by_rank = all(self.score[i] == int(self.score[i]) for i in self.id_of.values())
        self.longest = max(map(len, self.id_of), default=1)
        #: Id of each beginning of a piece, -1 if it isn't one itself: no text is tried beyond the last of these.
        self.prefix: dict[str, int] = {p[:n]: -1 for p in self.id_of for n in range(1, len(p))} | self.id_of
        #: Cost of a byte: dearer than any piece.
        self.byte_score = min([s for s in self.score if s] or [-1.0]) * 2 - 10
        #: Whether text may be cut in front of each run of blanks that follows something else.
        self.cuts_at_blanks = not any(BLANK in p.lstrip(BLANK) for p in self.id_of)

    def fallback(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8", "replace")]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; control pieces have none. The leading blank of encode() goes."""
        joined = b"".join(self.text[i] or b"" for i in ids).decode("utf-8", "replace")
        return joined[1:] if joined.startswith(" ") else joined


def viterbi_stream(pieces: Pieces, chars: str, keep: int = 64) -> Iterator[list[int]]:
    """Ids of the best segmentation of chars, in parts, as soon as they are certain.

    Position by position, the best way to each later boundary within reach of the longest piece is
    kept. Only boundaries that a piece from here on can still start at are alive, so the window is
    bounded by the longest piece. Every `keep` positions the alive boundaries' backpointers are
    followed; where all of them meet in one boundary, the ids before it are given out and
    forgotten. Equal scores go to the piece that starts earlier, that is, the longer one.
    """
    n, prefix, id_of, score = len(chars), pieces.prefix.get, pieces.id_of, pieces.score
    best: dict[int, float] = {0: 0.0}
    back: dict[int, tuple[int, int]] = {}  # boundary: where its last piece starts, its id (-1: bytes)
    done = 0

    def ids(stop: int) -> list[int]:
        out: list[list[int]] = []
        while stop > done:
            start, i = back[stop]
            out.append(pieces.fallback(chars[start]) if i < 0 else [i])
            stop = start
        return [i for part in reversed(out) for i in part]

    for at in range(n):
        here = best[at]
        single = id_of.get(chars[at])
        value, i = (here + score[single], single) if single is not None else (here + pieces.byte_score * len(chars[at].encode("utf-8", "replace")), -1)
        if value > best.get(at + 1, -np.inf):
            best[at + 1], back[at + 1] = value, (at, i)
        for end in range(at + 2, n + 1):
            i = prefix(chars[at:end])
            if i is None:
                break
            if i >= 0:
                value = here + score[i]
                if value > best.get(end, -np.inf):
                    best[end], back[end] = value, (at, i)
        del best[at]
        if (at + 1) % keep == 0 and at + 1 < n:
            alive = set(best)
            while len(alive) > 1:
                last = max(alive)
                alive.remove(last)
                alive.add(max(back[last][0], done))
            meet = alive.pop()
            if meet > done:
                yield ids(meet)
                for b in range(done + 1, meet + 1):
                    back.pop(b, None)
                done = meet
    if n > done:
        yield ids(n)


class Merges:
    """Which pieces stand side by side in the encoding of a BPE model, told from ranks and splits.

    Merging goes by rank, the leftmost of equal ones first. Two pieces stand side by side if merging
    their joint text gives the two back. Undone in reverse order, the later of the merges on either
    side of the border first, each step bares the parts that met at the border before it; the two
    pieces stand if no such pair would have been merged across the border earlier than that.
    """

    NEVER = 1 << 40

    def __init__(self, pieces: Pieces, remember: int = 1_000_000):
        self.pieces, self.remember, self.known = pieces, remember, {}
        names, n = list(pieces.id_of), len(pieces.id_of)
        at = {name: i for i, name in enumerate(names)}
        self.of, self.names = at, names
        #: By number of a piece, the last number standing for any character without one: id, length, rank of the merge that makes it (-1: none), its two parts.
        self.ids = np.array([*pieces.id_of.values(), -1], np.int32)
        self.length = np.array([*map(len, names), 1], np.int16)
        self.rank, self.left, self.right = np.full(n + 1, -1), np.full(n + 1, -1), np.full(n + 1, -1)
        self.stands = np.ones(n + 1, bool)
        pairs: dict[int, int] = {}
        for i, name in enumerate(names):
            if len(name) > 1:
                self.rank[i] = -int(pieces.score[pieces.id_of[name]])
                parts = self.merge(name, stop=2)
                self.stands[i] = len(parts) == 2
                if self.stands[i]:
                    self.left[i], self.right[i] = at.get(parts[0], n), at.get(parts[1], n)
                for cut in range(1, len(name)):
                    x, y = at.get(name[:cut]), at.get(name[cut:])
                    if x is not None and y is not None:
                        pairs[x * (n + 1) + y] = int(self.rank[i])
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ranks, self.pairs = np.append(keys, np.int64(1) << 62), np.array([pairs[k] for k in keys.tolist()] + [self.NEVER]), pairs
        self.lists = [x.tolist() for x in (self.rank, self.left, self.right)]
        # the beginnings of pieces as a tree: keys (node << 21 | character), the nodes they lead to, the pieces there
        node = {"": 0} | {p: k + 1 for k, p in enumerate(pieces.prefix)}
        steps = sorted((node[p[:-1]] << 21 | ord(p[-1]), node[p]) for p in pieces.prefix)
        self.step_keys, self.step_nodes = np.array([k for k, _ in steps] + [1 << 62], np.int64), np.array([v for _, v in steps] + [-1], np.int32)
        self.piece_at = np.full(len(node), -1, np.int32)
        for name, i in at.items():
            self.piece_at[node[name]] = i

    def merge(self, chars: str, stop: int = 1) -> list[str]:
        """The best-scoring piece that two neighbours make is merged, the leftmost of equal ones, until none or `stop` parts are left."""
        id_of, score, parts = self.pieces.id_of.get, self.pieces.score, list(chars)
        while len(parts) > stop:
            best, where = -np.inf, -1
            for k in range(len(parts) - 1):
                i = id_of(parts[k] + parts[k + 1])
                if i is not None and score[i] > best:
                    best, where = score[i], k
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def beside(self, left: str, right: str) -> bool:
        pair = (left, right)
        found = self.known.get(pair)
        if found is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            found = self.known[pair] = self._beside(self.of.get(left), self.of.get(right))
        return found

    def _beside(self, a: int | None, b: int | None) -> bool:
        if a is None or b is None:
            return True
        rank, lefts, rights = self.lists
        n, limit = len(rank), self.NEVER
        while True:
            if self.pairs.get(a * n + b, self.NEVER) < limit:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                limit, a = rank[a], rights[a]
            else:
                limit, b = rank[b] + 1, lefts[b]

    def all_beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """_beside for arrays of numbers of pieces."""
        ok, where, n = np.ones(len(a), bool), np.arange(len(a)), len(self.rank)
        limit = np.full(len(a), self.NEVER)
        while len(where):
            key = a.astype(np.int64) * n + b
            spot = self.pair_keys.searchsorted(key)
            bad = (self.pair_keys[spot] == key) & (self.pair_ranks[spot] < limit)
            ok[where[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~bad & ((ra >= 0) | (rb >= 0))
            where, a, b, ra, rb = where[on], a[on], b[on], ra[on], rb[on]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return ok

    #: Positions that a round goes on before ways are followed back, and stretches below which each is streamed by itself.
    ROUND, FEW = 64, 16

    def encode(self, stretches: list[str]) -> list[bytes]:
        """Ids of many stretches of text, streamed abreast: merged_stream's steps, each for all stretches that reach its position.

        Every ROUND positions the ways to the boundaries that are still alive are followed back; what
        lies before the boundary where they meet is given out, and the stretch goes on from there
        with the piece in front of it, so no more than a round and the longest piece is held of any.
        The last few stretches that go on are streamed one by one, by the same steps.
        """
        out: list[list[bytes]] = [[] for _ in stretches]
        at, before = np.zeros(len(stretches), np.int64), np.full(len(stretches), -1, np.int32)
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        live = np.flatnonzero(lengths)
        while len(live):
            if len(live) < self.FEW and at[live].any():
                for k in live.tolist():
                    left = before[k]
                    front = self.names[left] if 0 <= left < len(self.names) else ""
                    rest = (i for part in merged_stream(self.pieces, self, stretches[k][at[k] :], before=front) for i in part)
                    out[k].append(np.fromiter(rest, "<i4").tobytes())
                break
            window = self.ROUND + self.pieces.longest - 1
            parts = [stretches[k][a : a + window] for k, a in zip(live.tolist(), at[live].tolist(), strict=True)]
            whole = lengths[live] - at[live] <= window
            ids, met, last = self._round(parts, whole, before[live])
            for k, some in zip(live.tolist(), ids, strict=True):
                out[k].append(some)
            stuck = live[~whole & (met == 0)]  # the ways do not meet within a round
            for k in stuck.tolist():
                front = self.names[before[k]] if 0 <= before[k] < len(self.names) else ""
                rest = (i for part in merged_stream(self.pieces, self, stretches[k][at[k] :], before=front) for i in part)
                out[k].append(np.fromiter(rest, "<i4").tobytes())
            at[live] += met
            before[live] = last
            live = live[~whole & (met > 0)]
        return [b"".join(parts) for parts in out]

    def _round(self, parts: list[str], whole: np.ndarray, before: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(ids, boundary up to which they go, piece in front of it) of each part; of a whole one all, of others what is certain."""
        sizes = np.array([len(w) for w in parts])
        order = np.lexsort((whole, -sizes))  # those that go on are the longest and come first
        sizes, going = sizes[order], int((~whole).sum())
        chars = np.frombuffer("".join([parts[k] for k in order]).encode("utf-32-le", "surrogatepass"), np.int32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        none = len(self.rank) - 1
        last = np.full((len(parts), int(sizes[0]) + 1), -1, np.int32)
        last[:, 0] = before[order]
        for at in range(int(sizes[0])):
            rows = np.arange(going if at >= self.ROUND else 0, np.searchsorted(-sizes, -at, side="left"))
            node = np.zeros(len(rows), np.int64)
            for k in range(1, self.pieces.longest + 1):
                fits = np.searchsorted(-sizes[rows], -(at + k), side="right")
                if not fits:
                    break
                rows, node = rows[:fits], node[:fits]
                key = node << 21 | chars[starts[rows] + at + k - 1]
                spot = self.step_keys.searchsorted(key)
                node = np.where(self.step_keys[spot] == key, self.step_nodes[spot], -1).astype(np.int64)
                piece = np.where(node >= 0, self.piece_at[node], -1)
                if k == 1:
                    piece[piece < 0] = none
                some = np.flatnonzero(piece >= 0)
                some = some[self.stands[piece[some]]]
                r, p = rows[some], piece[some]
                left = last[r, at]
                ok = (left >= 0) | (at == 0)
                asked = left >= 0
                ok[asked] = self.all_beside(left[asked], p[asked])
                r, p = r[ok], p[ok]
                last[r, at + k] = p
                on = node >= 0
                rows, node = rows[on], node[on]
        front = last[:, 0].copy()
        last[:, 0] = -1
        met = sizes.copy()
        met[:going] = self._meeting(last[:going])
        ids = self._followed(parts, order, met, last)
        ends = np.where(met > 0, last[np.arange(len(parts)), met], front)
        back = np.empty(len(parts), np.int64)
        back[order] = np.arange(len(parts))
        return ids, met[back], ends[back]

    def _meeting(self, last: np.ndarray) -> np.ndarray:
        """Of each row the boundary in which all ways to the boundaries from ROUND on meet; 0 if that is the start."""
        alive = last >= 0
        alive[:, : self.ROUND] = False
        rows = np.arange(len(last))
        while True:
            many = rows[alive[rows].sum(axis=1) > 1]
            if not len(many):
                return np.where(alive.any(axis=1), alive.argmax(axis=1), 0)
            top = alive.shape[1] - 1 - alive[many, ::-1].argmax(axis=1)
            alive[many, top] = False
            alive[many, top - self.length[last[many, top]]] = True
            rows = many

    def _followed(self, words: list[str], order: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Ids along the backpointers from the boundary `sizes` of each word."""
        none = len(self.rank) - 1
        at, rows = sizes.copy(), np.flatnonzero(sizes > 0)
        found = np.full(last.shape, -1, np.int32)  # filled from the right
        column = last.shape[1] - 1
        while len(rows):
            p = last[rows, at[rows]]
            found[rows, column] = p
            column -= 1
            at[rows] -= self.length[p]
            rows = rows[at[rows] > 0]
        out: list[bytes] = [b""] * len(words)
        held = found >= 0
        flat, counts = self.ids[found[held]].astype("<i4").tobytes(), held.sum(axis=1)
        stops = 4 * np.cumsum(counts)
        plain = (found != none).all(axis=1)
        for k, (stop, n, o) in enumerate(zip(stops.tolist(), counts.tolist(), order.tolist(), strict=True)):
            if plain[k]:
                out[o] = flat[stop - 4 * n : stop]
            else:
                ids, spot = [], 0
                for p in found[k][held[k]].tolist():
                    ids += self.pieces.fallback(words[o][spot]) if p == none else [int(self.ids[p])]
                    spot += int(self.length[p])
                out[o] = np.array(ids, "<i4").tobytes()
        return out


def merged_stream(pieces: Pieces, merges: Merges, chars: str, keep: int = 64, before: str = "") -> Iterator[list[int]]:
    """Ids that merging by rank gives chars, in parts, as soon as they are certain. `before` is the piece in front of them.

    viterbi_stream with a cost of 0 for a piece that may follow the last one of the text before it,
    and none that is finite for others: one last piece at each boundary remains, as each beginning
    of a text has one encoding. The window and the early ends are those of viterbi_stream.
    """
    n, prefix, beside = len(chars), pieces.prefix.get, merges.beside
    last: dict[int, str] = {0: before}  # boundary: the last piece before it
    back: dict[int, tuple[int, int]] = {}  # boundary: where its last piece starts, its id (-1: bytes)
    done = 0

    def ids(stop: int) -> list[int]:
        out: list[list[int]] = []
        while stop > done:
            start, i = back[stop]
            out.append(pieces.fallback(chars[start]) if i < 0 else [i])
            stop = start
        return [i for part in reversed(out) for i in part]

    for at in range(n):
        left = last.pop(at, None)
        if left is not None:
            for end in range(at + 1, n + 1):
                piece = chars[at:end]
                i = prefix(piece)
                if end == at + 1 and (i is None or i < 0):
                    ok, i = True, -1 if i is None else i
                elif i is None:
                    break
                else:
                    ok = i >= 0
                if ok and (not left or beside(left, piece)):
                    last[end], back[end] = piece, (at, i)
                if end == at + 1 and prefix(piece) is None:
                    break
        if (at + 1) % keep == 0 and at + 1 < n:
            alive = set(last)
            while len(alive) > 1:
                end = max(alive)
                alive.remove(end)
                alive.add(max(back[end][0], done))
            meet = alive.pop()
            if meet > done:
                yield ids(meet)
                for b in range(done + 1, meet + 1):
                    back.pop(b, None)
                done = meet
    if n > done:
        yield ids(n)


class Encoder:
    """Ids of whole texts. A blank opens each text that is not empty; a blank mark in it reads as a blank, as in the model itself.

    Where no piece runs across the end of a word, all ways through a text meet in front of each run
    of blanks, so what lies before is final there. The stretches between are streamed many abreast
    (Merges.encode), whatever their length, and equal ones once: short ones are remembered.
    """

    AT_ONCE, SHORT = 20_000, 128

    def __init__(self, pieces: Pieces, remember: int = 400_000):
        self.pieces, self.remember, self.known = pieces, remember, {}
        self.merges = Merges(pieces) if pieces.by_rank else None

    def _streamed(self, stretches: list[str]) -> list[bytes]:
        marked = [w.replace(" ", BLANK) for w in stretches]
        if self.merges:
            return self.merges.encode(marked)
        return [np.fromiter((i for part in viterbi_stream(self.pieces, w) for i in part), "<i4").tobytes() for w in marked]

    def _learn(self, stretches: set[str]) -> Mapping[str, bytes]:
        """Ids of all stretches."""
        new = [w for w in stretches if w not in self.known]
        if len(self.known) + len(new) > self.remember:
            self.known.clear()
            new = list(stretches)
        found: dict[str, bytes] = {}
        for at in range(0, len(new), self.AT_ONCE):
            part = new[at : at + self.AT_ONCE]
            found.update(zip(part, self._streamed(part), strict=True))
        long = {w: found.pop(w) for w in [w for w in found if len(w) > self.SHORT]}
        self.known.update(found)
        return ChainMap(self.known, long) if long else self.known

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = _words if self.pieces.cuts_at_blanks else lambda part: [part] if part else []
        stretches = [cut(" " + text.replace(BLANK, " ")) if text else [] for text in texts]
        known = self._learn({w for of in stretches for w in of})
        return [np.frombuffer(b"".join([known[w] for w in some]), "<i4") for some in stretches]

    def __call__(self, text: str) -> np.ndarray:
        return self.many([text])[0]


def _words(text: str) -> list[str]:
    """Runs of blanks each with what follows up to the next blank."""
    bits = text.split(" ")
    if "" not in bits[1:]:
        return [b for b in [bits[0], *[" " + b for b in bits[1:]]] if b]
    out, blanks = [bits[0]] if bits[0] else [], 0
    for b in bits[1:]:
        blanks += 1
        if b:
            out.append(" " * blanks + b)
            blanks = 0
    return out + ([" " * blanks] if blanks else [])


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(Pieces(path))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every whole text, one narrow pass.

    A BPE model's merges are followed by the steps of merged_stream; of other models the best-scoring
    segmentation under the pieces' scores is found by viterbi_stream. The ids are those of the model
    itself. Defined cases: a null text has null ids; an empty one has none; a blank mark in a text is
    a blank, and decodes to one; characters without a piece go as bytes; repeated rows give repeated
    rows; an empty table gives an empty result; further columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = [None if t is None else i for t, i in zip(texts, encoder.many([t or "" for t in texts]), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, text of encode()'s rows; null ids have a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(model_path).pieces
        for batch in batches:
            texts = [None if x.as_py() is None else pieces.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), decoded_sha256, round_trip.

    Encodes and decodes in one pass, without keeping the ids. A null text counts as an empty one.
    round_trip is false for texts that hold a blank mark, which comes back as a blank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                for text, ids in zip(texts, encoder.many(texts), strict=True):
                    back = encoder.pieces.decode(ids.tolist())
                    rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == text))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "round_trip"])

    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean"
    return in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
