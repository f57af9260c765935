"""Log-likelihood of documents under a gated recurrent language model."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import cut, first_row_key, in_small_batches

#: The end of a text, as a token. Words hold no space, so none is like it.
END = b" "
WORD_CLASSES, CLASS_WORDS = 63, 64
#: Kinds of words outside the model's classes: by ASCII or not, and up to 4, up to 8, or more bytes.
SHAPES = 6
MODEL_WORDS = WORD_CLASSES * CLASS_WORDS
HEAD_WORDS, HEAD_BYTES = 1 << 18, 8 << 20
HIDDEN = 16


def tokens(text: bytes | None) -> list[bytes]:
    r"""Words [^\x20\x09-\x0D]+ with A-Z as a-z: bytes.lower() and bytes.split() know ASCII only."""
    return text.lower().split() if text else []


def _shape(word: bytes) -> int:
    n = len(word)
    return (0 if word.isascii() else 3) + (0 if n <= 4 else 1 if n <= 8 else 2)


def _shape_column(word: str) -> Column:
    n = F.octet_length(word)
    plain = ~F.col(word).cast("string").rlike(r"[^\x00-\x7F]")
    return F.when(plain, 0).otherwise(3) + F.when(n <= 4, 0).when(n <= 8, 1).otherwise(2)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 10, is 0: never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def token_counts(docs: DataFrame, flush: int = 200_000) -> DataFrame:
    """word (bytes, END for the ends), c: over all rows of docs (text as bytes). Tasks count first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                held[END] += 1
                if len(held) > flush:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The most frequent words, bounded: about HEAD_WORDS words and HEAD_BYTES bytes.

    The first MODEL_WORDS are the model's own, CLASS_WORDS of them to a class by frequency. All
    others belong to a class for their shape; shape_mass is the sum of count + 0.1 over a shape's
    words in the training tokens, and 0.1 for those never seen.
    """

    head: dict[bytes, int]
    counts: np.ndarray
    shape_mass: np.ndarray
    tokens: int
    distinct: int

    def __post_init__(self) -> None:
        words = list(self.head)
        n = min(len(words), MODEL_WORDS)
        # symbol of each head word: its rank, or MODEL_WORDS + shape
        self.symbol = np.array([i if i < n else MODEL_WORDS + _shape(w) for i, w in enumerate(words)], np.int32)
        self.end = self.head.get(END, MODEL_WORDS)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The head is all words from a count on, as far as HEAD_WORDS and HEAD_BYTES go, and the end.

    That count comes from a histogram of a few hundred steps: no task or driver sorts words that
    don't make it into the head. Of the step that has room in part, a hash chooses.
    """
    n, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    step, size = F.floor(F.log2("c") * 8), F.octet_length("word")
    steps = counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).collect()  # a few hundred
    words, room, least, share = HEAD_WORDS - 1, HEAD_BYTES, 1 << 30, 1.0
    for r in sorted(steps, reverse=True):
        least, share = r["s"], min(1.0, words / r["n"], room / max(1, r["bytes"]))
        words, room = words - r["n"], room - r["bytes"]
        if share < 1:
            break
    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    head = counts.filter((F.col("word") == END) | (step > least) | ((step == least) & chosen)).collect()  # about HEAD_WORDS at most
    # the end is a word of the model whatever its count
    top = sorted(((bytes(r["word"]), r["c"]) for r in head), key=lambda x: (x[0] != END, -x[1], x[0]))
    mass = np.full(SHAPES, 0.1)
    for r in counts.groupBy(_shape_column("word").alias("s")).agg(F.sum(F.col("c") + 0.1).alias("m")).collect():
        mass[r["s"]] += r["m"]
    for w, c in top[:MODEL_WORDS]:
        mass[_shape(w)] -= c + 0.1
    return Vocabulary({w: i for i, (w, _) in enumerate(top)}, np.array([c for _, c in top], float), np.maximum(mass, 0.1), n, distinct)


class Gru:
    """Gates from a table by the last symbol and from the state; a softmax over classes, and one over a class's words."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 3):
        rng = np.random.default_rng(seed)
        classes = WORD_CLASSES + SHAPES
        own = np.zeros((WORD_CLASSES, CLASS_WORDS))
        own.flat[: min(len(vocabulary.counts), MODEL_WORDS)] = vocabulary.counts[:MODEL_WORDS]
        own += 0.01
        share = np.concatenate([own.sum(axis=1), vocabulary.shape_mass])
        self.p = {
            "x": rng.normal(0, 0.1, (MODEL_WORDS + SHAPES, 3 * HIDDEN)),
            "u": rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)),
            "wc": rng.normal(0, 0.01, (HIDDEN, classes)),
            "bc": np.log(share / share.sum()),
            "ww": rng.normal(0, 0.01, (WORD_CLASSES, HIDDEN, CLASS_WORDS)),
            "bw": np.log(own / own.sum(axis=1, keepdims=True)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.class_share, self.word_share = share / share.sum(), (own / own.sum(axis=1, keepdims=True)).ravel()

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def step(self, h: np.ndarray, symbols: np.ndarray, by_symbol: np.ndarray) -> np.ndarray:
        """The states (HIDDEN x streams) after these symbols; by_symbol: the table with a column for each symbol."""
        g, a = by_symbol.take(symbols, axis=1), self.p["u"].T @ h
        gates = a[: 2 * HIDDEN]
        gates += g[: 2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        c = gates[HIDDEN:] * a[2 * HIDDEN :]
        c += g[2 * HIDDEN :]
        np.tanh(c, out=c)
        return c + gates[:HIDDEN] * (h - c)

    def outputs(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of the targets; with grads also what flows back to the states.

        Without grads a tenth of each softmax is the share by count, so that a text unlike those
        learned from loses little against counts alone.
        """
        with_one = np.append(states, np.ones((len(states), 1), states.dtype), axis=1)
        cls = np.where(targets < MODEL_WORDS, targets // CLASS_WORDS, targets - MODEL_WORDS + WORD_CLASSES)
        rows = np.arange(len(targets))

        def softmax(logits: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
            """Log probabilities of the columns `of`; logits become the probabilities' numerators, or what flows back."""
            np.minimum(logits, 80, out=logits)  # within what exp() of 32 bits can hold
            told = logits[at, of]
            np.exp(logits, out=logits)
            total = np.maximum(logits @ np.ones(logits.shape[1], logits.dtype), 1e-37)
            if grads is not None:
                logits *= (1 / total)[:, None]
                logits[at, of] -= 1
            return told - np.log(total)

        d = with_one @ np.append(self.p["wc"], self.p["bc"][None], axis=0)
        out = softmax(d, rows, cls)
        if grads is None:
            out = np.log(0.9 * np.exp(out) + 0.1 * self.class_share[cls])
        order = np.argsort(cls.astype(np.int16), kind="stable")
        stops = np.cumsum(np.bincount(cls, minlength=WORD_CLASSES + SHAPES)).tolist()
        order = order[: stops[WORD_CLASSES - 1]]  # those of the model's own words, class by class
        runs = [(k, i, j) for k, i, j in zip(range(WORD_CLASSES), [0, *stops], stops) if i < j]
        s, weights = with_one[order], np.append(self.p["ww"], self.p["bw"][:, None], axis=1)
        l = np.empty((len(order), CLASS_WORDS), s.dtype)
        for k, i, j in runs:
            np.matmul(s[i:j], weights[k], out=l[i:j])
        inside = softmax(l, rows[: len(order)], targets[order] % CLASS_WORDS)
        if grads is None:
            inside = np.log(0.9 * np.exp(inside) + 0.1 * self.word_share[targets[order]])
        out[order] += inside
        if grads is None:
            return out, None
        by_class = with_one.T @ d
        grads["wc"], grads["bc"] = by_class[:-1], by_class[-1]
        back, flow, by_word = d @ self.p["wc"].T, np.empty((len(order), HIDDEN), s.dtype), np.zeros_like(weights)
        for k, i, j in runs:
            np.matmul(s[i:j].T, l[i:j], out=by_word[k])
            np.matmul(l[i:j], self.p["ww"][k].T, out=flow[i:j])
        grads["ww"], grads["bw"] = by_word[:, :-1], by_word[:, -1]
        back[order] += flow
        return out, back

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, end: int, real: np.ndarray | None = None) -> tuple[float, dict, np.ndarray, np.ndarray]:
        """Of the sum of -log probabilities over a window (time x streams): value, gradients, symbols read, state after it.

        The gradient of "x" has a row for each symbol read. A stream's state is cleared where it
        reads `end`, as a new text starts from nothing but the end before it. Targets outside `real`
        don't count.
        """
        steps, width = inputs.shape
        u = self.p["u"]
        goes_on = (inputs != end).astype(h.dtype)
        # gates and candidates take the place of what the table brings to them
        by_symbol, table = np.ascontiguousarray(self.p["x"].T), np.empty((steps, 3 * HIDDEN, width), h.dtype)
        for t in range(steps):
            by_symbol.take(inputs[t], axis=1, out=table[t], mode="clip")
        zs, rs, cs = (table[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
        states, before, turns = (np.empty((steps, HIDDEN, width), h.dtype) for _ in range(3))
        for t in range(steps):
            before[t] = h = h * goes_on[t]
            a = u.T @ h
            gates = table[t, : 2 * HIDDEN]
            gates += a[: 2 * HIDDEN]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            turns[t] = a[2 * HIDDEN :]
            cs[t] += rs[t] * turns[t]
            np.tanh(cs[t], out=cs[t])
            states[t] = h = cs[t] + zs[t] * (h - cs[t])
        grads: dict = {}
        flat, want = np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(-1, HIDDEN), targets.ravel()
        if real is None or real.all():
            logs, back = self.outputs(flat, want, grads)
        else:
            some = np.flatnonzero(real.ravel())
            logs, part = self.outputs(flat[some], want[some], grads)
            back = np.zeros_like(flat)
            back[some] = part
        back = np.ascontiguousarray(back.reshape(steps, width, HIDDEN).transpose(0, 2, 1))
        by_c, by_z, by_r = (1 - zs) * (1 - cs * cs), (before - cs) * zs * (1 - zs), turns * rs * (1 - rs)
        pre, last = np.empty_like(table), np.empty_like(states)
        dh, grads["u"] = np.zeros_like(h), np.zeros_like(u)
        for t in range(steps - 1, -1, -1):
            dh = dh + back[t]
            dc = np.multiply(dh, by_c[t], out=last[t])
            np.multiply(dh, by_z[t], out=pre[t, :HIDDEN])
            np.multiply(dc, by_r[t], out=pre[t, HIDDEN : 2 * HIDDEN])
            np.multiply(dc, rs[t], out=pre[t, 2 * HIDDEN :])
            grads["u"] += before[t] @ pre[t].T
            dh = (dh * zs[t] + u @ pre[t]) * goes_on[t]
        pre[:, 2 * HIDDEN :] = last  # what flows to the table does not pass the gate
        order = np.argsort(inputs.ravel().astype(np.int16), kind="stable")
        used, first = np.unique(inputs.ravel()[order], return_index=True)
        grads["x"] = np.add.reduceat(pre.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        return float(-logs.sum()), grads, used, h

    def train(self, stream: np.ndarray, end: int, streams: int = 512, window: int = 16, rate: float = 0.05) -> int:
        """Truncated backpropagation, once over a long row of symbols in which `end` ends each text.

        The row is laid out in parallel streams, the last of which may end early; the state is
        carried from window to window and cleared where a text begins. Every symbol is a target
        once. Returns the number of symbols.
        """
        if not len(stream):
            return 0
        streams = max(1, min(streams, len(stream) // (4 * window)))
        length = -(-len(stream) // streams)
        lay = lambda row: np.append(row, np.full(streams * length - len(row), end, row.dtype)).reshape(streams, length).T
        targets, inputs = lay(stream), lay(np.append(np.array([end], stream.dtype), stream[:-1]))
        real = (np.arange(streams * length) < len(stream)).reshape(streams, length).T
        square = {k: np.full_like(v, 1e-6) for k, v in self.p.items()}
        h = np.zeros((HIDDEN, streams), np.float32)
        for begin in range(0, length, window):
            at = slice(begin, begin + window)
            _, grads, used, h = self.gradients(inputs[at], targets[at], h, end, real[at])
            scale = np.float32(1.0 / real[at].sum())
            for k, g in grads.items():
                g = g * scale
                if k == "x":
                    square[k][used] += g * g
                    self.p[k][used] -= np.float32(rate) * g / np.sqrt(square[k][used])
                else:
                    square[k] += g * g
                    self.p[k] -= np.float32(rate) * g / np.sqrt(square[k])
        return len(stream)

    def score(self, texts: list[np.ndarray], end: int, rows: int = 1 << 13) -> np.ndarray:
        """Natural log probability of each text's symbols and its end; the state lasts a whole text."""
        lengths = np.array([len(t) + 1 for t in texts])
        order = np.argsort(-lengths, kind="stable")
        result = np.zeros(len(texts))
        starts = np.concatenate([[0], np.cumsum(lengths[order])])[:-1]
        line = np.concatenate([x for i in order for x in (texts[i], [end])]).astype(np.int32) if len(texts) else np.empty(0, np.int32)
        sorted_lengths = lengths[order]
        h, by_symbol = np.zeros((HIDDEN, len(texts)), np.float32), np.ascontiguousarray(self.p["x"].T)
        at = 0
        while at < (sorted_lengths[0] if len(texts) else 0):
            active = int(np.searchsorted(-sorted_lengths, -at, side="left"))
            stop = min(at + max(4, rows // active), int(sorted_lengths[0]))
            states, targets, owners = [], [], []
            for t in range(at, stop):
                active = int(np.searchsorted(-sorted_lengths, -t, side="left"))
                before = np.full(active, end, np.int32) if t == 0 else line[starts[:active] + t - 1]
                h = self.step(h[:, :active], before, by_symbol)
                states.append(h)
                targets.append(line[starts[:active] + t])
                owners.append(np.arange(active))
            logs, _ = self.outputs(np.concatenate(states, axis=1).T, np.concatenate(targets))
            result += np.bincount(np.concatenate(owners), weights=logs, minlength=len(texts))
            at = stop
        out = np.empty(len(texts))
        out[order] = result
        return out


class Places(dict):
    """Place of each word in the vocabulary's head; of others -1 less their shape."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.head)
        self.symbol = vocabulary.symbol if len(vocabulary.symbol) else np.zeros(1, np.int32)

    def __missing__(self, word: bytes) -> int:
        return -1 - _shape(word)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places and symbols."""
        at = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return at, np.where(at >= 0, self.symbol[np.maximum(at, 0)], MODEL_WORDS - 1 - at).astype(np.int32)


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = 2, task_tokens: int = 4_000_000, fan_in: int = 8) -> Gru:
    """The model after `rounds` rounds of local training and averaging, each over all documents of docs.

    The documents' symbols are made once, two bytes each, and read in every round. In a round each
    task trains a copy on its own documents, in pieces of `task_tokens`, from where the last round's
    average stands; copies are averaged by their tokens, `fan_in` at a time, so neither a task nor
    the driver ever holds more than one copy beside its sum, or the driver more than `fan_in`.
    """
    model = Gru(vocabulary)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # bounded by HEAD_WORDS and HEAD_BYTES

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, places = np.int16(shared.value.end), Places(shared.value)
        for batch in batches:
            rows = [np.append(places.of(tokens(text.as_py()))[1].astype(np.int16), end).tobytes() for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["symbols"])

    read_in = cut(docs.select("text").mapInArrow(symbols, "symbols binary"))
    for _ in range(rounds):
        weights = model.flat()

        def run(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            own = Gru(shared.value)
            own.load(weights)
            held, n, seen, end = [], 0, 0, shared.value.end

            for batch in batches:
                for text in batch.column(0):
                    held.append(np.frombuffer(text.as_buffer(), np.int16))
                    n += len(held[-1])
                    if n > task_tokens:
                        seen += own.train(np.concatenate(held).astype(np.int32), end)
                        held, n = [], 0
            if held:
                seen += own.train(np.concatenate(held).astype(np.int32), end)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([own.flat().tobytes()], pa.binary())], names=["w", "p"])

        def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            w, total = 0.0, None
            for pdf in batches:
                for a, b in zip(pdf["w"], pdf["p"], strict=True):
                    w, total = w + a, a * np.frombuffer(b, np.float32).astype(np.float64) + (0 if total is None else total)
            if total is not None:
                yield pd.DataFrame({"w": [w], "p": [(total / w).astype(np.float32).tobytes()]})

        copies = cut(read_in.mapInArrow(run, "w double, p binary"))
        n = copies.count()
        while n > fan_in:
            n = -(-n // fan_in)
            copies = cut(copies.repartition(n).mapInPandas(merge, "w double, p binary"))
        sums = copies.collect()  # at most fan_in copies
        if sums:
            model.load(sum(r["w"] * np.frombuffer(r["p"], np.float32).astype(np.float64) for r in sums) / sum(r["w"] for r in sums))
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = 2_000_000) -> DataFrame:
    r"""Log10 probabilities of every whole text and its end under a unigram and a recurrent model.

    Learned from the rows that are not held_out. Words are [^\x20\x09-\x0D]+ with A-Z as a-z. The
    unigram gives a token (c + 0.1) / (N + 0.1 (V + 1)). The recurrent model gives a token its
    class, and within it the word: by a softmax for the model's own words, by count for words
    outside them, whose classes are shapes. Counts of words beyond the bounded head come from a
    join with the counts of all words; a task sends each document's rare words once, with their
    number, and the sums of what it could look up itself.

    Defined cases: a null text is an empty one, whose only token is its end; rows without doc_id
    are learned from, and each row is scored by itself, repeated ones alike; without any training
    row every token has a base score of 0; an empty table gives an empty result; further columns
    are dropped.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    source = in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    learned = source.filter(~held_out())
    counts = cut(token_counts(learned))
    words = vocabulary(counts)
    model = train(learned, words)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((words, model.flat()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights = shared.value
        own = Gru(vocab)
        own.load(weights)
        logs = np.log10(vocab.counts + 0.1) if len(vocab.counts) else np.zeros(1)
        log_mass = np.log10(vocab.shape_mass)
        row, held, n = first_row_key(), [], 0
        end_log = float(logs[vocab.end]) if END in vocab.head else -1.0

        places = Places(vocab)

        def out() -> Iterator[pa.RecordBatch]:
            by_model = own.score([h[2] for h in held], vocab.end) / np.log(10)
            keys, ids, symbols, sums, rare = zip(*held, strict=True)
            # a document's own row is followed by those of its rare words; its word is one that no text can hold
            counts = np.array([1 + len(r) for r in rare])
            own_rows = np.concatenate([[0], np.cumsum(counts)[:-1]])

            def at_own(values: list, kind: type) -> pa.Array:
                column = np.zeros(counts.sum(), kind)
                column[own_rows] = values
                return pa.array(column)

            words = [w for key, r in zip(keys, rare, strict=True) for w in (b" %d" % key, *r)]
            columns = [
                pa.array(np.repeat(keys, counts)),
                pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(ids)), counts))),
                pa.array(words, pa.binary()),
                pa.array([c for r in rare for c in (0, *r.values())], pa.int64()),
                at_own([len(s) + 1 for s in symbols], np.int64),
                at_own([s[0] for s in sums], np.int64),
                at_own([s[1] for s in sums], np.float64),
                at_own([float(log_p) + s[2] for log_p, s in zip(by_model, sums, strict=True)], np.float64),
            ]
            whole = pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "word", "tf", "n_tokens", "n_known", "base", "score"])
            for i in range(0, whole.num_rows, 100_000):
                yield whole.slice(i, 100_000)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                w = tokens(text.as_py())
                at, symbols = places.of(w)
                known = at >= 0
                outside = symbols >= MODEL_WORDS
                rare = Counter([w[i] for i in np.flatnonzero(~known).tolist()])
                # of words in the head; of the others the join adds the logs of their counts to both scores
                sums = (int(known.sum()) + (END in vocab.head), float(logs[at[known]].sum()) + end_log, float(logs[at[known & outside]].sum()) - float(log_mass[symbols[outside] - MODEL_WORDS].sum()))
                held.append((row, doc_id, symbols, sums, rare))
                row, n = row + 1, n + len(w) + 1
                if n >= block_tokens:
                    yield from out()
                    held, n = [], 0
        if held:
            yield from out()

    rows = source.mapInArrow(run, "row long, doc_id long, word binary, tf long, n_tokens long, n_known long, base double, score double")
    extra = F.when(F.col("tf") > 0, F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).otherwise(0.0)
    known = F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)
    sums = (
        rows.join(counts, "word", "left")
        .groupBy("row", "doc_id")
        .agg(F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + known).alias("n_known"), F.sum(F.col("base") + extra).alias("base"), F.sum(F.col("score") + extra).alias("score"))
    )
    divisor = F.log10(F.lit(float(words.tokens + 0.1 * (words.distinct + 1))))
    return sums.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * divisor).alias("base_score"),
        "score",
    )
