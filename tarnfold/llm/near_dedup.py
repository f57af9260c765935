"""Near-duplicates: b-bit MinHash signatures and a multi-index Hamming join."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import cut, in_small_batches

_RNG = np.random.default_rng(20)
#: A random number for each byte, and an odd multiplier with its inverse (modulo 2**64).
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
ODD = 0x9E3779B97F4A7C15
ODD_INVERSE = pow(ODD, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[list(b" \t\n\x0b\x0c\r")] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Of so many document ids at most a broadcast is made.
BROADCAST_IDS = 2_000_000
#: Rows of ids that one task takes in the steps between (they hold no texts).
TASK_ROWS = 250_000
#: Bits of the sketch that bounds how many shingles two sets can share.
SKETCH_BITS = 4096
#: Whole sets leave a Python worker in batches of about so many bytes.
BATCH_BYTES = 8 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words lie between runs of [\\x20\\x09-\\x0D]; A-Z count as a-z. A text of fewer words than
    `words` has its whole sequence as its one shingle; a text without words has none.
    """

    def __init__(self, words: int):
        self.words = words
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(ODD, n), _powers(ODD_INVERSE, n)

    def __call__(self, text: bytes | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        a = LOWER[np.frombuffer(text, np.uint8)]
        if len(a) >= len(self.up):
            self._grow(2 * len(a))
        edge = np.flatnonzero(np.diff(WHITE[a], prepend=True, append=True))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.empty(0, np.uint64)
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(BYTE[a] * self.up[: len(a)], out=sums[1:])
        word = _mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        k = min(self.words, len(word))
        out = np.zeros(len(word) - k + 1, np.uint64)
        for i in range(k):
            out = _mix(out * np.uint64(ODD) + word[i : i + len(out)])
        return np.unique(out + np.uint64(k))


class Scheme:
    """A signature of `chunks` chunks, each a 64-bit number that holds four b-bit symbols (b = 16).

    The symbols are low bits of MinHash minima. By the pigeonhole principle two signatures that
    differ in at most chunks * (errors + 1) - 1 symbols have a chunk in which at most `errors` of
    the four differ. The index enumerates the choices of `errors` symbols of a chunk; a chunk with
    the chosen ones blanked out is a key, so every such pair meets under one. With 5 chunks and one
    error that is any distance up to 9 of 20; documents with a similarity of 0.8 miss each other in
    all five chunks with a probability of 0.0002.
    """

    SYMBOLS = 4

    def __init__(self, chunks: int = 5, errors: int = 1):
        self.chunks, self.symbols = chunks, chunks * self.SYMBOLS
        rng = np.random.default_rng(4)
        self.xor = rng.integers(0, 1 << 32, self.symbols, dtype=np.uint32)
        self.by = rng.integers(0, 1 << 32, self.symbols, dtype=np.uint32) | np.uint32(1)
        #: (chunk, mask of the symbols that count) of each choice.
        self.choices = [(c, sum(0xFFFF << (16 * i) for i in kept)) for c in range(chunks) for kept in combinations(range(self.SYMBOLS), self.SYMBOLS - errors)]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        h = (shingles >> np.uint64(16)).astype(np.uint32)
        out = np.empty(self.symbols, np.uint32)
        for i in range(self.symbols):
            x = (h ^ self.xor[i]) * self.by[i]
            out[i] = (x ^ (x >> np.uint32(15))).min()
        # the minima are small numbers: their bits are mixed before the low 16 are kept
        return ((out * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype("<u2").view(np.int64)

    def columns(self) -> list[str]:
        return [f"s{c}" for c in range(self.chunks)]

    def keys(self) -> Column:
        """SQL: an array of (choice, key) of a row with the signature's columns."""
        signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
        return F.array(*[F.struct(F.lit(n).alias("choice"), F.col(f"s{c}").bitwiseAND(F.lit(signed(mask)).cast("long")).alias("key")) for n, (c, mask) in enumerate(self.choices)])

    def first_shared(self, difference: np.ndarray) -> np.ndarray:
        """Of rows of chunk-wise differences (XOR): the first choice under which a pair meets, or -1."""
        out = np.full(len(difference), -1)
        for n in range(len(self.choices) - 1, -1, -1):
            c, mask = self.choices[n]
            out[(difference[:, c] & np.uint64(mask)) == 0] = n
        return out


def sketch(shingles: np.ndarray) -> bytes:
    """A bit for each shingle, by its hash. A union has at least as many shingles as both sketches have bits together."""
    bits = np.zeros(SKETCH_BITS, bool)
    bits[shingles & np.uint64(SKETCH_BITS - 1)] = True
    return np.packbits(bits).tobytes()


def signatures(docs: DataFrame, words: int, scheme: Scheme) -> DataFrame:
    """doc_id, n_shingles, h1, h2 (128 bits that identify the set) and the signature's chunks (null without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            n, h1, h2 = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            chunks = np.zeros((batch.num_rows, scheme.chunks), np.int64)
            for i, text in enumerate(batch.column(1)):
                s = shingler(text.as_py())
                if len(s):
                    n[i], chunks[i] = len(s), scheme.signature(s)
                    h1[i] = np.bitwise_xor.reduce(_mix(s + np.uint64(1))).view(np.int64)
                    h2[i] = np.add.reduce(_mix(s ^ np.uint64(ODD))).view(np.int64)
            columns = [batch.column(0), *map(pa.array, (n, h1, h2)), *[pa.array(np.ascontiguousarray(c), mask=n == 0) for c in chunks.T]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "h1", "h2", *scheme.columns()])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, " + ", ".join(f"{c} long" for c in scheme.columns()))


def _sets(docs: DataFrame, words: int, scheme: Scheme) -> DataFrame:
    """rep with the size, signature and sketch of its set, and the whole sorted set as bytes."""
    names = ["rep", "n", "sig", "sketch", "members"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, rows, size = Shingler(words), [], 0

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for rep, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingler(text.as_py())
                if len(s):
                    rows.append((rep, len(s), scheme.signature(s).tobytes(), sketch(s), s.tobytes()))
                    size += 8 * len(s)
                if size > BATCH_BYTES:
                    yield out()
                    rows, size = [], 0
        if rows:
            yield out()

    return docs.mapInArrow(run, "rep long, n long, sig binary, sketch binary, members binary")


def only(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """docs of the n ids. 8 bytes an id are broadcast if they are few enough; beyond that texts are shuffled to them."""
    return docs.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def tasks_for(rows: int) -> int:
    """Tasks for so many rows of ids: few for few, and more as they grow."""
    return max(8, -(-rows // TASK_ROWS))


def _linked(share: int, of: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = 0
                if of * min(len(a), len(b)) >= share * max(len(a), len(b)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(of * both >= share * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, share: int = 80, of: int = 100) -> DataFrame:
    """The pairs (a, b) whose whole sets have of * intersection >= share * union."""
    one = sets.select("rep", "members")
    both = pairs.join(one.toDF("a", "ma"), "a").join(one.toDF("b", "mb"), "b")
    return both.select("a", "b", "ma", "mb").mapInArrow(_linked(share, of), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, comp (smallest node reachable) for every node of edges (a, b); isolated nodes have none.

    Alternating large-star and small-star steps, each written to the checkpoint folder: the number
    of rounds grows with the logarithm of the longest chain, a round's rows are the edges' and no
    component is gathered in one place but by pre-aggregated minima and equi-joins.
    """
    edges = cut(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct())
    before = (0, None)
    while (state := edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()) != before:
        before, tasks = state, tasks_for(2 * state[0])
        edges = edges.coalesce(tasks)
        ways = edges.union(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi"))).toDF("u", "v")
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo < hi")
        down = large.coalesce(tasks).toDF("v", "u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select("m", F.explode(F.array("u", "v")).alias("x")).filter("m < x").coalesce(tasks).distinct()
        edges = cut(small.toDF("lo", "hi").coalesce(tasks))
    found = edges.groupBy("hi").agg(F.min("lo").alias("comp")).withColumnRenamed("hi", "node")
    return found.union(found.select(F.col("comp"), F.col("comp")).distinct())




def _in_blocks(rows: DataFrame, weight: Column, size: int) -> DataFrame:
    """rows (choice, key, rep, comp, minor, n) with the numbers of blocks of their key: n_left of its minor rows, n_right of all.

    A block holds rows of about the weight `size`, whatever the key's size. Keys without minor rows go.
    """
    sums = rows.groupBy("choice", "key").agg(
        F.ceil(F.sum(F.when(F.col("minor"), weight)) / size).cast("int").alias("n_left"),
        F.ceil(F.sum(weight) / size).cast("int").alias("n_right"),
    )
    return rows.join(sums.filter("n_left > 0"), ["choice", "key"])


def _meetings(rows: DataFrame) -> DataFrame:
    """Every block of a key's minor rows brought together with every block of its rows, sorted by meeting."""
    spots = F.expr("""concat(
        transform(sequence(0, n_left - 1), i -> struct(i as x, right as y, minor and i = left as is_left, true as is_right)),
        if(minor, transform(filter(sequence(0, n_right - 1), j -> j != right), j -> struct(left as x, j as y, true as is_left, false as is_right)), array()))""")
    dealt = rows.withColumn("left", F.pmod(F.xxhash64("rep"), F.col("n_left")).cast("int")).withColumn("right", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("n_right")).cast("int"))
    rest = [c for c in rows.columns if c not in ("n_left", "n_right")]
    met = dealt.select(*rest, F.inline(spots))
    order = ["choice", "key", "x", "y"]
    names = [*order, "is_left", "is_right", "rep", "comp", "minor", "n", "sig", "sketch", *(["members"] if "members" in rest else [])]
    return met.select(*names).repartition(*order).sortWithinPartitions(*order)


class Meeting:
    """The rows of one meeting as arrays."""

    def __init__(self, parts: list[pa.RecordBatch], scheme: Scheme):
        numbers = lambda name: np.concatenate([p.column(name).to_numpy(zero_copy_only=False) for p in parts])
        whole = lambda name: [v for p in parts for v in p.column(name).to_pylist()]
        self.scheme = scheme
        self.choice, self.key = (int(parts[0].column(c)[0].as_py()) for c in ("choice", "key"))
        self.left, self.right = (np.flatnonzero(numbers(c)) for c in ("is_left", "is_right"))
        self.rep, self.comp, self.minor, self.n = (numbers(c) for c in ("rep", "comp", "minor", "n"))
        self.sig = np.frombuffer(b"".join(whole("sig")), np.uint64).reshape(-1, scheme.chunks)
        self.sketch = np.frombuffer(b"".join(whole("sketch")), np.uint64).reshape(-1, SKETCH_BITS // 64)
        self.members = [np.frombuffer(v, np.uint64) for v in whole("members")] if "members" in parts[0].schema.names else []

    def partners(self, i: int, share: int, of: int) -> np.ndarray:
        """The rows that row i may be linked with, in other components.

        Left out is only what cannot be: by the sets' sizes, or as the bits of both sketches bound
        the union from below. A pair that several keys share comes up under the first of them.
        """
        j = self.right
        j = j[(self.comp[j] != self.comp[i]) & ((self.rep[j] > self.rep[i]) | ~self.minor[j])]
        n, own = self.n[j], self.n[i]
        j = j[of * np.minimum(n, own) >= share * np.maximum(n, own)]
        j = j[self.scheme.first_shared(self.sig[j] ^ self.sig[i]) == self.choice]
        if not len(j):
            return j
        union = np.bitwise_count(self.sketch[j] | self.sketch[i]).sum(axis=1, dtype=np.int64)
        return j[of * (self.n[j] + own - union) >= share * union]


def _by_meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The slices of each meeting from batches sorted by it: no more than two blocks are held."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
        for start, stop in zip(edges, edges[1:]):
            if held and last != at[start].tolist():
                yield held
                held = []
            held.append(batch.slice(start, stop - start))
            last = at[start].tolist()
    if held:
        yield held


def _maybe(scheme: Scheme, share: int, of: int):
    """The rows that have a partner in any meeting, with their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _by_meeting(batches):
            m, found = Meeting(parts, scheme), set()
            for i in m.left:
                j = m.partners(i, share, of)
                if len(j):
                    found.update([int(i), *j.tolist()])
            if found:
                at = np.array(sorted(found))
                columns = [np.full(len(at), m.choice, np.int32), np.full(len(at), m.key, np.int64), m.rep[at], m.comp[at], m.minor[at], m.n[at]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["choice", "key", "rep", "comp", "minor", "n"])

    return run


def _exact(scheme: Scheme, share: int, of: int):
    """Links between components, as many as join those of a meeting up, confirmed on whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _by_meeting(batches):
            m, out = Meeting(parts, scheme), []
            for i in m.left:
                j = m.partners(i, share, of)
                if not len(j):
                    continue
                own, sizes = m.members[i], m.n[j]
                every = np.concatenate([m.members[k] for k in j])
                spot = np.minimum(own.searchsorted(every), len(own) - 1)
                both = np.add.reduceat((own[spot] == every).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                for k in j[of * both >= share * (len(own) + sizes - both)]:
                    if m.comp[k] != m.comp[i]:
                        out.append((int(m.rep[i]), int(m.rep[k])))
                        m.comp[m.comp == m.comp[k]] = m.comp[i]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return run


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, share: int = 80, of: int = 100, scheme: Scheme | None = None, block: int = 2048, set_bytes: int = 16 << 20) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of share / of or more.

    1. One pass over the texts makes shingle sets and b-bit signatures. Documents with the same set
       fall into one class; only its smallest doc_id goes on. Spark makes the index keys (see
       Scheme) from the signatures.
    2. A second pass writes the whole sets of those documents that share a key with others, once.
    3. Of each key, all members are paired with its smallest document, the hub; pairs are confirmed
       on whole sets and folded into components, so a group of copies costs its size and not its
       square.
    4. What a key still holds outside the hub's component is compared with all of the key's rows in
       other components, in blocks: first by sizes and sketches, which leave out only pairs that
       cannot be similar enough, then on whole sets. Only links that join components up are given
       out, not every pair.
    No pair is dropped for a large key or by an estimate; nothing but counts reaches the driver.

    Defined cases: null, empty and white-only texts have no shingles and are linked with nothing;
    rows with one doc_id count as one document, linked if any of its texts is, and each row is
    returned; rows without doc_id are returned with their n_shingles, no component, and kept; equal
    sets are linked; an empty table gives an empty result; further columns, whatever their names,
    are dropped.
    Returns doc_id, n_shingles, component_id, kept.
    """
    scheme = scheme or Scheme()
    same = ["n_shingles", "h1", "h2"]
    source = in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    signed = cut(signatures(source, words, scheme))

    some = signed.filter("n_shingles > 0 and doc_id is not null")
    reps = cut(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in scheme.columns()]))
    every = reps.select("rep", F.inline(scheme.keys()))
    shared = every.groupBy("choice", "key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    keys = cut(every.join(shared, ["choice", "key"]))
    keys = keys.coalesce(tasks_for(keys.count()))

    ids = cut(keys.select(F.col("rep").alias("doc_id")).distinct())
    n_ids = ids.count()
    sets = cut(_sets(only(source, ids.coalesce(tasks_for(n_ids)), n_ids), words, scheme))
    asked = keys.filter("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    # an id that comes with several texts is one document
    again = some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id")
    again = some.join(again, "doc_id", "left_semi").join(reps, same).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comps = components(cut(confirmed(asked, sets, share, of)).union(again))

    # a key of two rows has been asked for all there is
    known = comps.toDF("rep", "comp")
    rows = (
        keys.filter("c > 2").join(known, "rep", "left").join(known.toDF("hub", "hub_comp"), "hub", "left")
        .select("choice", "key", "rep", F.coalesce("comp", "rep").alias("comp"), (F.coalesce("comp", "rep") != F.coalesce("hub_comp", "hub")).alias("minor"))
    )
    rows = cut(rows.coalesce(tasks_for(n_ids)))
    met = cut(_in_blocks(rows, F.lit(1), block).coalesce(tasks_for(n_ids)))
    if not met.isEmpty():
        described = _meetings(met.join(sets.drop("members"), "rep"))
        maybe = cut(described.mapInArrow(_maybe(scheme, share, of), "choice int, key long, rep long, comp long, minor boolean, n long").distinct())
        maybe = maybe.coalesce(tasks_for(maybe.count()))
        whole = _meetings(_in_blocks(maybe, 8 * F.col("n"), set_bytes).join(sets, ["rep", "n"]))
        links = cut(whole.mapInArrow(_exact(scheme, share, of), "a long, b long"))
        if not links.isEmpty():
            comps = components(comps.toDF("a", "b").union(links))

    classes = reps.select(*same, "rep").join(comps.toDF("rep", "comp"), "rep", "left").select(*same, F.coalesce("comp", "rep").alias("comp"))
    labelled = signed.select("doc_id", *same).join(classes, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
