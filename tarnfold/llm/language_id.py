"""Language identification by error-correcting output codes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import in_small_batches

#: Hashed n-grams of 1 to 3 bytes of the lower-cased text.
FEATURES = 1 << 13
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def features(text: bytes, part: int = 1 << 20) -> np.ndarray:
    """Counts of hashed n-grams. Digits and marks count as spaces, runs of which count once.

    Counted in parts of about `part` bytes, so that a long text takes little more than itself.
    """
    lower = text.decode("utf-8", "replace").lower().encode("utf-8", "replace")
    a = np.frombuffer(b" " + lower + b" ", np.uint8).copy()
    a[(a < 97) | ((a > 122) & (a < 128))] = 32
    space = a == 32
    a = a[np.append(True, ~(space[1:] & space[:-1]))]
    out = np.zeros(FEATURES, np.int64)
    for start in range(0, len(a), part):
        s = a[start : start + part + 2].astype(np.int64)
        one, two, three = s[:part], min(len(s) - 1, part), min(len(s) - 2, part)
        grams = [one * 7919, s[:two] * 104729 + s[1 : two + 1] * 1299709 + 1]
        if three > 0:
            grams.append(s[:three] * 15485863 + s[1 : three + 1] * 32452843 + s[2 : three + 2] * 49979687 + 2)
        for h in grams:
            out += np.bincount((h ^ (h >> 11)) & (FEATURES - 1), minlength=FEATURES)
    return out


def codebook(n: int, seed: int = 11) -> np.ndarray:
    """n codewords of +1 and -1: all distinct splits up to six languages, else a wide random code."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        columns = [[1 if (c >> k) & 1 else -1 for k in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(columns, float).T
    rng, best, apart = np.random.default_rng(seed), None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(n, int(10 * np.ceil(np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = min(float((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits: log odds of a bit for each n-gram
    trust: np.ndarray  # by bit: how far its two sides lie apart on their own n-grams
    scale: np.ndarray  # by bit: brings the mean margin of its own sides to 1
    sharpness: float = 12.0
    ambiguous_below: float = 0.05
    settled_grams: int = 200

    def decode(self, counts: np.ndarray) -> tuple[str, float, bool]:
        """Language, score, and whether two codewords lie equally near.

        They do if their losses differ by less than ambiguous_below. A short text has little to tell
        languages apart by, so less is asked of it: the limit grows with n / (n + settled_grams).
        """
        margin = (counts @ self.weights) / max(1, counts.sum()) * self.scale
        loss = (self.trust * np.log1p(np.exp(np.clip(-2 * self.code * margin, -50, 50)))).sum(axis=1)
        p = np.exp(-self.sharpness * (loss - loss.min()))
        order = np.argsort(loss, kind="stable")
        gap = float(loss[order[1]] - loss[order[0]]) if len(loss) > 1 else 1.0
        n = counts.sum()
        return self.languages[order[0]], float(p[order[0]] / p.sum()), gap < self.ambiguous_below * n / (n + self.settled_grams)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's n-gram counts by language."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            value = text.as_py()
            if has_letter(value):
                sums.setdefault(lang, np.zeros(FEATURES, np.int64))
                sums[lang] += features(value)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "counts"])


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model | None:
    """One binary n-gram classifier for each bit, from the n-gram counts of all labelled rows.

    Each task sums its rows by language; Spark adds those sums up, so what reaches the driver is
    FEATURES numbers for each language, whatever the number of rows. A bit's weights are log odds
    of the n-grams of the languages with that bit against those of the others; languages count
    alike however many rows they have. None if there is no labelled text.
    """
    rows = (
        in_small_batches(labelled).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"))
        .mapInArrow(_count, "lang string, counts array<long>")
        .select("lang", F.posexplode("counts").alias("k", "c"))
        .filter("c > 0")
        .groupBy("lang", "k")
        .agg(F.sum("c").alias("c"))
        .collect()  # at most FEATURES rows a language
    )
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    at = {x: i for i, x in enumerate(languages)}
    share = np.zeros((len(languages), FEATURES))
    for r in rows:
        share[at[r["lang"]], r["k"]] = r["c"]
    share = (share + smoothing) / (share + smoothing).sum(axis=1, keepdims=True)
    code = codebook(len(languages))
    weights = np.zeros((FEATURES, code.shape[1]))
    for bit in range(code.shape[1]):
        ones, zeros = share[code[:, bit] > 0], share[code[:, bit] < 0]
        if len(ones) and len(zeros):
            weights[:, bit] = np.log(ones.mean(axis=0) / zeros.mean(axis=0))
    own = np.abs(share @ weights).mean(axis=0)  # mean margin of each bit over the languages
    return Model(languages, code, weights, own / own.sum() if own.sum() else np.ones_like(own), np.where(own > 0, 1 / np.maximum(own, 1e-9), 0.0))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row, from its whole text alone.

    The weights travel in the task closure: FEATURES x bits numbers.
    Defined cases: a text that is null or has no letter, and every text where nothing was learned,
    is 'und' with score 0 and not ambiguous; repeated rows are judged alike; an empty table gives
    an empty result; `ambiguous` marks texts whose two nearest codewords lie equally near
    (see Model.decode).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, float, bool]] = []
            for text in batch.column(1):
                value = text.as_py()
                if model is None or not has_letter(value):
                    out.append(("und", 0.0, False))
                else:
                    out.append(model.decode(features(value)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, whose language could be told: not 'und' and not ambiguous.

    Defined cases: texts that are null or have no letter go; without a model every text with a
    letter stays; repeated rows are judged alike; an empty table gives an empty result; other
    columns, whatever their names, are carried along.
    """
    at = docs.columns.index(text_col)

    def good(text: bytes | None) -> bool:
        return has_letter(text) and (model is None or not model.decode(features(text))[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [good(None if t is None else t.encode("utf-8", "replace")) for t in (x.as_py() for x in batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2: never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
