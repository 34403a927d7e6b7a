"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 / -1. A letter trigram's vector binds its
letters' vectors, permuted by their place: rot2(a) * rot1(b) * c. A document's
vector bundles (adds) the vectors of all its trigrams; a language's prototype
bundles the unit vectors of labelled documents. A document's language is the
prototype with the largest cosine, which is also the score.

Letters are lower-cased; everything else is a word boundary, which takes part
in trigrams as one more letter. The vectors come from the code point, so any
alphabet works and no table has to be shipped.

Scale: one pass to bundle (a bounded sample of labelled rows, ``train_docs`` per
language expected; counted exactly, chosen by hash) and one to compare, without a
shuffle of texts. Only prototypes (languages x dims) reach the driver.

Defined results: ``und`` and score 0 for a null text or one without letters, and
for every text when no label can be learned; ties go to the first language in
order; repeated rows are separate rows. A text is read whole, in time linear in its length and about 50 bytes a
character (trigrams' vectors are held a slice at a time, however many there are).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, table

DIMS = 1024
TRAIN_DOCS = 1500
BUNDLE_TASKS = 12
BATCH_DOCS, BATCH_CHARS = 128, 600_000
SLICE = 16_384  # distinct trigrams whose vectors are held at once
_TABLE = 4 << 20  # largest direct-address trigram table; bigger alphabets are sorted instead


class Encoder:
    """Texts to bundled trigram vectors, a batch at a time."""

    def __init__(self, dims: int = DIMS, seed: int = 7):
        self.dims, self.seed = dims, seed
        self.letter = np.full(0x110000, -1, np.int32)  # code point -> letter number; 0 is the boundary
        self.numbers: dict[str, int] = {" ": 0}
        self.vectors = np.empty((64, dims), np.int8)
        self.vectors[0] = self._vector(0x20)

    def _vector(self, code: int) -> np.ndarray:
        return np.random.default_rng([self.seed, code]).integers(0, 2, self.dims, dtype=np.int8) * 2 - 1

    def _learn(self, codes: np.ndarray) -> None:
        for code in np.unique(codes).tolist():
            c = chr(code).lower()[0] if 0xD800 > code or code > 0xDFFF else " "
            c = c if c.isalpha() else " "
            if c not in self.numbers:
                n = self.numbers[c] = len(self.numbers)
                if n == len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                self.vectors[n] = self._vector(ord(c))
            self.letter[code] = self.numbers[c]

    def encode(self, texts: list[str]) -> np.ndarray:
        """One row of ``dims`` floats for each text; zeros for texts without letters."""
        lengths = np.array([len(t) + 2 for t in texts])
        codes = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter[codes]
        if (letters < 0).any():
            self._learn(codes[letters < 0])
            letters = self.letter[codes]
        doc = np.repeat(np.arange(len(texts)), lengths)
        first = np.zeros(len(letters), bool)
        first[np.cumsum(lengths) - lengths] = True
        keep = (letters > 0) | first
        keep[1:] |= letters[:-1] > 0
        letters, doc = letters[keep].astype(np.int64), doc[keep]
        m = len(self.numbers)
        grams = (letters[:-2] * m + letters[1:-1]) * m + letters[2:]
        same = doc[:-2] == doc[2:]
        grams, doc = grams[same], doc[:-2][same]
        if m**3 <= _TABLE:
            seen = np.zeros(m**3, np.int32)
            seen[grams] = 1
            distinct = np.flatnonzero(seen)
            seen[distinct] = np.arange(len(distinct))
            at = seen[grams]
        else:
            distinct, at = np.unique(grams, return_inverse=True)
        u, n = len(distinct), len(texts)
        if u > SLICE:  # a slice of the distinct trigrams at a time
            order = np.argsort(at, kind="stable")
            at, doc = at[order], doc[order]
        v = self.vectors[:m]
        twice, once = np.roll(v, 2, 1), np.roll(v, 1, 1)
        out = np.zeros((n, self.dims), np.float32)
        for lo in range(0, u, SLICE):
            w = min(SLICE, u - lo)
            some = slice(None) if u <= SLICE else slice(*np.searchsorted(at, [lo, lo + w]))
            counts = np.bincount(doc[some] * w + (at[some] - lo), minlength=n * w).reshape(n, w).astype(np.float32)
            part = distinct[lo : lo + w]
            bound = twice[part // (m * m)] * once[part // m % m] * v[part % m]
            out += counts @ bound.astype(np.float32)
        return out


def batches_of(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= BATCH_DOCS or chars + len(t) > BATCH_CHARS):
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def in_training(doc_id: Column) -> Column:
    """Rows whose labels may be learned from; an unknown id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, dims: int = DIMS, seed: int = 7) -> dict[str, np.ndarray]:
    """Prototype (unit vector) of each language, from the rows that may be learned from.

    ``train_docs`` rows of each language are expected in the sample; languages
    with fewer rows give all of them."""
    labelled = docs.filter(in_training(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return {}
    cells = 1 << 30
    share = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, min(cells, cells * train_docs // n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(cells)) < F.element_at(share, F.col("lang"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sums = Encoder(dims, seed), {}
        for b in batches:
            texts, langs = [t or "" for t in b.column(1).to_pylist()], b.column(0).to_pylist()
            for i, j in batches_of(texts):
                for lang, v in zip(langs[i:j], unit(enc.encode(texts[i:j])), strict=True):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "bundle"]
        )

    protos: dict[str, np.ndarray] = {}
    sample = labelled.filter(drawn).select("lang", "text").repartition(BUNDLE_TASKS)
    # at most BUNDLE_TASKS rows of dims numbers for each language
    for r in sample.mapInArrow(bundle, "lang string, bundle binary").collect():
        protos[r["lang"]] = protos.get(r["lang"], 0) + np.frombuffer(r["bundle"])
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(protos.items()) if np.linalg.norm(v) > 0}


def identify(docs: DataFrame, protos: dict[str, np.ndarray], seed: int = 7, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language and its score (cosine, 0 to 1) added as columns ``pred`` and ``score``."""
    langs = sorted(protos)
    matrix = np.array([protos[x] for x in langs], np.float32).reshape(len(langs), -1)
    dims = matrix.shape[1] if langs else DIMS

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(dims, seed)
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.names.index("text")).to_pylist()]
            found, scores = ["und"] * len(texts), np.zeros(len(texts))
            for i, j in batches_of(texts) if langs else ():
                v = enc.encode(texts[i:j])
                cosine = unit(v) @ matrix.T
                best = cosine.argmax(1)
                for k, (there, n) in enumerate(zip(v.any(1), best, strict=True)):
                    if there:
                        found[i + k], scores[i + k] = langs[n], min(1.0, max(0.0, float(cosine[k, n])))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names, pred, score]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(compare, ", ".join([*fields, f"`{pred}` string", f"`{score}` double"]))


def accepted(docs: DataFrame, least_score: float = 0.0, **options: object) -> DataFrame:
    """``docs`` without the rows whose language can't be told (``und``, or a
    cosine under ``least_score``). Where nothing could be learned, no row is rejected."""
    protos = train(docs, **options)
    if not protos:
        return docs
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    kept = identify(docs, protos, pred=pred, score=score)
    return kept.filter((F.col(pred) != "und") & (F.col(score) >= least_score)).drop(pred, score)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")
