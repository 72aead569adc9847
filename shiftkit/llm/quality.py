"""Quality by compression: which of two dictionaries explains a text better.

One zstandard dictionary is trained on text labelled good, one on text
labelled bad.  A text is cut into blocks, each block is compressed with either
dictionary, and the difference of the compressed sizes, normalised by their
sum, says which kind it resembles.  The mean and the lowest block's difference
and the compression ratios are calibrated by logistic regression on labelled
documents that the dictionaries have not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.llm.common import crc_mod, table, utf8_chunks
from shiftkit.llm.logistic import Logistic
from shiftkit.llm.samples import labelled_ids
from shiftkit.session import ship_package

#: Bounds of the training sample: documents of each label, and bytes of one document used for
#: fitting, as blocks from all over a longer text.  Scoring always reads whole texts.
TRAIN_DOCS = 4_000
TRAIN_BYTES = 1 << 16
BLOCK = 512
DICTIONARY = 32_768
LEVEL = 1


def train_dictionary(texts: list[bytes]) -> bytes:
    blocks = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:                 # too little text to train on: use it as it is
        return b"".join(blocks)[-DICTIONARY:]


def sampled(text: bytes) -> bytes:
    """A text of more than TRAIN_BYTES as that many bytes of its blocks, those of the smallest hashes, in their order."""
    if len(text) <= TRAIN_BYTES:
        return text
    blocks = [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]
    order = sorted(range(len(blocks)), key=lambda i: (zlib.crc32(blocks[i], i), i))
    return b"".join(blocks[i] for i in sorted(order[:TRAIN_BYTES // BLOCK]))


class QualityModel:
    """Two dictionaries and the calibration; small enough to travel with a task."""

    def __init__(self, dictionaries: tuple[bytes, bytes], constant: float | None = None):
        self.dictionaries, self.constant, self.calibration = dictionaries, constant, None
        self._c: list | None = None

    def __getstate__(self):
        return {**self.__dict__, "_c": None}

    def _sizes(self, block: bytes) -> tuple[int, int]:
        if self._c is None:
            self._c = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                                write_content_size=False, write_checksum=False, write_dict_id=False)
                       for d in self.dictionaries]
        return len(self._c[0].compress(block)), len(self._c[1].compress(block))

    def features(self, text: bytes) -> list[float]:
        """Mean and least normalised difference, log ratio of the whole and of the most compressible block, log length."""
        blocks = [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)] or [b""]
        g = np.array([(*self._sizes(b), len(b)) for b in blocks], float)
        bad, good, n = g.sum(0)
        ratio = (g[:, 0] + g[:, 1]) / 2 / (g[:, 2] + 8)
        return [(bad - good) / (bad + good), float(((g[:, 0] - g[:, 1]) / (g[:, 0] + g[:, 1])).min()),
                float(np.log((bad + good) / 2 / (n + 8))), float(np.log(ratio.min())), float(np.log1p(n)) / 10]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant if texts else 0.0)
        return self.calibration.predict(np.array([self.features(t) for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> QualityModel:
    """Dictionaries from one half of the sample, calibration from the other.

    Labels are learnt only from rows whose crc32 of the id is not 1 modulo 3.
    If one label is missing, every text scores as the other; without labels, 0.5.
    """
    ids, n = labelled_ids(docs, labels, "quality", crc_mod("doc_id", 3) != 1, per_class)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [sampled((t or "").encode()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), b.column("half"), pa.array(texts, pa.binary())],
                                             names=["doc_id", "y", "half", "b"])

    ship_package(docs.sparkSession)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "y", "half", "text")
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    # Of rows of one id the first text by bytes: at most 2 * per_class rows.
    rows = (chosen.mapInArrow(sample, f"doc_id {kinds['doc_id']}, y {kinds['y']}, half {kinds['half']}, b binary")
            .groupBy("doc_id", "y", "half").agg(F.min("b").alias("b")).orderBy("doc_id").collect())
    of = lambda y, half: [bytes(r.b) for r in rows if r.y == y and r.half == half]
    if not (n.get(0) and n.get(1)) or not all(of(y, h) for y in (0, 1) for h in (0, 1)):
        return QualityModel((b"", b""), 0.5 if not n else n.get(1, 0) / sum(n.values()))
    model = QualityModel((train_dictionary(of(0, 0)), train_dictionary(of(1, 0))))
    bad, good = of(0, 1), of(1, 1)
    x = np.array([model.features(t) for t in bad + good])
    y = np.array([0] * len(bad) + [1] * len(good))
    share = n[1] / (n[0] + n[1])
    w = np.where(y == 1, share / len(good), (1 - share) / len(bad)) * len(y)
    model.calibration = Logistic(x, y, w)
    return model


def scored(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with the score of its ``text`` (0 to 1, higher is better); a null text is empty, a column called ``name`` is replaced."""
    ship_package(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType([*rest, T.StructField(name, T.DoubleType())])
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in utf8_chunks(b.column("text")):
                s = model.score([data[off[i]:off[i + 1]].tobytes() for i in range(hi - lo)])
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(s, pa.float64())],
                                                 names=[*names, name])

    return docs.mapInArrow(run, schema)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
