"""Quality classifier: gradient-boosted trees over statistics of whole texts.

One scan turns each text into a short row of statistics. Labelled rows among them, at most `most_rows`, taken in the order of a
hash of their id, go to the driver, which fits the trees; the flat arrays are broadcast and every row is scored from its
statistics without reading the text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import fit
from .common import Words, cut, slices, table
from .quality_rules import _texts, line_statistics, repeated_words

_KINDS = ("upper", "lower", "digit", "space", "newline", "stop", "comma", "bang", "pipe", "symbol", "slash", "high")
_KIND = np.zeros((len(_KINDS), 256), bool)
for _k, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 11, 12, 13, 32), (10,), b".?:;", b",", b"!", b"|", b"#*$%&<>@^~", b"/\\_=", range(128, 256))):
    _KIND[_k, list(_bytes)] = True
_KINDS_OF = _KIND.T @ (1 << np.arange(len(_KINDS)))
_RANGE = 1 << 40
STATISTICS = ("log_bytes", "log_words", "word_bytes", "distinct", "repeated", "adjacent", "dup_lines", "lost", "line_words", *_KINDS)


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text; all zero for empty ones."""
    w = Words(data, offs)
    h = w.hashes()
    n_bytes = np.diff(offs).astype(float)
    out = np.zeros((len(n_bytes), len(STATISTICS)))
    kinds = _KINDS_OF[data]
    for k in range(len(_KINDS)):
        out[:, 9 + k] = np.diff(np.concatenate([[0], np.cumsum((kinds >> k) & 1)])[offs]) / np.maximum(n_bytes, 1)
    newlines = out[:, 9 + _KINDS.index("newline")] * n_bytes
    for d, (text, a, b) in enumerate(zip(_texts(data, offs), w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        n, x = b - a, h[a:b]
        if n:
            dup, lost = line_statistics(text)
            out[d, 2:9] = (
                (w.end[a:b] - w.start[a:b]).sum() / n, len(np.unique(x)) / n, repeated_words(x) / n, (x[1:] == x[:-1]).sum() / n, dup / (newlines[d] + 1), lost / n, n / (newlines[d] + 1),
            )
        out[d, :2] = np.log1p(n_bytes[d]), np.log1p(n)
    return out


def _scan(keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in slices(batch, text):
                x = statistics(data, offs).astype(np.float32)
                stats = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), stats], names=[*keep, "stats"])

    return run


def text_statistics(docs: DataFrame, id_: str, text: str) -> DataFrame:
    return docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(_scan(["id"], "text"), "id long, stats array<float>")


def held_out(id_: F.Column) -> F.Column:
    """Rows whose crc32(id as text) mod 5 is 0; a null id isn't held out (and is never labelled)."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, id_: str = "doc_id", text: str = "text", label: str = "quality", most_rows: int = 40_000, threshold: float = 0.3) -> DataFrame:
    """One row (id, held_out, score, predicted) for each row of docs; null and empty texts are scored too.

    Only labels of rows that aren't held out are learned. Without labels every score is 0.5."""
    stats = cut(text_statistics(docs, id_, text).withColumn("held_out", held_out(F.col("id"))), "quality-statistics")
    known = labels.where(F.col(label).isNotNull()).select(F.col(id_).cast("long").alias("id"), F.col(label).cast("double").alias("y"))
    known = stats.where("not held_out").join(known, "id").withColumn("r", F.pmod(F.xxhash64("id"), F.lit(_RANGE)))
    # Only a little more than most_rows rows are ordered at all, so tasks send little to the driver.
    few = known.where(F.col("r") < _RANGE * 1.2 * (most_rows + 100) / max(known.count(), 1))
    sample = few.orderBy("r", "id", "y").limit(most_rows).select("stats", "y").toPandas()
    x = np.array(sample["stats"].tolist(), float).reshape(-1, len(STATISTICS))
    model = docs.sparkSession.sparkContext.broadcast(fit(x, sample["y"].to_numpy(float)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)).astype(float)
            p = model.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    return stats.mapInArrow(score, "id long, held_out boolean, score double, predicted int")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_scores(docs, labels).withColumnRenamed("id", "doc_id")
