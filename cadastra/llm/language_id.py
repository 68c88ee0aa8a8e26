"""Language identification: a bidirectional gated recurrent network labels every byte; a text's answer is their mean.

The network (recurrent.py) is trained on the driver from a bounded sample: of each language, `per_language` texts that
aren't held out, in the order of a hash of their id, one stretch of each at a place that the hash picks. Prediction
reads whole texts: windows of `window` bytes with `context` more on both sides go through the network together, so every
position is labelled with that context on either side, whatever the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, table
from .quality_model import held_out
from .recurrent import Net, train

UNKNOWN = "und"


def pooled(net: Net, data: np.ndarray, offs: np.ndarray, window: int, context: int, rows: int = 2048) -> np.ndarray:
    """Mean label probabilities over all bytes of each text; zero for empty texts."""
    sizes = np.diff(offs)
    count = -(-sizes // window)
    doc = np.repeat(np.arange(len(sizes)), count)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
    length = np.minimum(sizes[doc] - start, window)
    padded = np.concatenate([np.zeros(context, np.uint8), data, np.zeros(window + 2 * context, np.uint8)])
    out = np.zeros((len(sizes), len(net.out_bias)))
    by_length = np.argsort(-length, kind="stable")
    for i in range(0, len(doc), rows):
        r = by_length[i : i + rows]
        longest = int(length[r[0]])
        t = np.arange(longest + 2 * context)[:, None] - context
        at = start[r] + t
        x = padded[offs[doc[r]] + at + context]
        x[(at < 0) | (at >= sizes[doc[r]])] = 0
        p = net.probabilities(x, context)
        p *= np.arange(longest)[:, None] < length[r]
        np.add.at(out, doc[r], p.sum(1, dtype=np.float64).T)
    return out / np.maximum(sizes, 1)[:, None]


def training_sample(docs: DataFrame, id_: str, text: str, lang: str, per_language: int, stretch: int) -> list:
    known = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL AND length(text) > 0").where(~held_out(F.col("id")))
    known = known.withColumn("h", F.xxhash64("id"))
    at = F.pmod(F.col("h"), F.greatest(F.length("text") - stretch, F.lit(1))).cast("int") + 1
    known = known.select("lang", "h", "id", F.substring(F.col("text"), at, F.lit(stretch)).alias("text"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "id", "text"))
    return known.withColumn("r", rank).where(F.col("r") <= per_language).orderBy("lang", "r").select("lang", "text").collect()


def fit_languages(docs: DataFrame, id_: str, text: str, lang: str, per_language: int = 300, stretch: int = 360, window: int = 96) -> tuple[list[str], Net | None]:
    sample = training_sample(docs, id_, text, lang, per_language, stretch)
    langs = sorted({r["lang"] for r in sample})
    x, y = [], []
    for r in sample:
        raw = r["text"].encode()
        for i in range(0, max(1, len(raw) - window // 2), window):
            x.append(np.frombuffer(raw[i : i + window].ljust(window, b"\0"), np.uint8))
            y.append(langs.index(r["lang"]))
    return langs, train(np.stack(x), np.array(y), len(langs)) if langs else None


def identify_languages(docs: DataFrame, id_: str = "doc_id", text: str = "text", lang: str = "lang", window: int = 160, context: int = 16) -> DataFrame:
    """One row (id, held_out, lang_pred, score) for each row of docs.

    A null text or one without a letter is `und` with score 0; without any labelled text, all are. lang is only learned
    from rows that aren't held out, and never used to predict."""
    langs, net = fit_languages(docs, id_, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in slices(batch, "text"):
                whole = data.tobytes()
                letters = [any(map(str.isalpha, whole[a:b].decode("utf-8", "replace"))) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                if langs:
                    p = pooled(shared.value, data, offs, window, context)
                    names = [langs[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), letters, strict=True)]
                    score = np.where(letters, np.clip(p.max(1), 0, 1), 0.0)
                else:
                    names, score = [UNKNOWN] * len(letters), np.zeros(len(letters))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)], names=["id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).withColumn("held_out", held_out(F.col("id")))
    return rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs).withColumnRenamed("id", "doc_id")
