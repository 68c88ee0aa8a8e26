"""Quality rules, line first: lines that fail a rule go, then documents that lose too much of their text.

A line (text between newlines) with at least one word fails if
- punctuation: its words that end in two or more of ! ? or in one of # * $ % & make up at least 3 words and 30 % of them;
- navigation: its words made of | < > « » · • / only are at least 3 and 20 % of its words;
- boilerplate: it holds one of the fixed phrases below, in any case of A-Z.
The document loses the failed lines; it is rejected if they held more than half of its words, or if the base rules fail
(under 10 words, or more than a fifth of the words in repeated 5-word windows). What is left of it is its clean text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import Words, slices, table, window_hashes

#: Fixed values.
PHRASES = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "click here", "lorem ipsum", "subscribe to our", "sign up for",
)
SYMBOLS = b"#*$%&|<>"
_LOUD = re.compile(rb"(?:[!?]{2}|[#*$%&])$")
_MENU = re.compile("^[|<>«»·•/]+$")
_PHRASE = re.compile("|".join(PHRASES))
_IS_SYMBOL = np.zeros(256, np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1
_IS_CHAR = np.array([0 if 0x80 <= b < 0xC0 or b in (32, 9, 10, 11, 12, 13) else 1 for b in range(256)])
#: Only lines with one of these can fail.
_SUSPECT = re.compile(rb"[!?#*$%&|<>/]|\xc2[\xab\xbb\xb7]|\xe2\x80\xa2|" + "|".join(PHRASES).encode(), re.IGNORECASE)


def line_fails(line: bytes) -> bool:
    if not _SUSPECT.search(line):
        return False
    words = line.split()
    n = len(words)
    loud = sum(1 for w in words if _LOUD.search(w))
    menu = sum(1 for w in words if _MENU.search(w.decode("utf-8", "replace")))
    lowered = line.lower().decode("utf-8", "replace")  # bytes.lower() changes A-Z only
    return (loud >= 3 and 10 * loud >= 3 * n) or (menu >= 3 and 5 * menu >= n) or bool(_PHRASE.search(lowered))


def _texts(data: np.ndarray, offs: np.ndarray) -> Iterator[bytes]:
    whole = data.tobytes()
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        yield whole[a:b]


def line_statistics(text: bytes, kept: list[bytes] | None = None) -> tuple[int, int]:
    """Lines with a word that equal an earlier line; words in lines that fail. Other lines are added to kept."""
    seen: set[bytes] = set()
    repeated = lost = 0
    verdict: dict[bytes, int] = {}
    for line in text.split(b"\n"):
        if not line or line.isspace():
            if kept is not None:
                kept.append(line)
            continue
        if line in seen:
            repeated += 1
        else:
            seen.add(line)
            verdict[line] = len(line.split()) if line_fails(line) else 0
        lost += verdict[line]
        if kept is not None and not verdict[line]:
            kept.append(line)
    return repeated, lost


def clean(text: bytes) -> bytes:
    """text without the lines that fail."""
    kept: list[bytes] = []
    return b"\n".join(kept) if line_statistics(text, kept)[1] else text


def repeated_words(h: np.ndarray, k: int = 5) -> int:
    """Words covered by k-word windows that occur more than once."""
    w = window_hashes(h, k)
    if len(w) < 2:
        return 0
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + k, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, base_failed boolean, kept boolean"


def judge(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of FIELDS for the texts in data."""
    w = Words(data, offs)
    h = w.hashes()
    n = np.diff(w.first).astype(np.int64)
    total = lambda kind: np.diff(np.concatenate([[0], np.cumsum(kind[data])])[offs])
    lines = np.array([line_statistics(t) for t in _texts(data, offs)], np.int64).reshape(-1, 2)
    repeat = np.array([repeated_words(h[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)], np.int64)
    failed = (n < 10) | (100 * repeat > 20 * n)
    return {
        "n_words": n, "word_chars": total(_IS_CHAR), "n_symbols": total(_IS_SYMBOL), "n_dup_lines": lines[:, 0], "n_repeat_words": repeat,
        "n_lost_words": lines[:, 1], "base_failed": failed, "kept": ~failed & (2 * lines[:, 1] <= n),
    }


def quality_rules(docs: DataFrame, text: str = "text", remove: bool = False) -> DataFrame:
    """docs with the columns of FIELDS (replacing columns of these names). Null and empty texts have no words and fail.

    With remove, texts lose their failed lines; the columns tell of what was there before. A null text stays null."""
    docs = docs.drop(*(f.split()[0] for f in FIELDS.split(", ")))
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(FIELDS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in slices(batch, text):
                cols = judge(data, offs)
                if remove and cols["n_lost_words"].any():
                    lost = cols["n_lost_words"].tolist()
                    left = [t if t is None or not n else clean(t.encode()).decode() for t, n in zip(part.column(text).to_pylist(), lost, strict=True)]
                    at = part.schema.get_field_index(text)
                    part = part.set_column(at, part.schema.field(at), pa.array(left, part.schema.field(at).type))
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, cols.values())], names=[*part.schema.names, *cols])

    return docs.mapInArrow(run, schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "n_lost_words")


_W = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_LIKE = " OR ".join(f"contains(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{p}')" for p in PHRASES)
OP5_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, j, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM
  (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS j FROM t)),
m AS (SELECT doc_id, j, line, len(lw) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY j) AS r,
    len(list_filter(lw, lambda x: regexp_matches(x, '([!?][!?]|[#*$%&])$'))) AS loud,
    len(list_filter(lw, lambda x: regexp_full_match(x, '[|<>«»·•/]+'))) AS menu, ({_LIKE}) AS plate
  FROM l WHERE len(lw) > 0),
ll AS (SELECT doc_id, count_if(r > 1) AS dup, sum(CASE WHEN (loud >= 3 AND 10 * loud >= 3 * n) OR (menu >= 3 AND 5 * menu >= n) OR plate THEN n ELSE 0 END) AS lost
  FROM m GROUP BY doc_id),
s AS (SELECT doc_id, unnest(range(len(w) - 4)) AS i, len(w) AS n, w FROM t WHERE len(w) >= 5),
s2 AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS win FROM s),
s3 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM s2),
rep AS (SELECT doc_id, count(DISTINCT i + d) AS rw FROM s3, (SELECT unnest(range(5)) AS d) WHERE c > 1 GROUP BY doc_id),
b AS (SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
   coalesce(dup, 0) AS n_dup_lines, coalesce(rw, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM t LEFT JOIN ll USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost <= n_words AS kept
FROM b
"""
