"""Licence scans by ordered signature rules over whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_rules import Scanner

#: Bytes of words after folding A-Z; all others become a space.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_DETECTION = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("priority", pa.int32())])
_OUT = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("detections", pa.list_(_DETECTION)),
])
_OUT_DDL = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,first_word:long,n_words:long,priority:int>>"


def scan_text(scanner: Scanner, text: bytes) -> tuple:
    """One text's row, without the identifier."""
    words = text.translate(_WORD).split()
    canonical = b" " + b" ".join(words) + b" "
    base = scanner.base_places(canonical)
    found = scanner.detect(canonical, words)
    base_labels = {b[2] for b in base}
    clear = 1.0
    for d in found:
        clear *= 1 - d[4]
    for _ in base:
        clear *= 0.5
    starts = [b[0] for b in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {d[2] for d in found})), 1 - clear,
        [{"label": d[2], "first_word": d[0], "n_words": d[1] - d[0], "priority": d[3]} for d in found],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            rows = [(i, *scan_text(scanner, t)) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence labels of every whole text: base phrases and the rules' resolved detections.

    Returns ``id_col``, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word`` (the
    smallest and largest start among them, null if none), ``base_labels``, ``labels`` (sorted, joined by
    commas), ``score`` (1 less the product of each detection's doubt; 0 without any) and
    ``detections``.  Base labels are never suppressed.

    One map over the rows: no shuffle, and a text is the unit of memory.  Defined cases: a null text
    counts as empty (no words, empty labels, score 0); repeated rows give repeated results; a null
    identifier stays null; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_scan, _OUT_DDL).withColumnRenamed("id", id_col)
