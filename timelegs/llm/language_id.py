"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up, for each language, how often each hashed n-gram occurs; tasks return one
fixed-size table per language, summed in parts. The log-probabilities are one matrix of
``BINS`` rows and a column per language, whose size is bounded and checked before it is broadcast.
A text's score is the sum of the matrix rows of its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from timelegs.llm.blocks import give_back
from timelegs.llm.store import row_and, row_and_text, text_of

BINS = 1 << 15
PARTS = 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 256
CHARS = 1 << 18
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def text_groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, code points and where each row begins, in groups of bounded size.

    Upper case is folded; a row is followed by two blanks, so that no n-gram crosses rows.
    """
    first, held, size = 0, [], 0
    for k, text in enumerate(column):
        held.append((text.as_py() or "").lower() if text.is_valid else "")
        size += len(held[-1]) + 2
        if size >= CHARS or k == len(column) - 1:
            raw = "".join(x + "  " for x in held).encode("utf-32-le", "replace")
            begins = np.cumsum([0, *(len(x) + 2 for x in held[:-1])])
            yield first, len(held), np.frombuffer(raw, np.uint32), begins
            first, held, size = k + 1, [], 0


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and bin of every n-gram that has a letter; other characters count as blanks."""
    letter = letters()[codes]
    codes = np.where(letter, codes, 0x20).astype(np.uint64)
    places, bins = [], []
    for n in ORDERS:
        if len(codes) < n:
            continue
        mixed, some = np.full(len(codes) - n + 1, n, np.uint64), np.zeros(len(codes) - n + 1, bool)
        for k in range(n):
            mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            some |= letter[k : len(codes) - n + 1 + k]
        at = np.flatnonzero(some)
        places.append(at)
        bins.append((mixed[at] * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 15)).astype(np.int64))
    return (np.concatenate(places), np.concatenate(bins)) if places else (np.empty(0, np.int64),) * 2


def has_letter(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(letters()[codes].astype(np.int64), begins) > 0


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_likelihood: np.ndarray  # BINS x languages


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each bin by language in one task; part -1 has the number of texts."""
    counts: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, rows, codes, begins in text_groups(batch.column("text")):
            places, bins = features(codes)
            row = np.searchsorted(begins, places, side="right") - 1
            mine = langs[first : first + rows]
            names = sorted(set(mine))
            index = np.array([names.index(x) for x in mine])
            both = np.bincount(index[row] * BINS + bins, minlength=len(names) * BINS).reshape(-1, BINS)
            for k, name in enumerate(names):
                counts[name] = counts[name] + both[k] if name in counts else both[k]
                texts[name] = texts.get(name, 0) + mine.count(name)
    step = BINS // PARTS
    for name, found in counts.items():
        parts = [np.array([texts[name]]), *(found[p * step : (p + 1) * step] for p in range(PARTS))]
        yield pa.RecordBatch.from_pydict(
            {"lang": [name] * len(parts), "part": np.arange(-1, PARTS, dtype=np.int32), "counts": [x.astype(np.int64).tobytes() for x in parts]}
        )
    give_back()


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("counts"))
    return table.slice(0, 1).set_column(2, "counts", pa.array([total.tobytes()], pa.binary()))


def train(labelled: DataFrame, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit to every row with a text and a ``lang``. More than ``max_languages`` is an error."""
    labelled = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    schema = "lang string, part int, counts binary"
    sums = labelled.mapInArrow(_count, schema).groupBy("lang", "part").applyInArrow(_add, schema)
    rows = sums.orderBy("lang", "part").limit((max_languages + 1) * (PARTS + 1)).collect()
    names = sorted({r["lang"] for r in rows})
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    table = {(r["lang"], r["part"]): np.frombuffer(r["counts"], np.int64) for r in rows}
    if not names:
        return Model([], np.empty(0), np.zeros((BINS, 0)))
    texts = np.array([table[n, -1][0] for n in names], float)
    counts = np.array([np.concatenate([table[n, p] for p in range(PARTS)]) for n in names], float) + 0.5
    likelihood = np.log(counts / counts.sum(axis=1, keepdims=True)).T
    return Model(names, np.log(texts / texts.sum()), np.ascontiguousarray(likelihood))


def predict(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (the input row, or its columns ``keep``), lang_pred, score: the predicted language's posterior.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if the
    model has learned no language. Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for batch in batches:
            pred, best = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            for first, rows, codes, begins in text_groups(text_of(batch, text_column)) if m.languages else ():
                places, bins = features(codes)
                owner = np.searchsorted(begins, places, side="right") - 1
                total = np.tile(m.log_prior, (rows, 1))
                for k in range(len(m.languages)):
                    total[:, k] += np.bincount(owner, m.log_likelihood[bins, k], minlength=rows)
                top = total.argmax(axis=1)
                share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for k in np.flatnonzero(has_letter(codes, begins)):
                    pred[first + k], best[first + k] = m.languages[top[k]], share[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(pred, pa.string()), pa.array(best, pa.float64())], ["row", "lang_pred", "score"]
            )
        give_back()

    rows = docs.select(*row_and_text(docs, text_column, keep))
    return rows.mapInArrow(score, row_and(rows, "lang_pred string, score double"))
