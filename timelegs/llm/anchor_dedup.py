"""Removal of long word passages that occur more than once, found from cover anchors.

Short windows are hashed only where the word's place in its document, modulo a period, is in a
difference cover. Two equal passages of ``width`` words, whatever their places, have an offset
below the period at which both are in the cover, so they share an aligned anchor. Only anchors
that occur twice are extended: the full windows around them are keyed and counted, and a window
that occurs twice marks its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.llm.blocks import Block, bucket_count, gather_answers, key_totals, make_blocks, open_blocks, read_answers
from timelegs.llm.store import Workspace
from timelegs.llm.textkeys import SPACES, distinct, grams, words

# Every residue modulo 21 is a difference of two of these.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)


def anchor_places(cuts: np.ndarray, width: int) -> np.ndarray:
    """Word positions of a block that begin an anchor of ``width`` words inside their document."""
    first = np.repeat(cuts[:-1], np.diff(cuts))
    last = np.repeat(cuts[1:], np.diff(cuts))
    at = np.arange(len(first))
    covered = np.isin(np.arange(PERIOD), COVER)
    return np.flatnonzero(covered[(at - first) % PERIOD] & (at + width <= last))


def places_near(anchors: np.ndarray, cuts: np.ndarray, width: int) -> np.ndarray:
    """Starts of full windows that hold one of the anchors."""
    n = int(cuts[-1])
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.maximum(anchors - (PERIOD - 1), 0), 1)
    np.add.at(change, anchors + 1, -1)
    last = np.repeat(cuts[1:], np.diff(cuts))
    return np.flatnonzero((np.cumsum(change[:-1]) > 0) & (np.arange(n) + width <= last))


def repeated(keys: np.ndarray, answers: np.ndarray) -> np.ndarray:
    """Which keys have a positive answer; answers are in the order of the distinct keys."""
    if not len(keys):
        return np.empty(0, bool)
    return answers[np.searchsorted(distinct(keys)[0], keys)] > 0


class Passages:
    """The words of a block, its anchors, and the windows that the anchors extend to."""

    def __init__(self, b: Block, width: int):
        self.width, self.small = width, width - PERIOD + 1
        self.starts, self.ends, self.hashes = words(b.data, SPACES)
        self.cuts = b.spans(self.starts)
        self.anchors = anchor_places(self.cuts, self.small)
        self.anchor_keys = grams(self.hashes, self.small)[self.anchors]

    def extend(self, answers: np.ndarray) -> np.ndarray:
        """Find the windows around repeated anchors; their keys."""
        self.windows = places_near(self.anchors[repeated(self.anchor_keys, answers)], self.cuts, self.width)
        self.window_keys = grams(self.hashes, self.width)[self.windows]
        return self.window_keys

    def marked(self, answers: np.ndarray) -> np.ndarray:
        """Whether each word is in a repeated window."""
        change = np.zeros(len(self.starts) + 1, np.int32)
        hit = self.windows[repeated(self.window_keys, answers)]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + self.width, -1)
        return np.cumsum(change[:-1]) > 0


def _twice(totals: np.ndarray) -> np.ndarray:
    return (totals > 1).astype(np.uint8)


def remove_repeats(docs: DataFrame, width: int = 35, space: Workspace | None = None) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its repeated passages removed.

    Returned: doc_id, n_words, n_removed, kept (the kept words joined by one space, as bytes).
    A word goes if a window of ``width`` words that covers it also starts anywhere else, in the
    same document too; every copy goes, the first included. Words are runs of other than ASCII
    white space. Null, blank and short texts lose nothing; repeated rows are repeats of each other.
    Windows are compared by 64-bit hashes.
    """
    if width < PERIOD + 4:
        raise ValueError(f"width must be at least {PERIOD + 4}")
    space = space or Workspace(docs.sparkSession, "anchors")
    blocks = space.write(make_blocks(docs), "blocks", "none")
    buckets = bucket_count(blocks, 0.4)

    def anchors(b: Block):
        return distinct(Passages(b, width).anchor_keys)

    seen = space.write(gather_answers(key_totals(blocks, anchors, _twice, buckets), "anchors"), "anchors")
    blocks = blocks.join(seen, "block", "left")

    def windows(b: Block):
        return distinct(Passages(b, width).extend(read_answers(b.row["anchors"], "u1")))

    seen = space.write(gather_answers(key_totals(blocks, windows, _twice, buckets), "windows"), "windows")

    def cut(batches):
        for b in open_blocks(batches):
            p = Passages(b, width)
            p.extend(read_answers(b.row["anchors"], "u1"))
            marked = p.marked(read_answers(b.row["windows"], "u1"))
            keep = ~marked
            change = np.zeros(len(b.data) + 2, np.int32)
            change[p.starts[keep]] += 1
            change[p.ends[keep] + 1] -= 1  # with the separator that follows the word
            inside = np.cumsum(change)[: len(b.data)] > 0
            data = b.data.copy()
            data[p.ends[p.ends < len(data)]] = 0x20
            size = np.concatenate(([0], np.cumsum(inside)))
            kept = data[inside].tobytes()
            removed = np.concatenate(([0], np.cumsum(marked)))
            at = np.append(b.starts, len(b.data))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(b.doc_id, pa.int64()),
                    "n_words": np.diff(p.cuts).astype(np.int64),
                    "n_removed": np.diff(removed[p.cuts]).astype(np.int64),
                    "kept": pa.array([kept[size[at[k]] : size[at[k + 1]]][:-1] for k in range(len(b.sizes))], pa.binary()),
                }
            )

    return blocks.join(seen, "block", "left").mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")
