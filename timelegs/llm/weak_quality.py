"""A quality classifier without hand labels: weak labellers, EM, and a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on each text. Documents are counted by their pattern
of votes, of which there is a fixed number, and expectation-maximisation over these counts
estimates each labeller's accuracies and each pattern's probability of being good. The
probabilities are the labels from which a logistic scorer over hashed words is learned, by tasks
on their parts of a bounded sample, averaged. The scorer then rates every text.

The same is done a second time for insults, with labellers that look for different evidence: stems
of insults in six languages, ill will near an address, shouting near an address, disguised
spellings, and the share of such words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timelegs.llm.textkeys import SPACES, U64, byte_values, running, utf8, window, words

# Fixed values, written down from general knowledge and not counted in any table: stems of words that
# insult in English, French, German, Spanish, Italian and Portuguese, and words of ill will.
INSULTS = """
    arschloch asshole babaca bastard bitch blockhead blödmann bonehead clown coglion connard coward cretin crétin abruti
    dickhead dimwit disgusting douchebag dumbass dummkopf escoria estúpid filthy fool garbage gilipollas halfwit idiot
    imbecil imbécil jackass loser lowlife lunatic miserabl moron nitwit numbskull otári palhaç pathetic payaso retarded salaud
    schwachkopf scum stronz stupid trash trottel useless vermin vollidiot worthless abschaum minable asqueros schifos
""".split()
ENDING = 4  # bytes that may follow a stem
NEGATIVE = "hate ugly dumb shut liar shame sick die awful terrible horrible lazy kill rotten nobody nothing déteste hasse odio odeio odi".split()
ADDRESS = "you your youre yours yourself ur tu toi vous ton dich dir dein deine usted tú ti você te".split()
DISGUISE = bytes.maketrans(b"013457@$!", b"oieastasi")
NEAR = 4  # words between an address and what is said of it
SYMBOLS = b"#*$%&|<>{}\\^~"
BINS = 1 << 16
SAMPLE = 40_000  # documents that the scorer learns from, at most about so many
PARTS = 16
ROUNDS = 3
PASSES = 8
RATE = 0.05
DECAY = 0.01
GROUP_BYTES = 2 << 20
QUALITY = ("plain", "symbols", "marked_words", "capitals", "capital_words", "lines", "word_size", "marks")
TOXICITY = ("insult", "address", "shouting", "disguise", "insult_share")
KINDS = {"quality": QUALITY, "toxicity": TOXICITY}


@dataclass
class Group:
    """Some texts laid end to end: byte counts per text, and the words."""

    first: int
    rows: int
    bins: np.ndarray
    owner: np.ndarray
    votes: dict[str, np.ndarray]


LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())  # all but letters


@lru_cache(maxsize=4)
def known_hashes(names: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    return np.sort(words(data, LETTERS, lower=True)[2])


def _among(hashes: np.ndarray, names: list[str]) -> np.ndarray:
    known = known_hashes(tuple(names))
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def insulting(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word is one of the stems, with an ending of a few bytes or none."""
    sums = running(byte_values(LETTERS, True)[0][data])
    hit = np.zeros(len(starts), bool)
    stems: dict[int, list[str]] = {}
    for stem in INSULTS:
        stems.setdefault(len(stem.encode()), []).append(stem)
    for size, names in stems.items():
        some = np.flatnonzero((ends - starts >= size) & (ends - starts <= size + ENDING))
        hit[some] |= _among(window(sums, starts[some], starts[some] + size) ^ U64(size), names)
    return hit


def _near(what: np.ndarray, address: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which of the words ``what`` have an address among the ``NEAR`` words of their text on either side."""
    at = np.flatnonzero(what)
    upto = np.append(0, np.cumsum(address))
    low = np.maximum(at - NEAR, np.searchsorted(owner, owner[at], side="left"))
    high = np.minimum(at + NEAR + 1, np.searchsorted(owner, owner[at], side="right"))
    out = np.zeros(len(what), bool)
    out[at] = upto[high] > upto[low]
    return out


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, -1 nothing."""
    return np.where(bad, 0, np.where(good, 1, -1))


def groups(column: pa.Array) -> Iterator[Group]:
    """Votes and hashed words of the texts, in groups of bounded size."""
    data, offsets = utf8(column)
    k = 0
    while k < len(column):
        upto = max(k + 1, int(np.searchsorted(offsets, offsets[k] + GROUP_BYTES, side="right")) - 1)
        yield _group(data[offsets[k] : offsets[upto]], offsets[k : upto + 1] - offsets[k], k)
        k = upto


def _group(data: np.ndarray, offsets: np.ndarray, first: int) -> Group:
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    # A line feed after each text, so that words and lines end there.
    laid = np.full(len(data) + rows, 0x0A, np.uint8)
    inside = np.ones(len(laid), bool)
    inside[offsets[1:] + np.arange(rows)] = False
    laid[inside] = data
    begins = offsets[:-1] + np.arange(rows)

    def count(members: bytes) -> np.ndarray:
        table = np.zeros(256, np.int64)
        table[list(members)] = 1
        return np.add.reduceat(table[laid], begins)

    starts, ends, hashes = words(laid, SPACES, lower=True)
    owner = np.searchsorted(begins, starts, side="right") - 1
    n = np.bincount(owner, minlength=rows)
    chars = np.bincount(owner, ends - starts, minlength=rows)
    some = np.maximum(n, 1)
    line_at, _, line_hash = words(laid, b"\n")
    line_of = np.searchsorted(begins, line_at, side="right") - 1
    lines = np.bincount(line_of, minlength=rows)
    order = np.lexsort((line_hash, line_of))
    again = np.append(False, (line_hash[order][1:] == line_hash[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])) if len(order) else np.empty(0, bool)
    repeats = np.bincount(line_of[order], again, minlength=rows) / np.maximum(lines, 1)
    symbols = count(SYMBOLS) / np.maximum(chars, 1)
    capitals = count(bytes(range(65, 91))) / np.maximum(chars, 1)
    stops = count(b".") / some
    marks = count(b"!?") / some
    size = chars / some
    letters_at, letters_end, bare = words(laid, LETTERS, lower=True)
    bare_owner = np.searchsorted(begins, letters_at, side="right") - 1

    def texts(which: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of[which], minlength=rows)

    hit = insulting(laid, letters_at, letters_end)
    address = _among(bare, ADDRESS)
    insults = texts(hit, bare_owner)
    ill = texts(_near(hit | _among(bare, NEGATIVE), address, bare_owner), bare_owner)
    # Words of capitals alone, and doubled marks after a word.
    large = np.concatenate(([0], np.cumsum((laid >= 65) & (laid <= 90))))
    shouts = (letters_end - letters_at > 3) & (large[letters_end] - large[letters_at] == letters_end - letters_at)
    after, then = (laid[np.minimum(letters_end + k, len(laid) - 1)] for k in (0, 1))
    shouts |= (after == 0x21) & (then == 0x21)
    loud = texts(_near(shouts, address, bare_owner), bare_owner)
    # Insults that show only when digits and signs are read as the letters they look like.
    shown = np.frombuffer(laid.tobytes().translate(DISGUISE), np.uint8)
    shown_at, shown_end, _ = words(shown, LETTERS, lower=True)
    seen = insulting(shown, shown_at, shown_end)
    plain = np.append(0, np.cumsum(np.bincount(letters_at[hit], minlength=len(laid) + 1)))
    seen &= plain[shown_end] == plain[shown_at]
    hidden = texts(seen, np.searchsorted(begins, shown_at, side="right") - 1)
    said = insults + hidden
    nothing, never = n == 0, np.zeros(rows, bool)
    table = np.zeros(256, np.int64)
    table[list(SYMBOLS)] = 1
    upto = np.concatenate(([0], np.cumsum(table[laid])))
    marked = np.bincount(owner, upto[ends] > upto[starts], minlength=rows) / some
    votes = {
        "plain": _vote((symbols < 0.001) & (marks < 0.05) & (capitals < 0.15), nothing),
        "symbols": _vote(never, symbols > 0.02),
        "marked_words": _vote(symbols == 0, marked > 0.1),
        "capitals": _vote(never, capitals > 0.4),
        "capital_words": _vote((capitals > 0) & (capitals < 0.1), count(bytes(range(65, 91))) > 2 * n),
        "lines": _vote(never, repeats > 0.3),
        "word_size": _vote(never, size > 20),
        "marks": _vote(marks == 0, marks > 0.2),
        "insult": _vote((said == 0) & (ill == 0), insults > 0),
        "address": _vote((ill == 0) & (hidden == 0) & (insults == 0), ill > 0),
        "shouting": _vote(never, loud > 0),
        "disguise": _vote(never, hidden > 0),
        "insult_share": _vote((said + ill) / some < 0.0005, said / some > 0.01),
    }
    # Hashed words, letters apart from their case and marks; length and marks have bins of their own.
    shape = np.arange(rows)
    signs = [np.digitize(x, [0.002, 0.01, 0.05, 0.2, 0.5]) for x in (symbols, capitals, stops, marks, repeats)] + [np.digitize(n, [5, 15, 40, 100, 1000])]
    extra = [BINS - 64 + 8 * j + s for j, s in enumerate(signs)]
    bins = np.concatenate([(bare % U64(BINS - 64)).astype(np.int64), *extra])
    # Which bins a text has, not how often, so that a rare word counts in a long text too.
    both = np.sort(np.concatenate([bare_owner, *[shape] * len(extra)]) * BINS + bins)
    both = both[np.append(True, both[1:] != both[:-1])]
    return Group(first, rows, both % BINS, both // BINS, votes)


def patterns(g: Group, kind: str) -> np.ndarray:
    """One number for each text's votes, in base three."""
    out = np.zeros(g.rows, np.int64)
    for name in KINDS[kind]:
        out = out * 3 + g.votes[name] + 1
    return out


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Accuracies (labeller, class, vote) and the probability of good for each pattern of votes.

    Labellers are taken as independent given the class. They start at an accuracy above chance,
    which also tells the classes apart.
    """
    labellers = votes.shape[1]
    chance = np.empty((labellers, 2, 3))
    first = np.array([[0.6, 0.3, 0.1], [0.03, 0.5, 0.47]])  # votes bad, nothing, good of the classes bad and good
    chance[:] = first
    prior = np.array([0.2, 0.8])
    share = np.zeros(len(votes))
    for _ in range(steps):
        log = np.tile(np.log(prior), (len(votes), 1))
        for j in range(labellers):
            log += np.log(chance[j][:, np.array([1, 0, 2])[votes[:, j] + 1]]).T
        log -= log.max(axis=1, keepdims=True)
        weight = np.exp(log)
        weight /= weight.sum(axis=1, keepdims=True)
        share = weight[:, 1]
        mass = weight * counts[:, None]
        prior = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
        for j in range(labellers):
            for vote, place in ((-1, 1), (0, 0), (1, 2)):
                chance[j][:, place] = mass[votes[:, j] == vote].sum(axis=0)
            chance[j] += 10 * first
            chance[j] /= chance[j].sum(axis=1, keepdims=True)
    return chance, share


@dataclass
class Scorer:
    weights: dict[str, np.ndarray]
    labels: dict[str, np.ndarray]

    def rate(self, g: Group, kind: str) -> np.ndarray:
        w = self.weights[kind]
        return 1 / (1 + np.exp(-np.clip(np.bincount(g.owner, w[g.bins], minlength=g.rows) + w[-1], -30, 30)))


def label_model(docs: DataFrame) -> dict[str, np.ndarray]:
    """The probability of good for every pattern of votes, from the patterns of all documents."""

    def count(batches):
        found = {kind: np.zeros(3 ** len(names), np.int64) for kind, names in KINDS.items()}
        for batch in batches:
            for g in groups(batch.column("text")):
                for kind in KINDS:
                    found[kind] += np.bincount(patterns(g, kind), minlength=len(found[kind]))
        for kind, n in found.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(some), "pattern": some, "n": n[some]})

    rows = docs.select("text").mapInArrow(count, "kind string, pattern bigint, n bigint").groupBy("kind", "pattern").agg(F.sum("n").alias("n")).collect()
    labels = {}
    for kind, names in KINDS.items():
        some = sorted((r["pattern"], r["n"]) for r in rows if r["kind"] == kind)
        out = np.full(3 ** len(names), 0.5)
        if some:
            pattern, n = np.array(some).T
            votes = pattern[:, None] // 3 ** np.arange(len(names))[::-1] % 3 - 1
            out[pattern] = expectation_maximisation(votes, n.astype(float))[1]
        labels[kind] = out
    return labels


def in_sample(sample: int, rows: int) -> Column:
    """Whether a row is among about ``sample`` of ``rows`` rows: 63 bits of its hash tell shares of any size."""
    share = min(1.0, sample / max(rows, 1))
    return F.xxhash64("doc_id", "text").bitwiseAND(F.lit(2**63 - 1)) <= min(2**63 - 1, int(share * 2**63))


def train(docs: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Labels from all documents; a scorer from at most about ``sample`` of them, chosen by hash."""
    labels = label_model(docs)
    rows = docs.count()
    chosen = docs.select("doc_id", "text").filter(in_sample(sample, rows))
    # Dealt anew, so that no task learns from texts of one kind alone.
    parts = min(PARTS, 1 + rows // 1000)
    chosen = chosen.repartition(parts, F.xxhash64("text", "doc_id"))
    scorer = Scorer({kind: np.zeros(BINS + 1) for kind in KINDS}, labels)

    def improve(batches, start):
        s = Scorer({k: w.copy() for k, w in start.value.weights.items()}, start.value.labels)
        past = {k: np.full(BINS + 1, 1e-4) for k in KINDS}
        seen = 0
        for batch in batches:
            for g in groups(batch.column("text")):
                for kind in KINDS:
                    target = s.labels[kind][patterns(g, kind)]
                    # Both classes count alike, however rare one is.
                    good = target > 0.5
                    weight = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum()))
                    for _ in range(PASSES):
                        slope = (s.rate(g, kind) - target) * weight
                        step = np.append(np.bincount(g.bins, slope[g.owner], minlength=BINS), slope.sum())
                        past[kind] += step * step
                        s.weights[kind] -= RATE * (step / np.sqrt(past[kind]) + DECAY * s.weights[kind])
                seen += g.rows
        for kind, w in s.weights.items():
            yield pa.RecordBatch.from_pydict({"kind": [kind], "n": pa.array([seen], pa.int64()), "body": [w.astype("<f4").tobytes()]})

    def mean(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        total = np.zeros(BINS + 1)
        for k, body in zip(n, table.column("body"), strict=True):
            total += k * np.frombuffer(body.as_buffer(), "<f4")
        body = (total / max(n.sum(), 1)).astype("<f4").tobytes()
        return pa.table({"kind": table.column("kind").slice(0, 1), "n": [int(n.sum())], "body": pa.array([body], pa.binary())})

    schema = "kind string, n bigint, body binary"
    for _ in range(ROUNDS):
        start = docs.sparkSession.sparkContext.broadcast(scorer)
        found = chosen.mapInArrow(lambda batches, s=start: improve(batches, s), schema).filter("n > 0")
        for r in found.groupBy("kind").applyInArrow(mean, schema).collect():
            scorer.weights[r["kind"]] = np.frombuffer(r["body"], "<f4").astype(float)
    return scorer


def classify(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, weak_label, score, insult_score, kept of every row of ``docs`` (doc_id, text).

    ``score`` is the probability of good text, ``insult_score`` that of insults; a document is
    kept if the first is at least and the second below one half. Null and empty texts have no
    words and are rated by their shape, which is bad; repeated rows are rated alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def rate(batches):
        for batch in batches:
            label, good, mild = (np.zeros(batch.num_rows) for _ in range(3))
            for g in groups(batch.column("text")):
                here = slice(g.first, g.first + g.rows)
                label[here] = shared.value.labels["quality"][patterns(g, "quality")]
                good[here] = shared.value.rate(g, "quality")
                mild[here] = shared.value.rate(g, "toxicity")
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "weak_label": label, "score": good, "insult_score": 1 - mild, "kept": (good >= 0.5) & (mild > 0.5)}
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        rate, "doc_id bigint, weak_label double, score double, insult_score double, kept boolean"
    )
