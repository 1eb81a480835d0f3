"""Sequence model of texts: a Markov chain with hidden regimes, fitted by expected counts.

A text is a chain of characters. In the neutral regime it moves as every text does, in the telling
regime of a label as only texts of that label do. Which regime holds at a character is hidden. The
likelihood of a text under either label is summed over all paths through the regimes, so a short
telling passage counts whatever stands around it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.session import stage

#: Characters of context.
ORDER = 3
#: Symbols before the listed ones: the start of a text, then letters, digits, spaces and others that are not listed.
CLASSES = 5
#: Characters that one step of the recursion covers, and characters held at once.
CHUNK = 128
GROUP_CHARS = 1 << 19
#: Standard errors by which a label's count must exceed the other's to be telling.
ERRORS = 3.0
#: Weight of the shorter context beside the counts of a longer one.
BACKOFF = 2.0
#: Expected counts are summed as multiples of this share of an occurrence, so that sums do not depend on their order.
UNIT = 1.0 / (1 << 16)


def _class_of(symbol: str) -> int:
    return 1 if symbol.isalpha() else 2 if symbol.isdigit() else 3 if symbol.isspace() else 4


@dataclass(frozen=True)
class Alphabet:
    """The listed characters by code point; all others are known by their class."""

    points: np.ndarray

    @classmethod
    def fit(cls, texts: DataFrame, text: str, listed: int) -> Alphabet:
        """The characters that most texts have, ties by character."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter[str] = Counter()
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    seen.update(set((t or "").lower()))
            points = [ord(c) for c in seen]
            yield pa.RecordBatch.from_arrays([pa.array(points, pa.int32()), pa.array(list(seen.values()), pa.int64())], ["c", "n"])

        counted = texts.select(text).mapInArrow(run, "c int, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
        rows = counted.orderBy(F.desc("n"), "c").limit(listed).collect()
        return cls(np.array(sorted(r["c"] for r in rows), np.uint32))

    @property
    def size(self) -> int:
        return CLASSES + len(self.points)

    @cached_property
    def _codes(self) -> np.ndarray:
        """The symbol of every code point, -1 until it is met."""
        return np.full(0x110000, -1, np.int16)

    def cells(self, text: str) -> np.ndarray:
        """Of every character of the text, the number of its context and itself."""
        return self.cells_of([text])[0]

    def cells_of(self, texts: Sequence[str]) -> list[np.ndarray]:
        """``cells`` of every text."""
        lowered = [t.lower() for t in texts]
        lengths = np.array([len(t) for t in lowered], np.int64)
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self._codes.take(points)
        if (codes < 0).any():
            new = np.unique(points[codes < 0])
            at, known = np.searchsorted(self.points, new), np.isin(new, self.points)
            self._codes[new] = np.where(known, CLASSES + at, [0 if k else _class_of(chr(p)) for p, k in zip(new, known)])
            codes = self._codes.take(points)
        # every text begins after symbols of its start
        first = np.cumsum(lengths) - lengths
        padded = np.zeros(len(points) + ORDER * len(texts), np.int64)
        place = np.arange(len(points)) + np.repeat(ORDER * np.arange(1, len(texts) + 1), lengths)
        padded[place] = codes
        cell = codes.astype(np.int64)
        for i in range(1, ORDER + 1):
            cell += padded.take(place - i) * self.size**i
        return [cell[a : a + n] for a, n in zip(first.tolist(), lengths.tolist())]


def chain(counts: np.ndarray, size: int) -> np.ndarray:
    """Probability of every symbol after every context; longer contexts lean on shorter ones."""
    shaped = counts.reshape((size,) * (ORDER + 1))
    p = np.full(size, 1.0 / size)
    for order in range(ORDER + 1):
        level = shaped.sum(axis=tuple(range(ORDER - order)))
        p = (level + BACKOFF * p) / (level.sum(axis=-1, keepdims=True) + BACKOFF)
    return p.reshape(-1)


def _odds(counts: np.ndarray, neutral: np.ndarray, size: int) -> np.ndarray:
    """A telling chain against the neutral one, on which it leans: after a context without counts both are alike."""
    context = counts.reshape(-1, size).sum(axis=1).repeat(size)
    return ((counts / neutral + BACKOFF) / (context + BACKOFF)).astype(np.float32)


@dataclass(frozen=True)
class Regimes:
    """Odds of the telling against the neutral chain by cell, and moves between the two, for either label."""

    odds: np.ndarray
    start: np.ndarray
    moves: np.ndarray


@dataclass(frozen=True)
class Chunks:
    """Pieces of a group of texts, side by side.

    ``owner`` and ``nth`` are a piece's text and its number in it, in the order of the texts. The steps of the recursion
    take the pieces by falling length (``order``), so those that still have a character at a step come first:
    ``on`` of them. ``place`` is by step and piece the place of the character in the group.
    """

    owner: np.ndarray
    nth: np.ndarray
    order: np.ndarray
    on: list[int]
    place: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> Chunks:
        number = -(-lengths // CHUNK)
        owner = np.repeat(np.arange(len(lengths)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        begin = (np.cumsum(lengths) - lengths)[owner] + nth * CHUNK
        long = np.minimum(CHUNK, lengths[owner] - nth * CHUNK)
        order = np.argsort(-long, kind="stable")
        steps = int(long.max(initial=0))
        on = np.cumsum(np.bincount(long, minlength=steps + 1)[::-1])[::-1][1:].tolist()
        # what lies beyond a piece is read, but never taken
        place = np.minimum(begin[order] + np.arange(steps)[:, None], int(lengths.sum()) - 1)
        return cls(owner, nth, order, on, place)

    def valid(self) -> np.ndarray:
        return np.arange(len(self.order)) < np.array(self.on)[:, None]

    def turns(self) -> list[np.ndarray]:
        """The first pieces of all texts, the second ones, and so on."""
        by_number = np.argsort(self.nth, kind="stable")
        return np.split(by_number, np.cumsum(np.bincount(self.nth))[:-1])


def _transfers(chunks: Chunks, odds: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every chunk, the scaled product of its steps and the log of the scale; odds are by step and piece."""
    (stay, go), (back, keep) = moves
    n = len(chunks.order)
    whole = np.zeros((4, n))
    whole[0] = whole[3] = 1.0
    scale = np.zeros(n)
    for m, ratios in zip(chunks.on, odds):
        a, b, c, d = whole[:, :m]
        ratio = ratios[:m]
        new = np.empty((4, m))
        w, x, y, z = new
        np.add(a * stay, b * back, out=w)
        np.multiply(a * go + b * keep, ratio, out=x)
        np.add(c * stay, d * back, out=y)
        np.multiply(c * go + d * keep, ratio, out=z)
        top = new.max(axis=0)
        np.divide(new, top, out=whole[:, :m])
        scale[:m] += np.log(top)
    product, logs = np.empty((n, 2, 2)), np.empty(n)
    product[chunks.order], logs[chunks.order] = whole.T.reshape(-1, 2, 2), scale
    return product, logs


def _logs(chunks: Chunks, product: np.ndarray, scale: np.ndarray, start: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The log odds of every text against the neutral chain, and the regimes' weights before every chunk."""
    logs, before = np.zeros(n), np.empty((len(chunks.owner), 2))
    state = np.tile(start, (n, 1)).astype(float)
    for at in chunks.turns():
        text, own = chunks.owner[at], product[at]
        now = state[text]
        before[at] = now
        moved = now[:, :1] * own[:, 0] + now[:, 1:] * own[:, 1]
        total = moved.sum(axis=1)
        logs[text] += np.log(total) + scale[at]
        state[text] = moved / total[:, None]
    return logs, before


def _posterior(
    chunks: Chunks, odds: np.ndarray, product: np.ndarray, before: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The telling regime's share by step and piece; of every chunk the expected moves and the share at its begin."""
    after = np.ones((len(chunks.owner), 2))
    for at in chunks.turns()[:0:-1]:
        own, next_ = product[at], after[at]
        moved = own[:, :, 0] * next_[:, :1] + own[:, :, 1] * next_[:, 1:]
        after[at - 1] = moved / moved.sum(axis=1, keepdims=True)
    (stay, go), (back, keep) = moves
    n = len(chunks.order)
    forward = np.empty((2, len(chunks.on) + 1, n))
    forward[:, 0] = before[chunks.order].T
    for t, m in enumerate(chunks.on):
        f0, f1 = forward[:, t, :m]
        s0, s1 = f0 * stay + f1 * back, (f0 * go + f1 * keep) * odds[t, :m]
        total = s0 + s1
        np.divide(s0, total, out=forward[0, t + 1, :m])
        np.divide(s1, total, out=forward[1, t + 1, :m])
    share, expected, begin = np.zeros(odds.shape), np.zeros((4, n)), np.empty(n)
    a = after[chunks.order].T.copy()
    for t in range(len(chunks.on) - 1, -1, -1):
        m = chunks.on[t]
        f0, f1 = forward[:, t, :m]
        a0, h1 = a[0, :m], a[1, :m] * odds[t, :m]
        pairs = np.empty((4, m))
        np.multiply(f0, stay * a0, out=pairs[0])
        np.multiply(f0, go * h1, out=pairs[1])
        np.multiply(f1, back * a0, out=pairs[2])
        np.multiply(f1, keep * h1, out=pairs[3])
        pairs /= pairs.sum(axis=0)
        np.add(pairs[1], pairs[3], out=share[t, :m])
        expected[:, :m] += pairs
        b0, b1 = a0 * stay + h1 * go, a0 * back + h1 * keep
        total = b0 + b1
        np.divide(b0, total, out=a[0, :m])
        np.divide(b1, total, out=a[1, :m])
    all_moves = np.empty((n, 2, 2))
    all_moves[chunks.order], begin[chunks.order] = expected.T.reshape(-1, 2, 2), share[0]
    return share, all_moves, begin


def _groups(cells: list[np.ndarray]) -> Iterator[slice]:
    """Runs of neighbouring texts of a bounded length; a longer text is alone."""
    begin, size = 0, 0
    for i, c in enumerate(cells):
        if size and size + len(c) > GROUP_CHARS:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(c)
    if begin < len(cells):
        yield slice(begin, len(cells))


def log_odds(regimes: Regimes, cells: list[np.ndarray]) -> np.ndarray:
    """Of every text, its log odds against the neutral chain under label 0 and label 1; an empty text has 0."""
    out = np.zeros((len(cells), 2))
    for part in _groups(cells):
        own = cells[part]
        chunks = Chunks.of(np.array([len(c) for c in own], np.int64))
        if len(chunks.owner):
            placed = np.concatenate(own).take(chunks.place)
            for y in (0, 1):
                product, scale = _transfers(chunks, regimes.odds[y].take(placed).astype(float), regimes.moves[y])
                out[part, y] = _logs(chunks, product, scale, regimes.start[y], len(own))[0]
    return out


def _expect(
    regimes: Regimes | None, cells: list[np.ndarray], labels: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(regime, label, cells, expected counts, their squares by text)``; without regimes every character counts once.

    Negative cells are the moves of texts of the regime's own label: -1 to -4 from and to either
    regime, -5 and -6 the starts.
    """
    for part in _groups(cells):
        own, y_of = cells[part], labels[part]
        chunks = Chunks.of(np.array([len(c) for c in own], np.int64))
        if not len(chunks.owner):
            continue
        placed, valid = np.concatenate(own).take(chunks.place), chunks.valid()
        # the cells of either label's texts are put in order once for both regimes
        owner, width = chunks.owner[chunks.order], int(placed.max()) + 1
        sides = []
        for label in (0, 1):
            chosen = valid & (y_of[owner] == label)
            texts = np.broadcast_to(owner, placed.shape)[chosen]
            pairs, nth = np.unique(texts * width + placed[chosen], return_inverse=True)
            sides.append((chosen, len(pairs), nth, *np.unique(pairs % width, return_inverse=True)))
        for y in (0, 1):
            share = None
            if regimes is not None:
                odds = regimes.odds[y].take(placed).astype(float)
                product, scale = _transfers(chunks, odds, regimes.moves[y])
                before = _logs(chunks, product, scale, regimes.start[y], len(own))[1]
                share, expected, begin = _posterior(chunks, odds, product, before, regimes.moves[y])
                mine = y_of[chunks.owner] == y
                first = mine & (chunks.nth == 0)
                starts = [first.sum() - begin[first].sum(), begin[first].sum()]
                yield y, y, -np.arange(1, 7), np.concatenate([expected[mine].sum(axis=0).reshape(-1), starts]), np.zeros(6)
            for label, (chosen, number, nth, names, of_cell) in enumerate(sides):
                each = np.bincount(nth, None if share is None else share[chosen], number)
                yield y, label, names, np.bincount(of_cell, each, len(names)), np.bincount(of_cell, each * each, len(names))


Sums = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def _count(texts: DataFrame, alphabet: Alphabet, regimes: Regimes | None) -> Sums:
    """Expected counts and squares by regime and label, summed in tasks first; the last six places hold moves and starts."""
    shared = texts.sparkSession.sparkContext.broadcast(regimes)
    width = alphabet.size ** (ORDER + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            cells = alphabet.cells_of([t or "" for t in batch.column(0).to_pylist()])
            for regime, label, names, *values in _expect(shared.value, cells, batch.column(1).to_numpy(zero_copy_only=False)):
                sums.setdefault((regime, label), np.zeros((2, width + 6)))[:, names] += values
        for (regime, label), total in sums.items():
            units = np.rint(total / UNIT).astype(np.int64)
            kept = np.flatnonzero(units[0])
            for at in range(0, len(kept), 1 << 16):
                some = kept[at : at + (1 << 16)]
                sides = [pa.array(np.full(len(some), v, np.int32)) for v in (regime, label)]
                yield pa.RecordBatch.from_arrays([*sides, pa.array(some), *map(pa.array, units[:, some])], ["regime", "label", "cell", "n", "squares"])

    counted = texts.mapInArrow(run, "regime int, label int, cell bigint, n bigint, squares bigint")
    summed = counted.groupBy("regime", "label", "cell").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares")).toArrow()
    regime, label, cell, *values = (c.to_numpy() for c in summed.columns)
    out = {}
    for r, y in ((0, 0), (0, 1), (1, 0), (1, 1)):
        own = (regime == r) & (label == y)
        total = np.zeros((2, width + 6))
        total[:, cell[own]] = np.stack([v[own] for v in values]) * UNIT
        out[r, y] = total[0], total[1]
    return out


def _refit(found: Sums, plain: dict[int, np.ndarray], size: int, before: Regimes | None) -> Regimes:
    """Regimes from expected counts.

    Telling is what a label has beyond its share of the other label's count by more than the error of
    both; the neutral chain keeps the rest. Texts, not characters, are drawn independently: a passage
    that one text repeats has a large error.
    """
    sizes = [max(plain[y].sum(), 1.0) for y in (0, 1)]
    telling = []
    for y in (0, 1):
        (own, own_squares), (other, other_squares) = ([v[:-6] for v in found[y, label]] for label in (y, 1 - y))
        ratio = sizes[y] / sizes[1 - y]
        beyond = own - ratio * other
        telling.append(np.where(beyond > ERRORS * np.sqrt(own_squares + ratio * ratio * other_squares), beyond, 0.0))
    neutral = chain(np.maximum(plain[0] + plain[1] - telling[0] - telling[1], 0.0), size)
    odds = np.stack([_odds(t, neutral, size) for t in telling])
    start, moves = np.full((2, 2), 0.5), np.tile([[0.98, 0.02], [0.1, 0.9]], (2, 1, 1))
    if before is not None:
        for y in (0, 1):
            # index -1 to -6 of the sums; one move of each kind is assumed
            tail = found[y, y][0][::-1][:6]
            counted = tail[:4].reshape(2, 2) + 1.0
            moves[y] = counted / counted.sum(axis=1, keepdims=True)
            start[y] = (tail[4:] + 1.0) / (tail[4:] + 1.0).sum()
    return Regimes(odds, start, moves)


@dataclass(frozen=True)
class SwitchingChain:
    """Alphabet and regimes; gives the log odds of texts under either label."""

    alphabet: Alphabet
    regimes: Regimes

    @classmethod
    def fit(cls, train: DataFrame, text: str, label: str, listed: int = 36, rounds: int = 3) -> SwitchingChain:
        """Every round sums expected counts over all texts labelled 0 or 1 and refits the regimes.

        Only sums by cell reach the driver, at most four rows for each cell of the alphabet, whatever the
        size of the corpus. Without texts of both labels nothing is telling.
        """
        texts = train.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label"))
        texts = stage(texts.where("label IN (0, 1)"), "sequence-texts")
        alphabet = Alphabet.fit(texts, "text", listed)
        found = _count(texts, alphabet, None)
        plain = {y: found[y, y][0][:-6] for y in (0, 1)}
        regimes = _refit(found, plain, alphabet.size, None)
        for _ in range(rounds):
            regimes = _refit(_count(texts, alphabet, regimes), plain, alphabet.size, regimes)
        return cls(alphabet, regimes)

    def log_odds(self, spark: SparkSession, text: Column) -> Column:
        """``array<double>``: the log odds of the whole text under label 0 and label 1; NULL counts as empty."""
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = shared.value
            for batch in batches:
                yield pd.Series(list(log_odds(model.regimes, model.alphabet.cells_of([t or "" for t in batch]))))

        return scored(text)

    def to_table(self, spark: SparkSession) -> DataFrame:
        """``part, place, value``: every number of the model."""
        parts = {"points": self.alphabet.points, "odds": self.regimes.odds, "start": self.regimes.start, "moves": self.regimes.moves}
        frames = [pd.DataFrame({"part": name, "place": np.arange(v.size), "value": v.reshape(-1).astype(float)}) for name, v in parts.items()]
        return spark.createDataFrame(pa.Table.from_pandas(pd.concat(frames, ignore_index=True), preserve_index=False))

    @classmethod
    def from_table(cls, table: DataFrame) -> SwitchingChain:
        rows = table.toArrow().to_pandas().sort_values("place")
        parts = {name: own["value"].to_numpy() for name, own in rows.groupby("part")}
        regimes = Regimes(
            parts["odds"].astype(np.float32).reshape(2, -1), parts["start"].reshape(2, 2), parts["moves"].reshape(2, 2, 2)
        )
        return cls(Alphabet(parts.get("points", np.zeros(0)).astype(np.uint32)), regimes)
