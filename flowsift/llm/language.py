"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.llm.tokens import Words, mix, pieces

#: Longest n-gram. Kind 0 of the model holds whole words, kind n the n-grams of n characters.
LONGEST = 5
#: Most frequent entries of each language that the model keeps, of words and of each n-gram length.
MAX_WORDS = 100_000
MAX_GRAMS = 30_000
#: Counted entries that a task holds before it hands them on.
HELD = 1 << 18
#: Words that count as independent evidence when the score is formed.
EVIDENCE = 30

UNKNOWN = "und"


def _spelled(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the chosen words, each between two spaces, and the number of its word for each."""
    texts = [words.data[a:b].tobytes() for a, b in zip(words.starts[chosen], words.ends[chosen])]
    points = np.frombuffer((" " + "  ".join(t.decode("utf-8", "replace") for t in texts) + " ").encode("utf-32-le"), np.uint32)
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # words hold no space, so spaces come in pairs around each word
    owner = (np.cumsum(points == 0x20) - 1) // 2
    return points.astype(np.uint64), owner


def _grams(points: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n neighbouring characters of one word, and the word's number."""
    m = len(points) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(m, n, np.uint64)
    for j in range(n):
        total = (total + points[j : j + m] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    same = (owner[:m] == owner[n - 1 :]) & ((points[:m] != 0x20) | (n > 1))
    return mix(total[same]), owner[:m][same]


def _summed(kind: np.ndarray, lang: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """One entry per language and hash of a single kind."""
    order = np.lexsort((key, lang))
    lang, key = lang[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (lang[1:] != lang[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return kind[at], lang[at], key[at], np.add.reduceat(times[order], at) if len(at) else times


def count_features(training: DataFrame) -> DataFrame:
    """``kind, hash, lang, times`` over the words and n-grams of ``lang, text`` rows, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            kind, lang, key, times = (np.concatenate(x) for x in zip(*parts))
            values = pa.array(list(names), pa.string()).take(pa.array(lang))
            return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key.view(np.int64)), values, pa.array(times)], ["kind", "hash", "lang", "times"])

        def settle() -> list[tuple[np.ndarray, ...]]:
            """Entries summed within each kind, so that one kind's arrays are sorted at a time."""
            kinds = sorted({int(h[0][0]) for h in held if len(h[0])})
            return [_summed(*(np.concatenate(x) for x in zip(*[h for h in held if len(h[0]) and h[0][0] == k]))) for k in kinds]

        for batch in batches:
            langs = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], np.int64)
            for row, data, offsets in pieces(batch.column(1)):
                words = Words(data, offsets, "letters", lower=True)
                of_word = langs[row + words.documents()]
                hashes = words.hashes()
                order = np.lexsort((hashes, of_word))
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
                at = np.flatnonzero(new)
                if not len(at):
                    continue
                distinct, times = order[at], np.diff(np.append(at, len(order))).astype(np.int64)
                held.append((np.zeros(len(at), np.int32), of_word[distinct], hashes[distinct], times))
                points, owner = _spelled(words, distinct)
                for n in range(1, LONGEST + 1):
                    keys, word = _grams(points, owner, n)
                    held.append(_summed(np.full(len(keys), n, np.int32), of_word[distinct][word], keys, times[word]))
                if sum(len(h[0]) for h in held) > HELD:
                    held[:] = settle()
                    if sum(len(h[0]) for h in held) > HELD // 2:
                        yield rows(held)
                        held.clear()
        if held:
            yield rows(settle())

    counted = training.select("lang", "text").mapInArrow(run, "kind int, hash bigint, lang string, times bigint")
    return counted.groupBy("kind", "hash", "lang").agg(F.sum("times").alias("times"))


@dataclass
class LanguageModel:
    """Log frequencies of the kept words and n-grams per language; its size depends on the number of languages only."""

    languages: list[str]
    usual: int  # the language of most training words
    keys: list[np.ndarray]
    logs: list[np.ndarray]

    def _find(self, kind: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[kind]
        if not len(keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return at, keys[at] == hashes

    def word_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """A row of log frequencies per word, and which words have any evidence."""
        hashes = words.hashes()
        at, known = self._find(0, hashes)
        scores = np.zeros((len(hashes), len(self.languages)), np.float32)
        scores[known] = self.logs[0][at[known]]
        missing, back = np.unique(hashes[~known], return_inverse=True)
        if len(missing):
            first = np.flatnonzero(~known)
            sample = np.zeros(len(missing), np.int64)
            sample[back[::-1]] = first[::-1]  # one place of every unknown word
            found = np.zeros((len(missing), len(self.languages)), np.float32)
            open_ = np.arange(len(missing))
            points, owner = _spelled(words, sample)
            for n in range(LONGEST, 0, -1):
                keys, word = _grams(points, owner, n)
                at_gram, hit = self._find(n, keys)
                hit &= np.isin(word, open_)
                number = np.bincount(word[hit], minlength=len(missing))
                for c in range(len(self.languages)):
                    total = np.bincount(word[hit], self.logs[n][at_gram[hit], c], minlength=len(missing))
                    found[:, c] += np.where(number > 0, total / np.maximum(number, 1), 0.0)
                open_ = open_[number[open_] == 0]
                if not len(open_):
                    break
            scores[first] = found[back]
            known[first] = ~np.isin(back, open_)
        return scores, known

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and score of each document."""
        words = Words(data, offsets, "letters", lower=True)
        scores, known = self.word_scores(words)
        seen = np.concatenate([[0], np.cumsum(known)])
        n = np.diff(seen[words.first])
        mean = np.zeros((len(n), len(self.languages)))
        for c in range(len(self.languages)):
            total = np.concatenate([[0.0], np.cumsum(scores[:, c], dtype=np.float64)])
            mean[:, c] = np.diff(total[words.first]) / np.maximum(n, 1)
        best = np.where(n > 0, mean.argmax(1), self.usual)
        gap = (mean - mean.max(1, keepdims=True)) * np.minimum(n, EVIDENCE)[:, None]
        return best, 1.0 / np.exp(gap).sum(1)


def _most_frequent(entries: DataFrame, n_languages: int, each: int, total: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order, and their counts per language, of the ``each`` most frequent entries of every language.

    If there are more than ``total``, the first of every language stay, then the second of every one, and so on.
    """
    hashes, counts, ranks = [], [], []
    for i in range(n_languages):
        table = entries.where(F.col(f"l{i}") > 0).orderBy(F.desc(f"l{i}"), "hash").limit(each).toArrow()
        hashes.append(table.column("hash").to_numpy().view(np.uint64))
        counts.append(np.column_stack([table.column(f"l{j}").to_numpy() for j in range(n_languages)]))
        ranks.append(np.arange(table.num_rows))
    found, rows, rank = np.concatenate(hashes), np.concatenate(counts), np.concatenate(ranks)
    order = np.lexsort((rank, found))
    new = np.ones(len(order), bool)
    new[1:] = found[order][1:] != found[order][:-1]
    at = order[new]
    if total is not None:
        at = at[np.lexsort((found[at], -rows[at].sum(1), rank[at]))[:total]]
        at = at[np.argsort(found[at])]
    return found[at], rows[at].astype(float)


def fit_languages(training: DataFrame, max_words: int | None = None, max_grams: int | None = None) -> LanguageModel:
    """Counts every word and n-gram of ``lang, text`` rows; the model keeps the most frequent of each language.

    Of each language that is ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams of each length, whatever the
    other languages have. ``max_words`` and ``max_grams`` bound the entries of all languages together;
    the languages then share them evenly. Rows without a language or text are left out. The number of
    distinct languages must be small: the driver receives ``MAX_WORDS + 5 * MAX_GRAMS`` entries for each,
    with one count per language.
    """
    usable = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.lower("text").alias("text"))
    languages = sorted(r.lang for r in usable.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], 0, [np.zeros(0, np.uint64)] * (LONGEST + 1), [np.zeros((0, 0), np.float32)] * (LONGEST + 1))
    columns = [F.sum(F.when(F.col("lang") == x, F.col("times")).otherwise(0)).alias(f"l{i}") for i, x in enumerate(languages)]
    entries = count_features(usable).groupBy("kind", "hash").agg(*columns).persist()
    sums = entries.groupBy("kind").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(len(languages))]).collect()
    totals = {r.kind: np.array(r[1:], float) for r in sums}
    keys, logs = [], []
    for kind in range(LONGEST + 1):
        total = max_words if kind == 0 else max_grams
        each = total if total is not None else MAX_WORDS if kind == 0 else MAX_GRAMS
        hashes, counts = _most_frequent(entries.where(F.col("kind") == kind), len(languages), each, total)
        of = np.maximum(totals.get(kind, np.ones(len(languages))), 1.0)
        # an entry that a language never had costs the same in all: a tenth of one sighting in the largest
        logs.append(np.where(counts > 0, np.log(np.maximum(counts, 1.0) / of), np.log(0.1 / of.max())).astype(np.float32))
        keys.append(hashes)
    entries.unpersist()
    return LanguageModel(languages, int(np.argmax(totals.get(0, np.ones(len(languages))))), keys, logs)


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns with ``lang_pred, score`` of every whole text.

    A word is a run of letters in lower case. Its evidence is the log frequency of the word in each
    language; a word that the model lacks is scored by its 5-grams, where it has none of those by
    4-grams, and so on. The language of the largest mean wins, on a tie the first by name. The score
    is its share after up to ``EVIDENCE`` words. ``und`` with score 0 for a NULL text, one without a
    letter, or an empty model; a text with letters of which nothing is known gets the language of most
    training words and an even score. Repeated rows are scored each; an empty table gives no rows.
    Kept columns named like the added ones are overwritten, other columns are not read.
    """
    kept = [c for c in keep if c not in ("lang_pred", "score")]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            letters = batch.column(len(kept) + 1).to_numpy(zero_copy_only=False).astype(bool)
            for row, data, offsets in pieces(batch.column(len(kept))):
                has = letters[row : row + len(offsets) - 1]
                if model.languages:
                    best, score = model.predict(data, offsets)
                    best, score = np.where(has, best, len(model.languages)), np.where(has, score, 0.0)
                else:
                    best, score = np.zeros(len(has), np.int64), np.zeros(len(has))
                own = [batch.column(i).slice(row, len(has)) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(names[best], pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])

    content = F.col(text)
    has_letter = F.coalesce(content.rlike(r"\p{L}"), F.lit(False))
    return docs.select(*kept, F.lower(content).alias("lower_text"), has_letter.alias("has_letter")).mapInArrow(run, schema)


def learn_and_identify(docs: DataFrame, in_training: Column) -> DataFrame:
    """Learns from the rows for which ``in_training`` holds and identifies all rows."""
    return identify(docs, fit_languages(docs.where(in_training)))
