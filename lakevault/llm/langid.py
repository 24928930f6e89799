"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its prefixes and suffixes, its character n-grams and its entry in a lexicon of frequent
words; the transitions between the languages of neighbouring words are learned. Forward-backward labels every
word of a line, so a text that switches languages is labelled piece by piece; a text's language is that with
the largest share of letters.
"""
from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm import crf
from lakevault.llm.common import WordTable, kept, lean, slices, texts

UNKNOWN = "und"
# Words are runs of letters; a line break ends a chain.
TOKEN = re.compile(r"[^\W\d_]+|\n")
# Bounds of the sample that the model is fitted to: rows of a language, and bytes of a text in it.
SAMPLE_ROWS, SAMPLE_BYTES = 150, 20_000
# Languages that a model tells apart at most.
LANGUAGES = 200
# Distinct words whose scores a worker remembers.
CACHED_WORDS = 100_000
LEXICON_WORDS = 500
AFFIX, GRAMS = 3, (2, 3)
SLICE = 2 << 20


def features(word: str, lexicon: dict[str, list[str]]) -> list[str]:
    """Affixes, character n-grams and lexicon entries of a lower-case word."""
    found = [f"<{word[:k]}" for k in range(1, min(AFFIX, len(word)) + 1)]
    found += [f"{word[-k:]}>" for k in range(1, min(AFFIX, len(word)) + 1)]
    for size in GRAMS:
        found += [word[at : at + size] for at in range(len(word) - size + 1)]
    return found + lexicon.get(word, [])


@dataclass
class LanguageModel:
    """Learned weights: rows of ``weights`` by feature (row 0 is for unseen ones), log transitions, log first labels."""

    languages: list[str]
    lexicon: dict[str, list[str]]
    rows: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of every language for each word, then its number of letters."""
        get, flat, ends = self.rows.get, [], []
        for word in words:
            flat += [row for name in features(word, self.lexicon) if (row := get(name))]
            ends.append(len(flat))
        picked = self.weights[np.array(flat, np.int64)] if flat else np.zeros((0, len(self.languages)))
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(picked, 0)])
        ends = np.array(ends, np.int64)
        scores = total[ends] - total[np.concatenate([[0], ends[:-1]])]
        letters = [[sum(map(str.isalpha, word))] for word in words]
        return np.concatenate([scores, letters], 1).reshape(-1), np.full(len(words), scores.shape[1] + 1)


def _pieces(lines: list[str]) -> tuple[list[str], np.ndarray]:
    words = [TOKEN.findall(line.lower()) for line in lines]
    return [word for row in words for word in row], np.array([len(row) for row in words], np.int64)


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, rounds: int = 40) -> LanguageModel | None:
    """Fit the model to texts of known language (columns text, lang); None if there are none with letters.

    Fitted on the driver to a sample of about ``sample_rows`` different texts of each language (twice that at most), of
    at most ``sample_bytes`` bytes each; which texts it takes depends on their contents alone, and copies count once. More
    than ``LANGUAGES`` values of lang are refused: the model, and what the driver holds, would grow with them.
    """
    usable = labelled.select("text", "lang").where("lang is not null and text is not null").where(F.octet_length("text") <= sample_bytes)
    texts_ = F.approx_count_distinct(F.xxhash64("text"))
    counts = {row["lang"]: row["n"] for row in usable.groupBy("lang").agg(texts_.alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different values of lang")
    if not counts:
        return None
    places = F.pmod(F.xxhash64("text", "lang"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(1e6 * min(1.0, sample_rows / n)) + 1)])
    near = usable.where(places < share[F.col("lang")]).distinct()
    own = Window.partitionBy("lang").orderBy(places, "text")
    sample = near.withColumn("place", F.row_number().over(own)).where(F.col("place") <= 2 * sample_rows).orderBy("lang", "place").collect()
    languages = sorted(counts)
    lines, labels = [], []
    for row in sample:
        for line in row["text"].split("\n"):
            lines.append(line)
            labels.append(languages.index(row["lang"]))
    words, lengths = _pieces(lines)
    labels = np.repeat(np.array(labels, np.int64), lengths)
    lengths = lengths[lengths > 0]
    if not words:
        return None
    seen: list[Counter] = [Counter() for _ in languages]
    for word, label in zip(words, labels.tolist()):
        seen[label][word] += 1
    lexicon: dict[str, list[str]] = {}
    for language, found in zip(languages, seen):
        for word, n in sorted(found.items(), key=lambda item: (-item[1], item[0]))[:LEXICON_WORDS]:
            if n > 1:
                lexicon.setdefault(word, []).append(f"={language}")
    distinct = {word: k for k, word in enumerate(dict.fromkeys(words))}
    place = np.array([distinct[word] for word in words], np.int64)
    rows: dict[str, int] = {}
    flat, sizes = [], []
    for word in distinct:
        found = [rows.setdefault(name, len(rows) + 1) for name in features(word, lexicon)]
        flat += found
        sizes.append(len(found))
    flat, owner = np.array(flat, np.int64), np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)

    def emit(weights):
        total = np.concatenate([np.zeros((1, len(languages))), np.cumsum(weights[flat], 0)])
        return (total[ends] - total[ends - sizes])[place]

    def back(gradient):
        by_word = np.stack([np.bincount(place, gradient[:, k], len(sizes)) for k in range(len(languages))], 1)[owner]
        return np.stack([np.bincount(flat, by_word[:, k], len(rows) + 1) for k in range(len(languages))], 1)

    start = np.zeros((len(rows) + 1, len(languages)))
    weights, moves, first = crf.fit(emit, back, start, labels, lengths, rounds, rate=0.1, decay=1e-6)
    return LanguageModel(languages, lexicon, rows, weights, moves, first)


def label_languages(docs: DataFrame, model: LanguageModel | None, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (the language's share of the text's letters, 0 to 1).

    One row for each row. A text that is null or has no letter is ``und`` with score 0, as is every text if
    there is no model. Ties go to the language that sorts first. Columns lang_pred and score are replaced.
    """
    rows = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in ("lang_pred", "score")])
    if model is None:
        return rows.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    kinds, own = len(model.languages), f"langid {uuid.uuid4().hex}"

    def label(batches):
        model = shared.value
        names = np.array(model.languages, object)
        table = kept(own, lambda: WordTable(model.scores, np.float32, words=CACHED_WORDS))
        moves, first = model.moves, model.first
        for batch in slices(batches, text_column, SLICE):
            codes, ends = table.encode(lambda text: TOKEN.findall(text.lower()), texts(batch, text_column))
            values = table.flat.reshape(-1, kinds + 1)
            breaks = codes == table.codes.get("\n", -1)
            words = np.flatnonzero(~breaks)
            owner = np.searchsorted(ends, words, side="right")
            # A chain is what lies between line breaks and ends of texts.
            chain = np.cumsum(breaks)[words] + owner
            lengths = np.diff(np.flatnonzero(np.diff(chain, append=-1)), prepend=-1)
            found = values[codes[words]]
            chances = crf.marginals(found[:, :kinds], lengths, moves, first) * found[:, kinds:]
            shares = np.stack([np.bincount(owner, chances[:, k], len(ends)) for k in range(kinds)], 1)
            letters = np.bincount(owner, found[:, kinds], len(ends))
            best = shares.argmax(1)
            score = np.where(letters > 0, shares.max(1) / np.maximum(letters, 1), 0.0).clip(0, 1)
            language = np.where(letters > 0, names[best], UNKNOWN)
            more = [pa.array(language.tolist(), pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "lang_pred", "score"])

    schema = rows.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(lean(label, own), schema)
