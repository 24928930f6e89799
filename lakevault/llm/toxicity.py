"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton in folded text.

Folding undoes disguises: accents, look-alike letters of other scripts, and digits and signs that stand for letters.
The lexicon holds beginnings of words, each with the log odds of toxic against clean documents that have such a word. One
walk over a folded text finds all of them, and the exception phrases in which they do not count. The weights found, as
they are and as a share of the text's length, go through a fitted logistic curve.
"""
from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import slices, texts

# Bounds of the sample that the model is fitted to: rows of a label, and bytes of a text in it.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_BYTES = 1_500, 4_500, 20_000
# Lengths of the beginnings of words that can enter the lexicon, and how many toxic texts must have one.
SHORTEST, LONGEST, LEAST = 3, 12, 4
# Log likelihood ratio (nats) that a beginning needs beyond the logarithm of the number of all candidates.
MARGIN = 3.0
# Log odds that a beginning needs at least.
EVIDENCE = 2.0
# Of texts with the same smallest word hashes, in one of so many bands of so many hashes, one is counted.
BANDS, HASHES = 4, 3

# English insults that count without any labels, and phrases in which such words are none.
SEEDS = ["idiot", "moron", "stupid", "loser", "scum", "pathetic", "worthless", "disgusting", "trash", "imbecile", "bastard"]
EXCEPTIONS = [
    "trash can", "trash bin", "trash bag", "trash collection", "take out the trash", "clown fish", "clown car", "pond scum", "sore loser rule",
    "stupid question", "worthless stock", "idiot proof", "idiot light",
]
SEED_WEIGHT = 3.0

# Letters of other scripts by the Latin letter they look like.
LOOKALIKES = {
    "a": "аαɑ", "b": "ьвβ", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һн", "i": "іıιɩ", "j": "јϳ", "k": "кκ", "l": "ӏǀ", "m": "мϻ", "n": "пηո",
    "o": "оοσօ", "p": "рρ", "q": "ԛ", "r": "гᴦ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
# Digits and signs by the letter they stand for inside a word.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}

_letters = {ord(other): letter for letter, others in LOOKALIKES.items() for other in others}
# Combining marks, soft hyphens and blanks of no width vanish.
_letters.update(dict.fromkeys([*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF]))
_signs = "".join(map(re.escape, STANDS_FOR))
_inside = re.compile(f"(?<=[a-z])[{_signs}]+(?=[a-z])|(?<![^\\W_])(?<![{_signs}])[{_signs}](?=[a-z][a-z{_signs}]*[a-z])")
_some_sign = re.compile(f"[{_signs}]")
_no_letters = re.compile(r"[\W\d_]+")
_stood = str.maketrans(STANDS_FOR)


def fold(text: str) -> str:
    """Words in plain lower-case letters, one blank before and behind each."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower().translate(_letters)
    else:
        text = text.lower()
    if _some_sign.search(text):
        text = _inside.sub(lambda found: found[0].translate(_stood), text)
    return f" {_no_letters.sub(' ', text).strip()} "


@dataclass
class ToxicityModel:
    """Lexicon entries with weights, exception phrases (all folded, entries with a blank in front), the curve, and the score of texts without words."""

    lexicon: dict[str, float]
    exceptions: list[str]
    curve: np.ndarray
    base: float
    _automaton: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for phrase in self.exceptions:
                found.add_word(phrase, (len(phrase), 0.0))
            for entry, weight in self.lexicon.items():
                if entry not in found:
                    found.add_word(entry, (len(entry), weight))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """Where in a folded text a word with an entry begins, and the highest weight of its entries; none inside exceptions."""
        words: dict[int, float] = {}
        spans = []
        if len(self.automaton()):
            for end, (size, weight) in self.automaton().iter(folded):
                start = end + 1 - size
                if weight:
                    words[start] = max(weight, words.get(start, weight))
                else:
                    spans.append((start, end))
        if spans:
            words = {at: weight for at, weight in words.items() if not any(start <= at < end for start, end in spans)}
        return sorted(words.items())

    def features(self, folded: list[str]) -> np.ndarray:
        """1, weight found, and weight per hundred words, both as logarithms."""
        rows = np.empty((len(folded), 3))
        for at, text in enumerate(folded):
            weight = sum(weight for _, weight in self.hits(text))
            words = max(1, text.count(" ") - 1)
            rows[at] = 1.0, math.log1p(weight), math.log1p(100.0 * weight / words)
        return rows

    def scores(self, texts: list[str]) -> np.ndarray:
        folded = [fold(text) for text in texts]
        odds = np.clip(self.features(folded) @ self.curve, -30, 30)
        wordless = np.array([not text.strip() for text in folded], bool)
        return np.where(wordless, self.base, 1 / (1 + np.exp(-odds)))


def beginnings(word: str) -> list[str]:
    """All beginnings of a word that could enter the lexicon, and the whole word, with the blanks around them."""
    return [f" {word[:size]}" for size in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [f" {word} "]


def apart(folded: list[str]) -> list[set[str]]:
    """The words of each text, of texts that hardly differ only those of the first (by shared smallest hashes of long words)."""
    spin = np.random.default_rng(7).integers(1, 2**63, BANDS * HASHES, np.uint64) | np.uint64(1)
    seen, kept = set(), []
    for text in folded:
        words = set(text.split())
        long = [word for word in words if len(word) > 4] or list(words)
        if not long:
            continue
        codes = np.fromiter((zlib.crc32(word.encode()) for word in long), np.uint64, len(long))
        least = (((codes + np.uint64(1)) * spin[:, None]) >> np.uint64(20)).min(1).reshape(BANDS, HASHES)
        marks = {(band, *least[band].tolist()) for band in range(BANDS)}
        if seen.isdisjoint(marks):
            kept.append(words)
        seen |= marks
    return kept


class Counts(Counter):
    """In how many texts the wanted beginnings occur; the beginnings of a word are worked out once."""

    def __init__(self, wanted=None):
        super().__init__()
        self.wanted, self.known = wanted, {}

    def take(self, texts: list[set[str]]) -> Counts:
        for words in texts:
            found: set[str] = set()
            for word in words:
                own = self.known.get(word)
                if own is None:
                    own = self.known[word] = [entry for entry in beginnings(word) if self.wanted is None or entry in self.wanted]
                found.update(own)
            self.update(found)
        return self


def choose(toxic: list[str], clean: list[str]) -> dict[str, float]:
    """The lexicon: beginnings of words that folded toxic texts have far oftener than clean ones, with their log odds.

    Of entries one of which continues the other the one with the higher likelihood ratio stays (then the longer one).
    """
    bad, good = apart(toxic), apart(clean)
    counts = Counts().take(bad)
    met = len(counts)
    counts = {entry: n for entry, n in counts.items() if n >= LEAST}
    many, rest = len(bad) + 1, len(good) + 1
    # A tenth of the clean texts rules out most beginnings; only the others are counted in all.
    few = Counts(counts).take(good[: rest // 10])
    counts = {entry: n for entry, n in counts.items() if not few[entry] or math.log(n / many / (few[entry] / (rest // 10 + 1))) > EVIDENCE - 1}
    others = Counts(counts).take(good)
    share = many / (many + rest)
    ranked = []
    for entry, n in counts.items():
        m = others[entry]
        weight = math.log((n + 0.5) / many) - math.log((m + 0.5) / rest)
        if weight > EVIDENCE:
            ratio = n * math.log(n / ((n + m) * share)) + (m * math.log(m / ((n + m) * (1 - share))) if m else 0.0)
            if ratio > math.log(met) + MARGIN:
                ranked.append((-ratio, entry.endswith(" "), -len(entry), entry, weight))
    lexicon: dict[str, float] = {}
    parts: set[str] = set()
    for *_, entry, weight in sorted(ranked):
        # Neither does a chosen entry begin this one, nor this one a chosen entry.
        if entry not in parts and not any(entry[:size] in lexicon for size in range(1, len(entry))):
            lexicon[entry] = weight
            parts.update(entry[:size] for size in range(1, len(entry)))
    return lexicon


def harmless(model: ToxicityModel, toxic: list[str], clean: list[str]) -> list[str]:
    """Phrases of a lexicon word and a neighbour that three clean texts or more have and no toxic one."""
    def around(text: str) -> set[str]:
        found = set()
        for at, _ in model.hits(text):
            end = text.index(" ", at + 1)
            if at:
                found.add(text[text.rindex(" ", 0, at) : end + 1])
            if end + 1 < len(text):
                found.add(text[at : text.index(" ", end + 1) + 1])
        return found

    counts = Counter(phrase for text in clean for phrase in around(text))
    bad = {phrase for text in toxic for phrase in around(text)}
    return sorted(phrase for phrase, n in counts.items() if n >= 3 and phrase not in bad)


def fit_curve(features: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps; a light pull keeps separable samples finite."""
    curve = np.zeros(features.shape[1])
    pull = 1e-3 * weight.sum() * np.eye(len(curve))
    for _ in range(30):
        guess = 1 / (1 + np.exp(-np.clip(features @ curve, -30, 30)))
        slope = features.T @ (weight * (truth - guess)) - pull @ curve
        bend = (features * (weight * guess * (1 - guess))[:, None]).T @ features + pull
        curve = curve + np.linalg.solve(bend, slope)
    return curve


def train(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, sample_bytes: int = SAMPLE_BYTES,
    exceptions: list[str] = EXCEPTIONS, seeds: list[str] = SEEDS,
) -> ToxicityModel:
    """Fit lexicon and curve to documents (doc_id, text) labelled toxic 1 or 0 (doc_id, toxic); other labels teach nothing.

    Fitted on the driver to a sample of about so many rows of each label (twice as many at most) whose texts have at most
    ``sample_bytes`` bytes; which rows it takes depends on their ids, and texts that repeat count once. The sampled labels
    are brought to the documents, so no text is exchanged. ``seeds`` (and with an s) are in the lexicon whatever the labels say, unless the
    sample has shown them in clean texts as often as in toxic ones. Without labels the seeds alone decide.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    counts = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    sample = []
    if counts:
        wanted = {1: toxic_rows, 0: clean_rows}
        place = F.pmod(F.xxhash64("doc_id", "toxic"), F.lit(1_000_000))
        parts = []
        for label, n in sorted(counts.items()):
            near = usable.where((F.col("toxic") == label) & (place < int(1e6 * min(1.0, 1.5 * wanted[label] / n)) + 1))
            parts.append(near.orderBy(place, "doc_id").limit(2 * wanted[label]))
        chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        readable = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes))
        found = readable.join(F.broadcast(chosen.distinct()), "doc_id").select("text", "toxic").distinct()
        sample = sorted((row["text"], row["toxic"]) for row in found.collect())
    folded = {label: [fold(text) for text, found in sample if found == label] for label in (0, 1)}
    total = sum(counts.values())
    base = counts.get(1, 0) / total if total else 0.0
    given = {f" {seed}{ending} ": SEED_WEIGHT for seed in seeds for ending in ("", "s")}
    lexicon = choose(folded[1], folded[0]) if folded[0] and folded[1] else {}
    for entry, weight in given.items():
        n, m = (sum(entry in text for text in folded[label]) for label in (1, 0))
        doubtful = m > 0 and n * (len(folded[0]) + 1) <= m * (len(folded[1]) + 1)
        if not doubtful and not any(entry.startswith(other) or other.startswith(entry) for other in lexicon):
            lexicon[entry] = weight
    phrases = [fold(phrase) for phrase in exceptions]
    model = ToxicityModel(lexicon, phrases, np.array([-3.0, 1.0, 1.5]), base)
    if folded[0] and folded[1]:
        model = ToxicityModel(lexicon, sorted({*phrases, *harmless(model, folded[1], folded[0])}), model.curve, base)
        truth = np.repeat([1, 0], [len(folded[1]), len(folded[0])])
        # The sample has too many toxic texts; weights restore the shares of the table.
        weight = np.where(truth == 1, base / len(folded[1]), (1 - base) / len(folded[0])) * len(truth)
        model.curve = fit_curve(model.features(folded[1] + folded[0]), truth, weight)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (0 to 1, higher is more toxic) and predicted (1 from 0.5 on, else 0).

    One row for each row. A text that is null or has no word gets the share of toxic labels of the training rows
    (0 without labels). Columns score and predicted are replaced; whole texts are judged, however long.
    """
    kept = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in ("score", "predicted")])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a lexicon of thousands of entries at most

    def judge(batches):
        model = shared.value
        for batch in slices(batches, text_column):
            score = model.scores(texts(batch, text_column))
            more = [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(judge, kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)
