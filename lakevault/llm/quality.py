"""Text quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own shape and that of the lines before and behind it; the
transitions between lines are learned. Forward-backward gives each line's chance of being good; weighted by
length they add up to the document's, which a fitted logistic curve turns into its score.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm import crf
from lakevault.llm.common import slices, texts

# Bounds of the sample that the model is fitted to: rows of a label, and bytes of a text in it.
SAMPLE_ROWS, SAMPLE_BYTES = 600, 50_000
SLICE = 2 << 20

# Kinds of bytes: letters in lower and upper case, digits, blanks, sentence marks, other marks by kind, beyond ASCII.
KINDS = ["lower", "upper", "digit", "blank", "sentence", "exclamation", "bracket", "bar", "quote", "sign", "control", "wide"]
_members = {
    "lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "blank": " \t\r",
    "sentence": ".,;:-", "exclamation": "!?", "bracket": "()[]{}<>", "bar": "|/\\_", "quote": "\"'`",
}
KIND_OF = np.full(256, KINDS.index("sign"), np.uint8)
KIND_OF[:32] = KINDS.index("control")
KIND_OF[127] = KINDS.index("control")
KIND_OF[128:] = KINDS.index("wide")
for _kind, _chars in _members.items():
    KIND_OF[[ord(char) for char in _chars]] = KINDS.index(_kind)

# Own features of a line: shares of bytes, size, words, word length, distinct share, repeats, sameness of lines.
OWN = len(KINDS) + 7


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines that hold more than blanks, their lengths in bytes, and the number of such lines per text."""
    lines, counts, same = [], [], []
    for text in texts:
        own = [line for line in text.split("\n") if line and not line.isspace()]
        met: dict[str, int] = {}
        for line in own:
            met[line] = met.get(line, 0) + 1
        same += [met[line] / len(own) for line in own]
        lines += own
        counts.append(len(own))
    if not lines:
        return np.zeros((0, 3 * OWN + 1), np.float32), np.zeros(0), np.array(counts, np.int64)
    sizes, words, distinct, runs = (np.zeros(len(lines)) for _ in range(4))
    for at, line in enumerate(lines):
        own = line.split()
        words[at], distinct[at] = len(own), len(set(own))
        runs[at] = sum(map(str.__eq__, own, own[1:]))
    raw = [line.encode(errors="replace") for line in lines]
    sizes[:] = [len(part) for part in raw]
    kinds = KIND_OF[np.frombuffer(b"".join(raw), np.uint8)]
    owner = np.repeat(np.arange(len(lines)) * len(KINDS), sizes.astype(np.int64))
    shares = np.bincount(owner + kinds, minlength=len(lines) * len(KINDS)).reshape(len(lines), len(KINDS)) / sizes[:, None]
    some = np.maximum(words, 1)
    own = np.concatenate(
        [shares, np.stack([np.log1p(sizes), np.log1p(words), sizes / some / 10, distinct / some, runs / some, np.array(same), words == 1], 1)], 1
    ).astype(np.float32)
    counts = np.array(counts, np.int64)
    ends = np.cumsum(counts)
    inner = np.ones(len(lines), bool)
    inner[(ends - counts)[counts > 0]] = False
    before = np.concatenate([own[:1], own[:-1]]) * inner[:, None]
    inner = np.ones(len(lines), bool)
    inner[ends[counts > 0] - 1] = False
    after = np.concatenate([own[1:], own[-1:]]) * inner[:, None]
    return np.concatenate([own, before, after, np.ones((len(lines), 1), np.float32)], 1), sizes, counts


@dataclass
class QualityModel:
    """Weights of good against bad by feature, log transitions, log first labels, the curve, and the score of empty texts."""

    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray
    curve: tuple[float, float]
    base: float

    def chances(self, texts: list[str]) -> np.ndarray:
        """Length-weighted chance of good of each text; not a number without lines."""
        found, sizes, counts = line_features(texts)
        scores = (found / self.scale) @ self.weights
        good = crf.marginals(scores, counts[counts > 0], self.moves, self.first)[:, 1] if len(scores) else np.zeros(0)
        owner = np.repeat(np.arange(len(texts)), counts)
        weight = np.bincount(owner, sizes, len(texts))
        with np.errstate(invalid="ignore"):
            return np.bincount(owner, good * sizes, len(texts)) / weight

    def scores(self, texts: list[str]) -> np.ndarray:
        chance = self.chances(texts)
        odds = np.log(np.clip(chance, 1e-6, 1 - 1e-6) / np.clip(1 - chance, 1e-6, 1 - 1e-6))
        return np.where(np.isnan(chance), self.base, 1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * odds))))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, rounds: int = 150) -> QualityModel | None:
    """Fit the model to documents (doc_id, text) of known quality (doc_id, quality: 1 good, 0 bad); None without any.

    All lines of a text take its label. Fitted on the driver to a sample of about ``sample_rows`` labels of each
    kind (twice that at most) whose texts have at most ``sample_bytes`` bytes; which labels it takes depends on
    their contents alone. The sampled labels are brought to the documents, so no text is exchanged. The share of
    good labels, over all rows, is the score of a text without lines.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    counts = {row["quality"]: row["count"] for row in usable.groupBy("quality").count().collect()}
    if not counts:
        return None
    base = counts.get(1, 0) / sum(counts.values())
    places = F.pmod(F.xxhash64("doc_id", "quality"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for label, n in sorted(counts.items()) for x in (label, int(1e6 * min(1.0, sample_rows / n)) + 1)])
    most = 2 * sample_rows * len(counts)
    chosen = usable.where(places < share[F.col("quality")]).orderBy(places, "doc_id", "quality").limit(most)
    texts_ = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes))
    sample = texts_.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id", "quality"), "text", "quality").limit(most).collect()
    found, sizes, lines = line_features([row["text"] for row in sample])
    width = found.shape[1]
    flat = QualityModel(np.ones(width), np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2), (0.0, 0.0), base)
    if len(counts) < 2 or not len(found):
        # One label only: every text gets the share of good labels.
        odds = np.log(np.clip(base, 1e-6, 1 - 1e-6) / np.clip(1 - base, 1e-6, 1 - 1e-6))
        flat.curve = (float(odds), 0.0)
        return flat
    truth = np.array([row["quality"] for row in sample], np.int64)
    labels = np.repeat(truth, lines)
    scale = np.sqrt((found.astype(float) ** 2).mean(0))
    scale[scale == 0] = 1.0
    inputs = found / scale
    weights, moves, first = crf.fit(
        lambda w: inputs @ w, lambda gradient: inputs.T @ gradient, np.zeros((width, 2)), labels, lines[lines > 0], rounds, rate=0.05, decay=1e-4
    )
    model = QualityModel(scale, weights, moves, first, (0.0, 1.0), base)
    # The curve from chances to scores, by Newton steps with a light pull to the identity.
    chance = model.chances([row["text"] for row in sample])
    lined = ~np.isnan(chance)
    odds = np.log(np.clip(chance[lined], 1e-6, 1 - 1e-6) / np.clip(1 - chance[lined], 1e-6, 1 - 1e-6))
    weight = 1.0 / np.bincount(truth[lined], minlength=2)[truth[lined]]  # both labels count alike: the sample is balanced, the table is not
    design, start, at = np.stack([np.ones_like(odds), odds], 1), np.array([0.0, 1.0]), np.array([0.0, 1.0])
    for _ in range(25):
        guess = 1 / (1 + np.exp(-design @ at))
        slope = design.T @ (weight * (truth[lined] - guess)) - 0.01 * (at - start)
        bend = (design * (weight * guess * (1 - guess))[:, None]).T @ design + 0.01 * np.eye(2)
        at = at + np.linalg.solve(bend, slope)
    model.curve = (float(at[0]), float(at[1]))
    return model


def score_quality(docs: DataFrame, model: QualityModel | None, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (0 to 1, higher is better) and predicted (1 from 0.5 on, else 0).

    One row for each row. A text that is null or has no line with more than blanks gets the share of good labels
    of the training rows; without a model every score is 0.5. Columns score and predicted are replaced.
    """
    kept = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in ("score", "predicted")])
    if model is None:
        return kept.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def judge(batches):
        model = shared.value
        for batch in slices(batches, text_column, SLICE):
            score = model.scores(texts(batch, text_column))
            more = [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(judge, kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)
