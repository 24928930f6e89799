"""Encoding and decoding with a SentencePiece model by a forward pass over a trie of marked words.

A text's blanks become marks and a mark goes in front; it is then cut before each run of marks, as no piece
has a mark behind another character. The distinct marked words of a slice are sorted, which lines them up as
a trie, and traversed depth-first: the forward state of a prefix is worked out once and shared by all words
that go on from it.

The forward state depends on the kind of model:

* *unigram*: the best score of any segmentation of the prefix, and its last piece (Viterbi).
* *merges* (BPE): the last piece of the prefix's own encoding. A segmentation is the one that merging gives
  exactly if each two neighbouring pieces are, by themselves, left unmerged at their border; so among the pieces that
  end a prefix, one alone fits the state in front of it, and it scores 0 where the others are ruled out.
  The highest sum of stored scores would be another segmentation, as these are merge ranks.

Characters without a piece become bytes. Both kinds give what the public library gives.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.common import WordTable, kept, lean, lists, ragged, rows_of, slices, sums, texts

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

# So many borders between pieces are remembered.
MOST_FITS = 300_000


class Model:
    """The pieces of a model file, and the segmentation of sorted words."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        if rules.precompiled_charsmap or not rules.escape_whitespaces or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"{path} changes texts in ways that are not handled")
        if trainer.model_type not in (1, 2):
            raise ValueError(f"{path} is neither a unigram nor a merge model")
        self.merges = trainer.model_type == 2
        self.unknown = next(k for k, piece in enumerate(proto.pieces) if piece.type == 2)
        kinds = {1, 4} if self.merges else {1, 4, 5}
        self.scores = {piece.piece: piece.score for piece in proto.pieces if piece.type in kinds}
        self.names = [piece.piece for piece in proto.pieces]
        self.score_of = [piece.score for piece in proto.pieces]
        self.numbers = {piece.piece: k for k, piece in enumerate(proto.pieces)}
        self.bytes = [self.numbers.get(f"<0x{byte:02X}>", self.unknown) for byte in range(256)]
        self.byte_fallback = trainer.byte_fallback
        self.lowest = min(self.scores.values(), default=0.0) - 10.0
        self.fits: dict[int, bool] = {}  # by left << 20 | right
        if self.merges:
            # Pieces that merging never yields by itself cannot end a prefix.
            self.ends = {piece: self.numbers[piece] for piece in self.scores if len(piece) == 1 or self.merged(piece) == [piece]}
        else:
            self.ends = {piece: self.numbers[piece] for piece in self.scores}
        self.breaks = not any("\n" in piece and len(piece) > 1 for piece in self.scores)
        self.longest = max(map(len, self.ends), default=1)
        self.reach: dict[str, int] = {}  # longest piece by its last two characters
        for piece in self.ends:
            self.reach[piece[-2:]] = max(len(piece), self.reach.get(piece[-2:], 1))
        # What each piece adds to a decoded text.
        surface = []
        for k, piece in enumerate(proto.pieces):
            if piece.type == 6:
                surface.append(bytes([int(piece.piece[3:5], 16)]))
            elif piece.type == 2:
                surface.append((trainer.unk_surface or " ⁇ ").encode())
            else:
                surface.append(b"" if piece.type == 3 else piece.piece.replace(MARK, " ").encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.widths = np.array([len(part) for part in surface], np.int64)
        self.places = np.cumsum(self.widths) - self.widths
        self.marked = np.array([piece.type in (1, 4) and piece.piece.startswith(MARK) for piece in proto.pieces] or [False])
        self.silent = np.array([piece.type == 3 for piece in proto.pieces] or [False])

    def split(self, text: str) -> list[str]:
        """Marked words of a text, each without its first mark; an empty text has none.

        If a line break is part of no longer piece, nothing merges over it and words are cut there, too; those
        that begin with one have no mark.
        """
        if not text:
            return []
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return self.cut([word[1:] for word in WORD.findall(MARK + text.replace(" ", MARK))])
        return self.cut(text.split(" "))

    def cut(self, words: list[str]) -> list[str]:
        if not self.breaks:
            return words
        found = []
        for word in words:
            if "\n" in word:
                first, *others = word.split("\n")
                found.append(first)
                found += ["\n" + other for other in others]
            else:
                found.append(word)
        return found

    def merged(self, text: str) -> list[str]:
        """Pieces of a short string by merging: the pair of highest score first, of equal ones the leftmost."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two pieces."""
        if len(self.fits) >= MOST_FITS:
            self.fits.clear()
        pair = [self.names[left], self.names[right]]
        found = self.fits[left << 20 | right] = self.merged("".join(pair)) == pair
        return found

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all words in a row, and how many each has; words share the states of common prefixes."""
        words = [word if self.breaks and word[:1] == "\n" else MARK + word for word in words]
        order = sorted(range(len(words)), key=words.__getitem__)
        found: list[list[int]] = [[]] * len(words)
        # For each prefix of the word at hand: its last piece (-1: a character without one), where that starts, the score.
        pieces: list[int] = []
        starts: list[int] = []
        scores: list[float] = []
        extend = self.extend_merges if self.merges else self.extend_unigram
        last = ""
        for at in order:
            word = words[at]
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del pieces[shared:], starts[shared:], scores[shared:]
            extend(word, shared, pieces, starts, scores)
            last, end, ids = word, len(word), []
            while end:
                start, piece = starts[end - 1], pieces[end - 1]
                if piece >= 0:
                    ids.append(piece)
                elif self.byte_fallback:
                    ids.extend(self.bytes[byte] for byte in reversed(word[start:end].encode(errors="replace")))
                elif not ids or ids[-1] != self.unknown:
                    ids.append(self.unknown)
                end = start
            ids.reverse()
            found[at] = ids
        return rows_of(found)

    def extend_merges(self, word: str, shared: int, pieces: list, starts: list, scores: list) -> None:
        ends, fits, reach = self.ends, self.fits, self.reach
        for end in range(shared + 1, len(word) + 1):
            longest = reach.get(word[end - 2 : end], 1)
            for start in range(end - longest if end > longest else 0, end):
                piece = ends.get(word[start:end])
                if piece is not None:
                    if not start or start == end - 1:
                        break
                    left = pieces[start - 1]
                    if left < 0:
                        break
                    fit = fits.get(left << 20 | piece)
                    if fit or fit is None and self.fit(left, piece):
                        break
            else:
                start, piece = end - 1, -1
            pieces.append(piece)
            starts.append(start)

    def extend_unigram(self, word: str, shared: int, pieces: list, starts: list, scores: list) -> None:
        for end in range(shared + 1, len(word) + 1):
            best = None
            for start in range(max(0, end - self.longest), end):
                piece = self.ends.get(word[start:end], -1)
                if piece < 0 and start < end - 1:
                    continue
                score = (self.score_of[piece] if piece >= 0 else self.lowest) + (scores[start - 1] if start else 0.0)
                if best is None or score > best[0]:
                    best = (score, start, piece)
            scores.append(best[0])
            starts.append(best[1])
            pieces.append(best[2])

    def join(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of consecutive runs of identifiers."""
        values, widths = ragged(self.surface, self.places, self.widths, ids)
        stops = np.cumsum(sums(widths, ends))
        raw, texts, start = values.tobytes(), [], 0
        for stop, first, end in zip(stops.tolist(), np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
            while first < end and self.silent[ids[first]]:
                first += 1
            # The mark in front is not part of the text.
            skip = 1 if first < end and self.marked[ids[first]] else 0
            texts.append(raw[start + skip : stop].decode(errors="replace"))
            start = stop
        return texts


def _made(path: str) -> tuple[Model, WordTable]:
    model = Model(path)
    return model, WordTable(model.segment)


def _model(path: str) -> tuple[Model, WordTable]:
    return kept(path, lambda: _made(path))


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Identifiers of every whole text: doc_id, ids; no begin or end identifiers.

    One row for each row, repeated ones included; null and empty texts have no identifiers. Texts are encoded
    where they lie, slice by slice; the trie holds the words of one slice that the worker has not met lately.
    """

    def run(batches):
        model, table = _model(path)
        for batch in slices(batches, "text"):
            codes, ends = table.encode(model.split, texts(batch, "text"))
            ids, counts = table.gather(codes)
            column = lists(ids, np.cumsum(sums(counts, ends)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "ids"])

    rows = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text")
    return rows.mapInArrow(lean(run, path), "doc_id long, ids array<int>")


def encode_checked(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with ids, and round_trip: whether decoding them gives the text (null: the empty one).

    It does unless the text has a mark of its own, or no valid UTF-8. Columns of these names are replaced.
    """
    rows = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in ("ids", "round_trip")])

    def run(batches):
        model, table = _model(path)
        for batch in slices(batches, text_column):
            given = texts(batch, text_column)
            codes, ends = table.encode(model.split, given)
            ids, counts = table.gather(codes)
            ends = np.cumsum(sums(counts, ends))
            same = [text == back for text, back in zip(given, model.join(ids, ends))]
            more = [lists(ids, ends, pa.int32()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "ids", "round_trip"])

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    return rows.mapInArrow(lean(run, path), T.StructType([*rows.schema, *fields]))


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Texts of lists of identifiers: doc_id, ids, text. A null list and null or unknown identifiers add nothing.

    What ``encode`` made comes back as it was, but that a mark in the text itself has become a blank.
    """

    def run(batches):
        model, _ = _model(path)
        size = len(model.widths)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                rows = part.column("ids")
                counts = np.array([0 if row is None else row for row in pc.list_value_length(rows).to_pylist()], np.int64)
                values = rows.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                known = (values >= 0) & (values < size)
                ends = np.cumsum(sums(known, np.cumsum(counts)))
                column = pa.array(model.join(values[known], ends), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows, column], ["doc_id", "ids", "text"])

    rows = encoded.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{ids_column}` as array<int>) as ids")
    return rows.mapInArrow(lean(run, path), "doc_id long, ids array<int>, text string")
