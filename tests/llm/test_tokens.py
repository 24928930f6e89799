"""Token operators against the public libraries."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
from tokenizers import Tokenizer

from lakevault.llm import common, sentencepiece, tokenfile
from lakevault.llm.tokencount import token_counts

BYTES, WORDS, PIECES = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = (
    "a|b|the|Word|wörd|ing|'s|'LL|1|23|²|½|Ⅷ|é|é|ß|İ|Σ|ΑΣ|ǅ|日本|😀|﻿|​|_|-|!!!|.,|.|,|<s>|<unk>|<0x0A>|<|endoftext|>"
    .replace("<|endoftext|>", "<\0endoftext\0>").split("|")
)
PARTS = [part.replace("\0", "|") for part in PARTS] + [" ", "  ", "    ", "\n", "\t", "\r\n", "\x00", "\x1c", "\x85", "\xa0", " ", "　", "▁", "<|startoftext|>"]


def sample(count: int, seed: int) -> list:
    chance = random.Random(seed)
    return [None, "", " ", "\n", "x" * 3000, "ab " * 3000] + ["".join(chance.choices(PARTS, k=chance.randrange(40))) for _ in range(count)]


def table(spark, texts, parts=3):
    """Rows with an extra column that clashes with a result's name, and the last row twice."""
    rows = [(k, text, "extra") for k, text in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, n_tokens string").repartition(parts)


def test_counts_are_those_of_the_library(spark):
    texts = sample(1500, 1)
    library = Tokenizer.from_file(BYTES)
    rows = token_counts(table(spark, texts), BYTES, limit=20).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        text = texts[row["doc_id"]] or ""
        wanted = len(library.encode(text, add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), wanted, wanted > 20), text


def test_pieces_are_those_of_the_library_and_decode_to_the_text(spark):
    texts = sample(1500, 2)
    library = SentencePieceProcessor(model_file=PIECES)
    encoded = sentencepiece.encode(table(spark, texts), PIECES)
    for row in sentencepiece.decode(encoded, PIECES).collect():
        text = texts[row["doc_id"]] or ""
        assert row["ids"] == library.encode(text), text
        assert row["text"] == library.decode(row["ids"]) == text.replace("▁", " ")
    checked = sentencepiece.encode_checked(table(spark, texts).withColumn("ids", F.lit(1)), PIECES)
    assert all(row["round_trip"] == ("▁" not in (row["text"] or "")) for row in checked.collect())


def test_decoding_leaves_out_what_is_no_identifier(spark):
    library = SentencePieceProcessor(model_file=PIECES)
    lists = [[], None, [None, 400, -1, 10**6], [1, 400, 2], [400, 0, 500], [3 + 0xE4, 400]]
    rows = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    found = {row["doc_id"]: row["text"] for row in sentencepiece.decode(rows, PIECES).collect()}
    wanted = [library.decode([x for x in ids or [] if x is not None and 0 <= x < 32000]) for ids in lists]
    assert [found[k] for k in range(5)] == wanted[:5]


def test_best_scores_win_in_a_unigram_model(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = 1
    model.normalizer_spec.remove_extra_whitespaces = False
    for piece, score, kind in [("<unk>", 0, 2), ("▁", -3, 1), ("a", -2.5, 1), ("b", -2.6, 1), ("ab", -4.1, 1), ("▁a", -3.3, 1), ("bab", -5.5, 1), ("▁ab", -6.9, 1), ("c", -9, 1)]:
        model.pieces.add(piece=piece, score=score, type=kind)
    path = tmp_path / "small.model"
    path.write_bytes(model.SerializeToString())
    library, own = SentencePieceProcessor(model_file=str(path)), sentencepiece.Model(str(path))
    chance = random.Random(5)
    words = ["".join(chance.choices("abc", k=chance.randrange(1, 12))) for _ in range(400)]
    flat, counts = own.segment(words)
    found = np.split(flat, np.cumsum(counts)[:-1])
    assert [part.tolist() for part in found] == [library.encode(word) for word in words]


@pytest.mark.parametrize("width", [2, 4])
def test_token_files_hold_what_the_library_gives(spark, folder, width):
    texts = sample(1200, 3)
    library = Tokenizer.from_file(WORDS)
    encoded = common.stage(tokenfile.tokenize(table(spark, texts), WORDS, width=width), "test-tokens")
    tokenfile.write_tokens(encoded, folder, width=width)
    rows = sorted(tokenfile.read_tokens(spark, folder).collect(), key=lambda row: row["start"])
    assert [row["doc_id"] for row in rows] == sorted([*range(len(texts)), len(texts) - 1])
    start = 0
    for row in rows:
        ids = [*library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4").tobytes()
        assert (row["start"], row["n_tokens"], zlib.crc32(row["ids"])) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)


def test_special_strings_are_looked_for_in_the_original_text(spark, folder):
    chance = random.Random(11)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|STARTOFTEXT|>", "<|endoftext|", "|endoftext|>", "<|", " ", "a", "Word", ".", "'s", "Σ", "é", "\x1c", "\n"]
    texts = ["a <|EndOfText|> b", "<|STARTOFTEXT|>", "<|endoftext|>", "x<|endoftext|><|startoftext|>Y", *("".join(chance.choices(parts, k=9)) for _ in range(400))]
    library = Tokenizer.from_file(WORDS)
    encoded = common.stage(tokenfile.tokenize(table(spark, texts), WORDS, count=True), "test-special")
    tokenfile.write_tokens(encoded, folder)
    found = {row["doc_id"]: np.frombuffer(row["ids"], "<u4").tolist() for row in tokenfile.read_tokens(spark, folder).collect()}
    assert len(found) == len(texts)
    for at, text in enumerate(texts):
        assert found[at] == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_counts_kept_while_encoding_are_those_of_the_rows(spark):
    encoded = tokenfile.tokenize(table(spark, sample(300, 4)), WORDS, width=2)
    counted = tokenfile.tokenize(table(spark, sample(300, 4)), WORDS, width=2, count=True)
    assert sorted(map(tuple, tokenfile.frequencies(counted, 2).collect())) == sorted(map(tuple, tokenfile.frequencies(encoded, 2).collect()))
    assert counted.where("counted is null").drop("counted").exceptAll(encoded).isEmpty()


def test_frequent_tokens_get_small_ranks(spark, folder):
    docs = spark.createDataFrame([(1, "the the the of"), (None, "the of in")], "doc_id long, text string")
    tokenfile.write_tokens(tokenfile.tokenize(docs, WORDS), folder)
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    assert [row["n"] for row in ranks] == [4, 2, 2, 1]
    assert [row["doc_id"] for row in tokenfile.read_tokens(spark, folder).orderBy("start").collect()] == [None, 1]


@pytest.mark.parametrize("seed", range(5))
def test_packing_is_reversible(seed):
    chance = np.random.default_rng(seed)
    ranks = chance.integers(0, 2**32, chance.integers(0, 999), np.uint64).astype(np.uint32) >> np.uint32(8 * seed % 32)
    assert (tokenfile.unpack(*tokenfile.pack(ranks), len(ranks)) == ranks).all()


def test_empty_tables(spark, folder):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(none, BYTES).count() == 0
    assert sentencepiece.decode(sentencepiece.encode(none, PIECES), PIECES).count() == 0
    tokenfile.write_tokens(tokenfile.tokenize(none, WORDS), folder)
    assert tokenfile.read_tokens(spark, folder).count() == 0


def test_a_full_word_table_starts_anew_without_changing_results():
    table = common.WordTable(lambda words: common.rows_of([[ord(char) for char in word] for word in words]), words=3)
    chance = random.Random(2)
    for _ in range(50):
        texts = [" ".join(chance.choices(["a", "bc", "def", "ghij", "", "kl"], k=5)) for _ in range(3)]
        codes, ends = table.encode(str.split, texts)
        values, counts = table.gather(codes)
        assert values.tolist() == [ord(char) for text in texts for char in text if char != " "]
        assert common.sums(counts, ends).tolist() == [len(text.replace(" ", "")) for text in texts]


def test_a_worker_keeps_the_tables_of_one_operator_only():
    """Stages of a pipeline share their workers: tables that an earlier operator left are dropped by the next one's task."""
    made = []
    for _ in range(2):
        list(common.lean(lambda batches: batches, "first")(iter([1])))
        common.kept("first", lambda: made.append("first"))
    assert made == ["first"]
    assert list(common.lean(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert not common._kept
    common.kept("second", lambda: made.append("second"))
    common.kept("first", lambda: made.append("first"))
    assert made == ["first", "second", "first"] and list(common._kept) == ["first"]
    common.forget(None)
