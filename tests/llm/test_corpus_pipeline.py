"""The stages of the corpus pipeline, each on what the one before kept."""
import corpus_pipeline
import public_tokenizers
from conftest import SMALL
from sentencepiece import SentencePieceProcessor
from test_groups import shingles, smallest_linked, without_repeats

import __spark_entry__ as driver


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {row["doc_id"]: row["text"] for row in docs.collect()}
    one = corpus_pipeline.language(spark, docs, SMALL)
    assert one.columns == corpus_pipeline.COLUMNS and {row["doc_id"] for row in one.select("doc_id").collect()} == set(rows)
    two = corpus_pipeline.near_duplicates(spark, one, SMALL)
    sets = {key: shingles(text) for key, text in rows.items()}
    links = [(i, j) for i in sets for j in sets if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    least = smallest_linked(sets, links)
    kept = {key: text for key, text in rows.items() if least[key] == key}
    assert {row["doc_id"]: row["text"] for row in two.collect()} == kept
    three = corpus_pipeline.repeated_passages(spark, two, SMALL)
    changed = without_repeats(list(kept.items()))
    found = {row["doc_id"]: row for row in three.collect()}
    assert set(found) == set(kept)
    for key, row in found.items():
        size, removed, _, _ = changed[key]
        assert 0 <= size - removed - len(row["text"].encode()) < 8 and row["n_chars"] == len(row["text"])
    plain = lambda text: " ".join(text.lower().split())
    items = [plain(row["text"]) for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    four = corpus_pipeline.decontaminate(spark, three, SMALL)
    clean = {key for key, row in found.items() if not any(item in plain(row["text"]) for item in items)}
    assert {row["doc_id"] for row in four.collect()} == clean
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row in corpus_pipeline.encode(spark, four, SMALL).collect():
        assert row["ids"] == library.encode(found[row["doc_id"]]["text"]) and row["n_tokens"] == len(row["ids"]) and row["round_trip"]


def test_stages_take_odd_rows(spark):
    long = "word " * 30 + "and more"
    rows = [(1, long, "en", "s", 1), (1, long, "en", "s", 1), (None, long, None, None, None), (3, None, None, None, None), (4, "", "en", "", 0), (5, "?!", "de", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            frame = step(spark, frame, SMALL)
            frame.collect()


def documents(spark, rows):
    return spark.createDataFrame([(key, text, lang, "s", len(text or "")) for key, text, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_language_decides(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) between 900 and 4000")
    texts = {lang: [row["text"] for row in docs.where(f"lang = '{lang}'").limit(40).collect()] for lang in ("en", "de", "fr", "es")}
    assert all(len(found) > 20 for found in texts.values())
    rows = [(10 * k + at, text, lang) for k, (lang, found) in enumerate(texts.items()) for at, text in enumerate(found[1:])]
    mixed = "\n".join(text[:200] for found in texts.values() for text in found[:8])
    odd = [(9001, mixed, None), (9002, next(text for text in texts["de"] if " the " not in text.lower()) * 30, "en"), (9003, texts["fr"][0], None), (9004, "12 !?", "en"), (None, texts["es"][0], "es")]
    found = {row["doc_id"]: row["lang"] for row in corpus_pipeline.language(spark, documents(spark, rows + odd), SMALL).collect()}
    assert {9001, 9004}.isdisjoint(found)  # four languages in equal parts, and no letters
    assert (found[9002], found[9003], found[None]) == ("de", "fr", "es")
    assert len(found) >= 0.95 * len({key for key, *_ in rows})


def test_rows_are_told_apart_whatever_their_ids(spark):
    a, b = (" ".join(f"{kind}{k}" for k in range(60)) for kind in "ab")
    rows = [(1, a, "en"), (1, b, "en"), (2, a + " more", "en"), (None, b, "en"), (None, "x y z", "en"), (None, "x y z", "en"), (3, None, "en"), (3, "", "en")]
    kept = sorted(((row["doc_id"], row["text"]) for row in corpus_pipeline.near_duplicates(spark, documents(spark, rows).repartition(3), SMALL).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (None, "x y z"), (3, None), (3, "")], key=str)


def test_an_item_in_a_row_without_an_id_is_found(spark):
    item = max((row["text"] for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()), key=len)
    rows = [(None, f"before {item} behind", "en"), (None, "clean words that no benchmark has at all", "en"), (7, f"more {item}", "en"), (7, "another clean text of some words", "en")]
    kept = {row["text"] for row in corpus_pipeline.decontaminate(spark, documents(spark, rows), SMALL).collect()}
    assert kept == {rows[1][1], rows[3][1]}


def test_run_is_registered(spark):
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert sum(name.startswith("op") for name in driver.queries()) == 13
    assert corpus_pipeline.run(spark, SMALL).count() > 100
