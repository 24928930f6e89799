"""Language, quality, benchmark leaks, shards and neighbours."""
import random
import re

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lakevault.llm import crf, langid, neighbours, quality, queries
from lakevault.llm.decontam import leaks
from lakevault.llm.sharding import shard

MIDDLE = "/root/testdata/sf0.01"


def test_marginals_are_those_of_all_label_sequences():
    chance = np.random.default_rng(3)
    lengths = np.array([1, 4, 2, 5])
    scores, moves, first = chance.normal(size=(12, 3)), chance.normal(size=(3, 3)), chance.normal(size=3)
    found, at = crf.marginals(scores, lengths, moves, first), 0
    for length in lengths:
        wanted = np.zeros((length, 3))
        for code in range(3**length):
            labels = [code // 3**k % 3 for k in range(length)]
            weight = np.exp(first[labels[0]] + sum(scores[at + k, label] for k, label in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
            for k, label in enumerate(labels):
                wanted[k, label] += weight
        assert np.allclose(found[at : at + length], wanted / wanted.sum(1, keepdims=True))
        at += length


def test_fitting_learns_transitions():
    labels = np.array([0, 0, 0, 1, 1, 1, 0, 0] * 20)
    weights, moves, _ = crf.fit(lambda w: np.tile(w, (len(labels), 1)), lambda g: g.sum(0, keepdims=True), np.zeros((1, 2)), labels, np.full(20, 8), 200, 0.1, 1e-4)
    assert moves[0, 0] + moves[1, 1] > moves[0, 1] + moves[1, 0] + 1


def test_languages_of_held_out_texts(spark):
    truth = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = queries.op2_language_id(spark, MIDDLE).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [row for row in rows if row["held_out"]]
    assert len(held) > 200 and np.mean([row["lang"] == row["lang_pred"] for row in held]) > 0.98
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_switching_texts_are_labelled_in_parts(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = langid.train(docs)
    text = {lang: next(row["text"] for row in docs.where((F.col("lang") == lang) & (F.length("text") > 2000)).limit(1).collect())[:1000] for lang in ("en", "de")}
    mixed = text["de"] + " " + text["en"][:400]
    rows = spark.createDataFrame([(1, mixed, "?"), (2, None, None), (3, "12 !?", None), (4, "", None), (5, text["en"] * 30, "x")], "doc_id long, text string, score string")
    found = {row["doc_id"]: row for row in langid.label_languages(rows, model).collect()}
    assert found[1]["lang_pred"] == "de" and 0.55 < found[1]["score"] < 0.9
    assert [found[k]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3 and found[3]["score"] == 0
    assert found[5]["lang_pred"] == "en"
    assert langid.train(docs.limit(0)) is None
    assert {row["lang_pred"] for row in langid.label_languages(rows, None).collect()} == {"und"}


def test_copies_do_not_push_texts_out_of_the_sample(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").where("lang in ('en', 'de') and length(text) > 300").select("text", "lang")
    french = [row["text"] for row in spark.read.parquet(f"{MIDDLE}/documents.parquet").where("lang = 'fr' and length(text) > 900").limit(4).collect()]
    copies = spark.createDataFrame([(text, "fr") for text in french[:3]] * 2000, "text string, lang string")
    model = langid.train(docs.unionByName(copies))
    assert model.languages == ["de", "en", "fr"]
    found = langid.label_languages(spark.createDataFrame([(french[3],), (french[0],)], "text string"), model).collect()
    assert [row["lang_pred"] for row in found] == ["fr", "fr"]
    many = spark.createDataFrame([(f"text {k}", f"l{k}") for k in range(langid.LANGUAGES + 1)], "text string, lang string")
    with pytest.raises(ValueError, match="different values"):
        langid.train(many)


def test_quality_of_held_out_texts(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "quality")
    rows = queries.op4_quality(spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    truth = {row["doc_id"]: row["quality"] for row in labels.collect()}
    held = [row for row in rows if row["held_out"] and row["doc_id"] in truth]
    assert len(held) > 80 and np.mean([row["predicted"] == truth[row["doc_id"]] for row in held]) > 0.97
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5) for row in rows)


def test_quality_of_odd_texts(spark):
    docs = spark.createDataFrame([(k, text, "x") for k, text in enumerate([None, "", " \n ", "a" * 200_000, "One line."])], "doc_id long, text string, score string")
    texts = spark.createDataFrame([(1, "A sentence of words."), (2, "###"), (2, "###"), (3, None), (None, "x")], "doc_id long, text string")
    good = spark.createDataFrame([(1, 1), (1, 1), (3, 1), (9, 1), (None, 0)], "doc_id long, quality int")
    for model in (None, quality.train(texts, good), quality.train(texts, good.union(good.selectExpr("doc_id + 1", "0")))):
        rows = quality.score_quality(docs, model).collect()
        assert len(rows) == 5 and all(0 <= row["score"] <= 1 for row in rows)
    assert quality.train(texts, good.limit(0)) is None


QUESTION = "Today Anna Miller drives 120 km from Rome to Bern in 3 hours and then rests for 2 hours before she drives another 45 km while people look for Anna in the hall and ask for Anna at the door"
CHANGED = "Today Tom Baker drives 250 miles from Oslo to Kiel in 7 minutes and then rests for 4 minutes before she drives another 33 miles while people look for Tom in the hall and ask for Tom at the door"
TORN = "Today Tom Baker drives 250 miles from Oslo to Kiel in 7 minutes and then rests for 4 minutes before she drives another 33 miles while people look for Tom in the hall and ask for Eve at the door"


def test_questions_are_found_with_other_numbers_names_and_units(spark):
    other = "an unrelated text of many plain words that speaks of nothing in particular at all"
    texts = [QUESTION, f"{other}. {QUESTION.upper()}. {other}", f"{other}. {CHANGED}.", TORN, other, None, "", QUESTION[:60], " ".join([other] * 500 + [CHANGED])]
    docs = spark.createDataFrame([(k, text, 1) for k, text in enumerate(texts)] + [(0, QUESTION, 1), (None, QUESTION, 1)], "doc_id long, text string, at long").repartition(3)
    items = spark.createDataFrame([(7, QUESTION, 2), (8, None, 2), (None, QUESTION, 2), (9, "12 3 4 km 5 6 7 8", 2)], "item_id long, text string, window long")
    found = {(row["doc_id"], row["item_id"]): row["changed"] for row in leaks(docs, items).collect()}
    assert {key for key in found} == {(0, 7), (2, 7), (8, 7)} | {key for key in found if key == (1, 7)}
    assert found[0, 7] == 0 and found[2, 7] > 5
    assert leaks(docs.limit(0), items).count() == leaks(docs, items.limit(0)).count() == 0


def test_every_planted_passage_is_found_and_nothing_else(spark):
    plain = lambda text: " ".join((text or "").lower().split())
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{MIDDLE}/benchmark.parquet").select("item_id", "text").collect()
    wanted = {(doc[0], item[0]) for doc in docs for item in items if plain(item[1]) in plain(doc[1])}
    assert {(row["doc_id"], row["item_id"]) for row in queries.op10_decontamination(spark, MIDDLE).collect()} == wanted


def test_shards_of_documents(spark):
    rows = queries.op6_sharding(spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    assert sorted(rows["doc_id"]) == sorted(docs["doc_id"])
    sizes = {row.doc_id: len((row.text or "").encode()) + 16 for row in docs.itertuples()}
    assert all(sizes[row.doc_id] == row.size for row in rows[["doc_id"]].assign(size=rows["size"]).itertuples(index=False))
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    by_shard = rows.groupby("shard")["size"].sum().reindex(range(40), fill_value=0)
    assert (by_shard - rows["size"].sum() / 40).abs().max() <= rows["size"].max()


@pytest.mark.parametrize("pieces", [500_000, 7])
def test_shards_with_hot_texts_and_odd_rows(spark, pieces):
    chance = random.Random(pieces)
    rows = [(None, None, 1)] + [(k, chance.choice(["same", "same", "other", str(k)]), chance.randrange(5, 9)) for k in range(400)] + [(5, "same", 6)] * 100
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot long").repartition(5)
    keys = [F.xxhash64("text"), F.col("doc_id")]
    placed = shard(frame, F.col("slot"), keys, shards=8, piece_rows=pieces).toPandas()
    assert len(placed) == len(rows)
    target = placed["size"].sum() / 8
    assert (placed.groupby("shard")["size"].sum() - target).abs().max() <= 9
    for _, part in placed.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    few = shard(frame.limit(3), F.lit(1), keys, shards=8).toPandas()
    assert len(few) == 3 and few["shard"].between(0, 7).all()
    assert shard(frame.limit(0), F.lit(1), keys, shards=8).count() == 0


def test_groups_of_equal_texts_are_cut_only_if_sizes_would_suffer(spark):
    chance = random.Random(12)
    rows = [(k, f"text {chance.randrange(1200)}", chance.randrange(80, 120)) for k in range(6000)] + [(k, "hot", 100) for k in range(6000, 8000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, bytes long").repartition(4)
    placed = shard(frame, F.col("bytes"), [F.xxhash64("text"), F.col("doc_id")], shards=8, group=1).toPandas()
    target = placed["size"].sum() / 8
    assert (placed.groupby("shard")["size"].sum() - target).abs().max() <= 0.05 * target
    homes = placed.groupby("text")["shard"].nunique()
    assert homes[homes > 1].index.tolist() == ["hot"]
    for _, part in placed.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    plain = shard(frame, F.col("bytes"), [F.xxhash64("text"), F.col("doc_id")], shards=8).toPandas()
    assert (plain.groupby("text")["shard"].nunique() > 1).sum() >= 3


def test_neighbours_of_the_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    vectors, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    found = queries.op8_neighbours(spark, folder).toPandas()
    hits = total = 0
    for query, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        scores = vectors @ vectors[ids == query][0]
        scores[ids == query] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        assert list(part["rank"]) == list(range(1, 21)) and query not in set(part["vec_id"])
        assert np.allclose(part["score"], [scores[ids == other][0] for other in part["vec_id"]], atol=1e-12)
        assert list(part["score"]) == sorted(part["score"], reverse=True)
        hits, total = hits + len(set(best) & set(part["vec_id"])), total + 20
    assert total == 20 * (ids % 20 == 0).sum() and hits / total >= 0.9


def test_neighbours_of_odd_vectors(spark):
    good = [(k, [float(k % 7), 1.0, -2.0 * (k % 3)]) for k in range(30)]
    odd = [(40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 2.0]), (100, [float("nan"), 1.0, 1.0]), (120, [float("inf"), 1.0, 1.0]), (140, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*row, 1) for row in good + odd + good[:3]], "vec_id long, embedding array<float>, rank int").repartition(4)
    rows = neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), shard_rows=8).collect()
    assert {row["query_id"] for row in rows} == {0, 20}
    for query in (0, 20):
        own = np.array(good[query][1])
        wanted = sorted(((-float(np.dot(own, vector)), k) for k, vector in good if k != query))[:20]
        assert [(row["vec_id"], row["rank"], row["score"]) for row in sorted(rows, key=lambda row: row["rank"]) if row["query_id"] == query] == [
            (k, at + 1, -score) for at, (score, k) in enumerate(wanted)
        ]
    few = frame.where("vec_id in (0, 1)")
    assert [(row["query_id"], row["vec_id"]) for row in neighbours.nearest(few, few.where("vec_id = 0")).collect()] == [(0, 1)]
    assert neighbours.nearest(frame.limit(0), frame).count() == 0


def test_edited_stripped_capitalised_and_partial_copies_are_found(spark):
    item = (
        "The garden behind our old house was full of apple trees. Every autumn the children of Mrs Brown came over with baskets "
        "and picked as many as they could carry. Paul once fell out of the tallest tree and broke both arms. Nobody climbed it again."
    )
    words = item.split()
    edited = " ".join("exchanged" if k in (9, 30) else word for k, word in enumerate(words))
    inserted = " ".join([*words[:12], "and", "so", "on", *words[12:]])
    texts = [item, edited, inserted, re.sub(r"[^\w\s]", "", item), item.upper(), item.lower(), " ".join(words[:24]), " ".join(words[20:]), " ".join(words[:9])]
    around = "Some other text of plain words stands in front"
    docs = spark.createDataFrame([(k, f"{around} {text} {around}") for k, text in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = leaks(docs, items).collect()
    assert {row["doc_id"] for row in found} == set(range(8))
    assert all(0.35 <= row["coverage"] <= 1 and row["windows"] >= row["matched"] for row in found)


def recall_of(rows, vectors, wanted=20):
    hits = total = 0
    found = rows.toPandas()
    for query, part in found.groupby("query_id"):
        scores = (vectors @ vectors[query]).round(12)
        scores[query] = -np.inf
        hits, total = hits + len(set(np.argsort(-scores, kind="stable")[:wanted].tolist()) & set(part["vec_id"])), total + wanted
    return hits / total


def around_centres(rows, seed):
    """Unit vectors around 60 centres."""
    chance = np.random.default_rng(seed)
    vectors = chance.normal(size=(60, 16))[chance.integers(0, 60, rows)] + 0.5 * chance.normal(size=(rows, 16))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def test_groups_of_copies_do_not_use_up_the_pivots(spark):
    vectors = around_centres(100, 1)[np.arange(6000) % 100]
    frame = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(vectors)], "vec_id long, embedding array<double>")
    asked = frame.where("vec_id >= 5900")
    assert recall_of(neighbours.nearest(frame, asked, pivots=32, prefix=16, share=0.05, least=300), vectors) >= 0.9


@pytest.mark.parametrize("sigma", [0.25, 1.0])
def test_neighbours_of_unequal_lengths(spark, sigma):
    vectors = around_centres(8000, 2) * np.exp(sigma * np.random.default_rng(3).normal(size=(8000, 1)))
    frame = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert recall_of(neighbours.nearest(frame, frame.where("vec_id % 100 = 0"), share=0.05, least=100), vectors) >= 0.9
