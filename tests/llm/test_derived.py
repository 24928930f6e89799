"""Fill-in-the-middle, whitening and toxicity."""
import hashlib
import random
import re

import compare
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lakevault.llm import fillmiddle, queries, toxicity, whitening

MIDDLE = "/root/testdata/sf0.01"
UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def cut_plainly(key, text):
    """The contract, with the list of all units."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNITS.findall(text)
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts(seed):
    chance = random.Random(seed)
    alphabet = ["a", "Zq", "word", " ", "\n", "\r\n", "é", "中", "😀", "é", "1", "<", "P>", "\x00", " "]
    texts = [None, "", " ", "a", "😀", "a" * 5000, "é" * 3000, "x <P> y", "<S>", "a<M>", "<P" + "a" * 2000 + ">", "ab" * 100_000 + "é" * 10_000]
    return texts + ["".join(chance.choices(alphabet, k=chance.choice([3, 40, 900, 4000]))) for _ in range(150)]


def test_cuts_are_those_of_the_list_of_units(spark):
    rows = list(enumerate(odd_texts(1))) + [(None, "one two"), (3, "other text"), (3, "other text"), (-7, "minus")]
    docs = spark.createDataFrame([(key, text, 9, "x") for key, text in rows], "doc_id long, text string, n int, output string")
    cut = fillmiddle.transform(docs.repartition(3))
    found = cut.withColumn("again", fillmiddle.restored(F.col("output"), F.col("form"))).collect()
    wanted = sorted(((key, *cut_plainly(key, text), text or "") for key, text in rows), key=repr)
    assert sorted((tuple(row) for row in found), key=repr) == wanted
    assert {row["form"] for row in found} == {"plain", "psm", "spm"}
    assert fillmiddle.transform(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_places_in_the_block_tree(block):
    for text in odd_texts(2)[:60]:
        text = (text or "")[:3000]
        units = UNITS.findall(text)
        tree = fillmiddle.BlockTree(text.encode(), block)
        assert (tree.units, tree.points) == (len(units), len(text))
        for unit in {0, 1, len(units) // 3, len(units) - 1, len(units), len(units) + 5}:
            if unit >= 0:
                before = "".join(units[:unit])
                assert tree.place(unit) == (len(before.encode()), len(before))


def test_marks_must_stay_apart():
    for marks in [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "ba", "x"), ("a", "bac", "x"), ("aba", "x", "y")]:
        with pytest.raises(ValueError):
            fillmiddle.check_marks(marks)
    fillmiddle.check_marks(("[pre]", "[suf]", "[mid]"))


def test_fill_middle_agrees_with_sql(spark):
    connection = compare.connect(SMALL)
    assert compare.difference(queries.op11_fill_middle(spark, SMALL), connection, queries.ORACLE["op11_fill_middle"]) is None


def whitened_plainly(vectors, components=4):
    """Contract by numpy's eigendecomposition: {(row, component): (n, deviation, |whitened|, explained)}."""
    kept = [(at, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for at, v in enumerate(vectors) if v and all(c is not None and np.isfinite(c) for c in v)]
    different = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(different), [sum(int(c) for c in column) for column in different.T]
    spread = np.cov(different.T, bias=True)
    values, basis = np.linalg.eigh(spread)
    out = {}
    for at, x in kept:
        for k in range(components):
            away = np.array([(n * c - s) / n for c, s in zip(x, sums)])
            out[at, k + 1] = (n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), abs(away @ basis[:, -1 - k]) / np.sqrt(values[-1 - k]), values[-1 - k] / values.sum())
    return out


def vectors_frame(spark, vectors):
    return spark.createDataFrame([(at, v, 1, [0.0]) for at, v in enumerate(vectors)], "vec_id long, embedding array<float>, n int, x array<double>")


@pytest.mark.parametrize("seed", [0, 1])
def test_whitening_is_that_of_the_whole_covariance(spark, seed):
    chance = np.random.default_rng(seed)
    vectors = (chance.normal(size=(400, 12)) @ chance.normal(size=(12, 12)) * 0.2).tolist()
    vectors += vectors[:50] * 5 + [None, [], [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [0.0] * 12, [-0.0] * 12, [1.0, 2.0]]
    wanted = whitened_plainly([v if v is None or len(v) == 12 else None for v in vectors])
    points = whitening.rounded(vectors_frame(spark, vectors).repartition(6))
    model = whitening.fit(points)
    rows = whitening.whiten(points, model).collect()
    assert len(rows) == len(wanted)
    signs = {}
    for row in rows:
        n, deviation, whitened, explained = wanted[row["vec_id"], row["component"]]
        assert (row["n"], int(row["deviation"])) == (n, deviation)
        assert abs(abs(row["whitened"]) - whitened) < 1e-9 and abs(row["explained"] - explained) < 1e-12 and row["identity_error"] < 1e-9
        if whitened > 1e-6:  # one sign for all copies of a vector
            assert signs.setdefault((tuple(vectors[row["vec_id"]]), row["component"]), np.sign(row["whitened"])) == np.sign(row["whitened"])
    assert model.basis.shape == (12, 4) and np.allclose(model.basis.T @ model.basis, np.eye(4), atol=1e-13)


def test_whitening_of_odd_tables(spark):
    def components(vectors):
        points = whitening.rounded(vectors_frame(spark, vectors))
        return whitening.whiten(points, whitening.fit(points)).collect()

    assert components([]) == [] and components([None, []]) == []
    assert components([[1.0, 2.0]] * 5) == []  # nothing varies
    line = components([[float(k), 2.0 * k, 0.0] for k in range(6)])
    assert len(line) == 6 and {row["component"] for row in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    # Products beyond 64 bits stay exact.
    wide = components([[1e9, 0.0], [-1e9, 3.0], [0.0, 5e8]])
    x = [[int(256e9), 0], [int(-256e9), 768], [0, int(128e9)]]
    sums = [sum(column) for column in zip(*x)]
    assert {int(row["deviation"]) for row in wide} == {sum((3 * c - s) ** 2 for c, s in zip(row, sums)) for row in x}


@pytest.mark.parametrize("kind", ["random", "copies", "flat", "wide", "equal"])
def test_rank_one_updates_give_the_scatter_matrix(kind):
    chance = np.random.default_rng(5)
    points = {
        "random": chance.integers(-60, 60, (200, 16)), "copies": np.repeat(chance.integers(-3, 3, (20, 16)), 10, 0),
        "flat": chance.integers(-1, 2, (150, 16)) * (np.arange(16) < 4), "wide": chance.integers(-(10**6), 10**6, (150, 16)) * 10 ** (np.arange(16) % 4),
        "equal": np.full((30, 16), 7),
    }[kind].astype(float)
    parts = [whitening.Spectrum.nothing(16) for _ in range(3)]
    for at, vector in enumerate(points):
        parts[at % 2].add(vector)
    total = whitening.Spectrum.nothing(16)
    for part in parts:
        total.merge(part)
    away = points - points.mean(0)
    size = max(1.0, np.abs(away.T @ away).max())
    assert total.count == len(points)
    assert np.abs(total.vectors * total.values @ total.vectors.T - away.T @ away).max() < 1e-11 * size
    assert np.abs(total.vectors.T @ total.vectors - np.eye(16)).max() < 1e-12


def test_whitening_of_the_table(spark):
    vectors = {row["vec_id"]: row["embedding"] for row in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    wanted = whitened_plainly([vectors[at] for at in ids])
    rows = queries.op12_whitening(spark, MIDDLE).collect()
    assert {(ids.index(row["vec_id"]), row["component"]) for row in rows} == wanted.keys()
    for row in rows:
        n, deviation, whitened, explained = wanted[ids.index(row["vec_id"]), row["component"]]
        assert (row["n"], row["deviation"]) == (n, deviation)
        assert abs(abs(row["whitened"]) - whitened) < 1e-8 and abs(row["explained"] - explained) < 1e-10 and row["identity_error"] < 1e-8


def test_folding():
    assert toxicity.fold("An 1d1ot, a $tup1d m0r0n!") == " an idiot a stupid moron "
    assert toxicity.fold("іdіоt  lò​ser") == " idiot loser "
    assert toxicity.fold("ｓｃｕｍ") == " scum "
    assert toxicity.fold("in 1999 it cost 35$ of$$$ 100 people") == " in it cost of people "
    assert toxicity.fold("") == toxicity.fold(" 12 !? ") == "  "


def test_entries_exceptions_and_length(spark):
    model = toxicity.train(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    filler = "plain words about the weather and the sea "
    texts = ["You idiot, you are pathetic", "You 1D10TS are pathеtic", "put it into the trash can please", filler * 50 + "idiot", None, "", "12 !?", "scumble and idi otic", filler * 2000]
    docs = spark.createDataFrame([(at, text, 5) for at, text in enumerate(texts)] + [(0, texts[0], 5)], "doc_id long, text string, score int")
    found = {row["doc_id"]: row for row in toxicity.score_toxicity(docs, model).collect()}
    assert [found[k]["predicted"] for k in range(len(texts))] == [1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert min(found[0]["score"], found[1]["score"]) > found[3]["score"] > found[8]["score"]
    assert found[4]["score"] == found[5]["score"] == found[6]["score"] == 0.0
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_all_entries_are_found_by_the_automaton():
    chance = random.Random(4)
    lexicon = {" ab": 1.0, " abc": 2.5, " b": 0.5, " cab ": 3.0}
    model = toxicity.ToxicityModel(lexicon, [" ab cab ", " b a "], np.zeros(3), 0.0)
    for _ in range(300):
        words = ["".join(chance.choices("abc", k=chance.randint(1, 4))) for _ in range(chance.randint(0, 12))]
        text = toxicity.fold(" ".join(words))
        spans = [(m.start(), m.start() + len(p) - 1) for p in model.exceptions for m in re.finditer(f"(?={p})", text)]
        wanted = []
        for at in range(len(text)):
            weights = [w for entry, w in lexicon.items() if text.startswith(entry, at)]
            if weights and not any(a <= at < b for a, b in spans):
                wanted.append((at, max(weights)))
        assert model.hits(text) == wanted


def test_toxicity_is_learned_from_beginnings_of_words_and_exceptions(spark):
    chance = random.Random(8)
    words = ["".join(chance.choices("abcdefghij", k=6)) for _ in range(400)]

    def text(bad):
        own = chance.choices(words, k=40)
        if bad:
            own[3:3] = ["zork" + chance.choice(words)[:3], "quz" + chance.choice(words)[:3]]
        elif chance.random() < 0.1:
            own[5:5] = ["zorkina", "garden"]
        return " ".join(own)

    rows = [(at, text(at % 4 == 0), int(at % 4 == 0)) for at in range(1200)]
    copied = [(2000 + at, rows[1][1] + f" w{at}", 0) for at in range(300)]  # near copies of a clean text
    table = spark.createDataFrame(rows + copied, "doc_id long, text string, toxic int")
    labels = table.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, toxic int"))
    model = toxicity.train(table.select("doc_id", "text"), labels)
    assert any(entry.startswith(" zork") for entry in model.lexicon) and any(entry.startswith(" quz") for entry in model.lexicon)
    assert " zorkina garden " in model.exceptions
    fresh = spark.createDataFrame([(at, text(at % 2 == 0)) for at in range(200)], "doc_id long, text string")
    assert all(row["predicted"] == (row["doc_id"] % 2 == 0) for row in toxicity.score_toxicity(fresh, model).collect())


def test_toxicity_of_held_out_texts(spark):
    folder = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op13_toxicity(spark, folder)
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = rows.where("held_out").join(truth, "doc_id").collect()
    assert len(held) > 700 and all(0 <= row["score"] <= 1 for row in held)
    assert np.mean([row["predicted"] == row["toxic"] for row in held]) > 0.98
    toxic = [row for row in held if row["toxic"]]
    assert np.mean([row["predicted"] for row in toxic]) > 0.9
