"""Similar groups and repeated passages against plain Python."""
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from lakevault.llm import jaccard, suffix
from lakevault.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def smallest_linked(nodes, links):
    least = {node: node for node in nodes}

    def find(node):
        while least[node] != node:
            node = least[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def texts_with_copies(seed):
    chance = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ä", "ß", "A", "a"]
    texts = [None, "", " \t\n", "one two", "One  TWO", "one two three"]
    for _ in range(12):
        base = [chance.choice(words) for _ in range(chance.randrange(5, 70))]
        for _ in range(chance.randrange(1, 12)):
            copy = list(base)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 5])):
                at = chance.randrange(len(copy))
                copy[at : at + chance.randrange(2)] = [chance.choice(words)]
            texts.append(chance.choice([" ", "\n", "  "]).join(copy))
    base = [f"x{k}" for k in range(120)]  # a chain: each step similar, the ends not
    for step in range(0, 60, 3):
        texts.append(" ".join([f"y{k}" for k in range(step)] + base[step:]))
    chance.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_groups_are_those_of_all_pairs(spark, seed):
    texts = texts_with_copies(seed)
    sets = [shingles(text) for text in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    wanted = smallest_linked(range(len(texts)), links)
    docs = spark.createDataFrame([(k, text, 7, 8) for k, text in enumerate(texts)], "doc_id long, text string, n long, component long").repartition(4)
    found = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in jaccard.similar_groups(docs).collect()}
    assert found == {k: (len(sets[k]), wanted[k]) for k in range(len(texts))}


def test_rows_without_id_and_rows_twice(spark):
    text = "a b c d e f g"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (9, text), (7, None)], "doc_id long, text string")
    rows = sorted(map(tuple, jaccard.similar_groups(docs).collect()), key=str)
    assert rows == sorted([(None, 3, None), (4, 3, 4), (4, 3, 4), (9, 3, 4), (7, 0, 7)], key=str)
    assert jaccard.similar_groups(docs.limit(0)).count() == 0


def test_several_texts_under_one_id(spark):
    chance = random.Random(3)
    a, b = ([f"{kind}{chance.randrange(10**6)}" for _ in range(60)] for kind in "ab")
    near = [" ".join(words[:30] + ["other"] + words[31:]) for words in (a, b)]
    docs = spark.createDataFrame([(1, " ".join(a)), (1, " ".join(b)), (2, near[0]), (3, near[1]), (None, near[0]), (8, "alone")], "doc_id long, text string")
    for part in (docs, docs.repartition(5)):
        found = sorted(((row["doc_id"], row["component_id"]) for row in jaccard.similar_groups(part).collect()), key=str)
        assert found == [(1, 1), (1, 1), (2, 1), (3, 1), (8, 8), (None, None)]
    # An id ties its texts together: 9 and 2 are reached over 5.
    tied = spark.createDataFrame([(5, " ".join(a)), (5, " ".join(b)), (2, near[0]), (9, near[1])], "doc_id long, text string")
    assert {row["component_id"] for row in jaccard.similar_groups(tied).collect()} == {2}


def test_large_groups_and_common_passages(spark):
    """Hundreds of near copies, and hundreds of unlike texts that share a passage: the right groups, and pairs in proportion."""
    chance = random.Random(9)
    base = [f"v{chance.randrange(10**6)}" for _ in range(150)]
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for k in range(300):
        copy = list(base)
        for at in chance.sample(range(150), 2):
            copy[at] = f"z{k}_{at}"
        texts.append(" ".join(copy))
    texts += [" ".join(passage + [f"u{k}_{j}" for j in range(60)]) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    sets = [shingles(text) for text in texts]
    links = [(i, j) for i in range(300) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    wanted = smallest_linked(range(600), links)
    assert {row["doc_id"]: row["component_id"] for row in jaccard.similar_groups(docs).collect()} == wanted


def test_components_of_random_graphs(spark):
    chance = random.Random(1)
    for size in (1, 60, 150):
        links = [(chance.randrange(200), chance.randrange(200)) for _ in range(size)] + [(k, k + 1) for k in range(300, 340)]
        wanted = smallest_linked({node for link in links for node in link if link[0] != link[1]}, links and [x for x in links if x[0] != x[1]])
        found = components(spark.createDataFrame(links + [(None, 3), (5, 5)], "a long, b long")).collect()
        assert {row["node"]: row["component"] for row in found} == wanted
        assert len(found) == len(wanted)


def without_repeats(docs):
    seen, result = {}, {}
    for key, text in sorted(docs, key=lambda doc: doc[0]):
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, int)
        for at in range(len(data) - 99):
            first = seen.setdefault(data[at : at + 100], (key, at))
            if first != (key, at):
                cover[at] += 1
                cover[at + 100] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
        result[key] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return result


def repetitive(seed):
    chance = random.Random(seed)
    noise = lambda n: "".join(chance.choices("abcdefghij é\n\0", k=n))
    passages = [noise(chance.randrange(90, 400)) for _ in range(6)] + ["ha " * 80, "z" * 300]
    docs = [None, "", noise(99), "z" * 5000, passages[0]]
    for _ in range(60):
        parts = []
        for _ in range(chance.randrange(1, 5)):
            passage = chance.choice(passages)
            start = chance.randrange(0, 60)
            parts += [noise(chance.randrange(0, 150)), passage[start : len(passage) - chance.randrange(0, 60)]]
        docs.append("".join(parts))
    docs += docs[10:20]
    chance.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed,hot,chunk", [(0, 20_000, 1 << 19), (1, 20_000, 700), (2, 3, 1 << 19)])
def test_repeats_are_those_of_all_strings(spark, monkeypatch, seed, hot, chunk):
    monkeypatch.setattr(suffix, "HOT", hot)
    docs = repetitive(seed)
    rows = spark.createDataFrame([(key, text, "x") for key, text in docs], "doc_id long, text string, kept string").repartition(3)
    found = {row["doc_id"]: (row["n_bytes"], row["n_removed"], row["n_spans"], hashlib.sha256(row["kept"]).hexdigest()) for row in suffix.remove_repeats(rows).collect()}
    assert found == without_repeats(docs)


def test_long_texts_are_cut_into_overlapping_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix, "CHUNK", 700)
    chance = random.Random(3)
    texts = ["".join(chance.choices("abc", k=size)) for size in (50, 100, 699, 700, 701, 5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    strings = set()
    for data, ids, begins, offsets in suffix.chunks(batch):
        _, _, start, many, owner = suffix.fragments(data, begins)
        for first, n, own in zip(start, many, owner):
            for at in range(first, first + n):
                place = (int(ids[own]), int(at - begins[own] + offsets[own]))
                assert data[at : at + 100].tobytes().decode() == texts[place[0]][place[1] : place[1] + 100]
                assert place not in strings
                strings.add(place)
    assert strings == {(k, at) for k, text in enumerate(texts) for at in range(len(text) - 99)}


@pytest.mark.parametrize("seed", range(4))
def test_run_index_finds_first_occurrences(seed):
    chance = random.Random(seed)
    alphabet = b"ab" if seed % 2 else bytes(range(100, 120)) + b"\0"
    pool = [bytes(chance.choices(alphabet, k=chance.randrange(80, 180))) for _ in range(4)]
    texts = []
    for _ in range(40):
        texts.append(bytes(chance.choices(alphabet, k=chance.randrange(60))) + chance.choice(pool)[chance.randrange(30) :] + bytes(chance.choices(alphabet, k=chance.randrange(40))))
    docs, starts = np.array([chance.randrange(6) for _ in texts]), np.arange(len(texts)) * 1000
    found = {(int(doc), int(start) + k) for doc, start, many in zip(*suffix.index_block(docs, starts, texts)) for k in range(many)}
    seen, wanted = set(), set()
    for at in sorted(range(len(texts)), key=lambda k: (docs[k], starts[k])):
        for place in range(len(texts[at]) - 99):
            string = texts[at][place : place + 100]
            if string in seen:
                wanted.add((int(docs[at]), int(starts[at]) + place))
            seen.add(string)
    assert found == wanted


def test_rows_without_id_and_empty_tables(spark):
    text = "".join(random.Random(8).choices("abcdefgh ", k=150))
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (5, None)], "doc_id long, text string").repartition(2)
    found = sorted(((row["doc_id"], row["n_removed"], row["n_spans"]) for row in suffix.remove_repeats(docs).collect()), key=str)
    assert found == sorted([(None, 0, 0), (3, 150, 1), (3, 150, 1), (5, 0, 0)], key=str)
    twice = docs.where("doc_id = 3")
    assert [(row["n_removed"], row["n_spans"]) for row in suffix.remove_repeats(twice).collect()] == [(0, 0)] * 2
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [20_000, 1])
def test_different_texts_under_null_and_equal_ids(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    chance = random.Random(9)
    noise = lambda n: "".join(chance.choices("abcdefghij klmnop", k=n))
    part, other = noise(150), noise(400)
    rows = [(None, part + noise(150) + part, 0), (None, "short text", 1), (None, other, 2), (None, other, 3), (5, noise(300), 4), (5, noise(80) + part, 5), (5, noise(20), 6), (-(2**63), noise(500), 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(3)
    found = {row["place"]: (row["n_bytes"], row["n_removed"]) for row in suffix.remove_repeats(docs).collect()}
    assert {place: size for place, (size, _) in found.items()} == {row[2]: len(row[1]) for row in rows}
    assert found[0][1] == 150 and sorted((found[2][1], found[3][1])) == [0, 400] and found[5][1] == 150
    assert found[1][1] == found[4][1] == found[6][1] == found[7][1] == 0


def test_suffixes_are_sorted_in_few_passes(monkeypatch):
    """Fragments of usual length take four sorts, one for ties, and none of their own for the ranks of LENGTH bytes."""
    rng, sorts = np.random.default_rng(5), []
    texts = [bytes(rng.integers(0, 3, int(size)).astype(np.uint8)) for size in rng.integers(90, 169, 30)] * 2
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(text) for text in texts])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    argsort, lexsort = np.argsort, np.lexsort
    monkeypatch.setattr(np, "argsort", lambda *by, **how: (sorts.append(1), argsort(*by, **how))[1])
    monkeypatch.setattr(np, "lexsort", lambda *by, **how: (sorts.append(1), lexsort(*by, **how))[1])
    order, rank = suffix.RunIndex.sort(data, left)
    assert len(sorts) <= 5
    suffixes = [data[at : at + size].tobytes() for at, size in enumerate(left.tolist())]
    assert order.tolist() == sorted(range(len(data)), key=lambda at: (suffixes[at], at))
    heads = [text[: suffix.LENGTH] for text in suffixes]
    place = {head: k for k, head in enumerate(sorted(set(heads)))}
    assert rank.tolist() == [place[head] for head in heads]


def test_index_takes_few_bytes_a_position():
    """Places and ranks are short numbers and a pass gives up those of the one before: executors hold several blocks at once."""
    rng = np.random.default_rng(11)
    texts = [rng.integers(0, 5, 160).astype(np.uint8).tobytes() for _ in range(700)] * 2
    data = np.frombuffer(b"".join(texts), np.uint8)
    borders = np.arange(len(texts) + 1) * 160
    tracemalloc.start()
    try:
        fragment, place, first = suffix.RunIndex(data, borders).earliest()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 * len(data)
    again = fragment >= 700
    assert len(fragment) == 1400 * 61 and (first[~again] == place[~again]).all() and (first[again] == place[again] - len(data) // 2).all()
